"""Compact a keyed table: fold its base and log into a new base.

    python -m orderstream.compact --log /shared/processed --base /shared/base-3 --out /shared/base-4

The stream then continues with a fresh log on top of the new base
(``KeyedTable(new_log, base=out)``); the old log and base are left in place
for the operator to retire.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from .sinks.files import KeyedTable


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> str:
    p = argparse.ArgumentParser(prog="orderstream.compact", description="Fold a keyed table's base and log into a new base.")
    p.add_argument("--log", required=True, help="the keyed table's log folder")
    p.add_argument("--base", help="its current base, if any")
    p.add_argument("--out", required=True, help="where to write the new base (must not exist)")
    a = p.parse_args(argv)
    spark = spark or SparkSession.builder.appName("orderstream-compact").getOrCreate()
    KeyedTable(a.log, base=a.base).compact(spark, a.out)
    return a.out


if __name__ == "__main__":
    main()
