"""Hot-key probe: put ~40% of the events on one order id and report, from
Spark's event log, how many rows cross each key shuffle (and the largest
per-task read). Usage: python tests/skew_probe.py <scratch dir> [sf_dir]"""

from __future__ import annotations

import collections
import glob
import json
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def run(log_dir: str, sf_dir: str) -> None:
    os.environ["PYSPARK_SUBMIT_ARGS"] = f"--conf spark.eventLog.enabled=true --conf spark.eventLog.dir={log_dir} pyspark-shell"
    from pyspark.sql import functions as F

    from orderstream.operators import empty_snapshot, latest_per_key, upsert_snapshot
    from orderstream.plans import PipelineOptions, process
    from orderstream.session import local_session, scratch_path
    from orderstream.sinks import KeyedTable
    from orderstream.sources import events_topic, read_table

    spark = local_session(8)
    p = process(events_topic(read_table(spark, sf_dir, "events", partitions=8)), PipelineOptions(at="2024-06-01 00:00:00"))
    hot = p.withColumn("order_id", F.when(F.col("status").isin("VIEW", "CLICK"), F.lit("HOT")).otherwise(F.col("order_id")))
    steps = {
        "latest_per_key": lambda: latest_per_key(hot).write.format("noop").mode("overwrite").save(),
        "upsert_snapshot": lambda: upsert_snapshot(empty_snapshot(hot), hot).write.format("noop").mode("overwrite").save(),
        "keyed_write": lambda: KeyedTable(scratch_path(spark, "skew")).write_batch(hot, 0),
    }
    for name, step in steps.items():
        spark.sparkContext.setJobGroup(name, name)
        step()
    spark.stop()


def report(log_dir: str) -> None:
    import zstandard

    path = glob.glob(f"{log_dir}/*/events_*")[0]
    raw = open(path, "rb").read()
    text = zstandard.ZstdDecompressor().stream_reader(open(path, "rb")).read().decode() if path.endswith(".zstd") else raw.decode()
    group, reads = {}, collections.defaultdict(list)
    for line in text.splitlines():
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            for s in e["Stage IDs"]:
                group[s] = (e.get("Properties") or {}).get("spark.jobGroup.id")
        elif e["Event"] == "SparkListenerTaskEnd":
            n = ((e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            if n and group.get(e["Stage ID"]):
                reads[(group[e["Stage ID"]], e["Stage ID"])].append(n)
    for (name, stage), v in sorted(reads.items(), key=lambda x: x[0][1]):
        print(f"{name} stage {stage}: {len(v)} tasks, {sum(v)} rows read, largest task {max(v)}")


if __name__ == "__main__":
    log_dir = sys.argv[1]
    run(log_dir, sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1")
    report(log_dir)
