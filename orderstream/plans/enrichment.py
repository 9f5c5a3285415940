"""The order-enrichment step as one composed plan:

``topic records -> [split_rows] -> decode -> enrich -> split_valid``

All narrow: no shuffle until a keyed sink. Works on batch and streaming
DataFrames.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..operators.decode import decode_json, malformed, split_rows
from ..operators.enrich import enrich
from ..operators.quality import split_valid
from ..schemas import FILL_MISSING, RAW_ORDER, RAW_ORDER_UNROUNDED


@dataclass(frozen=True)
class PipelineOptions:
    mode: str = "drop_malformed"
    split_lines: bool = False
    fill_missing: Mapping[str, object] | None = field(default_factory=lambda: dict(FILL_MISSING))
    null_numbers: str = "drop"
    coerce_numbers: bool = False
    ts_format: str = "iso"
    ts_precision: str = "us"
    rounding: str = "exact"
    null_status: str = "keep"
    at: dt.datetime | str | None = None
    keep: Sequence[str] = ("offset",)
    # The message fields. By default the price keeps its digits in the modes that
    # round the total; stored money is decimal(10,2) either way.
    schema: T.StructType | None = None

    @property
    def message_schema(self) -> T.StructType:
        if self.schema is not None:
            return self.schema
        return RAW_ORDER if self.rounding == "exact" else RAW_ORDER_UNROUNDED


def _decode_kwargs(o: PipelineOptions, keep: tuple[str, ...]) -> dict:
    return dict(
        schema=o.message_schema,
        keep=keep,
        fill_missing=o.fill_missing,
        coerce_numbers=o.coerce_numbers,
        ts_format=o.ts_format,
        ts_precision=o.ts_precision,
        null_numbers=o.null_numbers,
    )


def process(records: DataFrame, opts: PipelineOptions = PipelineOptions()) -> DataFrame:
    """Topic records -> processed orders (before the constraint check)."""
    df = records
    keep = tuple(opts.keep)
    if opts.split_lines:
        df = split_rows(df)
        keep = (*keep, "line")
    decoded = decode_json(df, opts.mode, **_decode_kwargs(opts, keep))
    return enrich(
        decoded,
        rounding=opts.rounding,
        at=opts.at,
        ts_precision=opts.ts_precision,
        null_status=opts.null_status,
        keep=keep,
    )


def process_split(records: DataFrame, opts: PipelineOptions = PipelineOptions()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(valid, rejected, malformed)``: rows fit for the store, rows that
    decoded but break a store constraint (with reasons), and messages the
    decode policy dropped (with the text). Each output reads ``records``
    again; persist it first when writing all three (``OrderBatchJob`` does
    this per micro-batch)."""
    valid, rejected = split_valid(process(records, opts))
    df = split_rows(records) if opts.split_lines else records
    keep = (*opts.keep, "line") if opts.split_lines else tuple(opts.keep)
    bad = malformed(df, opts.mode, **_decode_kwargs(opts, keep))
    return valid, rejected, bad
