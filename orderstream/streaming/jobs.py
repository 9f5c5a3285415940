"""``foreachBatch`` functions for the order pipeline.

Each decodes a micro-batch once (the annotated decode is persisted when more
than one job reads it), then writes valid rows to the target, constraint
violations and undecodable messages to dead-letter tables. All writes are
keyed by ``batch_id``, so a replay after failure overwrites, never duplicates.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.decode import accepted, annotate, apply_mode, rejected_by_mode, split_rows
from ..operators.enrich import enrich
from ..operators.quality import split_valid
from ..plans.enrichment import PipelineOptions
from ..schemas import PROCESSED_COLUMNS, UPDATE_COLUMNS
from ..sinks.files import KeyedTable, append_sorted, claim, write_rejected


@dataclass
class OrderBatchJob:
    """Decode, enrich, check and write one micro-batch.

    ``target`` is ``"sorted"`` (append-only table at ``path``, sorted by order
    id and processing time, every version kept), ``"keyed"`` (last arrival
    wins, ``created_at`` from the first) or any ``(valid, batch_id)`` writer,
    e.g. a JDBC upsert. With ``report`` set, every message is accounted for:
    messages = malformed + rows without a status where those are dropped +
    rejected + valid. A writer must then execute the frame it is given: the
    report waits for the metrics observed while it runs."""

    path: str | None = None
    target: str | Callable[[DataFrame, int], None] = "sorted"
    rejected_path: str | None = None
    malformed_path: str | None = None
    opts: PipelineOptions = PipelineOptions()
    created_value: Column | None = None
    report: Callable[[int, dict], None] | None = None
    tag: Callable[[DataFrame], DataFrame] | None = None
    # The stream's checkpoint; when set, the job claims its tables on the
    # first batch so a stream on another checkpoint cannot overwrite them.
    owner: str | None = None
    _claimed: bool = False

    def outputs(self, batch: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        o = self.opts
        df = split_rows(batch) if o.split_lines else batch
        keep = (*o.keep, "line") if o.split_lines else tuple(o.keep)
        # The message text is carried only when undecodable messages are kept.
        carry = ("value",) if self.malformed_path else ()
        annotated = annotate(
            df,
            schema=o.message_schema,
            keep=(*keep, *carry),
            fill_missing=o.fill_missing,
            coerce_numbers=o.coerce_numbers,
            ts_format=o.ts_format,
            ts_precision=o.ts_precision,
            null_numbers=o.null_numbers,
        )
        # Decode once when more than one job reads the decoded batch: dead
        # letters, or the sorted sink (its range partitioning samples the
        # batch in a job of its own), or the report. Blocks that do not fit in
        # memory go to disk; lost ones are recomputed from the replayable source.
        if self.rejected_path or self.malformed_path or self.report or self.target == "sorted":
            annotated = annotated.persist(StorageLevel.MEMORY_AND_DISK)
        decoded = apply_mode(annotated, o.mode).drop(*carry)
        processed = enrich(decoded, rounding=o.rounding, at=o.at, ts_precision=o.ts_precision, null_status=o.null_status, keep=keep)
        valid, rejected = split_valid(self.tag(processed) if self.tag else processed)
        bad = rejected_by_mode(annotated, o.mode, keep=keep) if self.malformed_path else None
        return annotated, valid, rejected, bad

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.owner and not self._claimed:
            paths = [p for p in (self.path if isinstance(self.target, str) else None, self.rejected_path, self.malformed_path) if p]
            for p in paths:
                claim(batch.sparkSession, p, self.owner)
            self._claimed = True
        annotated, valid, rejected, bad = self.outputs(batch)
        obs = Observation(f"orders_{batch_id}") if self.report else None

        def observe(df: DataFrame) -> DataFrame:
            if obs is None:
                return df
            return df.observe(obs, F.count(F.lit(1)).alias("valid_rows"), F.sum("total_price").alias("total_amount"))

        try:
            if callable(self.target):
                self.target(observe(valid), batch_id)
            elif self.target == "sorted":
                append_sorted(valid, self.path, batch_id, observe=observe)
            elif self.target == "keyed":
                order = (*self.opts.keep, "line") if self.opts.split_lines else tuple(self.opts.keep)
                extra = [c for c in valid.columns if c not in (*PROCESSED_COLUMNS, *order)]
                table = KeyedTable(self.path, order=order, columns=(*UPDATE_COLUMNS, *extra))
                table.write_batch(valid, batch_id, self.created_value, observe=observe)
            else:
                raise ValueError(f"unknown target {self.target!r}")
            if self.rejected_path:
                write_rejected(rejected, self.rejected_path, batch_id)
            if self.malformed_path:
                write_rejected(bad, self.malformed_path, batch_id)
            if obs is not None:
                self.report(batch_id, self._accounts(annotated, dict(obs.get)))
        finally:
            annotated.unpersist()

    def _accounts(self, annotated: DataFrame, written: dict) -> dict:
        """Counts of one micro-batch, from its persisted decode."""
        keeps = accepted(self.opts.mode)
        no_status = keeps & F.col("status").isNull() & F.lit(self.opts.null_status == "drop")
        seen = annotated.agg(
            F.count(F.lit(1)).alias("messages"), F.count_if(~keeps).alias("malformed"), F.count_if(no_status).alias("no_status")
        ).first()
        valid = written["valid_rows"]
        rejected = seen["messages"] - seen["malformed"] - seen["no_status"] - valid
        return {**written, **seen.asDict(), "rejected": rejected}
