"""JDBC sinks (SNK-1..5).

Spark's JDBC writer only inserts. A keyed upsert is therefore done the
set-based way: reduce the batch to one row per key, write it in parallel to a
stage table, then run one ``MERGE`` / ``INSERT .. ON CONFLICT`` statement in
the database. The statement is idempotent, so a replayed micro-batch is safe.

Not run in this repository: no database may be started here, so the writes
are covered by statement-generation tests only.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from ..operators.upsert import latest_per_key
from ..options import JdbcOptions
from ..schemas import KEY, PROCESSED_COLUMNS, UPDATE_COLUMNS

DIALECTS = ("on_conflict", "merge")


def write_table(df: DataFrame, opts: JdbcOptions, table: str | None, mode: str) -> None:
    """Parallel JDBC write: each task opens its own connection and sends
    ``batchsize`` rows per round trip."""
    df.write.format("jdbc").options(**opts.writer_options(table)).mode(mode).save()


def append_jdbc(batch: DataFrame, opts: JdbcOptions, table: str | None = None) -> None:
    """Per-batch append of every row (SNK-1). Not idempotent: a replayed
    micro-batch appends again, so use ``upsert_jdbc`` where that matters."""
    write_table(batch, opts, table, "append")


def upsert_statement(
    target: str,
    stage: str,
    *,
    key: str = KEY,
    columns: Sequence[str] = PROCESSED_COLUMNS,
    update: Sequence[str] = UPDATE_COLUMNS,
    dialect: str = "on_conflict",
) -> str:
    """One set-based upsert from ``stage`` into ``target``. Columns not in
    ``update`` (e.g. ``created_at``) keep their first value."""
    cols = ", ".join(columns)
    if dialect == "on_conflict":
        sets = ", ".join(f"{c} = EXCLUDED.{c}" for c in update)
        return f"INSERT INTO {target} ({cols}) SELECT {cols} FROM {stage} ON CONFLICT ({key}) DO UPDATE SET {sets}"
    if dialect == "merge":
        sets = ", ".join(f"{c} = s.{c}" for c in update)
        vals = ", ".join(f"s.{c}" for c in columns)
        return (
            f"MERGE INTO {target} t USING {stage} s ON t.{key} = s.{key} "
            f"WHEN MATCHED THEN UPDATE SET {sets} "
            f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals})"
        )
    raise ValueError(f"dialect must be one of {DIALECTS}")


def with_retries(fn: Callable[[], None], max_retries: int = 5, backoff_s: float = 0.2) -> None:
    """Run an idempotent write, retrying up to ``max_retries`` times (SNK-5)."""
    for attempt in range(max_retries + 1):
        try:
            fn()
            return
        except Exception:
            if attempt == max_retries:
                raise
            time.sleep(backoff_s * (2**attempt))


def execute_statement(batch: DataFrame, opts: JdbcOptions, sql: str) -> None:
    """Run one statement in the database from the driver (through the JVM's
    JDBC driver manager); the data itself never passes through the driver."""
    jvm = batch.sparkSession.sparkContext._jvm
    if opts.driver:
        # A driver added with spark.jars is visible to the context class loader
        # only; loading it registers it with the driver manager.
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        jvm.java.lang.Class.forName(opts.driver, True, loader)
    conn = jvm.java.sql.DriverManager.getConnection(opts.url, opts.user, opts.password)
    try:
        stmt = conn.createStatement()
        stmt.executeUpdate(sql)
        stmt.close()
    finally:
        conn.close()


def stage_name(table: str, stream: str, batch_id: int) -> str:
    """A stage table of its own for each stream and batch."""
    return f"{table}_stage_{hashlib.sha256(stream.encode()).hexdigest()[:10]}_{int(batch_id)}"


def upsert_jdbc(
    batch: DataFrame,
    opts: JdbcOptions,
    batch_id: int,
    *,
    order: str | Sequence[str] = "offset",
    dialect: str = "on_conflict",
    stream: str = "",
) -> None:
    """Keyed upsert of one micro-batch (SNK-2): latest per key (one statement
    may not see a key twice), parallel write to a stage table, one set-based
    statement, stage dropped. Rerunning the whole step is safe. ``stream`` (the
    stream's checkpoint) keeps the stages of two streams into one table apart.
    Columns beyond the processed ones, such as an engine tag, are upserted too."""
    stage = stage_name(opts.table, stream, batch_id)
    arrival = [order] if isinstance(order, str) else list(order)
    extra = [c for c in batch.columns if c not in (*PROCESSED_COLUMNS, *arrival)]
    columns = (*PROCESSED_COLUMNS, *extra)
    reduced = latest_per_key(batch, KEY, order).select(*columns)
    statement = upsert_statement(opts.table, stage, columns=columns, update=(*UPDATE_COLUMNS, *extra), dialect=dialect)

    def run() -> None:
        write_table(reduced, opts, stage, "overwrite")
        execute_statement(batch, opts, statement)
        execute_statement(batch, opts, f"DROP TABLE {stage}")

    with_retries(run, opts.max_retries)
