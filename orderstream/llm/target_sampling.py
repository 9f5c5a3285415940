"""Importance resampling towards a target distribution (operator 13).

A text's features are its runs of one to three words. Their CRC-32 modulo
``BUCKETS`` gives the buckets whose counts over the corpus and over the target make
a bucket's gain, the (floored, per mille) log ratio of the smoothed shares. A
document's weight is the sum of its features' gains; with seeded Gumbel noise on
top, the highest scores are a sample without replacement.

The checksums come from length-bucketed matrices: the distinct features of a block
of text are grouped by their length in bytes, each group is one uint8 matrix (a row
for each byte place), all of its checksums are updated together place by place, and
the results are scattered back to the features. A feature longer than ``LANE`` bytes
is dealt to several rows of a matrix of ``LANE`` places (zeros in front change
nothing once the register's start value is folded into the first four bytes), and
the rows' checksums are put together by the linear map "``LANE`` zero bytes on".

Spark reads the texts twice (counts, then weights). A task sends at most ``BUCKETS``
counts, and the ``BUCKETS`` gains are all that goes through the driver. Ranks come
from a range partitioning of the narrow scores, stored once, and the sizes of its
parts: no task holds more than its part.

Edge cases: NULL or blank text has no features, weight 0, and is never drawn; nor is
any text of fewer than ``MIN_WORDS`` words. A NULL doc_id draws the noise of the
text ``null`` and loses ties. Repeated rows are separate documents of equal score,
ranked one after the other. Without target texts every t is 0. Extra columns are
ignored by ``score`` and carried by ``resample``. An empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .word_bytes import blocks, byte_table, words_of

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
SEED = 42
#: Words taken at once, and the longest feature that is one row of a matrix.
WORDS_AT_ONCE = 400_000
LANE = 256
_SPACE = 0x20
_WORD_BYTES = byte_table(digits=True)


def _crc_table() -> np.ndarray:
    """Of the reflected polynomial of CRC-32."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_TABLE = _crc_table()
_ONES = np.uint32(0xFFFFFFFF)


def _run(matrix: np.ndarray, register: np.ndarray) -> np.ndarray:
    """Registers after the bytes of ``matrix``, one row for each byte place."""
    for place in matrix:
        register = _TABLE[(register ^ place) & np.uint32(0xFF)] ^ (register >> np.uint32(8))
    return register


def _lane_map() -> np.ndarray:
    """By byte place and byte of a register: the register ``LANE`` zero bytes on."""
    ones = (np.arange(256, dtype=np.uint32)[None, :] << (np.uint32(8) * np.arange(4, dtype=np.uint32)[:, None])).astype(np.uint32)
    return _run(np.zeros((LANE, 1), np.uint8), ones.ravel()).reshape(4, 256)


_ON = _lane_map()


def _long_crc(data: np.ndarray) -> int:
    """Of one feature longer than ``LANE`` bytes."""
    lanes = -(-len(data) // LANE)
    padded = np.zeros(lanes * LANE, np.uint8)
    padded[-len(data) :] = data
    first = lanes * LANE - len(data)
    padded[first : first + 4] ^= 0xFF  # the register's start value
    parts = _run(padded.reshape(lanes, LANE).T, np.zeros(lanes, np.uint32))
    register = 0
    for part in parts.tolist():
        register = part ^ int(_ON[0][register & 255] ^ _ON[1][register >> 8 & 255] ^ _ON[2][register >> 16 & 255] ^ _ON[3][register >> 24])
    return register ^ 0xFFFFFFFF


def crc32s(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC-32 of each slice of ``data``, by matrices of equal length."""
    out = np.empty(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, cuts) if len(order) else ():
        length = int(lengths[group[0]])
        if length > LANE:
            out[group] = [_long_crc(data[s : s + length]) for s in starts[group]]
        elif length:
            matrix = np.lib.stride_tricks.sliding_window_view(data, length)[starts[group]]
            out[group] = _run(np.ascontiguousarray(matrix.T), np.full(len(group), _ONES)) ^ _ONES
        else:
            out[group] = 0
    return out


def feature_buckets(data: np.ndarray, starts: np.ndarray, ids: np.ndarray, doc: np.ndarray, first: int, last: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the features that begin at the words first..last-1.
    ``data`` holds the words joined by single spaces, word i at ``starts[i]``."""
    stop = min(len(ids), last + 2)
    own, word = doc[first:stop], ids[first:stop]
    begin, ends = starts[first:stop], starts[first + 1 : stop + 1] - 1
    codes, uniques = pd.factorize(word)
    n, size = last - first, len(uniques)
    rows, wheres, spans, froms, base = [], [], [], [], 0
    gram = codes.astype(np.int64)
    for k in (1, 2, 3):
        count = min(n, len(word) - k + 1)
        if count <= 0:
            break
        if k > 1:
            # Up to the last place that has k words: longer runs extend it.
            gram, _ = pd.factorize(gram[: len(word) - k + 1] * size + codes[k - 1 :])
        keep = np.flatnonzero(own[:count] == own[k - 1 : count + k - 1])
        seen = gram[:count][keep]
        where = np.full(int(gram.max()) + 1 if len(gram) else 0, -1, np.int64)
        where[seen[::-1]] = keep[::-1]  # a place of each distinct feature
        found = np.flatnonzero(where >= 0)
        number = np.empty(len(where), np.int64)
        number[found] = np.arange(len(found)) + base
        base += len(found)
        rows.append(own[:count][keep])
        wheres.append(number[seen])
        froms.append(begin[where[found]])
        spans.append(ends[where[found] + k - 1] - begin[where[found]])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    distinct = crc32s(data, np.concatenate(froms), np.concatenate(spans)) % np.uint32(buckets)
    return np.concatenate(rows), distinct.astype(np.int64)[np.concatenate(wheres)]


def _features(text: pa.Array, buckets: int) -> Iterator[tuple[int, int, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """By block of rows: first row, row after the last, words of each row, and
    the (row, bucket) pairs of its features piece by piece."""
    for low, high, data, offsets in blocks(text):
        words = words_of(data, offsets, _WORD_BYTES)
        lengths = np.diff(words.starts)
        spaced = np.full(len(words.data) + len(words), _SPACE, np.uint8)
        inside = np.ones(len(spaced), bool)
        starts = words.starts + np.arange(len(words) + 1)
        inside[starts[1:] - 1] = False
        spaced[inside] = words.data
        ids, _ = words.encoded() if len(lengths) else (np.zeros(0, np.int64), None)
        pieces = (
            feature_buckets(spaced, starts, ids, words.doc, a, min(len(words), a + WORDS_AT_ONCE), buckets)
            for a in range(0, len(words), WORDS_AT_ONCE)
        )
        yield low, high, np.bincount(words.doc, minlength=words.rows), pieces


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all features of ``text``; buckets without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, pieces in _features(batch.column(0), buckets):
                for _, found in pieces:
                    total += np.bincount(found, minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of each bucket; all that is collected are ``buckets`` counts."""
    s, t = (dict((r.bucket, r.n) for r in bucket_counts(x, buckets).collect()) for x in (docs, target))
    all_s, all_t = sum(s.values()), sum(t.values())
    return [
        math.floor(1000 * math.log(float(t.get(b, 0) + 1) * (all_s + buckets) / (float(s.get(b, 0) + 1) * (all_t + buckets))))
        for b in range(buckets)
    ]


def weigh(docs: DataFrame, gain: list[int], text: str = "text") -> DataFrame:
    """``docs`` without the text, with _words, _features and _weight added."""
    by_bucket = np.array(gain, np.int64)
    carried = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, n_words, pieces in _features(batch.column(0), len(by_bucket)):
                n = np.zeros(high - low, np.int64)
                weight = np.zeros(high - low, np.int64)
                for row, found in pieces:
                    n += np.bincount(row, minlength=high - low)
                    # Sums of whole numbers below 2**53 are exact.
                    weight += np.bincount(row, by_bucket[found], high - low).astype(np.int64)
                rest = batch.slice(low, high - low).columns[1:]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(n_words), pa.array(n), pa.array(weight)], names)

    names = [*carried, "_words", "_features", "_weight"]
    kept = docs.select(text, *carried)
    added = "_words long, _features long, _weight long"
    schema = kept.select(*carried).schema
    for part in added.split(", "):
        schema = schema.add(*part.split(" "))
    return kept.mapInArrow(run, schema)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Seeded Gumbel noise in whole thousandths."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` (with _words and _score) and ``_rank``, NULL if not drawn."""
    fit = F.col("_words") >= min_words
    order = [fit.desc(), F.col("_score").desc(), F.col("doc_id").asc_nulls_last()]
    # Stored: range partitioning reads its input twice, and a row keeps its place.
    scored = stored(scored, "sampling_weights")
    placed = scored.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = stored(placed, "sampling_scores").withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), F.count(F.when(fit, 1)).alias("_fit"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.expr(f"{int(percent)} * sum(_fit) over (order by _part rows between unbounded preceding and unbounded following) div 100").alias("_drawn"),
    )
    # One row for each partition of the stored scores.
    joined = placed.join(F.broadcast(parts), F.col("_part") == F.col("_p"))
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return joined.withColumn("_rank", F.when(fit & (rank <= F.col("_drawn")), rank)).drop("_at", "_part", "_p", "_before", "_drawn")


def score(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED, min_words: int = MIN_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank (NULL: not drawn)."""
    weighed = weigh(docs.select("text", "doc_id"), gains(docs, target, buckets))
    scored = weighed.withColumn("_score", F.col("_weight") + noise(F.col("doc_id"), seed))
    return ranked(scored, percent, min_words).select(
        "doc_id", F.col("_features").alias("n_features"), F.col("_weight").alias("weight"),
        F.col("_score").alias("score"), F.col("_rank").cast("long").alias("rank"),
    )


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED, min_words: int = MIN_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """The drawn documents with the columns of ``docs``."""
    renamed = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(docs.columns)], F.monotonically_increasing_id().alias("_row"))
    numbered = stored(renamed, "sampling_documents")
    name = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    narrow = numbered.select(F.col(name["text"]).alias("text"), F.col(name["doc_id"]).alias("doc_id"), "_row")
    weighed = weigh(narrow, gains(docs, target, buckets))
    scored = weighed.withColumn("_score", F.col("_weight") + noise(F.col("doc_id"), seed))
    drawn = ranked(scored, percent, min_words).filter("_rank is not null").select("_row")
    return numbered.join(drawn, "_row", "left_semi").select(*[F.col(v).alias(k) for k, v in name.items()])
