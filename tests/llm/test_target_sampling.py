import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderstream.llm import target_sampling, word_bytes

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [" ".join(w[i : i + k]).encode() for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(rows, target, percent=5, seed=42, min_words=20, buckets=10_000):
    """(n_features, weight, score) of each row, and the drawn rows in order."""
    bucket = lambda f: zlib.crc32(f) % buckets
    s = Counter(bucket(f) for _, text in rows for f in features(text)[1])
    t = Counter(bucket(f) for text in target for f in features(text)[1])
    total, aim = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * total / ((s[b] + 1) * aim)))
    out, fit = [], []
    for at, (i, text) in enumerate(rows):
        n, found = features(text)
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in found)
        out.append((len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
        if n >= min_words:
            fit.append((-out[-1][2], i is None, i or 0, at))
    return out, [at for *_, at in sorted(fit)][: percent * len(fit) // 100]


def texts():
    rows = []
    for i in range(150):
        words = ["Abc", "ünïcode", "x9", "É", "tail", "deep", "Sea", "日本語"]
        rows.append((None if i % 41 == 7 else i, " ".join(words[(i * k + k * k) % 8] + ("," if k % 5 == i % 5 else "") for k in range(i % 60))))
    rows += [(200, None), (201, ""), (202, " \n\t--"), (203, "A" * 3000 + " b"), (204, "é" * 700 + "\x00" + "z" * 256 + " " + "z" * 257)]
    rows += [(205, "same words over and over again " * 8), (205, "same words over and over again " * 8)]
    return rows


TARGET = ["Deep sea abc", None, "", "tail tail TAIL x9", "日本語 é"]


@pytest.mark.parametrize("percent, block, piece", [(5, 8_000_000, 400_000), (40, 500, 7), (100, 1, 1)])
def test_against_brute_force(spark, docs, monkeypatch, percent, block, piece):
    monkeypatch.setattr(word_bytes.blocks, "__defaults__", (block,))
    monkeypatch.setattr(target_sampling, "WORDS_AT_ONCE", piece)
    rows = texts()
    target = spark.createDataFrame([(x,) for x in TARGET], "text string")
    got = target_sampling.score(docs(rows), target, percent).collect()
    want, drawn = brute(rows, TARGET, percent)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=key) == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=key)
    by_rank = {r["rank"]: r.doc_id for r in got if r["rank"] is not None}
    assert [by_rank[k + 1] for k in range(len(by_rank))] == [rows[at][0] for at in drawn]


@pytest.mark.parametrize("lane", [4, 8, 256])
def test_checksums(monkeypatch, lane):
    monkeypatch.setattr(target_sampling, "LANE", lane)
    monkeypatch.setattr(target_sampling, "_ON", target_sampling._lane_map())
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 20_000, dtype=np.uint8)
    lengths = np.concatenate([np.arange(0, 40), rng.integers(1, 60, 300), [255, 256, 257, 511, 512, 513, 9000]])
    starts = np.array([rng.integers(0, len(data) - n + 1) for n in lengths])
    got = target_sampling.crc32s(data, starts, lengths)
    assert got.tolist() == [zlib.crc32(data[s : s + n].tobytes()) for s, n in zip(starts, lengths)]


def test_ranks_over_many_parts(spark):
    """Ties of a third of all rows; every part of the range partitioning counts."""
    scored = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 7 == 0, 3).otherwise(50).alias("_words"),
        F.when(F.col("id") % 3 == 0, 11).otherwise(F.col("id") * 7919 % 1000).alias("_score"),
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = target_sampling.ranked(scored, 40, 20).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    fit = sorted((r for r in rows if r._words >= 20), key=lambda r: (-r._score, r.doc_id))
    count = 40 * len(fit) // 100
    assert [r._rank for r in fit] == [*range(1, count + 1), *[None] * (len(fit) - count)]
    assert all(r._rank is None for r in rows if r._words < 20) and len(rows) == 3000


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "text string")
    assert target_sampling.score(docs([]), none).count() == 0
    rows = [(1, None), (2, "a b")]
    got = {r.doc_id: (r.n_features, r.weight, r["rank"]) for r in target_sampling.score(docs(rows), none).collect()}
    want, _ = brute(rows, [])
    assert got == {1: (0, 0, None), 2: (3, want[1][1], None)}


def test_resample_carries_all_columns(spark, docs):
    rows = texts()
    target = spark.createDataFrame([(x,) for x in TARGET], "text string")
    frame = docs(rows).withColumns({"_words": F.lit("w"), "_weight": F.lit(None).cast("string"), "_row": F.lit(1), "rank": F.lit(2)})
    got = target_sampling.resample(frame, target, 40)
    _, drawn = brute(rows, TARGET, 40)
    assert got.columns == frame.columns
    assert sorted(((r.doc_id or 0, r.text) for r in got.collect())) == sorted((rows[at][0] or 0, rows[at][1]) for at in drawn)
