import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderstream.llm import near_dedup


def shingle_set(text, words):
    parts = re.findall(r"[^ \t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not parts:
        return set()
    n = min(words, len(parts))
    return {tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)}


def brute(rows, words, percent):
    sets = [shingle_set(t, words) for _, t in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and part[i] != part[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                old = part[j]
                part = [part[i] if p == old else p for p in part]
    low = {}
    for (i, _), p in zip(rows, part, strict=True):
        if i is not None:
            low[p] = min(i, low.get(p, i))
    return sorted((repr(i), len(s), repr(low.get(p)), i == low.get(p)) for (i, _), s, p in zip(rows, sets, part, strict=True))


def corpus(seed, n=260):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocab) for _ in range(60)] for _ in range(4)]
    passage = [rng.choice(vocab) for _ in range(40)]
    out = []
    for i in range(n):
        kind = i % 5
        if kind < 3:  # near copies with a spread of edits, some of them shared
            w = list(base[kind])
            for _ in range(rng.randrange(8)):
                at = rng.randrange(len(w))
                w[at : at + 1] = rng.choice([[], [rng.choice(vocab[:6])], [w[at], "ins"], ["X", "y"]])
        elif kind == 3:
            w = passage + [rng.choice(vocab) for _ in range(rng.randrange(40))]
        else:
            w = [rng.choice(vocab) for _ in range(rng.randrange(50))]
        out.append((i, " ".join(w)))
    out += [(None, " ".join(base[0])), (None, None), (900, ""), (901, " \n"), (902, "a"), (903, "A  b"), (904, "a b"), (905, "a"), (5, out[5][1]), (906, out[10][1] + "\t")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("words, percent, limit", [(3, 85, 10**6), (5, 80, 900)])
def test_components_against_all_pairs(docs, words, percent, limit):
    rows = corpus(words)
    got = near_dedup.classify(docs(rows).withColumnRenamed("lang", "node").repartition(3), words, percent, limit).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id), r.kept) for r in got) == brute(rows, words, percent)


def test_local_links_find_every_component():
    rng = np.random.default_rng(2)
    for case in range(60):
        core = rng.choice(10_000, 60, replace=False)
        members = []
        for _ in range(rng.integers(2, 60)):
            keep = core[rng.random(60) > rng.choice([0.02, 0.08, 0.2])]
            extra = rng.choice(30 if case % 2 else 9_000, rng.integers(0, 8), replace=False) + 20_000
            members.append(np.unique(np.concatenate([keep, extra])))
        percent = 80 + case % 10
        part = list(range(len(members)))
        for i, j in near_dedup.local_links(members, percent):
            both = len(np.intersect1d(members[i], members[j]))
            assert 100 * both >= percent * (len(members[i]) + len(members[j]) - both)
            part = [part[i] if p == part[j] else p for p in part]
        for i in range(len(members)):
            for j in range(i):
                both = len(np.intersect1d(members[i], members[j]))
                if 100 * both >= percent * (len(members[i]) + len(members[j]) - both):
                    assert part[i] == part[j]


def test_stage_keeps_one_row_of_each_component(docs):
    rows = corpus(1, 60)
    df = docs(rows)
    kept = near_dedup.keep_one(df)
    assert kept.columns == df.columns
    sets = [shingle_set(t, 5) for _, t in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                part = [part[i] if p == part[j] else p for p in part]
    assert kept.count() == len(set(part))


def test_stage_names_rows_by_their_place_in_the_files(spark, docs, tmp_path):
    rows = corpus(1, 60)
    df = docs(rows + rows).withColumn("_row", F.lit(7)).withColumn("node", F.lit("x"))
    df.repartition(4).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    classes = near_dedup.classify(docs(rows)).collect()
    empty = sum(r.n_shingles == 0 for r in classes)  # each is a component of its own
    known = sorted({r.component_id for r in classes if r.n_shingles})
    for on_files in (True, False):
        kept = near_dedup.keep_one(table, on_files=on_files)
        assert kept.columns == df.columns
        got = kept.collect()
        assert {(r._row, r.node) for r in got} == {(7, "x")}
        assert sorted(r.doc_id for r in got if shingle_set(r.text, 5)) == known
        assert sum(not shingle_set(r.text, 5) for r in got) == 2 * empty


def test_empty(docs):
    assert near_dedup.classify(docs([])).count() == 0
    assert near_dedup.classify(docs([(1, None), (2, "")])).count() == 2
