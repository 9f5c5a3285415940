import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderstream.llm import source_divergence as sd

WORD = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs, top):
    docs = [(lang or "", source or "", WORD.findall((text or "").translate(LOWER))) for _, text, lang, source in rows]
    df, count, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, words in docs:
        groups.add((lang, source))
        df[lang].update(set(words))
        count[lang, source].update(words)
    out = []
    for lang in {g[0] for g in groups}:
        terms = [t for t, n in df[lang].items() if n >= min_docs]
        members = sorted(s for x, s in groups if x == lang)
        total = {t: sum(count[lang, s][t] for s in members) for t in terms}
        share = lambda c, n: 1 + 10**9 * (c + 5) // (n + 5 * len(terms))
        n = {s: sum(count[lang, s][t] for t in terms) for s in members}
        p = {s: {t: share(count[lang, s][t], n[s]) for t in terms} for s in members}
        q = {t: share(total[t], sum(total.values())) for t in terms}
        for s in members:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in terms), o.encode(), o) for o in members if o != s)
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)]
            more = sorted((q[t] - p[s][t], t.encode(), t) for t in terms if count[lang, s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(more[:top])]
    return sorted(out)


def corpus(n=400):
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("Ab", "cé", "日本", "x", "ÉÀ", "zz") for b in ("", "er", "ION", "ü", "q" * 40)]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "fr", None, ""])
        source = rng.choice(["hot", "hot", "b", None, "", "é", f"s{i % 11}"])
        text = " ".join(rng.choice(words[: 6 + 12 * (source == "hot")] if rng.random() < 0.8 else words) + rng.choice(["", ",", "1", "_"]) for _ in range(rng.randrange(40)))
        rows.append((i, None if i % 29 == 0 else text, lang, source))
    rows += [(1000, "", "xx", "a"), (1001, None, "xx", "b"), (1002, "lone lone", "yy", "only"), (1003, "only here " * 3000, "fr", "hot"), (1003, "only here " * 3000, "fr", "hot")]
    return rows


@pytest.mark.parametrize(
    "postings, fan_in, held, min_docs, top", [(400_000, 64, 200_000, 5, 50), (20, 2, 3, 2, 4), (1, 3, 1, 1, 1000), (50, 5, 10, 500, 50)]
)
def test_against_brute_force(docs, monkeypatch, postings, fan_in, held, min_docs, top):
    monkeypatch.setattr(sd, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(sd, "PAIRS_HELD", held)
    monkeypatch.setattr(sd.merged, "__defaults__", (min_docs, fan_in))
    monkeypatch.setattr(sd.blocks, "__defaults__", (3000,))
    rows = corpus()
    frame = docs(rows).withColumns({"p": F.lit(1), "term": F.lit("x"), "rank": F.lit(None).cast("int")})
    got = sorted(tuple(r) for r in sd.audit(frame, min_docs, top).collect())
    assert got == brute(rows, min_docs, top)


def test_empty_table_and_no_words(docs):
    assert sd.audit(docs([])).count() == 0
    rows = [(1, None, "en", "a"), (2, "", "en", "b"), (3, "7 8", None, None)]
    got = sorted(tuple(r) for r in sd.audit(docs(rows)).collect())
    assert got == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_runs_are_sorted_and_merge_to_the_counts(docs, monkeypatch):
    monkeypatch.setattr(sd, "BLOCK_POSTINGS", 30)
    monkeypatch.setattr(sd.blocks, "__defaults__", (2000,))
    runs = sd.spilled_runs(docs(corpus()).na.fill(""), 4).collect()
    assert len({r.run for r in runs}) > 2
    for r in runs:
        assert list(r.terms) == sorted(r.terms) and sum(r.n) == len(r.sources) == len(r.counts)


def test_shares_are_exact_for_very_large_counts(spark):
    big = 3 * 10**15
    row = spark.range(1).select(sd.share(F.lit(big), F.lit(7 * big + 1), F.lit(10**6)).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 5) // (7 * big + 1 + 5 * 10**6)


def test_pair_corrections_of_one_batch():
    rng = np.random.default_rng(2)
    lengths = rng.integers(0, 7, 60)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    source = np.concatenate([np.sort(rng.choice(9, n, replace=False)) for n in lengths] or [[]]).astype(np.int64)
    p, p0 = rng.integers(100, 200, len(source)), rng.integers(1, 150, len(source))
    lang = rng.integers(0, 3, 60)
    want = Counter()
    for t in range(60):
        for i in range(starts[t], starts[t + 1]):
            for j in range(i + 1, starts[t + 1]):
                want[(lang[t] * 9 + source[i]) * 9 + source[j]] += abs(p[i] - p[j]) - abs(p[i] - p0[j]) - abs(p0[i] - p[j]) + abs(p0[i] - p0[j])
    keys, values = sd._batch_corrections(lang, starts, source, p, p0, 9)
    assert dict(zip(keys.tolist(), values.tolist())) == dict(want)
