import hashlib
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from orderstream.llm import mixing


def fill(budget, children):
    """children: {name: (weight, capacity)}; whole tokens, rounded down."""
    full, open_ = {}, dict(children)
    while True:
        weight = sum(w for w, _ in open_.values())
        left = budget - sum(full.values())
        done = {n: c for n, (w, c) in open_.items() if w and c <= Fraction(left * w, weight)}
        if not done:
            return full | {n: left * w // weight if weight else 0 for n, (w, _) in open_.items()}
        full |= done
        open_ = {n: x for n, x in open_.items() if n not in done}


def brute(rows, weights, percent, epochs, seed):
    leaves = defaultdict(list)
    for row, (i, text, lang, source) in enumerate(rows):
        number = int(source[3:]) if source and source[3:].isdigit() else None
        domain = "forum" if number is None or number >= 15 else "web" if number < 10 else "books"
        n = len((text or "").split())
        if n:
            leaves[(domain, lang, source)].append((row, i, n))
    tokens = {k: sum(x[2] for x in v) for k, v in leaves.items()}
    weight = lambda level, name: weights.get(level, {}).get(name, 1)

    usable = lambda leaf: all(weight(level, name) for level, name in zip(mixing.LEVELS, leaf))

    def down(budget, prefix, depth):
        names = {k[depth] for k in tokens if k[:depth] == prefix}
        kids = {}
        for n in names:
            w = weight(mixing.LEVELS[depth], n)
            cap = sum(t for k, t in tokens.items() if k[: depth + 1] == (*prefix, n) and usable(k)) * epochs
            kids[n] = (w, cap)
        out = {}
        for n, q in fill(budget, kids).items():
            out |= {(*prefix, n): q} if depth == 2 else down(q, (*prefix, n), depth + 1)
        return out

    quota = down(sum(tokens.values()) * percent // 100, (), 0)
    copies = {}
    for leaf, members in leaves.items():
        whole, more = divmod(quota[leaf], tokens[leaf])
        key = lambda m, e=whole: (hashlib.md5(f"{seed}:{e}:{'null' if m[1] is None else m[1]}".encode()).hexdigest(), m[1] is not None, m[1] or 0, m[0])
        at = 0
        for row, _, n in sorted(members, key=key):
            c = whole + (at < more)
            at += n
            if c:
                copies[row] = c
    return quota, copies


@pytest.mark.parametrize("percent, epochs, slice_rows", [(60, 4, 4096), (150, 2, 7), (500, 2, 3), (5, 1, 5)])
def test_against_brute_force(docs, monkeypatch, percent, epochs, slice_rows):
    monkeypatch.setattr(mixing, "SLICE_ROWS", slice_rows)
    rows = []
    for i in range(300):
        source = None if i % 41 == 0 else "odd" if i % 43 == 0 else f"src{0 if i % 3 == 0 else i % 19}"
        lang = None if i % 37 == 0 else ("en", "de", "fr", "xx")[i * 7 % 4]
        rows.append((None if i % 97 == 0 else i, None if i % 53 == 0 else "w " * (i % 17), lang, source))
    weights = {**mixing.WEIGHTS, "source": {"src0": 2, "src5": 0}}
    quota, copies = brute(rows, weights, percent, epochs, 7)
    frame = docs(rows).coalesce(1)
    got = mixing.choose(frame, percent, weights, epochs, 7).collect()
    leaf = {(r.domain, r.lang, r.source): r.quota for r in got}
    assert all(quota[k] == v for k, v in leaf.items())
    ids = sorted((r.doc_id is None, r.doc_id or 0, r.copies) for r in got)
    assert ids == sorted((rows[k][0] is None, rows[k][0] or 0, c) for k, c in copies.items())
    mixed = mixing.mix(frame, budget_percent=percent, weights=weights, max_epochs=epochs, seed=7)
    assert mixed.columns == frame.columns and mixed.count() == sum(copies.values())


def test_weight_zero_below_passes_its_share_on(docs):
    """web has tokens only below a source of weight 0: its whole share goes to
    its sibling domain."""
    rows = [(i, "w " * 10, "en", "src5") for i in range(40)] + [(100 + i, "w " * 10, "en", "src12") for i in range(40)]
    weights = {"domain": {"web": 5, "books": 3}, "source": {"src5": 0}}
    got = mixing.choose(docs(rows), 50, weights, 4).collect()
    assert {r.source for r in got} == {"src12"} and sum(r.n_tokens * r.copies for r in got) == 400


def test_mix_reads_a_table_on_files(spark, docs, tmp_path):
    rows = [(i, "w " * (i % 9), "en", f"src{i % 4}") for i in [*range(50)] * 6]
    docs(rows).withColumnRenamed("n_chars", "copies").withColumn("_row", F.lit(7)).repartition(3).write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    chosen = mixing.choose(frame, budget_percent=150).collect()
    for on_files in (True, False):
        mixed = mixing.mix(frame, on_files, budget_percent=150)
        assert mixed.columns == frame.columns
        got = mixed.collect()
        assert {r._row for r in got} == {7}
        assert sorted(r.doc_id for r in got) == sorted(x for r in chosen for x in [r.doc_id] * r.copies)


def test_empty(docs):
    assert mixing.choose(docs([])).count() == 0
    assert mixing.choose(docs([(1, None), (2, " ")])).count() == 0
