import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from orderstream.llm import sketches

PIECE = re.compile(r"[^ \x09-\x0D][^\n.!?。]{0,159}[.!?。]*")
CONTRACT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def keys(text):
    return {int(hashlib.md5(p.encode()).hexdigest()[:15], 16) for p in PIECE.findall(text)}


def like(a, b):
    a, b = keys(a), keys(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def cells(text):
    out = [[0, 0, 0] for _ in range(12)]
    for k in keys(text):
        check = ((k & (2**28 - 1)) * 2654435761 + (k >> 28) * 40503) >> 20 & 0xFFFFFFFF
        for third in range(3):
            cell = out[4 * third + (k >> 2 * third & 3)]
            cell[0], cell[1], cell[2] = cell[0] + 1, cell[1] ^ k, cell[2] ^ check
    return " ".join(".".join(f"{x:X}" for x in c) if c[0] else "-" for c in out)


def brute(ordered):
    """Rows of the contract for texts in the order of their documents."""
    out = []
    for at, (i, text) in enumerate(ordered):
        nxt = ordered[(at + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + nxt[:half]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), cells(text), cells(edited), like(text, edited), like(text, nxt)))
    return out


def corpus(n=220):
    rng = random.Random(5)
    sentence = lambda: " ".join(rng.choice(["deep", "sea", "ÉTÉ", "日本。", "tail", "x" * 70]) for _ in range(rng.randrange(1, 9))) + rng.choice([".", "!", "\n", " "])
    texts = ["".join(sentence() for _ in range(rng.choice([0, 1, 2, 5, 40]))) for _ in range(n)]
    texts[7], texts[8], texts[9] = "", None, "..."
    texts[20] = texts[21] = texts[22]
    texts[30] = "".join(f"Line {i} of a long text.\n" for i in range(3000))
    texts[31] = "".join(f"Line {i} of a long text.\n" for i in range(2900))
    return [(3 * i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("steps, load, spare", [(6, 1.5, 16), (1, 0.1, 1)])
def test_against_brute_force(docs, monkeypatch, steps, load, spare):
    """Also with sketches that fail at first and have to grow."""
    monkeypatch.setattr(sketches, "STEPS", steps)
    monkeypatch.setattr(sketches, "LOAD", load)
    monkeypatch.setattr(sketches, "SPARE", spare)
    rows = corpus() if steps > 1 else corpus()[:30]
    frame = docs(rows).withColumns({"size": F.lit(1), "payload": F.lit(None).cast("string"), "_slice": F.lit(7)}).repartition(5)
    got = sketches.digests(sketches.edits(frame))
    assert got.columns == CONTRACT
    assert sorted(tuple(r) for r in got.collect()) == brute([(i, t or "") for i, t in rows])


def test_repeated_rows_and_ids(docs):
    rows = [(None, "First. Second."), (1, "a. b. c."), (1, "a. b. c."), (1, "Other text. More of it."), (5, None)]
    got = sketches.digests(sketches.edits(docs(rows * 1))).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert {k: len(v) for k, v in by.items()} == {None: 1, 1: 3, 5: 1}
    assert by[5][0].near_next == 0.0 and by[5][0].edited_sha256 == hashlib.sha256(b"").hexdigest()
    # Of the two equal rows one is followed by the other.
    same = [r for r in by[1] if r.n_chars == 8]
    assert len({r.fingerprint for r in same}) == 1 and sorted(r.near_next for r in same)[-1] == 1.0
    assert by[1][0].near_next in (0.0, 1.0)


def test_one_document_and_none(docs):
    only = sketches.digests(sketches.edits(docs([(4, "One. Two. Three.")]))).collect()
    assert [tuple(r) for r in only] == brute([(4, "One. Two. Three.")])
    assert sketches.edits(docs([])).count() == 0


def test_compare_recovers_the_changed_paragraphs(spark):
    base = [f"Paragraph number {i}." for i in range(60)]
    cases = [
        (1, "\n".join(base), "\n".join(base)),
        (2, "\n".join(base), "\n".join([*base[:30], "An insertion.", *base[31:]])),
        (3, "\n".join(base), "\n".join(f"Unlike {i}." for i in range(50))),
        (4, None, "Only new."),
        (5, "", None),
    ]
    frame = spark.createDataFrame(cases, "changed long, old_text string, new_text string").withColumn("_row", F.lit("mine"))
    got = sketches.compare(frame)
    assert got.columns == ["changed", "_row", "old_text", "new_text", "removed", "added", "likeness"]
    for r in got.collect():
        old, new = keys(r.old_text or ""), keys(r.new_text or "")
        assert (r.removed, r.added, r.likeness) == (sorted(old - new), sorted(new - old), like(r.old_text or "", r.new_text or ""))
    assert got.count() == 5


def test_peeling_a_base_sketch(spark):
    rng = random.Random(9)
    rows = []
    for i in range(200):
        shared = [rng.getrandbits(60) for _ in range(rng.randrange(30))]
        rows.append((shared + [rng.getrandbits(60) for _ in range(rng.randrange(5))], shared + [rng.getrandbits(60) for _ in range(rng.randrange(5))]))
    frame = spark.createDataFrame(rows, "a array<long>, b array<long>")
    got = frame.withColumn("p", sketches.peel(sketches.subtract(sketches.sketch(F.col("a")), sketches.sketch(F.col("b"))))).collect()
    solved = [r for r in got if r.p.solved]
    assert len(solved) > 100
    for r in solved:
        assert (set(r.p.removed), set(r.p.added)) == (set(r.a) - set(r.b), set(r.b) - set(r.a))


def test_one_shuffle_of_the_texts(spark, docs):
    cut = sketches.in_slices(docs(corpus())).repartition("_slice")
    assert cut.groupBy("_guard").count().collect()  # runs
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
