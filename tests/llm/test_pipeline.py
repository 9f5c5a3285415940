import random
import re
from collections import Counter

import pytest
import test_mixing
import test_near_dedup
import test_quality

import corpus_pipeline
from orderstream.llm import mixing, near_dedup, sampled_pieces


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    base = [r for r in test_near_dedup.corpus(4, 150) if r[0] is not None]
    texts = [t for _, t in base] + [base[3][1] + " ", base[4][1].replace(" ", "\n"), "ab cd ef gh " * 12, None, "", "one two"]
    return [(i, t, ("en", "de", None)[i % 3], f"src{rng.randrange(19)}") for i, t in enumerate(texts)]


def brute(rows):
    """doc_id -> copies after the first four stages."""
    good = []
    for r in rows:
        n_words, _, _, _, repeats = test_quality.base(r[1])
        if n_words >= 20 and 100 * repeats <= 30 * n_words:
            good.append(r)
    first = {}
    for r in sorted(good, key=lambda r: (-len(r[1]), r[0])):
        first.setdefault(re.sub(r"[ \t-\r]", "", r[1]), r)
    unique = sorted(first.values())
    sets = [test_near_dedup.shingle_set(r[1], 5) for r in unique]
    part = list(range(len(unique)))
    for i in range(len(unique)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                part = [part[j] if p == part[i] else p for p in part]
    kept = [r for at, r in enumerate(unique) if at == part.index(part[at])]
    assert len(kept) < len(unique) < len(good) < len(rows)
    _, copies = test_mixing.brute(kept, mixing.WEIGHTS, mixing.BUDGET_PERCENT, mixing.MAX_EPOCHS, mixing.SEED)
    return {kept[k][0]: c for k, c in copies.items()}


def test_run_against_brute_force(docs, spark, tmp_path, rows):
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "draw").collect()
    copies = brute(rows)
    seen = Counter((r.doc_id, r.draw) for r in got)
    assert seen == Counter({(i, d): c for i, c in copies.items() for d in range(sampled_pieces.DRAWS)})


def test_stages_return_the_columns_of_documents(docs, spark, tmp_path, rows):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    df = docs(rows[:30])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, str(tmp_path)).columns == df.columns, name
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_duplicates", "near_duplicates", "mixture", "segmentations"]
    empty = df.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
    assert near_dedup.needed_matches(80) >= 8
