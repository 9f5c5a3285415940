import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from orderstream.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for at, (i, text) in enumerate(rows):
        groups[re.sub(r"[ \t-\r]", "", text or "")].append((-len(text or ""), i is None, i or 0, at))
    out = []
    for norm, members in groups.items():
        members.sort()
        keep = None if members[0][1] else members[0][2]
        for k, m in enumerate(members):
            out.append((None if m[1] else m[2], keep, len(members), k == 0, norm))
    return sorted(map(repr, out))


def rows_of():
    rng = random.Random(5)
    words = ["a b", "ab", " a\tb ", "", None, "x y", "xy\n", "long " * 3000, "é ü", "éü", "a b"]
    return [(rng.choice([None, *range(30)]) if i % 7 == 0 else i, rng.choice(words)) for i in range(80)]


def test_matches_brute_force_with_a_true_digest_and_with_colliding_ones(docs):
    rows = rows_of()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = [re.sub(r"'([^']*)'\)$", "", r) for r in brute(rows)]
    for digest in (exact_dedup.sha256, lambda text: F.substring(F.sha2(text, 256), 1, 1), lambda text: F.lit("same")):
        got = exact_dedup.classify(docs(rows).repartition(5), digest).collect()
        assert sorted((repr(tuple(r[:4]))[:-1] + ", ") for r in got) == sorted(expected)
    got = exact_dedup.classify(docs(rows)).collect()
    assert {r.digest for r in got} == {sha(re.sub(r"[ \t-\r]", "", t or "")) for _, t in rows}


def test_stage_keeps_one_row_of_each_class_and_all_columns(docs):
    rows = rows_of()
    df = docs(rows).withColumn("keep_id", F.lit(1)).withColumn("_rows", F.lit("x"))
    kept = exact_dedup.keep_first(df)
    assert kept.columns == df.columns
    assert kept.count() == len({re.sub(r"[ \t-\r]", "", t or "") for _, t in rows})


def test_stage_names_rows_by_their_place_in_the_files(spark, docs, tmp_path):
    """Rows repeat in whole, within a file and across files, and columns bear the
    names the stage uses itself."""
    rows = rows_of()
    df = docs(rows + rows).withColumn("_row", F.lit(7)).withColumn("_ROW_", F.lit("x")).withColumn("_file", F.col("doc_id"))
    df.repartition(4).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    best = {}
    for i, text in rows:
        norm = re.sub(r"[ \t-\r]", "", text or "")
        best[norm] = min(best.get(norm, (1, False, 0)), (-len(text or ""), i is None, i or 0))
    expected = sorted((norm, None if b[1] else b[2]) for norm, b in best.items())
    for on_files, digest in ((True, exact_dedup.sha256), (False, exact_dedup.sha256), (True, lambda text: F.substring(F.sha2(text, 256), 1, 1))):
        kept = exact_dedup.keep_first(table, digest, on_files=on_files)
        assert kept.columns == df.columns
        got = kept.collect()
        assert {(r._row, r._ROW_) for r in got} == {(7, "x")} and all(r._file == r.doc_id for r in got)
        assert sorted((re.sub(r"[ \t-\r]", "", r.text or ""), r.doc_id) for r in got) == expected


def test_a_row_repeated_by_a_join_is_named_twice(spark, docs, tmp_path):
    docs(rows_of()[:9]).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    twice = table.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    assert exact_dedup.keep_first(twice).count() == exact_dedup.keep_first(table).count()


def test_empty_table(docs):
    assert exact_dedup.classify(docs([])).count() == 0
