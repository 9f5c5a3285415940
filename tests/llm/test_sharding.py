import pytest

from orderstream.llm import sharding


def brute(names, slots):
    names = sorted(names)
    pref = {n: [(sharding._draw(n, "start", slots) + k * (1 + sharding._draw(n, "step", slots - 1))) % slots for k in range(slots)] for n in names}
    table, turn = [None] * slots, 0
    while None in table:
        n = names[turn % len(names)]
        table[next(s for s in pref[n] if table[s] is None)] = n
        turn += 1
    return table


def test_table_against_plain_preference_lists():
    names = ["c", "a", "b", "zz"]
    assert [names[i] for i in sharding.fill(names, 101)] == brute(names, 101)


def test_even_and_stable():
    full = sharding.fill(sharding.SHARDS)
    counts = [full.count(i) for i in range(len(sharding.SHARDS))]
    assert max(counts) - min(counts) <= 1
    less = sharding.fill(sharding.SHARDS[1:])
    moved = sum(a != 0 and a != b + 1 for a, b in zip(full, less, strict=True))
    assert moved < 0.2 * len(full)


def test_bad_arguments():
    for names, slots in (([], 7), (["a", "a"], 7), (["a"], 8)):
        with pytest.raises(ValueError):
            sharding.fill(names, slots)


def test_place(docs, tmp_path, spark):
    rows = [(i, f"t{i}") for i in range(500)] + [(None, None), (None, "x"), (None, "x"), (3, "t3")]
    df = docs(rows).withColumnRenamed("lang", "shard")
    out = sharding.place(df)
    assert out.count() == len(rows) and set(out.columns) == set(df.columns)
    by = {}
    for r in out.collect():
        assert by.setdefault((r.doc_id, r.text), r.shard) == r.shard
    sharding.write_shards(out, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(rows)
    assert sharding.place(docs([])).count() == 0
