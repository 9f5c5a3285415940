import hashlib
import math
from collections import Counter

import pytest

from orderstream.llm import sampled_pieces as sp

TEXTS = [
    None, "", " ", "Hello  world\n foo\tbar é 日本 \U0001F600", "  lead", "trail  ", "a", "<s> </s> <unk> <0x41>", "x" * 3000,
    "no▁mark", "the of and " * 400, "ﬁ Ａ", "\x01\x7f", "word\nword\nword", " \n \n ",
]


@pytest.fixture(scope="module")
def model():
    return sp.load()


@pytest.fixture(scope="module")
def pieces(model):
    return sp.Pieces(model)


def enumerate_all(pieces, text):
    """Every segmentation of a text with its probability."""
    norm = pieces.normalise(text)
    out = {}

    def go(i, ids, score):
        if i == len(norm):
            out[tuple(ids)] = score
            return
        here = [(n, pieces.text[norm[i : i + n]]) for n in range(1, 17) if norm[i : i + n] in pieces.text and i + n <= len(norm)]
        for n, p in here:
            go(i + n, [*ids, p], score + float(pieces.score[p]))
        if not any(n == 1 for n, _ in here):
            raw = norm[i].encode()
            go(i + 1, [*ids, *[int(pieces.byte[b]) for b in raw]], score + pieces.byte_score * len(raw))

    go(0, [], 0.0)
    top = max(out.values())
    total = sum(math.exp(s - top) for s in out.values())
    return {k: math.exp(s - top) / total for k, s in out.items()}


def draws(pieces, text, k, seed):
    ((found, threshold),) = sp.sample(pieces, pieces.starts([pieces.normalise(text)]), k, [sp._key(seed, "x")])
    return [(tuple(sp.ids_of(pieces, d.edges).tolist()), d) for d in found], threshold


def test_ordered_sampling_without_replacement(pieces):
    pieces.score = pieces.score * 0.2  # flatter, so that many orders occur
    try:
        text = "it is"
        exact = enumerate_all(pieces, text)
        n = 6000
        pairs, estimate = Counter(), 0.0
        for seed in range(n):
            found, threshold = draws(pieces, text, 3, seed)
            assert len({ids for ids, _ in found}) == 3
            for ids, d in found:
                assert math.isclose(math.exp(d.log_p), exact[ids], rel_tol=1e-9)
            pairs[found[0][0], found[1][0]] += 1
            # Horvitz-Thompson: the weights estimate the mean of any function.
            estimate += sum(len(ids) * math.exp(d.log_p - sp._log_inclusion(d.log_p - threshold)) for ids, d in found)
        for (a, b), seen in pairs.most_common(12):
            p = exact[a] * exact[b] / (1 - exact[a])
            assert abs(seen / n - p) < 5 * math.sqrt(p / n)
        assert abs(estimate / n - sum(p * len(k) for k, p in exact.items())) < 0.1
    finally:
        pieces.score = pieces.score / 0.2
    

def test_all_segmentations_of_a_short_text(pieces):
    exact = enumerate_all(pieces, "ab é")
    found, threshold = draws(pieces, "ab é", 10_000, 1)
    assert {ids for ids, _ in found} == set(exact) and threshold == -math.inf
    values = [d.value for _, d in found]
    assert values == sorted(values, reverse=True)


def test_tables_round_trip(docs, model, spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "the key"), (3, TEXTS[3])]
    df = docs(rows).withColumnRenamed("lang", "ids")
    encoded = sp.encode(df, model, k=4, decoded=True)
    got = sp.decode(encoded, model).collect()
    pieces = sp.Pieces(model)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for i, text in rows:
        norm = pieces.normalise(text or "").replace("▁", " ")
        for r in by[i]:
            assert r.text == norm[1:] and r.n_pieces == len(r.ids)
            assert r.text_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
            assert not set(r.ids) & {0, 1, 2}
            assert r.log_inclusion <= 0 and r.log_prob <= 1e-9
    assert len({tuple(r.ids) for r in by[10]}) == 4 and len(by[0]) == len(by[1]) == 1
    assert len(by[3]) == 8 and len({tuple(r.ids) for r in by[3]}) == 4  # a repeated row draws alike
    again = sp.encode(df.repartition(7), model, k=4).select("doc_id", "draw", "ids").collect()
    assert sorted(map(repr, again)) == sorted(repr(r) for r in encoded.select("doc_id", "draw", "ids").collect())
    assert sp.encode(docs([]), model).count() == 0
