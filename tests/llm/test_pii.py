import random
import re

import numpy as np
import pytest

from orderstream.llm import pii

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                0: lambda: True,
                1: lambda: all(int(p) <= 255 for p in m[0].split(".")),
                2: lambda: 16 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0,
                3: lambda: 8 <= len(digits) <= 15,
            }[kind]()
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_against_the_plain_patterns():
    rng = random.Random(1)
    parts = ["1", "12", "255", "256", "007", ".", ".", "@", "a", "a.b", "-", " ", "+", "+1 ", "(", ")", "4111111111111111", "4111 1111 1111 1111", "é", "٣", "\n", "x@y.z", "0000"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        assert sorted(pii.base_spans(text)) == brute(text), text


def test_long_runs_are_linear():
    for unit in ("a", "1", "1.", "a@", "+1", "1 ", "+1 (", "a.", "@a."):
        pii.base_spans(unit * 300_000)
        pii.tokens(unit * 300_000)


def test_messages_are_exact_on_a_tree():
    rng = np.random.default_rng(0)
    model = pii.Model(rng.normal(size=(int(pii._OFFSETS[-1]), pii.LABELS)), *[(x + x.T) for x in rng.normal(size=(2, pii.LABELS, pii.LABELS))])
    feats = np.array([[int(pii._OFFSETS[t]) + int(rng.integers(n)) for t, n in enumerate(pii.TEMPLATES)] for _ in range(4)])
    chain, skip = np.array([[0, 1], [1, 2]]), np.array([[1, 3]])
    got = pii.marginals(model, feats, chain, skip, sweeps=60)
    node = model.nodes[feats].sum(axis=1)
    weight = np.zeros((pii.LABELS,) * 4)
    for y in np.ndindex(*weight.shape):
        weight[y] = np.exp(sum(node[i, y[i]] for i in range(4)) + model.chain[y[0], y[1]] + model.chain[y[1], y[2]] + model.skip[y[1], y[3]])
    weight /= weight.sum()
    for i in range(4):
        assert np.allclose(got[i], weight.sum(axis=tuple(j for j in range(4) if j != i)), atol=1e-6)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for i in range(300):
        phone = f"+1 (425) 555-{rng.randrange(1000, 9999)}"
        words = " ".join(rng.choice(["the", "of", "12", "1999", "3.5", "room 7"]) for _ in range(30))
        mail = f"user.{rng.randrange(99)}@mail{i % 7}.example.com"
        ip = ".".join(str(rng.randrange(256)) for _ in range(4))
        out.append((i, [f"{words}, {phone} and {words}", f"{words} {mail}. {words}", f"{ip}; {words}", words][i % 4]))
    return out


def test_find(docs, rows):
    rows = rows + [(None, None), (900, ""), (901, "9" * 50000), (0, rows[0][1]), (902, "+1 (425) 555-0735 x. later again 555-0735 end 12 12")]
    df = docs(rows)
    model = pii.fit(df)
    got = pii.find(df.withColumnRenamed("lang", "spans"), model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, text in rows:
        base = brute(text or "")
        assert [by[i].n_email, by[i].n_ip, by[i].n_card, by[i].n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
        spans = set(by[i].spans.split(",")) - {""}
        assert set(pii.span_string(base).split(",")) - {""} <= spans
        if i is not None and i < 300 and i % 4 == 3:
            assert len(spans) == len(base)  # plain numbers are left alone
    at = rows[-1][1].index("555-0735 end")
    assert f"phone:{at}:{at + 8}" in by[902].spans.split(",")  # the repeat shares the label


def test_empty(docs):
    assert pii.fit(docs([])) is None
    assert pii.find(docs([]), None).count() == 0


@pytest.mark.parametrize("repeats", [50, 500])
def test_evidence_reaches_every_repeat(repeats):
    nodes = np.zeros((int(pii._OFFSETS[-1]), pii.LABELS))
    nodes[int(pii._OFFSETS[-2]) + 1, 4] = 8.0  # a + before the number; all else is neutral
    model = pii.Model(nodes, np.zeros((pii.LABELS,) * 2), pii.CONSISTENCY * np.eye(pii.LABELS))
    graph = pii.Graph()
    graph.add(0, "+4255550735" + " and 4255550735" * (repeats - 1))
    p = pii.marginals(model, np.array(graph.feats), pii._edge_array(graph.chain), pii._edge_array(graph.skip))
    assert len(p) == repeats and (p[:, 4] > 0.8).all()


@pytest.mark.parametrize("repeats", [50, 500])
def test_find_every_repeat(docs, rows, repeats):
    text = "+1 (425) 555-0735" + " later again 555-0735" * repeats
    df = docs([*rows, (902, text)])
    got = {r.doc_id: r for r in pii.find(df, pii.fit(docs(rows))).collect()}[902]
    assert got.n_added == repeats


def test_number_written_again_without_its_plus(docs, rows):
    pairs = [
        ("+1 425 555 0735", "425 555 0735"),
        ("+1 (425) 555-0735", "(425) 555-0735"),
        ("+14255550735", "425-555-0735"),
        ("+1 425 555 0735", "425.555.0735"),
        ("+49 30 123 45 67", "030 123 45 67"),
        ("+1 425 555 0735", "001 425 555 0735"),
        ("4111 1111 1111 1111", "4111.1111.1111.1111"),
    ]
    more = [(900 + i, f"{a} x. later again {b} end 12 12, in 1999 {b} too") for i, (a, b) in enumerate(pairs)]
    got = {r.doc_id: r.spans.split(",") for r in pii.find(docs([*rows, *more]), pii.fit(docs(rows))).collect()}
    for (i, text), (_, b) in zip(more, pairs, strict=True):
        kind = "card" if b.startswith("4111") else "phone"
        for at in (text.index(" " + b + " end") + 1, text.index(" " + b + " too") + 1):
            assert f"{kind}:{at}:{at + len(b)}" in got[i], (text, got[i])
        assert len(got[i]) == 3, (text, got[i])


def test_runs_alike_share_a_variable():
    def tied(text):
        graph = pii.Graph()
        graph.add(0, text)
        return [text[graph.spans[n][1] : graph.spans[n][2]] for n, _ in graph.tied]

    assert sorted(tied("a 425 555 0735 b 425-555-0735 c 1 425 555 0735")) == ["1 425 555 0735", "425 555 0735", "425-555-0735"]
    assert tied("a 206 555 0735 b 425 555 0735") == []  # other area codes
    assert tied("+1 425 555 0735 a 12065550735") == []


def test_sample_is_collected_as_counts(docs):
    text = "+1 (425) 555-0735 and 12 apples, 1999 pears, mail user.1@mail1.example.com. "
    few, many = ([(1, text * 20)] * k for k in (2, 200))
    got = [{tuple(r.case): r.n for r in pii.sampled_cases(docs(rows)).collect()} for rows in (few, many)]
    graph = pii.Graph()
    graph.add(0, text * 20)
    assert sum(got[0].values()) == 2 * (len(graph.feats) + graph.shared)
    assert got[1] == {case: 100 * n for case, n in got[0].items()}  # as many rows, whatever is repeated
    one, other = (pii.fit(docs(rows)) for rows in (few, many))
    assert np.allclose(one.nodes, other.nodes, atol=1e-6) and np.allclose(one.skip, other.skip, atol=1e-6)
