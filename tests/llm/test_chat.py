import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderstream.llm import chat
from orderstream.llm.template import Const, Emit, TemplateError, compile_template, fold, parse

PIECE = st.sampled_from(["<|", "|", "<", "\\", "<\\|", "<|im_end|>", "<|im_start|>assistant\n", "\n", "%", "%0A", "é", "a", "%25"])
TEXT = st.lists(PIECE, max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), TEXT), TEXT), max_size=5))
def test_round_trip(turns):
    run = compile_template(chat.TEMPLATE, chat.FILTERS)
    text, spans = chat.render([{"role": r, "text": t} for r, t in turns], run)
    assert chat.read_turns(text) == turns
    assert "".join(chat.unquoted(text[a:b]) for a, b in spans) == "".join(t for r, t in turns if r == "assistant")


def show(source, filters=None, **variables):
    return "".join(t for t, _ in compile_template(source, filters)(variables))


def test_language():
    assert show("{% for x in xs %}{% if x.a == 1 %}one{% elif x['a'] %}{{ x.a ~ '!' }}{% else %}-{% endif %},{% endfor %}", xs=[{"a": 1}, {"a": 7}, {}]) == "one,7!,-,"
    assert show("{{ not a and b or 'z' }}{{ a != b }}", a=0, b="") == "zTrue"
    assert show("{{ ('a' ~ 'b') | up }}", {"up": str.upper}) == "AB"
    assert fold(parse("a{{ 'b' ~ 1 }}{% if 1 == 2 %}x{% else %}c{% endif %}d"), {}) == (Emit(Const("ab1cd")),)


@pytest.mark.parametrize("source", ["{{ a.__class__ }}", "{{ a.upper() }}", "{{ open }}", "{% import os %}", "{% for x in %}{% endfor %}", "{% if a %}", "{{ a | nope }}", "{{ }}", "{% endif %}"])
def test_sandbox(source):
    with pytest.raises(TemplateError):
        show(source, a="text")


def brute(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = []
    for c, turns in by.items():
        turns.sort()
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        loss = "".join(t[5] for t in turns if t[3] == "assistant")
        out.append((c, len(turns), sha("".join(f"{t[3]}\n{t[5]}\n" for t in turns)), len(loss), sha(loss)))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    rows = [(i // 4, 3 - i % 4, ("user", "assistant", None, "system")[i % 4 if i % 5 else 1], None if i % 11 == 0 else f"t{i}<|im_end|>\n") for i in range(60)]
    rows += [(None, 0, "user", "x"), (None, None, "assistant", "y"), (2**60 + 1, 0, "assistant", "z" * 200000), (3, 1, "assistant", "a"), (3, 1, "assistant", "a"), (None, 0, "user", "x")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, loss string")
    got = [tuple(r)[:5] for r in chat.digests(chat.format_chats(df)).collect()]
    assert sorted(got, key=repr) == brute(rows)
    assert chat.digests(chat.format_chats(df.limit(0))).count() == 0
