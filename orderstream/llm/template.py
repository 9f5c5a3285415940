"""A sandboxed chat-template language compiled to Python closures.

Grammar: text, ``{{ expression }}``, ``{% for x in expression %} .. {% endfor %}``,
``{% if expression %} .. {% elif expression %} .. {% else %} .. {% endif %}`` and
``{% generation %} .. {% endgeneration %}``. Expressions: string and whole-number
literals, names, ``x.key`` / ``x['key']``, ``a ~ b``, ``==``, ``!=``, ``not``,
``and``, ``or``, parentheses and filters ``x | name``. A name is looked up in the
variables given to the template and nowhere else, a key only in a mapping, a
filter only in the table given to ``compile_template``: there is no attribute
access, no call and no import.

Compilation: source -> syntax tree -> folded tree (constant operations, branches
and neighbouring texts) -> closures. A compiled template maps variables to a list
of (text, generated) pieces, where ``generated`` marks what stands inside a
generation block.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

Filter = Callable[[str], str]
_BLOCK = re.compile(r"\{\{(?P<expr>.*?)\}\}|\{%(?P<tag>.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<str>'[^']*'|\"[^\"]*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[~|.\[\]()]))")


class TemplateError(ValueError):
    """A template that does not parse, or a lookup that is not allowed."""


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: object
    key: object


@dataclass(frozen=True)
class Op:
    name: str
    args: tuple


@dataclass(frozen=True)
class Emit:
    expr: object


@dataclass(frozen=True)
class For:
    var: str
    items: object
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body); Const(True) for else


@dataclass(frozen=True)
class Generation:
    body: tuple


@dataclass
class _Tokens:
    source: str
    items: list = field(default_factory=list)
    at: int = 0

    def __post_init__(self) -> None:
        pos = 0
        while self.source[pos:].strip():
            m = _TOKEN.match(self.source, pos)
            if not m:
                raise TemplateError(f"unexpected text in expression: {self.source[pos:]!r}")
            self.items.append((m.lastgroup, m[m.lastgroup]))
            pos = m.end()

    def peek(self, *values: str) -> bool:
        return self.at < len(self.items) and self.items[self.at][0] != "str" and self.items[self.at][1] in values

    def take(self, kind: str | None = None, value: str | None = None) -> str:
        if self.at >= len(self.items):
            raise TemplateError(f"expression ends early: {self.source!r}")
        got_kind, got = self.items[self.at]
        if (kind and got_kind != kind) or (value and got != value):
            raise TemplateError(f"unexpected {got!r} in {self.source!r}")
        self.at += 1
        return got


def _expression(t: _Tokens):
    left = _conjunction(t)
    while t.peek("or"):
        t.take()
        left = Op("or", (left, _conjunction(t)))
    return left


def _conjunction(t: _Tokens):
    left = _negation(t)
    while t.peek("and"):
        t.take()
        left = Op("and", (left, _negation(t)))
    return left


def _negation(t: _Tokens):
    if t.peek("not"):
        t.take()
        return Op("not", (_negation(t),))
    left = _joined(t)
    while t.peek("==", "!="):
        left = Op(t.take(), (left, _joined(t)))
    return left


def _joined(t: _Tokens):
    left = _filtered(t)
    while t.peek("~"):
        t.take()
        left = Op("~", (left, _filtered(t)))
    return left


def _filtered(t: _Tokens):
    value = _operand(t)
    while t.peek("|"):
        t.take()
        value = Op("|" + t.take("name"), (value,))
    return value


def _operand(t: _Tokens):
    kind = t.items[t.at][0] if t.at < len(t.items) else None
    if t.peek("("):
        t.take()
        value = _expression(t)
        t.take(value=")")
    elif kind == "str":
        value = Const(t.take()[1:-1])
    elif kind == "int":
        value = Const(int(t.take()))
    else:
        value = Name(t.take("name"))
    while t.peek(".", "["):
        if t.take() == ".":
            value = Key(value, Const(t.take("name")))
        else:
            value = Key(value, _expression(t))
            t.take(value="]")
    return value


def _whole(source: str):
    t = _Tokens(source)
    value = _expression(t)
    if t.at != len(t.items):
        raise TemplateError(f"unexpected {t.items[t.at][1]!r} in {source!r}")
    return value


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    root: list = []
    # Open blocks: (tag, node parts, body being filled).
    stack: list[tuple[str, object, list]] = [("", None, root)]
    pos = 0
    for m in _BLOCK.finditer(source):
        if m.start() > pos:
            stack[-1][2].append(Emit(Const(source[pos : m.start()])))
        pos = m.end()
        if m["expr"] is not None:
            stack[-1][2].append(Emit(_whole(m["expr"])))
            continue
        tag, _, rest = m["tag"].strip().partition(" ")
        if tag == "for":
            var, word, items = (*rest.split(None, 2), "", "")[:3]
            if word != "in" or not var.isidentifier():
                raise TemplateError(f"bad for: {m[0]!r}")
            stack.append(("for", (var, _whole(items)), []))
        elif tag == "if":
            stack.append(("if", [(_whole(rest), [])], []))
            stack[-1] = ("if", stack[-1][1], stack[-1][1][0][1])
        elif tag in ("elif", "else") and stack[-1][0] == "if":
            branches = stack[-1][1]
            branches.append((_whole(rest) if tag == "elif" else Const(True), []))
            stack[-1] = ("if", branches, branches[-1][1])
        elif tag == "generation":
            stack.append(("generation", None, []))
        elif tag.startswith("end") and len(stack) > 1 and tag[3:] == stack[-1][0]:
            kind, parts, body = stack.pop()
            if kind == "for":
                node = For(parts[0], parts[1], tuple(body))
            elif kind == "if":
                node = If(tuple((c, tuple(b)) for c, b in parts))
            else:
                node = Generation(tuple(body))
            stack[-1][2].append(node)
        else:
            raise TemplateError(f"unexpected tag: {m[0]!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not closed")
    if source[pos:]:
        root.append(Emit(Const(source[pos:])))
    return tuple(root)


def _show(value: object) -> str:
    return "" if value is None else str(value)


def _apply(name: str, args: list, filters: Mapping[str, Filter]):
    if name == "~":
        return _show(args[0]) + _show(args[1])
    if name == "==":
        return args[0] == args[1]
    if name == "!=":
        return args[0] != args[1]
    if name == "not":
        return not args[0]
    return filters[name[1:]](_show(args[0]))


def _fold_expr(e, filters):
    if isinstance(e, Key):
        return Key(_fold_expr(e.of, filters), _fold_expr(e.key, filters))
    if not isinstance(e, Op):
        return e
    if e.name[0] == "|" and e.name[1:] not in filters:
        raise TemplateError(f"unknown filter {e.name[1:]!r}")
    args = tuple(_fold_expr(a, filters) for a in e.args)
    if e.name in ("and", "or"):
        if isinstance(args[0], Const):  # the left side decides, or the right one is the result
            return args[1] if bool(args[0].value) == (e.name == "and") else args[0]
    elif all(isinstance(a, Const) for a in args):
        return Const(_apply(e.name, [a.value for a in args], filters))
    return Op(e.name, args)


def fold(body: tuple, filters: Mapping[str, Filter]) -> tuple:
    """The tree with constant expressions computed, dead branches dropped and
    neighbouring constant texts joined."""
    out: list = []
    for node in body:
        if isinstance(node, Emit):
            made = [Emit(_fold_expr(node.expr, filters))]
        elif isinstance(node, For):
            made = [For(node.var, _fold_expr(node.items, filters), fold(node.body, filters))]
        elif isinstance(node, Generation):
            made = [Generation(fold(node.body, filters))]
        else:
            branches = []
            for condition, inner in node.branches:
                condition = _fold_expr(condition, filters)
                if isinstance(condition, Const) and not condition.value:
                    continue
                branches.append((condition, fold(inner, filters)))
                if isinstance(condition, Const):
                    break
            always = branches and isinstance(branches[0][0], Const)
            made = list(branches[0][1]) if always else [If(tuple(branches))] if branches else []
        for n in made:
            last = out[-1] if out else None
            if isinstance(n, Emit) and isinstance(n.expr, Const):
                text = _show(n.expr.value)
                if isinstance(last, Emit) and isinstance(last.expr, Const):
                    out[-1] = Emit(Const(last.expr.value + text))
                elif text:
                    out.append(Emit(Const(text)))
            else:
                out.append(n)
    return tuple(out)


def _value(e, filters) -> Callable[[Mapping], object]:
    """The closure of a folded expression."""
    if isinstance(e, Const):
        return lambda env, v=e.value: v
    if isinstance(e, Name):

        def name(env, n=e.name):
            try:
                return env[n]
            except KeyError:
                raise TemplateError(f"unknown name {n!r}") from None

        return name
    if isinstance(e, Key):
        of, key = _value(e.of, filters), _value(e.key, filters)

        def look(env):
            mapping = of(env)
            if not isinstance(mapping, Mapping):
                raise TemplateError("keys are looked up in mappings only")
            return mapping.get(key(env))

        return look
    args = [_value(a, filters) for a in e.args]
    if e.name == "and":
        return lambda env: args[0](env) and args[1](env)
    if e.name == "or":
        return lambda env: args[0](env) or args[1](env)
    return lambda env, n=e.name: _apply(n, [a(env) for a in args], filters)


def _writer(body: tuple, generated: bool, filters) -> Callable[[dict, list], None]:
    """The closure that appends a body's pieces to a list."""
    steps: list[Callable[[dict, list], None]] = []
    for node in body:
        if isinstance(node, Emit):
            if isinstance(node.expr, Const):
                steps.append(lambda env, out, p=(node.expr.value, generated): out.append(p))
            else:
                steps.append(lambda env, out, f=_value(node.expr, filters): out.append((_show(f(env)), generated)))
        elif isinstance(node, Generation):
            steps.append(_writer(node.body, True, filters))
        elif isinstance(node, For):

            def loop(env, out, items=_value(node.items, filters), var=node.var, inner=_writer(node.body, generated, filters)):
                for item in items(env):
                    inner({**env, var: item}, out)

            steps.append(loop)
        else:
            cases = [(_value(c, filters), _writer(b, generated, filters)) for c, b in node.branches]

            def choose(env, out, cases=cases):
                for condition, inner in cases:
                    if condition(env):
                        return inner(env, out)

            steps.append(choose)

    def write(env: dict, out: list) -> None:
        for step in steps:
            step(env, out)

    return write


def compile_template(source: str, filters: Mapping[str, Filter] | None = None) -> Callable[[Mapping], list[tuple[str, bool]]]:
    """A function from variables to (text, generated) pieces."""
    filters = dict(filters or {})
    write = _writer(fold(parse(source), filters), False, filters)

    def render(variables: Mapping) -> list[tuple[str, bool]]:
        out: list[tuple[str, bool]] = []
        write(dict(variables), out)
        return out

    return render
