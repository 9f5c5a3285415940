"""Personal data by patterns and a skip-chain conditional random field (operator 2).

Base spans come from four patterns with their checks (see ``base_spans``); each
scan is linear in the text, also for one very long token. The model works on the
tokens that hold a digit or ``@``. Its graph has an edge between neighbours in
the text and skip edges between distant tokens of one document that are the same
(ignoring case) or alike (7 digits or more, those of one the end of the other's):
all occurrences are tied to one shared variable, so the graph grows with the number
of tokens, not with its square, and any two of them are two edges apart. A number
written as several tokens is one node where it repeats: neighbouring tokens that
end like a matched phone number (7 digits or more, leading zeros and up to 3 more
digits aside) or hold all digits of a matched card, and whole runs of number tokens
that are alike. Tokens in a base span are given, and so is a
shared variable whose matched occurrences are of one kind. Loopy message passing
over that graph, until the messages settle, gives each token's label; a token that
the patterns left out but the model labels is added as a span of its own.

Weights are trained here by pseudo-likelihood on the documents with the smallest
id hash, ``FIT_DOCS`` ids at most (documented bound of the labelled sample), with
all their rows and tokens; their labels come from the base spans, carried over to
repeats of a matched token. Variables of equal features, label and labels of their
neighbours are counted on Spark, and only the counts are collected: they grow with
the number of different cases, not with the rows or the length of the texts.

Edge cases: NULL text is empty. A NULL doc_id is kept as NULL. Repeated rows are
judged one by one; other columns are ignored. Without any base span in the sample
the model adds nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + len(KINDS)  # 0: none
FIT_DOCS = 2000
MIN_PROBABILITY = 0.8
TOLERANCE = 1e-4  # largest change of a settled message
CONSISTENCY = 8.0
CHUNK = 20_000  # tokens whose graphs are solved together

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_PART = re.compile(r"[0-9]+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]++")
_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[ \x09-\x0D]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_EMAIL_SHAPE = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EDGE = "()[]{}<>.,;:!?\"'+"
_NUMBER = re.compile(r"[0-9().+/-]+")
_JOINT = frozenset(" \t().-/")  # between the tokens of one number
ALIKE = 7  # digits
LONGEST = 19  # digits of a number
PREFIX = 3  # digits before a number that is otherwise the same

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind, ordered by kind and start."""
    spans: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            done = m.end()
            spans.append((0, start, done))
        else:
            done = max(done, at + 1)  # no local part reaches across an @
        at = text.find("@", done)
    for m in _DOTTED.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts = [(p.start(), p.end()) for p in _PART.finditer(text, m.start(), m.end())]
        for i in range(0, len(parts) - 3, 4):  # four parts at a time, from the left
            if all(len(n := text[a:b].lstrip("0")) <= 3 and int(n or "0") <= 255 for a, b in parts[i : i + 4]):
                spans.append((1, parts[i][0], parts[i + 3][1]))
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        run = m[0].rstrip(" ().-")
        if len(run) >= 4 and 8 <= sum(c.isdigit() for c in run) <= 15:
            spans.append((3, m.start(), m.start() + len(run)))
    return spans


def span_string(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def tokens(text: str) -> list[tuple[int, int]]:
    """Tokens with a digit or @, without punctuation at their ends."""
    out, end = [], 0
    m = _MARK.search(text)
    while m:
        start = m.start()
        while start > end and text[start - 1] not in " \t\n\x0b\x0c\r":
            start -= 1
        stop = _SPACE.search(text, m.start())
        end = stop.start() if stop else len(text)
        a, b = start, end
        while a < b and text[a] in _EDGE:
            a += 1
        while b > a and text[b - 1] in _EDGE:
            b -= 1
        if a < b:
            out.append((a, b))
        m = _MARK.search(text, end)
    return out


def _step(n: int, *limits: int) -> int:
    return sum(n >= x for x in limits)


# Sizes of the feature templates; each token has one active value in each.
TEMPLATES = (1, 3, 8, 4, 5, 8, 2, 2, 3, 2)
_OFFSETS = np.concatenate([[0], np.cumsum(TEMPLATES)])


def _near(text: str, end: int, start: int) -> bool:
    return 0 < start - end <= 3 and "\n" not in text[end:start]


def _backwards(digits: str) -> str:
    """The digits from the last one on, without zeros at the front."""
    bare = digits.lstrip("0")
    return (bare if len(bare) >= ALIKE else digits)[::-1]


def _common(a: str, b: str) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


class _Parts:
    """The tokens of a text; those of a repeated number as one.

    ``values`` has, by the end of a token, the matched numbers it is tied to as a
    part of their span or as a repeat; ``repeats`` has the places of the repeats."""

    def __init__(self, text: str, base: list[Span]) -> None:
        self.text, self.found = text, tokens(text)
        self.digits = [_NOT_DIGIT.sub("", text[a:b]) for a, b in self.found]
        plain = [bool(_NUMBER.fullmatch(text, a, b)) for a, b in self.found]
        self.touched = [False] * len(self.found)
        self.values: dict[int, list[str]] = {}
        self.repeats: set[tuple[int, int]] = set()
        matched = self._matched(base)
        # Whether the token belongs to one number with the next one.
        self.joined = [
            plain[i] and plain[i + 1] and not self.touched[i] and not self.touched[i + 1]
            and _near(text, a[1], b[0]) and _JOINT.issuperset(text[a[1] : b[0]])
            for i, (a, b) in enumerate(zip(self.found, self.found[1:], strict=False))
        ]
        self.taken: dict[int, int] = {}  # first and last token of what is one node
        used = [False] * len(self.found)
        for _, first, last, value in sorted(self._ends_like(matched)):
            if not any(used[first : last + 1]):
                used[first : last + 1] = [True] * (last + 1 - first)
                self.taken[first] = last
                self.values.setdefault(self.found[last][1], []).append(value)
                self.repeats.add(self._place(first, last))
        for first, last in self._same_runs(used):
            self.taken[first] = last

    def _place(self, first: int, last: int) -> tuple[int, int]:
        a, b = self.found[first][0], self.found[last][1]
        opened = a > 0 and self.text[a - 1] == "(" and ")" in self.text[a:b] and "(" not in self.text[a : self.text.index(")", a)]
        return (a - 1 if opened else a), b

    def nodes(self) -> list[tuple[int, int]]:
        out, i = [], 0
        while i < len(self.found):
            last = self.taken.get(i)
            out.append(self.found[i] if last is None else self._place(i, last))
            i = i + 1 if last is None else last + 1
        return out

    def _matched(self, base: list[Span]) -> dict[str, list[tuple[str, bool]]]:
        """Digits of the matched numbers, reversed, by the last ones of them; a
        card counts as a whole. A phone span may run on into other numbers, so it
        stands for each of its beginnings of 8 digits or more."""
        ends = [b for _, b in self.found]
        by: dict[str, set[tuple[str, bool]]] = {}
        for kind, s, e in base:
            n, so_far = bisect_right(ends, s), ""
            while n < len(ends) and self.found[n][0] < e:
                self.touched[n] = True
                a, b = self.found[n]
                so_far += _NOT_DIGIT.sub("", self.text[max(a, s) : min(b, e)])
                whole = b >= e or n + 1 == len(ends) or self.found[n + 1][0] >= e
                if (kind == 3 and len(so_far) >= 8) or (kind == 2 and whole):
                    by.setdefault(so_far[-ALIKE:], set()).add((so_far[::-1], kind == 2))
                    self.values.setdefault(b, []).append(so_far)
                n += 1
        return {k: sorted(v) for k, v in by.items()}

    def _ends_like(self, matched: dict[str, list[tuple[str, bool]]]) -> list[tuple[int, int, int, str]]:
        """(- common digits, first token, last token, number) of possible repeats."""
        out = []
        for last in range(len(self.found) if matched else 0):
            if self.touched[last]:
                continue
            first, have = last, self.digits[last]
            while first > 0 and self.joined[first - 1] and len(have) < LONGEST:
                first -= 1
                have = self.digits[first] + have
            known = matched.get(have[-ALIKE:]) if len(have) >= ALIKE else None
            if not known:
                continue
            turned = have[::-1]
            at = bisect_left(known, (turned, False))
            best = max(known[max(at - 1, 0) : at + 2], key=lambda v: (_common(turned, v[0]), -len(v[0])))
            same = _common(turned, best[0])
            first, inside = last + 1, 0
            while first > 0 and inside < same and (first > last or self.joined[first - 1]):
                more = self.digits[first - 1]
                extra = more[: max(0, inside + len(more) - same)]
                if extra.strip("0") and not (same == len(best[0]) and len(extra) <= PREFIX):
                    break
                first -= 1
                inside += len(more)
            inside = min(inside, same)
            if inside >= ALIKE and (not best[1] or inside == len(best[0])):
                out.append((-inside, first, last, best[0][::-1]))
        return out

    def _same_runs(self, used: list[bool]) -> list[tuple[int, int]]:
        """Whole runs of number tokens whose digits another number has or ends with."""
        values, i = [], 0
        while i < len(self.found):
            j, size = i, len(self.digits[i])
            while j < len(self.joined) and self.joined[j]:
                j += 1
                size += len(self.digits[j])
            if j > i and ALIKE <= size <= LONGEST and not any(used[i : j + 1]):
                values.append((_backwards("".join(self.digits[i : j + 1])), i, j))
            values.extend((_backwards(self.digits[k]), k, k) for k in range(i, j + 1) if len(self.digits[k]) >= ALIKE)
            i = j + 1
        values.sort()
        out, ends = [], []
        for n, (value, first, last) in enumerate(values):
            while ends and not value.startswith(ends[-1]):
                ends.pop()
            if first < last:
                longer = n + 1 < len(values) and values[n + 1][0].startswith(value)
                shorter = bool(ends) and len(ends[-1]) > len(self.digits[last]) and len(value) - len(ends[-1]) <= PREFIX
                if longer or shorter:
                    out.append((first, last))
            ends.append(value)
        return out


@dataclass
class Graph:
    """The tokens of some documents, their features and edges."""

    feats: list[list[int]] = field(default_factory=list)
    chain: list[tuple[int, int]] = field(default_factory=list)
    tied: list[tuple[int, int]] = field(default_factory=list)  # token, shared variable (numbered from 0)
    shared: int = 0
    spans: list[tuple[int, int, int]] = field(default_factory=list)  # document, start, end
    keys: list[str | None] = field(default_factory=list)

    @property
    def skip(self) -> list[tuple[int, int]]:
        """The edges to the shared variables, which are numbered after the tokens."""
        return [(a, len(self.feats) + b) for a, b in self.tied]

    def add(self, doc: int, text: str, base: list[Span] | None = None) -> None:
        parts = _Parts(text, base_spans(text) if base is None else base)
        found = parts.nodes()
        first = len(self.feats)
        near = [_near(text, a[1], b[0]) for a, b in zip(found, found[1:], strict=False)]
        alike: dict[str, list[int]] = {}
        values: list[tuple[str, int]] = []
        i = 0
        while i < len(found):
            j = i
            while j < len(near) and near[j] and j - i < 8:
                j += 1
            whole = "".join(_NOT_DIGIT.sub("", text[a:b]) for a, b in found[i : j + 1])
            plus = found[i][0] > 0 and "+" in text[max(0, found[i][0] - 2) : found[i][0]]
            card = 16 <= len(whole) <= 19 and luhn(whole)
            for k in range(i, j + 1):
                node = first + k
                core = text[found[k][0] : found[k][1]]
                digits = _NOT_DIGIT.sub("", core)
                self.feats.append(_features(core, digits, len(whole), plus, card, k - i, j - i))
                self.spans.append((doc, *found[k]))
                key = core.lower() if len(core) >= 5 and ("@" in core or len(digits) >= 5) else None
                self.keys.append(key)
                for value in parts.values.get(found[k][1], ()):
                    alike.setdefault("+" + value, []).append(node)
                if key is not None and found[k] not in parts.repeats:
                    if len(digits) >= ALIKE:
                        values.append((_backwards(digits), node))
                    else:
                        alike.setdefault(key, []).append(node)
                if k > i:
                    self.chain.append((node - 1, node))
            i = j + 1
        root = ""
        for value, node in sorted(values):  # what ends like the root follows it
            if not root or not value.startswith(root):
                root = value
            alike.setdefault("#" + root, []).append(node)
        for nodes in alike.values():
            if len(nodes) > 1:
                self.tied.extend((node, self.shared) for node in nodes)
                self.shared += 1


def _features(core: str, digits: str, run: int, plus: bool, card: bool, place: int, last: int) -> list[int]:
    if "@" in core:
        at = 1 if _EMAIL_SHAPE.fullmatch(core) else 2
    else:
        at = 0
    parts = core.split(".")
    octets = len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    dots = 0 if len(parts) == 1 else 1 if octets else 2 if len(parts) == 4 else 3
    rest = set(core) - set("0123456789")
    chars = 0 if not rest else 1 if rest <= {"-"} else 2 if rest <= {"."} else 3 if rest <= set("-.() ") else 4
    steps = (4, 6, 7, 8, 12, 16, 20)
    values = (
        0, at, _step(len(digits), *steps), dots, chars, _step(run, *steps), int(plus and 8 <= run <= 15), int(card),
        0 if place == 0 else 2 if place == last else 1, int(plus),
    )
    return [int(_OFFSETS[t]) + v for t, v in enumerate(values)]


def matched_labels(graph: Graph, base: list[list[Span]]) -> np.ndarray:
    """Labels of the tokens that a base span touches (0: none), then those of the
    shared variables: their tokens' label, 0 if there is none or more than one."""
    labels = np.zeros(len(graph.feats) + graph.shared, dtype=np.int64)
    docs, ends = [s[0] for s in graph.spans], [s[2] for s in graph.spans]
    for doc, spans in enumerate(base):
        first, stop = bisect_right(docs, doc - 1), bisect_right(docs, doc)
        for kind, s, e in spans:
            n = bisect_right(ends, s, first, stop)
            while n < stop and graph.spans[n][1] < e:
                labels[n] = kind + 1
                n += 1
    kinds: dict[int, set[int]] = {}
    for token, variable in graph.skip:
        if labels[token]:
            kinds.setdefault(variable, set()).add(int(labels[token]))
    for variable, found in kinds.items():
        labels[variable] = found.pop() if len(found) == 1 else 0
    return labels


def silver_labels(graph: Graph, base: list[list[Span]]) -> np.ndarray:
    """Labels from the base spans, carried over to repeats of a matched token;
    the shared variables' labels follow those of the tokens."""
    labels = matched_labels(graph, base)
    for _ in range(2):  # to the shared variables, then to their other tokens
        for token, variable in graph.skip:
            if labels[token] and not labels[variable]:
                labels[variable] = labels[token]
            elif labels[variable] and not labels[token]:
                labels[token] = labels[variable]
    return labels


def _edge_array(edges: list[tuple[int, int]]) -> np.ndarray:
    return np.array(edges, dtype=np.int64).reshape(-1, 2)


@dataclass
class Model:
    nodes: np.ndarray  # feature, label
    chain: np.ndarray  # label, label
    skip: np.ndarray  # label, label


def _potentials(weights: np.ndarray, feats: np.ndarray, n: int) -> np.ndarray:
    """One row per variable; those after the tokens have no features."""
    node = np.zeros((n, LABELS))
    if len(feats):
        node[: len(feats)] = weights[feats].sum(axis=1)
    return node


def cases(graph: Graph, labels: np.ndarray) -> np.ndarray:
    """One row per variable: its label, how many neighbours it has of each label
    along the chain and the skip edges, its features (-1: a shared variable)."""
    one = np.eye(LABELS, dtype=np.int64)
    out = np.full((len(labels), 1 + 2 * LABELS + len(TEMPLATES)), -1, dtype=np.int64)
    out[:, 0] = labels
    for at, edges in ((1, _edge_array(graph.chain)), (1 + LABELS, _edge_array(graph.skip))):
        total = np.zeros((len(labels), LABELS), dtype=np.int64)
        np.add.at(total, edges[:, 0], one[labels[edges[:, 1]]])
        np.add.at(total, edges[:, 1], one[labels[edges[:, 0]]])
        out[:, at : at + LABELS] = total
    if graph.feats:
        out[: len(graph.feats), 1 + 2 * LABELS :] = graph.feats
    return out


def train(rows: np.ndarray, counts: np.ndarray, rounds: int = 300, l2: float = 1e-3) -> Model:
    """Pseudo-likelihood: each variable's label given its features and the labels
    of its neighbours (Adam, deterministic). ``rows`` as of ``cases``, each found
    ``counts`` times."""
    size = int(_OFFSETS[-1])
    one = np.eye(LABELS)
    labels, feats = rows[:, 0], rows[:, 1 + 2 * LABELS :]
    chain, skip = rows[:, 1 : 1 + LABELS].astype(float), rows[:, 1 + LABELS : 1 + 2 * LABELS].astype(float)
    share = (counts / counts.sum())[:, None]
    # Tied tokens agree unless the sample says otherwise: a prior, and the start.
    prior = [np.zeros((size, LABELS)), np.zeros((LABELS, LABELS)), CONSISTENCY * np.eye(LABELS)]
    params = [p.copy() for p in prior]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        weights = np.concatenate([params[0], np.zeros((1, LABELS))])  # the last row is that of no feature, -1
        score = weights[feats].sum(axis=1) + chain @ params[1] + skip @ params[2]
        score -= score.max(axis=1, keepdims=True)
        p = np.exp(score)
        p /= p.sum(axis=1, keepdims=True)
        miss = (one[labels] - p) * share
        g0 = np.zeros_like(weights)
        for t in range(feats.shape[1]):
            np.add.at(g0, feats[:, t], miss)
        grads = [g0[:-1], chain.T @ miss, skip.T @ miss]
        grads[1], grads[2] = (grads[1] + grads[1].T) / 2, (grads[2] + grads[2].T) / 2  # one table for both directions
        for k, g in enumerate(grads):
            g = g - l2 * (params[k] - prior[k])
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            params[k] = params[k] + 0.1 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(*params)


def marginals(
    model: Model, feats: np.ndarray, chain: np.ndarray, skip: np.ndarray, sweeps: int | None = None, damping: float = 0.3, given: np.ndarray | None = None
) -> np.ndarray:
    """Label probabilities of the tokens by loopy sum-product message passing (all
    messages at once per sweep, in logarithms, damped).

    Edges may name shared variables, numbered after the tokens. ``given`` has a
    known label of each variable, or 0. Without ``sweeps`` the messages are passed
    until none would change by ``TOLERANCE``. Should some circle, the damping grows;
    the last stop is one sweep per variable, when any message has crossed the graph."""
    both = np.concatenate([chain, skip])
    m = len(both)
    n = max(len(feats), int(both.max()) + 1 if m else 0)
    node = _potentials(model.nodes, feats, n)
    if given is not None:
        known = np.nonzero(given)[0]
        node[known] = -1e6
        node[known, given[known]] = 0
    source = np.concatenate([both[:, 0], both[:, 1]])
    target = np.concatenate([both[:, 1], both[:, 0]])
    back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    is_skip = np.tile(np.arange(m) >= len(chain), 2).astype(np.int64)
    tables = np.stack([model.chain, model.skip])
    messages = np.zeros((2 * m, LABELS))
    belief = node.copy()
    at = np.arange(2 * m)  # the messages that may still change
    sweep = 0
    while len(at) and sweep < (n + 100 if sweeps is None else sweeps):
        sweep += 1
        out = belief[source[at]] - messages[back[at]]  # all but what came from the target
        new = np.logaddexp.reduce(out[:, :, None] + tables[is_skip[at]], axis=1)
        new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
        moved = np.abs(new - messages[at]).max(axis=1) >= TOLERANCE
        messages[at] = damping * messages[at] + (1 - damping) * new
        belief = node.copy()
        np.add.at(belief, target, messages)
        if sweeps is None:
            live = np.zeros(2 * m, dtype=bool)
            live[at[moved]] = True
            fresh = np.zeros(n, dtype=bool)
            fresh[target[at[moved]]] = True
            at = np.nonzero(live | fresh[source])[0]
            if sweep % 100 == 0:
                damping = (1 + damping) / 2 if damping < 0.9 else damping
    belief = belief[: len(feats)]
    belief -= np.logaddexp.reduce(belief, axis=1, keepdims=True) if len(feats) else 0
    return np.exp(belief)


def added_spans(graph: Graph, model: Model, base: list[list[Span]]) -> list[list[Span]]:
    """Per document, the labelled tokens that no base span touches; neighbours
    of one label form one span."""
    out: list[list[Span]] = [[] for _ in base]
    if not graph.feats:
        return out
    given = matched_labels(graph, base)
    p = marginals(model, np.array(graph.feats), _edge_array(graph.chain), _edge_array(graph.skip), given=given)
    best = p.argmax(axis=1)
    sure = (best > 0) & (p[np.arange(len(best)), best] >= MIN_PROBABILITY)
    linked = {b for _, b in graph.chain}
    for n in np.nonzero(sure)[0].tolist():
        doc, a, b = graph.spans[n]
        if graph.keys[n] is None or given[n]:
            continue
        kind = int(best[n]) - 1
        if n in linked and out[doc] and out[doc][-1][0] == kind and out[doc][-1][2] == graph.spans[n - 1][2]:
            out[doc][-1] = (kind, out[doc][-1][1], b)
        else:
            out[doc].append((kind, a, b))
    return out


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter[tuple[int, ...]] = Counter()
        for text in batch["text"].tolist():
            base = base_spans(text)
            graph = Graph()
            graph.add(0, text, base)
            if graph.feats:
                rows, found = np.unique(cases(graph, silver_labels(graph, [base])), axis=0, return_counts=True)
                for case, n in zip(rows.tolist(), found.tolist(), strict=True):
                    counts[tuple(case)] += n
        if counts:
            yield pd.DataFrame({"case": [list(case) for case in counts], "n": list(counts.values())})


def sampled_cases(docs: DataFrame, limit: int = FIT_DOCS) -> DataFrame:
    """The different cases in the documents of at most ``limit`` ids, and their counts."""
    ids = docs.select("doc_id").dropna().distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    sample = docs.join(F.broadcast(ids), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"))
    return sample.mapInPandas(_counted, "case array<int>, n long").groupBy("case").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, limit: int = FIT_DOCS) -> Model | None:
    """The model from the documents of at most ``limit`` ids; None if nothing is labelled."""
    found = sorted((r.case, r.n) for r in sampled_cases(docs, limit).collect())
    rows = np.array([case for case, _ in found], dtype=np.int64).reshape(-1, 1 + 2 * LABELS + len(TEMPLATES))
    if not rows[:, 0].any():
        return None
    return train(rows, np.array([n for _, n in found], dtype=float))


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans."""

    def solve(ids: list, base: list[list[Span]], graph: Graph) -> pd.DataFrame:
        added = added_spans(graph, model, base) if model is not None else [[] for _ in base]
        rows = []
        for doc_id, spans, more in zip(ids, base, added, strict=True):
            counts = [sum(s[0] == k for s in spans) for k in range(len(KINDS))]
            digest = hashlib.sha256(span_string(spans).encode()).hexdigest()
            rows.append((None if doc_id is None else int(doc_id), *counts, digest, span_string(spans + more), len(more)))
        out = pd.DataFrame(rows, columns=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, base, graph = [], [], Graph()
            for doc_id, text in zip(batch["doc"].tolist(), batch["text"].tolist(), strict=True):
                base.append(base_spans(text))
                graph.add(len(ids), text, base[-1])
                ids.append(doc_id)
                if len(graph.feats) >= CHUNK:
                    yield solve(ids, base, graph)
                    ids, base, graph = [], [], Graph()
            if ids:
                yield solve(ids, base, graph)

    rows = docs.select(F.col("doc_id").cast("string").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, FOUND)
