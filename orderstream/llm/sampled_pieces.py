"""SentencePiece encoding by sampling without replacement, and decoding (operator 1).

The pieces of a SentencePiece model span a lattice over the normalised text: one
edge per piece that matches at a position, single bytes as the fall-back where no
piece covers a character. With edge weights exp(alpha * score) a segmentation's
probability is its weight over the sum of all. ``encode`` draws the ``k`` best of
Gumbel-perturbed segmentations, which is a sample without replacement, by a
perturbed A* search: a region is "this prefix, not these next edges"; its bound is
a Gumbel of its log mass, truncated at the bound of the region it was cut from, and
equals the value of its best segmentation. So the region with the largest bound is
taken out, its best segmentation drawn by extending the prefix edge by edge, and
the rest of it split along that path. Only the ``k`` best regions can matter, so
no more are kept; nothing else is pruned. The search also gives the bound of the
best segmentation not taken; a drawn one with log probability ``p`` exceeds such a
threshold ``t`` with the inclusion score 1 - exp(-exp(p - t)).

Randomness comes from (seed, row key), so a retried task repeats its draw. No piece
of the model spans the start of a word, so the lattice falls into independent words
(checked when the model is loaded: a word starts at a space mark that follows a
character which is not one). Lattices are built once per distinct word of some
megabytes of text and kept as flat arrays; drawing and splitting are array operations over a
whole document.

The model's scores are merge ranks for a BPE file, so its pieces get the weight
1 / (rank + 1); a unigram file's scores are used as they are.

Edge cases: NULL or empty text has one segmentation, the empty one. If a text has
fewer than ``k`` segmentations, it gets them all, with inclusion 1. Repeated rows
draw alike; a NULL key is a key. Other columns are ignored. Control pieces are never
produced, also not from texts that spell them. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import math
from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
DRAWS = 2
ALPHA = 1.0
SEED = 7
MARK = "▁"
_MARK_BYTES = MARK.encode()
_BARE = 1 << 22  # added to piece numbers; below it are the characters without a piece
#: Characters of the texts that share their words' lattices, and of those that are
#: walked together.
CHUNK_CHARS = 4_000_000
BATCH_CHARS = 1_000_000
SLAB_CHARS = 50_000  # of words whose lattices are built together


class Trie:
    """The pieces as a table of (node, character) -> node, looked up for many
    positions at a time (open addressing with linear probing). Characters are
    numbered densely (0: in no piece), so that a key is as short as can be."""

    def __init__(self, pieces: dict[str, int]):
        alphabet = sorted({ord(c) for c in set("".join(pieces))})
        self.alphabet = np.array(alphabet, dtype=np.int64)
        number = {c: i + 1 for i, c in enumerate(alphabet)}
        width = len(alphabet) + 1
        step: dict[int, int] = {}  # node * width + character
        piece = [-1]
        for text, value in pieces.items():
            node = 0
            for c in text:
                key = node * width + number[ord(c)]
                node = step.get(key, 0)
                if not node:
                    node = step[key] = len(piece)
                    piece.append(-1)
            piece[node] = value
        self.piece = np.array(piece, dtype=np.int64)
        self.bits = max(4, int(len(step) * 2.5).bit_length())
        self.kind = np.uint32 if len(piece) * width < 2**32 - 1 else np.uint64
        self.width = self.kind(width)
        self.shift = self.kind(self.kind().itemsize * 8 - self.bits)
        self.odd = self.kind(0x9E3779B97F4A7C15 >> (64 - self.kind().itemsize * 8) | 1)
        self.mask = (1 << self.bits) - 1
        self.free = self.kind(-1 % (1 << self.kind().itemsize * 8))
        self.inner = np.zeros(len(piece), dtype=bool)  # nodes that lead further
        self.inner[[key // width for key in step]] = True
        keys = np.fromiter(step, self.kind, len(step))
        values = np.fromiter(step.values(), np.int32, len(step))
        self.keys = np.full(1 << self.bits, self.free, dtype=self.kind)
        self.values = np.full(1 << self.bits, -1, dtype=np.int32)
        at = self._home(keys)
        todo = np.arange(len(keys))
        while len(todo):
            slot = at[todo]
            free = self.keys[slot] == self.free
            self.keys[slot[free]] = keys[todo[free]]  # of several on one slot the last one stays
            won = self.keys[slot] == keys[todo]
            self.values[slot[won]] = values[todo[won]]
            todo = todo[~won]
            at[todo] = (at[todo] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self.odd) >> self.shift).astype(np.int32)

    def numbers(self, chars: np.ndarray) -> np.ndarray:
        """The dense numbers of characters."""
        at = np.minimum(np.searchsorted(self.alphabet, chars), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == chars, at + 1, 0).astype(self.kind)

    def next(self, nodes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The node each one leads to, or -1."""
        keys = nodes.astype(self.kind) * self.width + numbers
        slot = self._home(keys)
        found = self.keys[slot]
        hit = found == keys
        out = self.values[slot]
        out[~hit] = -1
        todo = np.flatnonzero(~hit & (found != self.free))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            found = self.keys[slot[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (found != self.free)]
        return out


class Pieces:
    """Pieces and weights of a model file, and the flat lattices of words."""

    def __init__(self, model_bytes: bytes, alpha: float = ALPHA):
        import sentencepiece

        self.processor = p = sentencepiece.SentencePieceProcessor(model_proto=model_bytes)
        n = p.get_piece_size()
        self.text: dict[str, int] = {}
        byte = np.zeros(256, dtype=np.int64)
        ranks = np.zeros(n)
        for i in range(n):
            piece, ranks[i] = p.id_to_piece(i), p.get_score(i)
            if p.is_byte(i):
                byte[int(piece[1:-1], 16)] = i
            elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)):
                self.text[piece] = i
        self.byte = byte
        whole = ranks[list(self.text.values())]
        merges = bool(len(whole)) and bool((whole <= 0).all()) and bool((whole == np.round(whole)).all()) and float(whole.min()) < -1000
        # Scores of -1e9 mark pieces outside the merge order: they come last.
        self.score = alpha * (-np.log1p(np.minimum(-ranks, n)) if merges else ranks)
        self.byte_score = alpha * (-math.log(2.0 * n) if merges else float(whole.min(initial=0.0)) - 10.0)
        if max(map(len, self.text), default=0) >= 1 << 10:
            raise ValueError("a piece of this model is too long")
        if any(a != MARK and b == MARK for t in self.text for a, b in zip(t, t[1:], strict=False)):
            raise ValueError("a piece of this model spans the start of a word")
        self.trie = Trie(self.text)
        self.starts([])

    def _edges(self, chars: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(from, to, piece, score) of all edges, ordered by where they start and
        by length; a negative piece stands for the bytes of a character."""
        start, node, length = np.arange(len(chars)), np.zeros(len(chars), dtype=np.int32), 0
        numbers = self.trie.numbers(chars)
        found: list[np.ndarray] = []
        covered = np.zeros(len(chars), dtype=bool)
        while len(start):
            node = self.trie.next(node, numbers[start + length])
            length += 1
            on = np.flatnonzero(node >= 0)
            start, node = start[on], node[on]
            piece = self.trie.piece[node]
            is_piece = np.flatnonzero(piece >= 0)
            begin = start[is_piece]
            found.append(begin << 33 | length << 23 | (piece[is_piece] + _BARE))
            if length == 1:
                covered[begin] = True
            on = np.flatnonzero(self.trie.inner[node] & (start + length < end[start]))
            start, node = start[on], node[on]
        bare = np.flatnonzero(~covered)
        found.append(bare << 33 | 1 << 23 | (_BARE - 1 - chars[bare]))
        # One sort of whole numbers: start, length, piece.
        edge = np.sort(np.concatenate(found))
        begin, piece = edge >> 33, (edge & (1 << 23) - 1) - _BARE
        score = self.score[np.maximum(piece, 0)]
        odd = np.flatnonzero(piece < 0)
        code = -1 - piece[odd]
        score[odd] = self.byte_score * (1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))  # bytes of a bare character
        return begin, begin + (edge >> 23 & (1 << 10) - 1), piece, score

    def _build(self, chars: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """The lattices of words, given as their characters and lengths: edges of
        each node; per edge the cumulative probability within its node, the node
        it leads to (-1: the word's end), the piece and the log probability."""
        n = len(chars)
        end = np.repeat(np.cumsum(size), size)
        begin, to, piece, score = self._edges(chars, end)
        degree = np.bincount(begin, minlength=n)
        first = np.concatenate([[0], np.cumsum(degree)])
        # Log weight of all ways from a character to its word's end, for all words
        # at a time: characters by their distance from it. Place n is every end.
        beta = np.zeros(n + 1)
        log = np.empty(len(to))
        share = np.empty(len(to))
        to = np.where(to == end[begin], n, to) if n else to
        left = end - np.arange(n)
        by_left = np.argsort(left.astype(np.uint16) if len(left) and left.max() < 1 << 16 else left, kind="stable")
        cut = np.concatenate([[0], np.cumsum(np.bincount(left, minlength=1)[1:])])
        for d in range(len(cut) - 1):
            at = by_left[cut[d] : cut[d + 1]]
            many = degree[at]
            offset = np.cumsum(many) - many
            e = np.arange(int(many.sum())) + np.repeat(first[at] - offset, many)
            value = score[e] + beta[to[e]]
            top = np.maximum.reduceat(value, offset)
            part = np.exp(value - np.repeat(top, many))
            whole = np.add.reduceat(part, offset)
            beta[at] = top + np.log(whole)
            share[e] = part / np.repeat(whole, many)
            log[e] = value - np.repeat(beta[at], many)
        total = np.cumsum(share)
        cum = total - np.concatenate([[0.0], total])[first[begin]]
        cum[first[1:] - 1] = 1.0
        return degree, cum, np.where(to == n, -1, to).astype(np.int32), piece.astype(np.int32), log

    def arrays(self):
        return self._arrays

    def normalise(self, text: str) -> str:
        return self.processor.normalize(text) if text else ""

    def starts(self, texts: list[str]) -> list[np.ndarray]:
        """For each normalised text the nodes at which its words start (a node per
        character). From now on ``arrays`` holds the lattices of these texts, each
        distinct word's once."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        size = np.array([len(r) for r in raw], dtype=np.int64)
        data = np.frombuffer(b"".join([*raw, bytes(len(_MARK_BYTES))]), dtype=np.uint8)
        n, ends = len(data) - len(_MARK_BYTES), np.cumsum(size)
        mark = np.ones(n, dtype=bool)
        for i, byte in enumerate(_MARK_BYTES):
            mark &= data[i : n + i] == byte
        # A word starts at a text's start, and at a mark that follows no mark.
        first = mark.copy()
        first[len(_MARK_BYTES) :] &= ~mark[: -len(_MARK_BYTES)]
        first[(ends - size)[size > 0]] = True
        at = np.flatnonzero(first)
        offsets = pa.py_buffer(np.append(at, n).astype(np.int64))
        coded = pa.Array.from_buffers(pa.large_binary(), len(at), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        words = coded.dictionary
        if not len(words):
            none = np.zeros(0, dtype=np.int32)
            self._arrays = (np.zeros(1, dtype=np.int64), np.zeros(0), none, none, np.zeros(0))
            return [np.zeros(0, dtype=np.int64) for _ in texts]
        # Words by length, some thousand at a time: their arrays fit a cache, and
        # words of equal length take equally many steps.
        order = np.argsort(np.diff(np.frombuffer(words.buffers()[1], np.int64, len(words) + 1)), kind="stable")
        words = words.take(pa.array(order))
        cuts = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1)
        raw = words.buffers()[2].to_pybytes()
        begins = (np.frombuffer(raw, np.uint8, int(cuts[-1])) & 0xC0) != 0x80  # bytes that begin a character
        length = np.add.reduceat(begins, cuts[:-1], dtype=np.int64)
        begin = np.cumsum(length) - length
        slab = np.flatnonzero(np.diff(begin // SLAB_CHARS, prepend=-1))
        parts = []
        for low, high in zip(slab, np.append(slab[1:], len(length))):
            text = raw[cuts[low] : cuts[high]].decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass")
            degree, cum, to, piece, log = self._build(np.frombuffer(text, dtype=np.uint32).astype(np.int64), length[low:high])
            to[to >= 0] += begin[low]
            parts.append((degree, cum, to, piece, log))
        columns = [list(x) for x in zip(*parts, strict=True)]
        del parts, degree, cum, to, piece, log
        joined = []
        for column in columns:  # one at a time: its parts go when it is joined
            joined.append(np.concatenate(column))
            column.clear()
        self._arrays = (np.concatenate([[0], np.cumsum(joined[0])]), *joined[1:])
        node = np.empty(len(order), dtype=np.int64)
        node[order] = begin
        return np.split(node[coded.indices.to_numpy()], np.searchsorted(at, ends[:-1]))


@dataclass
class Draw:
    """A segmentation: its edges, where each word's edges start, and its value."""

    edges: np.ndarray
    word: np.ndarray  # word of each edge
    value: float  # Gumbel-perturbed log probability
    log_p: float = 0.0


def uniforms(streams: np.ndarray, step: int) -> np.ndarray:
    """The ``step``-th number of each stream (a mixed counter), in [0, 1)."""
    x = streams + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53


def walk(pieces: Pieces, starts: np.ndarray, streams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Draw a path from each start node to its word's end, by a stream of random
    numbers per word: (edges, word of each), in text order."""
    first, cum, to, _, _ = pieces.arrays()
    at, who = starts, np.arange(len(starts))
    edges, words = [], []
    while len(at):
        e, u = first[at], uniforms(streams[who], len(edges))
        on = np.flatnonzero(cum[e] <= u)
        while len(on):  # a node has few edges, and the last one's value is 1
            e[on] += 1
            on = on[cum[e[on]] <= u[on]]
        edges.append(e)
        words.append(who)
        nxt = to[e]
        on = np.flatnonzero(nxt >= 0)
        at, who = nxt[on], who[on]
    if not edges:
        none = np.zeros(0, dtype=np.int64)
        return none, none
    # Step s of a word goes s places behind the word's first edge.
    many = np.zeros(len(starts), dtype=np.int64)
    for who in words:
        many[who] += 1
    place = np.cumsum(many) - many
    e = np.empty(int(many.sum()), dtype=np.int64)
    for step, who in enumerate(words):
        e[place[who] + step] = edges[step]
    return e, np.repeat(np.arange(len(starts)), many)


def best_regions(prefix: np.ndarray, share: np.ndarray, bound: float, need: int, rng: np.random.Generator) -> list[tuple[int, float]]:
    """The ``need`` regions of the largest value, by place. A region's value is a
    Gumbel of location prefix + log(share), given that it does not exceed ``bound``;
    the condition keeps the order of the values, so it is applied to the best only."""
    with np.errstate(divide="ignore"):
        free = prefix + np.log(share / rng.standard_exponential(len(share)))
    best = np.argpartition(-free, need - 1)[:need] if len(free) > need else np.arange(len(free))
    best = np.sort(best[free[best] > -np.inf])
    return list(zip(best.tolist(), (-np.logaddexp(-bound, -free[best])).tolist(), strict=True))


def streams_of(key: int, words: np.ndarray) -> np.ndarray:
    """A stream for each word number of one text."""
    x = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) ^ np.uint64(key)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


Path = tuple[np.ndarray, np.ndarray]


def search(pieces: Pieces, starts: np.ndarray, k: int, key: int) -> Generator[tuple, Path, tuple[list[Draw], float]]:
    """The ``k`` best perturbed segmentations of a text given as the start nodes
    of its words, best first, and the bound of the best one not taken. The search
    yields what is to be walked (start nodes, streams) and is sent the path, so
    that ``sample`` can walk for many texts at a time."""
    rng = np.random.Generator(np.random.PCG64(key))
    first, _, to, _, logs = pieces.arrays()
    node_of = lambda edge: int(np.searchsorted(first, edge, "right")) - 1  # noqa: E731  every node has an edge
    whole = float(rng.gumbel())
    # (-bound, number, parent draw, position in it, excluded edges); None: the root.
    heap: list = [(-whole, 0, None, 0, ())]
    made, out = 1, []
    while heap and len(out) < k:
        neg, _, parent, at, excluded = heapq.heappop(heap)
        bound = -neg
        if parent is None:
            e, w = yield starts, streams_of(key, np.arange(len(starts)))
        else:
            node, word = node_of(int(parent.edges[at])), int(parent.word[at])
            options = [x for x in range(int(first[node]), int(first[node + 1])) if x not in excluded]
            weights = np.exp(logs[options])
            pick = options[min(int(np.searchsorted(np.cumsum(weights), rng.random() * weights.sum())), len(options) - 1)]
            rest = np.concatenate([to[pick : pick + 1][to[pick : pick + 1] >= 0], starts[word + 1 :]])
            ends_word = int(to[pick]) < 0
            e, w = yield rest, rng.integers(0, 2**64, len(rest), dtype=np.uint64)
            w = w + (word + 1 if ends_word else word)
            e = np.concatenate([parent.edges[:at], [pick], e])
            w = np.concatenate([parent.word[:at], [word], w])
        draw = Draw(e, w, bound)
        taken = logs[e]
        before = np.concatenate([[0.0], np.cumsum(taken)])
        draw.log_p = float(before[-1])
        out.append(draw)
        exclude_here = (*excluded, int(e[at])) if len(e) else ()
        # The regions beside the new path, from the popped position on: the share
        # of each one's mass in its prefix (0 where a node has one edge only).
        beside = -np.expm1(np.minimum(taken[at:], 0.0))
        if parent is not None:
            left = [x for x in range(int(first[node]), int(first[node + 1])) if x not in exclude_here]
            beside[0] = np.exp(logs[left]).sum()
        need = k - len(out) + 1  # one more, for the threshold
        for pos, value in best_regions(before[at:-1], beside, bound, need, rng):
            pos += at
            heapq.heappush(heap, (-value, made, draw, pos, exclude_here if pos == at else (int(e[pos]),)))
            made += 1
        if len(heap) > need:
            heap = heapq.nsmallest(need, heap)
            heapq.heapify(heap)
    return out, -heap[0][0] if heap else -math.inf


def ids_of(pieces: Pieces, edges: np.ndarray) -> np.ndarray:
    """Piece numbers of a path; a character without a piece becomes its bytes."""
    ids = pieces.arrays()[3][edges]  # a copy
    bare = np.nonzero(ids < 0)[0]
    if len(bare):
        code = -1 - ids[bare]
        if code.max() < 0x80:
            ids[bare] = pieces.byte[code]
        else:
            raw = [chr(c).encode("utf-8", "surrogatepass") for c in code.tolist()]
            many = np.ones(len(ids), dtype=np.int64)
            many[bare] = [len(r) for r in raw]
            at = np.repeat(np.arange(len(ids)), many)
            is_bare = ids < 0
            ids = ids[at]
            ids[is_bare[at]] = pieces.byte[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    return ids.astype(np.int32, copy=False)


def _key(seed: int, key: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{seed}:{key}".encode())


def sample(pieces: Pieces, texts: list[np.ndarray], k: int, keys: list[int]) -> list[tuple[list[Draw], float]]:
    """The result of ``search`` for each text; in each round the paths that all
    unfinished searches ask for are walked together."""
    done: dict[int, tuple[list[Draw], float]] = {}
    running = [(i, search(pieces, t, k, key)) for i, (t, key) in enumerate(zip(texts, keys, strict=True))]
    asked = [next(g) for _, g in running]
    while running:
        e, w = walk(pieces, np.concatenate([a[0] for a in asked]), np.concatenate([a[1] for a in asked]))
        offset = np.concatenate([[0], np.cumsum([len(a[0]) for a in asked])])
        cut = np.searchsorted(w, offset)
        on, asked = [], []
        for j, (i, g) in enumerate(running):
            part = slice(cut[j], cut[j + 1])
            try:
                asked.append(g.send((e[part], w[part] - offset[j])))
                on.append((i, g))
            except StopIteration as end:
                done[i] = end.value
        running = on
    return [done[i] for i in range(len(texts))]


def load(path: str = MODEL_FILE) -> bytes:
    with open(path, "rb") as f:
        return f.read()


ENCODED = "doc_id long, draw int, n_pieces long, ids array<int>, log_prob double, log_inclusion double, weight double"
CHECKED = ENCODED + ", text_sha256 string"


@functools.lru_cache(maxsize=1)
def _prepared(model: bytes, alpha: float) -> tuple[Pieces, Callable[[np.ndarray], str]]:
    """Kept by a Python worker from one task to the next."""
    return Pieces(model, alpha), decoder(model)


def encode(
    docs: DataFrame, model: bytes, k: int = DRAWS, alpha: float = ALPHA, seed: int = SEED, decoded: bool = False
) -> DataFrame:
    """``k`` rows per document: doc_id, draw (best first), n_pieces, ids,
    log_prob, log_inclusion (logarithm of the inclusion score: that of a long
    text is too small for a double) and weight = probability / inclusion.
    ``decoded`` adds text_sha256, a digest of the text that the drawn ids decode
    to, made where they are drawn (``decode`` gives the text itself)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one model file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, decoding = _prepared(shared.value, alpha)
        restore = decoding if decoded else None
        todo: list[tuple] = []
        chars = 0

        def drawn() -> Iterator[pa.RecordBatch]:
            starts = pieces.starts([text for _, text in todo])
            size = np.cumsum([len(text) for _, text in todo]) // BATCH_CHARS
            for at in np.split(np.arange(len(todo)), np.flatnonzero(np.diff(size)) + 1):
                yield from some([todo[i][0] for i in at], [starts[i] for i in at])

        def some(keys: list, starts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            rows, size = [], 0
            found = sample(pieces, starts, k, [_key(seed, repr(key)) for key in keys])
            for key, (draws, threshold) in zip(keys, found, strict=True):
                for r, d in enumerate(draws):
                    ids = ids_of(pieces, d.edges)
                    log_q = 0.0 if threshold == -math.inf else _log_inclusion(d.log_p - threshold)
                    row = (None if key is None else int(key), r, len(ids), ids, d.log_p, log_q, math.exp(d.log_p - log_q))
                    if restore:
                        row += (hashlib.sha256(restore(ids).encode("utf-8", "surrogatepass")).hexdigest(),)
                    rows.append(row)
                    size += len(ids)
                if size > 1_000_000:
                    yield _encoded(rows, decoded)
                    rows, size = [], 0
            if rows:
                yield _encoded(rows, decoded)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                todo.append((key, pieces.normalise(text)))
                chars += len(text)
                if chars >= CHUNK_CHARS:
                    yield from drawn()
                    todo, chars = [], 0
        if todo:
            yield from drawn()
        pieces.starts([])  # the lattices go, the model stays for the next task

    rows = docs.select(F.col("doc_id").cast("string").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, CHECKED if decoded else ENCODED)


def _log_inclusion(x: float) -> float:
    """log(1 - exp(-exp(x)))"""
    if x < -30:
        return x  # the probability itself, where exp would round it off
    return math.log(-math.expm1(-math.exp(min(x, 50.0))))


def _encoded(rows: list[tuple], decoded: bool) -> pa.RecordBatch:
    doc, draw, size, ids, log_p, log_q, weight, *text = zip(*rows, strict=True)
    ends = np.cumsum(size).astype(np.int32)
    columns = {
        "doc_id": pa.array(doc, pa.int64()), "draw": pa.array(draw, pa.int32()), "n_pieces": pa.array(size, pa.int64()),
        "ids": pa.ListArray.from_arrays(pa.array(np.append(np.int32(0), ends)), pa.array(np.concatenate(ids))),
        "log_prob": pa.array(log_p, pa.float64()), "log_inclusion": pa.array(log_q, pa.float64()), "weight": pa.array(weight, pa.float64()),
    }
    if decoded:
        columns["text_sha256"] = pa.array(text[0], pa.string())
    return pa.RecordBatch.from_pydict(columns)


def decoder(model: bytes) -> Callable[[np.ndarray], str]:
    """From piece numbers to the normalised text: space marks become spaces, the
    leading one that normalising added goes, bytes that are no UTF-8 become U+FFFD,
    control pieces are nothing."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_proto=model)
    table = []
    for i in range(p.get_piece_size()):
        piece = p.id_to_piece(i)
        table.append(bytes([int(piece[1:-1], 16)]) if p.is_byte(i) else b"" if p.is_control(i) else piece.replace(MARK, " ").encode())
    prefix = p.normalize("a") != "a"
    spelled = pa.array(table, pa.large_binary())

    def restore(ids: np.ndarray) -> str:
        pieces = spelled.take(pa.array(ids))
        text = pieces.buffers()[2].to_pybytes().decode("utf-8", "replace") if len(ids) else ""
        return text[1:] if prefix and text[:1] == " " else text

    return restore


def decode(encoded: DataFrame, model: bytes, ids: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` with the text of its ``ids`` in column ``text`` (NULL for NULL)."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def restored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restore = decoder(shared.value)
        for batch in batches:
            yield pd.Series([None if x is None else restore(np.asarray(x, dtype=np.int64)) for x in batch], dtype=object)

    return encoded.withColumn(text, restored(ids))
