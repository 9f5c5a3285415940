"""Source divergence audit (operator 12).

How far the sources of a language differ from each other, and which terms a source
has more of than its language. A language's vocabulary are the terms in at least
``MIN_DOCS`` of its documents; a group's smoothed share of a term, in billionths, is
``1 + (10**9 * (count + SMOOTH)) div (N + SMOOTH * V)``.

Frequencies come from single-pass in-memory indexing. A task adds the postings of
its documents (term, language -> documents; term, source -> count) block by block to
a book in memory until ``BLOCK_POSTINGS`` are in it, and spills the book as a run:
sorted by language and term, dealt to hash shards of (language, term). Runs are written below
``spark.checkpoint.dir``. Each shard then merges its runs with a heap, at most
``FAN_IN`` at a time and so level by level, until one is left. A term that every
document has is one entry in a run, so no shard is hot.

The distance of two sources sums |p - q| over the whole vocabulary. Where neither
source has the term both shares are the constants p0 and q0, so the sum starts from
V * |p0 - q0| and is corrected for the terms that occur: the one-sided corrections
of a source (against every other's constant) follow from its sorted shares and their
prefix sums, and the postings of the merged terms are streamed once for the
corrections of terms that both have. Corrections are summed by pair inside a task
first; what is shuffled is at most one row per pair and task batch. The result
itself has one row per ordered pair of sources of a language.

All arithmetic is exact (whole numbers, decimals where 64 bits do not do).

Edge cases: NULL text, lang or source count as the empty string, which is a language
or source like any other. Every (lang, source) that occurs has its pairs, with value
0 if the language has no vocabulary; a group without terms has no term rows.
Repeated rows are separate documents. Other columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .target_sampling import crc32s
from .word_bytes import blocks, byte_table, words_of

MIN_DOCS = 30
SMOOTH = 5
TOP_TERMS = 50
BILLION = 1_000_000_000
#: Postings of a book in memory, and runs merged at once.
BLOCK_POSTINGS = 1_000_000
FAN_IN = 64
#: Pairs of sources whose corrections a task sums up before it sends them on.
PAIRS_HELD = 200_000
_WORD_BYTES = byte_table(digits=False)

_RUN = (
    "shard int, run long, lang string, terms array<binary>, df array<long>, "
    "n array<int>, sources array<string>, counts array<long>"
)
_MERGED = "lang string, term string, df long, total long, postings array<struct<source:string,count:long>>"

_RUN_ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("run", pa.int64()), ("lang", pa.string()), ("terms", pa.list_(pa.binary())),
        ("df", pa.list_(pa.int64())), ("n", pa.list_(pa.int32())), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
    ]
)
_MERGED_ARROW = pa.schema(
    [
        ("lang", pa.string()), ("term", pa.string()), ("df", pa.int64()), ("total", pa.int64()),
        ("postings", pa.list_(pa.struct([("source", pa.string()), ("count", pa.int64())]))),
    ]
)


def _counted(keys: np.ndarray, amounts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, and how often each occurs or the sum of its amounts."""
    code, unique = pd.factorize(keys)
    if amounts is None:
        return unique, np.bincount(code, minlength=len(unique))
    total = np.zeros(len(unique), np.int64)
    np.add.at(total, code, amounts)
    return unique, total


class Book:
    """Postings in memory. A block of texts adds its distinct terms, (term, group,
    count) and (term, language, documents); a group is a language and a source."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.langs: dict[str, int] = {}
        self.blocks: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.postings = 0

    def add(self, text: tuple[np.ndarray, np.ndarray], lang: list[str], source: list[str]) -> None:
        """The documents of a block of texts, one language and source each."""
        words = words_of(*text, _WORD_BYTES)
        if not len(words):
            return
        ids, terms = words.encoded()
        size = len(terms)
        group = np.array([self.groups.setdefault(pair, len(self.groups)) for pair in zip(lang, source)])
        own = np.array([self.langs.setdefault(x, len(self.langs)) for x in lang])
        posted = _counted(group[words.doc] * size + ids)
        once = pd.unique(words.doc * size + ids)  # a term of a document
        found = _counted(own[once // size] * size + once % size)
        self.blocks.append((terms, *posted, *found))
        self.postings += len(posted[0])

    def spilled(self, shards: int, run: int) -> pa.RecordBatch:
        """The book as a run: its blocks' terms made one, sorted."""
        terms = pa.concat_arrays([block[0] for block in self.blocks]).dictionary_encode()
        order = pc.sort_indices(terms.dictionary).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        number = place[terms.indices.to_numpy()]
        size, at, posted, found = len(order), 0, [], []
        for block, group, count, lang, df in self.blocks:
            own = number[at : at + len(block)]
            at += len(block)
            posted.append((group // len(block) * size + own[group % len(block)], count))
            found.append((lang // len(block) * size + own[lang % len(block)], df))
        key, count = _counted(*map(np.concatenate, zip(*posted)))
        pair, df = _counted(*map(np.concatenate, zip(*found)))
        names = [*self.groups]
        lang_of = np.array([self.langs[lang] for lang, _ in names])
        return _run_rows(
            terms.dictionary.take(pa.array(order)), [*self.langs], shards, run,
            lang=pair // size, term=pair % size, df=df,
            posted_lang=lang_of[key // size], posted_term=key % size,
            source=pa.array([source for _, source in names]), which=key // size, count=count,
        )


def _run_rows(terms: pa.Array, langs: list[str], shards: int, run: int, *, lang, term, df, posted_lang, posted_term, source, which, count, shard=None) -> pa.RecordBatch:
    """One row per shard and language, terms in order. ``terms`` are sorted;
    ``lang``, ``term``, ``df`` are the entries, the rest their postings."""
    if shard is None:
        offsets = np.frombuffer(terms.buffers()[1], np.int64, len(terms) + 1)
        by_term = crc32s(np.frombuffer(terms.buffers()[2], np.uint8), offsets[:-1], np.diff(offsets)).astype(np.int64)
        salt = np.array([zlib.crc32(x.encode()) for x in langs], np.int64)
        shard_of = lambda lang, term: (by_term[term] ^ salt[lang]) % shards
    else:
        shard_of = lambda lang, term: np.full(len(lang), shard, np.int64)
    own = shard_of(lang, term)
    order = np.lexsort((term, lang, own))
    own, lang, term, df = own[order], lang[order], term[order], df[order]
    posted = np.lexsort((which, posted_term, posted_lang, shard_of(posted_lang, posted_term)))
    source, count = source.take(pa.array(which[posted])), count[posted]
    entry = np.flatnonzero(np.diff(posted_lang[posted] * len(terms) + posted_term[posted], prepend=-1))
    n = np.diff(np.append(entry, len(posted)))  # postings of each entry, in the same order
    first = np.flatnonzero(np.diff(own * len(langs) + lang, prepend=-1))
    cuts = pa.array(np.append(first, len(own)).astype(np.int32))
    ends = np.concatenate([[0], np.cumsum(n)])
    posting_cuts = pa.array(ends[np.append(first, len(own))].astype(np.int32))
    listed = lambda at, values: pa.ListArray.from_arrays(at, values)
    columns = [
        pa.array(own[first].astype(np.int32)), pa.array(np.full(len(first), run, np.int64)), pa.array([langs[x] for x in lang[first]], pa.string()),
        listed(cuts, terms.take(pa.array(term)).cast(pa.binary())), listed(cuts, pa.array(df.astype(np.int64))),
        listed(cuts, pa.array(n.astype(np.int32))), listed(posting_cuts, source.cast(pa.string())), listed(posting_cuts, pa.array(count.astype(np.int64))),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_RUN_ARROW)


def spilled_runs(docs: DataFrame, shards: int) -> DataFrame:
    """Runs of the index of ``docs`` (text, lang, source)."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, book = TaskContext.get().partitionId() << 24, Book()
        for batch in batches:
            langs, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for low, high, *text in blocks(batch.column(0)):
                book.add(tuple(text), langs[low:high], sources[low:high])
                if book.postings >= BLOCK_POSTINGS:
                    yield book.spilled(shards, run)
                    run, book = run + 1, Book()
        if book.postings:
            yield book.spilled(shards, run)

    return docs.select("text", "lang", "source").mapInArrow(index, _RUN)


def _heap_merged(table: pa.Table) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """The runs of one shard, merged with a heap. By language: its name, the sorted
    terms, their document counts, and their postings as term number, distinct
    sources, source number and count."""
    for lang in sorted(set(table.column("lang").to_pylist())):
        rows = table.filter(pc.equal(table.column("lang"), lang))
        runs = [rows.column("terms")[i].as_py() for i in range(len(rows))]
        terms, origin, group, last = [], [], [], None
        for term, run in heapq.merge(*[zip(run, itertools.repeat(i)) for i, run in enumerate(runs)]):
            if term != last:
                terms.append(term)
                last = term
            origin.append(run)
            group.append(len(terms) - 1)
        # Entries of a run come in its order: put the merged numbers back there.
        back = np.argsort(np.array(origin), kind="stable")
        number = np.array(group)[back]
        flat = {c: pc.list_flatten(rows.column(c)).combine_chunks() for c in ("df", "n", "sources", "counts")}
        df = np.zeros(len(terms), np.int64)
        np.add.at(df, number, flat["df"].to_numpy())
        sources = flat["sources"].dictionary_encode()
        posted, size = np.repeat(number, flat["n"].to_numpy()), len(sources.dictionary)
        key, count = _counted(posted * size + sources.indices.to_numpy(), flat["counts"].to_numpy())
        yield lang, pa.array(terms, pa.large_binary()), df, key // size, sources.dictionary, key % size, count


def merged(runs: DataFrame, min_docs: int = MIN_DOCS, fan_in: int = FAN_IN) -> DataFrame:
    """(lang, term, df, total, postings) of the terms in ``min_docs`` documents
    of a language, from stored ``runs``."""

    def some(key: tuple, table: pa.Table) -> pa.Table:
        shard, run = (k.as_py() for k in key)
        parts = []
        for lang, terms, df, term, source, which, count in _heap_merged(table):
            zeros = np.zeros(len(term), np.int64)
            parts.append(
                _run_rows(
                    terms, [lang], 1, run, shard=shard, lang=np.zeros(len(terms), np.int64), term=np.arange(len(terms)), df=df,
                    posted_lang=zeros, posted_term=term, source=source, which=which, count=count,
                )
            )
        return pa.Table.from_batches(parts, _RUN_ARROW)

    def last(table: pa.Table) -> pa.Table:
        parts = []
        for lang, terms, df, term, source, which, count in _heap_merged(table):
            kept = np.flatnonzero(df >= min_docs)
            order = np.lexsort((which, term))
            order = order[df[term[order]] >= min_docs]
            starts = np.searchsorted(term[order], np.append(kept, len(terms)))
            total = np.zeros(len(terms), np.int64)
            np.add.at(total, term, count)
            postings = pa.StructArray.from_arrays([source.take(pa.array(which[order])).cast(pa.string()), pa.array(count[order])], ["source", "count"])
            columns = [
                pa.array([lang] * len(kept), pa.string()), terms.take(pa.array(kept)).cast(pa.string()), pa.array(df[kept]), pa.array(total[kept]),
                pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), postings),
            ]
            parts.append(pa.RecordBatch.from_arrays(columns, schema=_MERGED_ARROW))
        return pa.Table.from_batches(parts, _MERGED_ARROW)

    count = runs.select("run").distinct().count()
    while count > fan_in:
        count = -(-count // fan_in)
        # A run goes to one of the groups; each holds about ``fan_in``.
        grouped = runs.withColumn("run", F.pmod(F.xxhash64("run", F.lit(count)), F.lit(count)))
        runs = stored(grouped.groupBy("shard", "run").applyInArrow(some, _RUN), "divergence_runs")
    return runs.groupBy("shard").applyInArrow(last, _MERGED)


def share(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a term in billionths; NULL without a vocabulary."""
    top = ((count + SMOOTH).cast("decimal(20,0)") * F.lit(BILLION).cast("decimal(10,0)")).cast("decimal(38,0)")
    below = (total + SMOOTH * terms).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.when(below > 0, F.call_function("div", top, below))


def _one_sided(rows: DataFrame) -> DataFrame:
    """Partial sums (lang, low, high, value) of each source against the constants
    of the others, and what two sources without any terms would differ by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, p0, size = row["source"], row["p0"], row["terms"]
                others = [o for o in row["others"] if o["source"] != own]
                q0 = np.array([o["p0"] or 0 for o in others], np.int64)
                gap = np.abs(q0 - (p0 or 0))
                shares = row["shares"] or []
                p = np.array([s["p"] for s in shares], np.int64)
                n = np.array([s["n"] for s in shares], np.int64)
                below = np.searchsorted(p, q0, "right")
                count, total = (np.concatenate([[0], np.cumsum(x)]) for x in (n, n * p))
                value = q0 * (2 * count[below] - count[-1]) + total[-1] - 2 * total[below] - gap * count[-1]
                names = [o["source"] for o in others]
                value += np.array([size if own < name else 0 for name in names], np.int64) * gap
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["lang"]] * len(names), pa.string()), pa.array([min(own, x) for x in names], pa.string()),
                        pa.array([max(own, x) for x in names], pa.string()), pa.array(value, pa.int64()),
                    ],
                    ["lang", "low", "high", "value"],
                )

    return rows.mapInArrow(run, "lang string, low string, high string, value long")


def _pair_sums(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(value, first)


def _batch_corrections(lang: np.ndarray, starts: np.ndarray, source: np.ndarray, p: np.ndarray, p0: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(pair, sum) of the terms of a batch; ``source`` is sorted in every term.
    A pair is (lang * size + low) * size + high."""
    keys, values, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    lengths = np.diff(starts)
    for k in np.unique(lengths[lengths > 1]).tolist():
        terms = np.flatnonzero(lengths == k)
        step = max(1, 1_000_000 // k)
        for part in (terms[i : i + step] for i in range(0, len(terms), step)):
            at = starts[part][:, None] + np.arange(k)
            s, q, q0, own = source[at], p[at], p0[at], lang[part][:, None]
            for d in range(1, k):
                a, a0, b, b0 = q[:, :-d], q0[:, :-d], q[:, d:], q0[:, d:]
                values.append((np.abs(a - b) - np.abs(a - b0) - np.abs(a0 - b) + np.abs(a0 - b0)).ravel())
                keys.append(((own * size + s[:, :-d]) * size + s[:, d:]).ravel())
                held += len(values[-1])
                if held > 4_000_000:
                    (key, value), held = _pair_sums(keys, values), 0
                    keys, values = [key], [value]
    if sum(map(len, keys)) == 0:
        return keys[0], values[0]
    return _pair_sums(keys, values)


def _both_sided(terms: DataFrame) -> DataFrame:
    """Partial sums (lang, low, high, value) of the corrections of terms that both
    sources have, from ``terms`` (lang, postings: sorted (source, p, p0))."""

    def out(sums: dict[tuple[str, str, str], int]) -> pa.RecordBatch:
        lang, low, high = zip(*sums) if sums else ((), (), ())
        columns = [pa.array(x, pa.string()) for x in (lang, low, high)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(sums.values(), pa.int64())], ["lang", "low", "high", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str, str], int] = {}
        for batch in batches:
            postings = batch.column(1)
            flat = postings.flatten()
            starts = np.concatenate([[0], np.cumsum(postings.value_lengths().to_numpy())])
            source, lang = (x.dictionary_encode() for x in (flat.field(0), batch.column(0)))
            names, langs = source.dictionary.to_pylist(), lang.dictionary.to_pylist()
            numbers = [x.to_numpy().astype(np.int64) for x in (lang.indices, source.indices, flat.field(1), flat.field(2))]
            keys, values = _batch_corrections(numbers[0], starts, *numbers[1:], size := max(1, len(names)))
            for key, value in zip(keys.tolist(), values.tolist()):
                pair = (langs[key // size // size], names[key // size % size], names[key % size])
                sums[pair] = sums.get(pair, 0) + value
                if len(sums) >= PAIRS_HELD:
                    yield out(sums)
                    sums = {}
        yield out(sums)

    return terms.mapInArrow(run, "lang string, low string, high string, value long")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    empty = F.lit("")
    clean = docs.select(*[F.coalesce(F.col(c), empty).alias(c) for c in ("text", "lang", "source")])
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = stored(spilled_runs(clean, shards), "divergence_runs")
    kept = stored(merged(runs, min_docs), "divergence_terms")
    entries = kept.select("lang", "term", "total", F.explode("postings").alias("e")).select("lang", "term", "total", "e.source", "e.count")

    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("all"))
    counts = entries.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    zero = F.lit(0).cast("long")
    groups = clean.select("lang", "source").distinct().join(counts, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n", "terms", "all")])
    groups = stored(groups.withColumn("p0", share(zero, F.col("n"), F.col("terms"))), "divergence_groups")

    shares = entries.join(groups, ["lang", "source"]).withColumn("p", share(F.col("count"), F.col("n"), F.col("terms")))
    shares = stored(shares.select("lang", "source", "term", "p", "p0", share(F.col("total"), F.col("all"), F.col("terms")).alias("q")), "divergence_shares")

    more = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    more = more.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)

    steps = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n"))
    sorted_shares = steps.groupBy("lang", "source").agg(F.sort_array(F.collect_list(F.struct("p", "n"))).alias("shares"))
    # The sources of a language, once for each of them: as many as it has pairs in the result.
    others = groups.groupBy("lang").agg(F.collect_list(F.struct("source", "p0")).alias("others"))
    rows = groups.join(sorted_shares, ["lang", "source"], "left").join(others, "lang")
    single = _one_sided(rows.select("lang", "source", "terms", "p0", "shares", "others"))
    postings = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "p", "p0"))).alias("postings"))
    joint = _both_sided(postings.select("lang", "postings"))
    pairs = single.unionByName(joint).groupBy("lang", "low", "high").agg(F.sum("value").alias("value"))
    ends = F.explode(F.array(F.struct(F.col("low").alias("source"), F.col("high").alias("item")), F.struct(F.col("high").alias("source"), F.col("low").alias("item"))))
    pairs = pairs.select("lang", ends.alias("e"), "value").select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(by))
    return pairs.unionByName(more).withColumn("rank", F.col("rank").cast("int"))
