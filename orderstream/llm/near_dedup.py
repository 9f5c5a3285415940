"""Near-duplicate documents by a join of MinHash coordinates (operator 7).

Documents are sets of distinct word shingles. Equal sets are one node. A node is
posted under each (coordinate, value) pair of its MinHash signature; two nodes
collide in a coordinate with the probability of their similarity, so a pair at or
above the threshold reaches at least ``needed`` of ``COORDINATES`` collisions but
for a chance of 1e-6. Postings are merged with prefix skipping: with the pairs of
a node ordered from rare to frequent, two nodes with ``needed`` common pairs share
one among the first ``COORDINATES - needed + 1``, so the frequent rest is skipped,
and a pair that no one else has is not posted at all.

A posting list may hold a third of all documents, so its pairs are never written
out. Every list names a hub (its node with the most frequent pairs); lists of one
hub are merged, and within a merged list links are found exactly by

* the core: shingles that most members have. For a member x let D(x) be the
  symmetric difference of x and the core, and g(x) = (100-p)|x| - (100+p)|D(x)|.
  Two members whose D do not meet are p % similar exactly if g(x) + g(y) >= 0;
* so the member of the largest g links to every member that has such a partner at
  all, and only members it does not link to can have further links, to members
  that share an element of D with them. Those are looked up in an inverted index
  of D, and the count of shared elements gives the similarity exactly.

All of this counts on full shingle sets. Lists of more than ``LIST_SHINGLES``
shingles go through the same step in Spark (core, D, best member), which leaves
sub-lists of the members that share an element of D, each less than half as long;
this repeats until all lists are small. Links then form components.

Edge cases: NULL or blank text has an empty set, links with nothing and is a
component of its own. With fewer words than a shingle the whole sequence is the one
shingle. A NULL doc_id can be linked; the component id is the smallest known id in
it (NULL if none). Repeated rows share a component. Other columns are ignored by
``classify`` and carried by ``keep_one``. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import named_rows, stored
from .components import components

COORDINATES = 24
MISS = 1e-6
LIST_SHINGLES = 4_000_000
WORDS_KEPT = 500_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)


def needed_matches(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """The largest number of collisions a pair at the threshold reaches but for
    a chance of ``miss``."""
    p, below = percent / 100, 0.0
    for t in range(coordinates + 1):
        below += math.comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if below > miss:
            return max(1, t)
    return coordinates


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * _MIX
    x = (x ^ (x >> _SHIFT)) * _MIX
    return x ^ (x >> _SHIFT)


class Shingler:
    """Sets of 64-bit shingle hashes; hashes of words are kept between texts."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        parts = text.encode("utf-8", "surrogatepass").lower().split()  # A-Z and the six blanks only
        if not parts:
            return np.zeros(0, dtype=np.uint64)
        known = self.known
        if len(known) > WORDS_KEPT:
            known.clear()
        for w in set(parts).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, parts), dtype=np.uint64, count=len(parts))
        n = min(self.words, len(h))
        s = np.full(len(h) - n + 1, n, dtype=np.uint64) * _GOLDEN
        for j in range(n):
            s = _mixed(s + h[j : len(h) - n + 1 + j])
        return np.unique(s)


def signature(s: np.ndarray, factors: np.ndarray) -> np.ndarray:
    out = np.empty(len(factors), dtype=np.uint64)
    for i, f in enumerate(factors):
        out[i] = _mixed(s * f).min()
    return out


def _factors(n: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(f"coordinate {i}") | 1 for i in range(n)], dtype=np.uint64)


def _set_id(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def sets(docs: DataFrame, words: int, row: Column | None = None) -> DataFrame:
    """One narrow row per document: _row, doc_id, n, node (digest of the set), sig."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, factors = Shingler(words), _factors(COORDINATES)
        for batch in batches:
            out = []
            for r, i, text in zip(batch["_row"].tolist(), batch["doc"].tolist(), batch["text"].tolist(), strict=True):
                s = shingles(text)
                sig = signature(s, factors).view(np.int64) if len(s) else None
                out.append((r, None if i is None else int(i), len(s), _set_id(s) if len(s) else None, sig))
            frame = pd.DataFrame(out, columns=["_row", "doc_id", "n", "node", "sig"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    number = row if row is not None else F.monotonically_increasing_id()
    rows = docs.select(number.alias("_row"), F.col("doc_id").cast("string").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, f"_row {rows.schema['_row'].dataType.simpleString()}, doc_id long, n long, node binary, sig array<long>")


def merged_lists(nodes: DataFrame, needed: int) -> DataFrame:
    """(hub, node): every pair with ``needed`` collisions shares a hub."""
    posts = nodes.select("node", F.posexplode("sig").alias("i", "v")).select("node", F.xxhash64("i", "v").alias("pair"))
    common = posts.groupBy("pair").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    posts = posts.join(common, "pair")
    own = Window.partitionBy("node")
    ranked = posts.withColumns(
        {
            "_at": F.row_number().over(own.orderBy("df", "pair")),
            "_alone": F.lit(COORDINATES) - F.count(F.lit(1)).over(own),
            "_weight": F.sum("df").over(own),
        }
    )
    prefix = ranked.filter(F.col("_alone") + F.col("_at") <= COORDINATES - needed + 1).select("pair", "node", "_weight")
    prefix = stored(prefix, "near_prefix")
    hubs = prefix.groupBy("pair").agg(F.max(F.struct("_weight", "node")).alias("h"), F.count(F.lit(1)).alias("c"))
    hubs = hubs.filter("c > 1").select("pair", F.col("h.node").alias("hub"))
    return prefix.join(hubs, "pair").select("hub", "node").distinct()


def shingle_table(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, n, shingles) of the wanted nodes, read again from one of their
    documents (a document whose set has another digest is passed over)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(words)
        for batch in batches:
            out = []
            for node, text in zip(batch["node"].tolist(), batch["text"].tolist(), strict=True):
                s = shingles(text)
                if len(s) and _set_id(s) == bytes(node):
                    out.append((bytes(node), len(s), s.view(np.int64)))
            yield pd.DataFrame(out, columns=["node", "n", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("_d"), F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(wanted, F.col("_d").eqNullSafe(F.col("doc_id"))).select("node", "text")
    return found.mapInPandas(run, "node binary, n long, shingles array<long>")


def local_links(members: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join all members that are ``percent`` % similar, directly or
    through others: the hub's, and further ones between different parts."""
    n = len(members)
    size = np.array([len(m) for m in members])
    owner = np.repeat(np.arange(n, dtype=np.int32), size)
    unique, at = np.unique(np.concatenate(members), return_inverse=True)
    at, kinds = at.astype(np.int32), len(unique)
    del unique
    core = 2 * np.bincount(at) > n
    in_core = core[at]
    inside = np.bincount(owner[in_core], minlength=n)
    delta = (size - inside) + (int(core.sum()) - inside)
    g = (100 - percent) * size - (100 + percent) * delta
    hub = int(g.argmax())
    has = np.zeros(kinds, dtype=bool)
    has[at[owner == hub]] = True
    both = np.bincount(owner[has[at]], minlength=n)
    linked = 100 * both >= percent * (size + size[hub] - both)
    part = np.where(linked, hub, np.arange(n))
    links = [(hub, int(i)) for i in np.nonzero(linked)[0] if i != hub]
    rest = np.nonzero(~linked)[0]
    if not len(rest):
        return links
    # Elements of D, by member: shingles beside the core, then core ones missing.
    place = np.cumsum(core, dtype=np.int32) - 1
    missing = np.ones((n, int(core.sum())), dtype=bool)
    missing[owner[in_core], place[at[in_core]]] = False
    miss_owner, miss_at = (x.astype(np.int32) for x in np.nonzero(missing))
    element = np.concatenate([at[~in_core], kinds + miss_at])
    holder = np.concatenate([owner[~in_core], miss_owner])
    del at, owner, in_core, missing, miss_owner, miss_at
    shared = np.bincount(element, minlength=1)[element] > 1
    element, holder = element[shared], holder[shared]
    order = np.argsort(element, kind="stable")
    posting, keys = holder[order], element[order]
    del order
    by_holder = np.argsort(holder, kind="stable")
    first = np.searchsorted(holder[by_holder], np.arange(n + 1))
    for u in rest.tolist():
        mine = element[by_holder[first[u] : first[u + 1]]]
        if not len(mine):
            continue
        lo, hi = np.searchsorted(keys, mine), np.searchsorted(keys, mine, side="right")
        others, common = np.unique(np.concatenate([posting[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]), return_counts=True)
        good = others[(g[u] + g[others] + 2 * (100 + percent) * common >= 0) & (part[others] != part[u])]
        for v in good.tolist():
            if part[v] != part[u]:
                links.append((u, v))
                part[part == part[v]] = part[u]
    return links


def small_links(lists: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) within lists of (hub, node, shingles), one list at a time."""
    parts = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = lists.repartition(parts, "hub").sortWithinPartitions("hub", "node")

    def close(nodes: list[bytes], members: list[np.ndarray]) -> list[tuple[bytes, bytes]]:
        return [(nodes[i], nodes[j]) for i, j in local_links(members, percent)] if len(nodes) > 1 else []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hub, nodes, members, out = None, [], [], []
        for batch in batches:
            for h, node, s in zip(batch["hub"].tolist(), batch["node"].tolist(), batch["shingles"].tolist(), strict=True):
                if h != hub:
                    out += close(nodes, members)
                    hub, nodes, members = h, [], []
                if not nodes or nodes[-1] != node:  # a node can come from repeated rows
                    nodes.append(node)
                    members.append(np.asarray(s, dtype=np.int64))
            yield pd.DataFrame(out, columns=["a", "b"])
            out = []
        yield pd.DataFrame(close(nodes, members), columns=["a", "b"])

    return ordered.mapInPandas(run, "a binary, b binary")


def split_large(lists: DataFrame, table: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """One step on large lists (hub, node): links of the best members, and the
    sub-lists (hub, node) of members that share an element of D."""
    full = stored(lists.join(table, "node"), "near_large")
    lengths = full.groupBy("hub").agg(F.count(F.lit(1)).alias("_members"))
    counts = full.select("hub", F.explode("shingles").alias("s")).groupBy("hub", "s").agg(F.count(F.lit(1)).alias("c"))
    core = counts.join(lengths, "hub").filter("2 * c > _members").groupBy("hub").agg(F.collect_list("s").alias("core"))  # < 2 mean sets
    none = F.array().cast("array<long>")
    beside = full.join(core, "hub", "left").withColumn("core", F.coalesce("core", none))
    beside = beside.withColumns({"more": F.array_except("shingles", "core"), "less": F.array_except("core", "shingles")})
    delta = F.size("more") + F.size("less")
    beside = beside.withColumn("g", (100 - percent) * F.col("n") - (100 + percent) * delta)
    beside = stored(beside.drop("core"), "near_beside")
    best = beside.groupBy("hub").agg(F.max(F.struct("g", "node")).alias("b")).select("hub", F.col("b.node").alias("best"))
    best = best.join(table.select(F.col("node").alias("best"), F.col("n").alias("best_n"), F.col("shingles").alias("best_set")), "best").dropDuplicates(["hub"])
    both = F.size(F.array_intersect("shingles", "best_set"))
    judged = beside.join(best, "hub").withColumn("linked", 100 * both >= percent * (F.col("n") + F.col("best_n") - both))
    judged = stored(judged.select("hub", "node", "best", "linked", "more", "less"), "near_judged")
    links = judged.filter("linked").select(F.col("best").alias("a"), F.col("node").alias("b"))
    element = F.concat(
        F.transform("more", lambda s: F.xxhash64(F.lit("more"), s)), F.transform("less", lambda s: F.xxhash64(F.lit("less"), s))
    )
    shares = judged.select("hub", "node", "linked", F.explode(element).alias("e")).select(
        F.md5(F.concat(F.col("hub"), F.encode(F.col("e").cast("string"), "utf-8"))).alias("sub"), "node", "linked"
    )
    open_ = shares.groupBy("sub").agg(F.count(F.lit(1)).alias("c"), F.min("linked").alias("done")).filter("c > 1 and not done")
    subs = shares.join(open_.select("sub"), "sub").select(F.unhex("sub").alias("hub"), "node")
    return links, subs


def links(docs: DataFrame, nodes: DataFrame, words: int, percent: int, list_shingles: int) -> DataFrame:
    """Links (a, b) between nodes (node, doc_id, n, sig)."""
    lists = stored(merged_lists(nodes, needed_matches(percent)), "near_lists")
    wanted = nodes.select("node", "doc_id").join(lists.select("node").distinct(), "node", "left_semi")
    table = stored(shingle_table(docs, wanted, words), "near_shingles")
    sizes = table.select("node", "n")
    found = None
    while True:
        weights = lists.join(sizes, "node").groupBy("hub").agg(F.sum("n").alias("_weight"))
        large = stored(weights.filter(F.col("_weight") > list_shingles).select("hub"), "near_large_hubs")
        small = small_links(lists.join(large, "hub", "left_anti").join(table.select("node", "shingles"), "node").select("hub", "node", "shingles"), percent)
        small = stored(small, "near_links")
        found = small if found is None else found.unionByName(small)
        if large.isEmpty():
            return found
        more, subs = split_large(lists.join(large, "hub", "left_semi"), table, percent)
        found = found.unionByName(more)
        lists = stored(subs, "near_lists")


def _classified(docs: DataFrame, words: int, percent: int, row: Column | None, list_shingles: int) -> DataFrame:
    """_row, doc_id, n, component_id, first_row (the row that stays)."""
    rows = stored(sets(docs, words, row), "near_sets")
    nodes = rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig"))
    roots = components(links(docs, nodes, words, percent, list_shingles))
    alone = F.encode(F.concat(F.lit("row "), F.col("_row").cast("string")), "utf-8")  # an empty set
    joined = rows.drop("sig").join(roots, "node", "left").withColumn("_root", F.coalesce("root", "node", alone))
    joined = stored(joined.drop("root", "node"), "near_rooted")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "_row")).alias("f")
    best = joined.groupBy("_root").agg(first).select("_root", F.col("f.doc_id").alias("component_id"), F.col("f._row").alias("first_row"))
    return joined.join(best, "_root").drop("_root")


def classify(docs: DataFrame, words: int = 5, percent: int = 80, list_shingles: int = LIST_SHINGLES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    out = _classified(docs, words, percent, None, list_shingles)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, list_shingles: int = LIST_SHINGLES, on_files: bool = False) -> DataFrame:
    """One document of each component, with the columns of ``docs``.
    ``on_files``: see ``named_rows``."""
    rows, row = named_rows(docs, "near_documents", on_files)
    rows = rows.withColumn(row, F.concat_ws(" ", f"{row}.row_index", f"{row}.file_path"))
    out = _classified(rows, words, percent, F.col(row), list_shingles)
    return rows.join(out.filter("_row = first_row").select(F.col("_row").alias(row)), row, "left_semi").select(*docs.columns)
