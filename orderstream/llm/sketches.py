"""Document fingerprints as invertible Bloom lookup sketches (operator 11).

A text is the set of its paragraphs: its lines, cut further after a sentence's end
and after ``PIECE`` characters at the latest, so that a text of one line has several
too. A paragraph's key is 60 bits of its digest. A sketch has ``3 * PLACES`` cells;
a key goes to one cell in each third, and a cell holds how many keys it got, the XOR
of the keys and the XOR of their check numbers. The fingerprint is this base sketch.

Two versions are compared by subtracting their sketches cell by cell: what they
share goes away. A cell that is left with one key gives it back (its check number
tells), the key is taken out of its other cells, which lays bare more, and so on.
If cells stay unresolved the versions get larger sketches: first of a size that
fits their number of paragraphs, then twice that, until all differing keys are
recovered. The likeness is the Jaccard index of the two sets, counted from them.

Base sketches are built and peeled by expressions over a row. The cells of larger
ones are rows, summed (and XORed) by an aggregate that needs no shuffle, since all
rows of a document stay in the partition of its slice; a round of peeling is one
more such aggregate, over what is not yet resolved. A document is thus never one
large value, and only what remains unsolved after a fixed number of rounds
(about two documents in a thousand) is tried again.

``edits`` needs
each document's successor by doc_id: the keys (doc_id, hash of the text) are
range partitioned first, without the texts, to find the slices' least keys; the
texts are then shuffled once, by slice, the first document of a slice also going to
the slice before it (of the first slice: to the last), so that the successor is in
the same slice.

Edge cases: NULL text counts as empty; an empty text has no paragraphs, and two
texts without any have likeness 1. Repeated paragraphs count once. NULL doc_ids come
first in the order; rows of equal doc_id follow by a hash of their text, then the
text. A single document is its own successor. Extra columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_or_empty

#: Cells of each third of a base sketch (a power of two), and its bits.
PLACES = 4
PLACE_BITS = 2
KEY_BITS = 60
PIECE = 160
#: Cells a third of a larger sketch for each key of both versions, and some more;
#: the rounds of peeling before a still larger one is tried.
LOAD, SPARE = 1.5, 16
STEPS = 6
#: Rows of a slice at scale; small tables get more slices.
SLICE_ROWS = 32_768
_PATTERN = rf"[^ \x09-\x0D][^\n.!?。]{{0,{PIECE - 1}}}[.!?。]*"
# Odd multipliers of the check number.
_MIX_LOW, _MIX_HIGH = 2654435761, 40503


def paragraph_keys(text: Column) -> Column:
    """The distinct 60-bit keys of a text's paragraphs."""
    pieces = F.regexp_extract_all(text, F.lit(_PATTERN), F.lit(0))
    key = lambda p: F.conv(F.substring(F.md5(p), 1, KEY_BITS // 4), 16, 10).cast("long")
    return F.array_distinct(F.transform(pieces, key))


def _check(key: Column) -> Column:
    """A check number of a key that is not linear under XOR."""
    low, high = key.bitwiseAND(F.lit((1 << 28) - 1)), F.shiftright(key, 28)
    return F.shiftright(low * F.lit(_MIX_LOW) + high * F.lit(_MIX_HIGH), 20).bitwiseAND(F.lit(0xFFFFFFFF))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _place(key: Column, third: int) -> Column:
    return F.shiftright(key, PLACE_BITS * third).bitwiseAND(F.lit(PLACES - 1))


def _cell(n: Column, k: Column, c: Column) -> Column:
    return F.struct(n.alias("n"), k.alias("k"), c.alias("c"))


def sketch(keys: Column) -> Column:
    """The base sketch: the cells of the first, second and last third."""
    zero = F.lit(0).cast("long")

    def third(t: int) -> Column:
        def cell(place: Column) -> Column:
            own = F.filter(keys, lambda k: _place(k, t) == place)
            return F.aggregate(own, _cell(zero, zero, zero), lambda a, k: _cell(a["n"] + 1, a["k"].bitwiseXOR(k), a["c"].bitwiseXOR(_check(k))))

        return F.transform(F.sequence(F.lit(0), F.lit(PLACES - 1)), cell)

    return F.concat(*[third(t) for t in range(3)])


def subtract(old: Column, new: Column) -> Column:
    """The sketch of what only one of two versions has; new keys count negative."""
    return F.zip_with(old, new, lambda a, b: _cell(a["n"] - b["n"], a["k"].bitwiseXOR(b["k"]), a["c"].bitwiseXOR(b["c"])))


def peel(difference: Column) -> Column:
    """Struct (solved, removed, added) of a subtracted sketch: the keys that only
    the old and only the new version has, as far as they could be recovered."""
    none = F.array().cast("array<bigint>")

    def without(c: Column, i: Column, keys: Column, sign: int) -> Column:
        here = F.when(i < PLACES, F.lit(0)).when(i < 2 * PLACES, F.lit(PLACE_BITS)).otherwise(F.lit(2 * PLACE_BITS))
        place = i.bitwiseAND(F.lit(PLACES - 1)).cast("long")
        own = F.filter(keys, lambda k: F.call_function("shiftright", k, here).bitwiseAND(F.lit(PLACES - 1)) == place)
        return F.aggregate(own, c, lambda a, k: _cell(a["n"] - sign, a["k"].bitwiseXOR(k), a["c"].bitwiseXOR(_check(k))))

    def found(cells: Column, sign: int) -> Column:
        alone = F.filter(cells, lambda c: (c["n"] == sign) & (c["c"] == _check(c["k"])))
        return F.array_distinct(F.transform(alone, lambda c: c["k"]))

    def take(state: Column, plus: Column, minus: Column) -> Column:
        cells = F.transform(state["cells"], lambda c, i: without(without(c, i, plus, 1), i, minus, -1))
        return F.struct(
            cells.alias("cells"), F.concat(state["removed"], plus).alias("removed"),
            F.concat(state["added"], minus).alias("added"), (F.size(plus) + F.size(minus) == 0).alias("stuck"),
        )

    def turn(state: Column, _: Column) -> Column:
        pair = F.struct(found(state["cells"], 1).alias("plus"), found(state["cells"], -1).alias("minus"))
        return F.when(state["stuck"], state).otherwise(_let(pair, lambda x: take(state, x["plus"], x["minus"])))

    start = F.struct(difference.alias("cells"), none.alias("removed"), none.alias("added"), F.lit(False).alias("stuck"))
    empty = lambda s: F.forall(s["cells"], lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["c"] == 0))
    # No more turns than cells: each one empties at least one, or it is stuck.
    turns = F.sequence(F.lit(1), F.lit(3 * PLACES + 1))
    return F.aggregate(turns, start, turn, lambda s: F.struct(empty(s).alias("solved"), s["removed"].alias("removed"), s["added"].alias("added")))


def _placed(key: Column, size: Column) -> list[Column]:
    """A key's three cells in a larger sketch with ``size`` cells a third."""
    return [F.lit(t).cast("long") * size + F.pmod(F.xxhash64(key, F.lit(t), size), size) for t in range(3)]


def _entry(cell: Column, n: Column, k: Column, c: Column, key: Column) -> Column:
    return F.struct(*[x.cast("long").alias(name) for x, name in ((cell, "cell"), (n, "n"), (k, "k"), (c, "c"), (key, "key"))])


_SAME = ("_slice", "_row", "payload", "pair", "size")
#: Cell numbers of recovered keys, and of the row that carries the payload.
_REMOVED, _ADDED, _CARRIER = -1, -2, -3


def _summed(entries: DataFrame) -> DataFrame:
    """Cells from their entries; what is empty goes."""
    cells = entries.groupBy(*_SAME, "cell", "key").agg(F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c"))
    return cells.filter("cell < 0 or n <> 0 or k <> 0 or c <> 0")


def attempt(rows: DataFrame, pairs: list[str], factor: int, with_keys: bool) -> DataFrame:
    """Decode larger sketches. ``rows``: _slice, _row (unique in a slice), payload
    and for each of ``pairs`` a column struct(old, new) of keys, NULL if it needs
    no decoding. Partitioned by _slice, so that no step below shuffles.

    Gives payload and for each pair struct(solved, removed, added, removed_keys,
    added_keys); the lists only ``with_keys``."""
    null, zero = F.lit(None).cast("long"), F.lit(0).cast("long")

    def keys(number: int, name: str) -> Column:
        both = F.col(name)
        size = (F.ceil(F.lit(LOAD) * (F.size(both["old"]) + F.size(both["new"]))) + SPARE) * factor
        signed = [F.transform(both[v], lambda k: F.struct(F.lit(number).alias("pair"), size.alias("size"), F.lit(n).alias("n"), k.alias("k"))) for v, n in (("old", 1), ("new", -1))]
        return F.when(both.isNotNull(), F.concat(*signed)).otherwise(F.array().cast("array<struct<pair:int,size:bigint,n:int,k:bigint>>"))

    carrier = F.struct(F.lit(-1).alias("pair"), zero.alias("size"), F.lit(0).alias("n"), zero.alias("k"))
    all_keys = F.concat(F.array(carrier), *[keys(i, name) for i, name in enumerate(pairs)])
    # Sizes are worked out before the keys are listed, once a pair.
    listed = rows.select("_slice", "_row", "payload", F.explode(all_keys).alias("e"))
    listed = listed.select("_slice", "_row", F.when(F.col("e.pair") < 0, F.col("payload")).alias("payload"), "e.pair", "e.size", "e.n", "e.k")
    k, n, size = F.col("k"), F.col("n"), F.col("size")
    carried = F.array(_entry(F.lit(_CARRIER), zero, zero, zero, null))
    own = F.array(*[_entry(cell, n, k, _check(k), null) for cell in _placed(k, size)])
    entries = listed.select(*_SAME, F.explode(F.when(F.col("pair") < 0, carried).otherwise(own)).alias("e"))
    cells = _summed(entries.select(*_SAME, "e.*"))
    for step in range(STEPS):
        # A key is alone in at most one cell of a third, so it is found once.
        third = step % 3
        c, cell = F.col("c"), F.col("cell")
        alone = (cell >= third * size) & (cell < (third + 1) * size) & (F.abs(n) == 1) & (c == _check(k))
        others = [_entry(x, -n, k, c, null) for t, x in enumerate(_placed(k, size)) if t != third]
        got = _entry(F.when(n > 0, F.lit(_REMOVED)).otherwise(F.lit(_ADDED)), F.lit(1), zero, zero, k if with_keys else null)
        after = F.when(F.coalesce(alone, F.lit(False)), F.array(got, *others)).otherwise(F.array(_entry(cell, n, k, c, F.col("key"))))
        cells = _summed(cells.select(*_SAME, F.explode(after).alias("e")).select(*_SAME, "e.*"))
    results = [F.first("payload", ignorenulls=True).alias("payload")]
    for i, name in enumerate(pairs):
        here = F.col("pair") == i
        count = lambda kind: F.coalesce(F.sum(F.when(here & (F.col("cell") == kind), F.col("n"))), zero)
        kept = lambda kind: F.collect_list(F.when(here & (F.col("cell") == kind), F.col("key"))) if with_keys else F.lit(None).cast("array<bigint>")
        solved = F.coalesce(F.max(F.when(here & (F.col("cell") >= 0), 1)), F.lit(0)) == 0
        results.append(
            F.struct(
                solved.alias("solved"), count(_REMOVED).alias("removed"), count(_ADDED).alias("added"),
                kept(_REMOVED).alias("removed_keys"), kept(_ADDED).alias("added_keys"),
            ).alias(name)
        )
    return cells.groupBy("_slice", "_row").agg(*results)


def differences(rows: DataFrame, pairs: dict[str, tuple[str, str]], carried: list[str], with_keys: bool = False) -> DataFrame:
    """What differs between versions, by sketches that grow until they decode.

    ``rows``: _slice, _row, the columns ``carried`` and, for every version that
    ``pairs`` (name -> old and new version) speaks of, its _keys_ and _sketch_.
    Partitioned by _slice. Gives ``carried`` and a struct ``name`` of counts (and
    keys, ``with_keys``) for each pair."""
    versions = sorted({v for both in pairs.values() for v in both})
    first = rows
    for name, (old, new) in pairs.items():
        first = first.withColumn(f"_base_{name}", peel(subtract(F.col(f"_sketch_{old}"), F.col(f"_sketch_{new}"))))
    base = [F.col(f"_base_{name}").alias(name) for name in pairs]
    payload = F.struct(*carried, *[f"_keys_{v}" for v in versions], *base)
    open_ = [F.when(~F.col(f"_base_{name}.solved"), F.struct(F.col(f"_keys_{old}").alias("old"), F.col(f"_keys_{new}").alias("new"))).alias(name) for name, (old, new) in pairs.items()]
    todo = first.select("_slice", "_row", payload.alias("payload"), *open_)
    done, factor = None, 1
    while True:
        tried = attempt(todo, list(pairs), factor, with_keys)
        outcome = []
        for name in pairs:
            before, now = F.col(f"payload.{name}"), F.col(name)
            sizes = F.struct(F.lit(True).alias("solved"), F.size(before["removed"]).cast("long").alias("removed"), F.size(before["added"]).cast("long").alias("added"), before["removed"].alias("removed_keys"), before["added"].alias("added_keys"))
            outcome.append(F.when(before["solved"], sizes).otherwise(now).alias(name))
        flat = tried.select("_slice", "_row", "payload", *outcome)
        solved = F.lit(True)
        for name in pairs:
            solved = solved & F.col(f"{name}.solved")
        kept = [F.when(~solved, F.col(f"payload._keys_{v}")).alias(f"_keys_{v}") for v in versions]
        flat = stored(flat.select("_slice", "_row", solved.alias("_solved"), *[F.col(f"payload.{c}").alias(c) for c in carried], *pairs, *kept), "sketch_results")
        ready = flat.filter("_solved").select(*carried, *pairs)
        done = ready if done is None else done.unionByName(ready)
        rest = flat.filter("not _solved")
        if rest.isEmpty():
            return done
        # A retry decodes all pairs of the row again, in sketches of twice the size.
        factor *= 2
        again = F.struct(F.lit(False).alias("solved"), F.array().cast("array<bigint>").alias("removed"), F.array().cast("array<bigint>").alias("added"))
        payload = F.struct(*carried, *[f"_keys_{v}" for v in versions], *[again.alias(name) for name in pairs])
        both = [F.struct(F.col(f"_keys_{old}").alias("old"), F.col(f"_keys_{new}").alias("new")).alias(name) for name, (old, new) in pairs.items()]
        todo = rest.select("_slice", "_row", payload.alias("payload"), *both).repartition("_slice")


def likeness(old_keys: Column, changed: Column) -> Column:
    """Jaccard index of two sets, from the one's size and what differs."""
    union = old_keys + changed["added"]
    return F.when(union > 0, (old_keys - changed["removed"]).cast("double") / union.cast("double")).otherwise(F.lit(1.0))


def size_of(cells: Column) -> Column:
    """How many keys a base sketch holds."""
    return F.aggregate(F.slice(cells, 1, PLACES), F.lit(0).cast("long"), lambda a, c: a + c["n"])


def written(cells: Column) -> Column:
    """A sketch as text: its cells in hexadecimal, ``-`` for an empty one."""
    one = lambda c: F.concat_ws(".", F.hex(c["n"]), F.hex(c["k"]), F.hex(c["c"]))
    return F.array_join(F.transform(cells, lambda c: F.when(c["n"] == 0, F.lit("-")).otherwise(one(c))), " ")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with paragraph_keys, sketch and fingerprint of ``text`` added."""
    keyed = docs.withColumn("paragraph_keys", paragraph_keys(text_or_empty()))
    sketched = keyed.withColumn("sketch", sketch(F.col("paragraph_keys")))
    return sketched.withColumn("fingerprint", written(F.col("sketch")))


def compare(pairs: DataFrame) -> DataFrame:
    """``pairs`` (old_text, new_text; other columns are carried, without maps) with
    the paragraph keys that were removed and added, and the likeness."""
    others = [c for c in pairs.columns if c not in ("old_text", "new_text")]
    renamed = pairs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(others)], "old_text", "new_text")
    keyed = renamed.withColumns({f"_keys_{v}": paragraph_keys(text_or_empty(f"{v}_text")) for v in ("old", "new")})
    keyed = stored(keyed.withColumn("_row", F.monotonically_increasing_id()).withColumn("_slice", F.col("_row")), "sketch_pairs")
    sketched = keyed.withColumns({f"_sketch_{v}": sketch(F.col(f"_keys_{v}")) for v in ("old", "new")})
    sized = sketched.withColumn("_size", size_of(F.col("_sketch_old"))).repartition("_slice")
    carried = [*[f"_c{i}" for i in range(len(others))], "old_text", "new_text", "_size"]
    out = differences(sized, {"changed": ("old", "new")}, carried, with_keys=True)
    found = F.col("changed")
    return out.select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(others)], "old_text", "new_text",
        F.sort_array(found["removed_keys"]).alias("removed"), F.sort_array(found["added_keys"]).alias("added"),
        likeness(F.col("_size"), found).alias("likeness"),
    )


def _order(text: Column) -> Column:
    return F.struct(F.col("doc_id").alias("id"), F.xxhash64(text).alias("hash"))


def in_slices(docs: DataFrame) -> DataFrame:
    """doc_id, text ('' for NULL) and the slice of every document, and a guard row
    for the first document of a slice in the slice before it."""
    spark = docs.sparkSession
    clean = docs.select("doc_id", text_or_empty().alias("text"))
    keys = stored(clean.select(_order(F.col("text")).alias("key")), "sketch_keys")
    rows = keys.count()
    slices = max(1, min(rows, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-rows // SLICE_ROWS))
    least = keys.repartitionByRange(slices, "key").groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("least"))
    # One row with one key a slice, stored: a slice's bounds never change.
    width = max(1, round(slices**0.5))
    cuts = least.groupBy(F.lit(0).alias("_one")).agg(F.sort_array(F.collect_list("least")).alias("_cuts"))
    cuts = cuts.withColumn("_tops", F.filter("_cuts", lambda c, i: i % width == 0))
    cuts = stored(cuts, "sketch_cuts")
    placed = clean.withColumns({"_key": _order(F.col("text")), "_one": F.lit(0)}).join(F.broadcast(cuts), "_one")
    at_most = lambda bounds: F.size(F.filter(bounds, lambda c: c <= F.col("_key"))) - 1
    placed = placed.withColumn("_top", at_most(F.col("_tops")))
    placed = placed.withColumn("_slice", F.col("_top") * width + at_most(F.slice("_cuts", F.col("_top") * width + 1, F.lit(width))))
    first = F.get("_cuts", F.col("_slice")) == F.col("_key")
    before = F.when(F.col("_slice") == 0, F.size("_cuts") - 1).otherwise(F.col("_slice") - 1)
    own = F.struct(F.col("_slice").alias("slice"), F.lit(False).alias("guard"))
    guard = F.struct(before.alias("slice"), F.lit(True).alias("guard"))
    placed = placed.withColumn("_to", F.explode(F.when(first, F.array(own, guard)).otherwise(F.array(own))))
    return placed.select("doc_id", "text", "_key", F.col("_to.slice").alias("_slice"), F.col("_to.guard").alias("_guard"))


def edits(docs: DataFrame) -> DataFrame:
    """Every document and its edited version: the last half of its code points
    replaced by the first as many (or all) of the next document's.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, paragraphs,
    and counts of the keys that change ``to_edited`` and ``to_next``."""
    shuffled = in_slices(docs).repartition("_slice")
    keyed = shuffled.withColumn("_keys_own", paragraph_keys(F.col("text")))
    keyed = keyed.withColumn("_sketch_own", sketch(F.col("_keys_own")))
    by = Window.partitionBy("_slice").orderBy("_guard", "_key", "text")
    ahead = {"_next": F.lead("text").over(by), "_keys_next": F.lead("_keys_own").over(by), "_sketch_next": F.lead("_sketch_own").over(by)}
    cut = keyed.withColumns({**ahead, "_row": F.row_number().over(by)}).filter(~F.col("_guard"))
    cut = cut.withColumn("n_chars", F.length("text").cast("long"))
    half = F.expr("n_chars div 2").cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("_next", F.lit(1), half))
    cut = cut.withColumn("_edited", edited).drop("text", "_next", "_key", "_guard")
    cut = cut.withColumn("_keys_edited", paragraph_keys(F.col("_edited")))
    cut = cut.withColumn("_sketch_edited", sketch(F.col("_keys_edited")))
    named = cut.withColumns(
        {
            "edited_sha256": F.sha2("_edited", 256),
            "fingerprint": written(F.col("_sketch_own")),
            "edited_fingerprint": written(F.col("_sketch_edited")),
            "paragraphs": F.size("_keys_own").cast("long"),
        }
    )
    carried = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "paragraphs"]
    return differences(named, {"to_edited": ("own", "edited"), "to_next": ("own", "next")}, carried)


def digests(edited: DataFrame) -> DataFrame:
    """The contract's columns of ``edits``."""
    near = {f"near_{name}": likeness(F.col("paragraphs"), F.col(f"to_{name}")) for name in ("edited", "next")}
    return edited.withColumns(near).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", *near)
