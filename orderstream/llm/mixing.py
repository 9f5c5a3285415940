"""Mixing sources to target weights by hierarchical budgets (operator 4).

A token budget flows down a domain > language > source tree. At each node it is
split over the children in proportion to their weights; a child that cannot use
its share (its leaves' tokens times ``max_epochs``) is filled and what it leaves
is split over its siblings again (water filling). Because a child's capacity is
that of its whole subtree, a shortage is first met by siblings and reaches the
ancestors only when the subtree is exhausted. All amounts are whole tokens.

A leaf's quota is then met from seeded epochs: an epoch passes the leaf's
documents in an order drawn from (seed, epoch, doc_id), and the leaf takes the
prefix of that endless sequence that reaches its quota: as many whole epochs as
fit, then from the next one every document that starts before the quota is
reached (so a leaf overshoots by less than one document).

The prefix needs no single task per leaf: the order key is cut into slices of
about ``SLICE_ROWS`` documents, the slices' token sums are summed up first (a
small table), and rows are numbered inside their slice only.

Edge cases: NULL or blank text has no tokens and is never selected. NULL language
or source is a child of its own with weight 1, as is any child without a listed
weight; weight 0 gives nothing, and what is below it counts in no ancestor's
capacity. Repeated rows are separate documents that follow
each other in every epoch (their order among themselves does not matter). Extra
columns are carried. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_CLASS, named_rows, stored, text_or_empty

SLICE_ROWS = 4096
LEVELS = ("domain", "lang", "source")
MAX_EPOCHS = 4
SEED = 20240601
#: Of all tokens at hand; above 1 the mix repeats sources.
BUDGET_PERCENT = 60
#: Target weights (whole numbers) by level; anything else weighs 1.
WEIGHTS: dict[str, dict[str, int]] = {
    "domain": {"web": 5, "books": 3, "forum": 2},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 2},
    "source": {"src0": 2},
}


def domain_of(source: Column) -> Column:
    """The domain of a source, from the number in its name."""
    number = F.regexp_extract(source, "([0-9]+)$", 1).try_cast("int")
    return F.when(number < 10, F.lit("web")).when(number < 15, F.lit("books")).otherwise(F.lit("forum"))


def count_tokens(text: Column | str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD_CLASS + "+")).cast("long")


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    listed = F.lit(1)
    for name, value in weights.get(level, {}).items():
        listed = F.when(F.col(level) == name, F.lit(value)).otherwise(listed)
    return listed.cast("long")


def _share(nodes: DataFrame, parent: list[str], level: str) -> DataFrame:
    """Split ``budget`` of each parent over its children by water filling.

    Children in the order of capacity per weight: one is full if it could not
    use the share it would get were all before it full; the rest divide what the
    full ones leave. Decimal arithmetic, rounded down."""
    by = Window.partitionBy(*parent)
    fill = by.orderBy((F.col("capacity") / F.nullif(F.col("weight"), F.lit(0))).asc_nulls_last(), F.col(level).asc_nulls_first())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    big = "decimal(38,0)"
    zero = F.lit(0).cast("decimal(28,0)")
    nodes = nodes.withColumns(
        {
            "_used": F.coalesce(F.sum("capacity").over(before), zero).cast("decimal(28,0)"),
            "_rest": (F.sum("weight").over(by) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast("decimal(10,0)"),
        }
    )
    c, w, b = (F.col(x).cast("decimal(28,0)") for x in ("capacity", "weight", "budget"))
    left = F.greatest(b - F.col("_used"), zero)
    full = (c * F.col("_rest")).cast(big) <= (left * w.cast("decimal(10,0)")).cast(big)
    nodes = nodes.withColumn("_full", (F.col("weight") > 0) & full)
    nodes = nodes.withColumns(
        {
            "_taken": F.coalesce(F.sum(F.when(F.col("_full"), F.col("capacity"))).over(by), zero).cast("decimal(28,0)"),
            "_share_of": F.coalesce(F.sum(F.when(~F.col("_full"), F.col("weight"))).over(by), F.lit(0)),
        }
    )
    part = F.expr("cast((cast(budget as decimal(28,0)) - _taken) * cast(weight as decimal(10,0)) as decimal(38,0)) div _share_of")
    quota = F.when(F.col("_full"), F.col("capacity")).when(F.col("_share_of") > 0, F.greatest(part, F.lit(0))).otherwise(F.lit(0))
    return nodes.withColumn("quota", quota.cast("long")).drop("_used", "_rest", "_full", "_taken", "_share_of")


def plan(leaves: DataFrame, budget: Column, weights: Mapping[str, Mapping[str, int]] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens, rows) with their ``quota``;
    ``budget`` is an expression over ``_total``, the tokens of all leaves. The tree
    has one row per leaf, not per document."""
    usable = F.lit(True)  # a leaf below any child of weight 0 has nothing to give
    for level in LEVELS:
        usable = usable & (_weight(level, weights) > 0)
    cap = F.when(usable, F.col("tokens") * max_epochs).otherwise(F.lit(0))
    nodes = leaves.withColumn("_cap", cap).withColumn("_root", F.lit(0))
    parent, quota = ["_root"], None
    for depth, level in enumerate(LEVELS):
        keys = [*parent, level]
        level_nodes = nodes.groupBy(*keys).agg(F.sum("_cap").alias("capacity"), F.sum("tokens").alias("_tokens"))
        if quota is None:
            # Over the domains, of which there are few.
            total = F.sum("_tokens").over(Window.partitionBy("_root"))
            level_nodes = level_nodes.withColumn("_total", total).withColumn("budget", budget).drop("_total")
        else:
            same = [level_nodes[k].eqNullSafe(quota[f"_q_{k}"]) for k in parent]
            condition = same[0]
            for s in same[1:]:
                condition = condition & s
            level_nodes = level_nodes.join(quota, condition).drop(*[f"_q_{k}" for k in parent])
        shared = _share(level_nodes.withColumn("weight", _weight(level, weights)), parent, level)
        quota = shared.select(*[F.col(k).alias(f"_q_{k}") for k in keys], F.col("quota").alias("budget"))
        parent = keys
        if depth == len(LEVELS) - 1:
            return shared.select(*LEVELS, "quota")
    raise AssertionError("no level")


def _order_key(epoch: Column, doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def _prefix(rows: DataFrame, leaf: list[str]) -> DataFrame:
    """Adds ``_start``: tokens of the leaf's rows before this one in key order."""
    slices = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("rows") / SLICE_ROWS))
    # 52 bits of the key as a fraction of 1, so slices follow the key's order.
    fraction = F.conv(F.substring("_key", 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
    cut = rows.withColumn("_slice", F.floor(fraction * slices))
    sums = cut.groupBy(*leaf, "_slice").agg(F.sum("_tokens").alias("_slice_tokens"))
    before = Window.partitionBy(*leaf).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_before", F.coalesce(F.sum("_slice_tokens").over(before), F.lit(0)))
    offsets = offsets.select(*[F.col(k).alias(f"_o_{k}") for k in (*leaf, "_slice")], "_before")
    condition = F.lit(True)
    for k in (*leaf, "_slice"):
        condition = condition & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    inside = Window.partitionBy(*leaf, "_slice").orderBy("_key", "_doc_id", "_row").rowsBetween(Window.unboundedPreceding, -1)
    within = cut.withColumn("_inside", F.coalesce(F.sum("_tokens").over(inside), F.lit(0)))
    return within.join(offsets, condition).withColumn("_start", F.col("_before") + F.col("_inside"))


def choose(
    docs: DataFrame,
    budget_percent: int = BUDGET_PERCENT,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    row: Column | None = None,
) -> DataFrame:
    """The selected documents (narrow): _row, doc_id, domain, lang, source,
    n_tokens, copies (how often the mix repeats the document), quota."""
    number = row if row is not None else F.monotonically_increasing_id()
    narrow = docs.select(
        number.alias("_row"), F.col("doc_id").alias("_doc_id"), domain_of(F.col("source")).alias("domain"), "lang", "source",
        count_tokens().alias("_tokens"),
    ).filter("_tokens > 0")
    narrow = stored(narrow, "mixing_tokens")
    leaf = list(LEVELS)
    leaves = narrow.groupBy(*leaf).agg(F.sum("_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    budget = F.expr(f"_total * {int(budget_percent)} div 100").cast("long")
    quotas = plan(leaves, budget, weights, max_epochs)
    condition = F.lit(True)
    for k in leaf:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_l_{k}"))
    renamed = quotas.select(*[F.col(k).alias(f"_l_{k}") for k in leaf], "quota")
    leaf_plan = leaves.join(renamed, condition).select(
        *[F.col(k).alias(f"_l_{k}") for k in leaf], "rows", "quota",
        F.expr("quota div tokens").alias("_epochs"), F.expr("quota % tokens").alias("_more"),
    )
    leaf_plan = stored(leaf_plan, "mixing_plan")
    rows = narrow.join(leaf_plan, condition).withColumn("_key", _order_key(F.col("_epochs"), F.col("_doc_id"), seed))
    placed = _prefix(rows.drop(*[f"_l_{k}" for k in leaf]), leaf)
    copies = F.col("_epochs") + F.when(F.col("_start") < F.col("_more"), 1).otherwise(0)
    return placed.withColumn("copies", copies.cast("long")).filter("copies > 0").select(
        "_row", F.col("_doc_id").alias("doc_id"), *leaf, F.col("_tokens").alias("n_tokens"), "copies", "quota"
    )


def mix(docs: DataFrame, on_files: bool = False, **options) -> DataFrame:
    """The mixed documents with the columns of ``docs``, each as often as the
    mix repeats it. ``on_files``: see ``named_rows``."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    rows, row = named_rows(docs, "mixing_documents", on_files)
    chosen = choose(rows, row=F.col(row), **options).select("_row", "copies")
    renamed = rows.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)], F.col(row).alias("_row"))
    repeated = renamed.join(chosen, "_row").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
