"""Quality rules with risk-controlled cutoffs (operator 6).

Base rules are fixed (``n_words < 20``, or more than 30 % of the words inside
repeated 8-word windows). On top of them each stratum (language) gets one cutoff
per metric of ``METRICS``, chosen from a labelled holdout: reject a document that
has a metric above its cutoff.

The cutoffs of a stratum are chosen jointly, as one step of a nested family of
``STEPS`` steps from no rejection to a tail of the good documents beyond the
risk. The good documents whose id's SHA-256 begins with one of ``FIT_DIGITS`` (a
quarter) shape the family and take no further part: per metric, the first steps
close in on their largest value, the others cut into their upper tail, equally
deep in every metric. The other good documents certify: a step is safe where the
exact binomial (Clopper-Pearson) test over them rejects "more than ``risk`` of
the good documents are lost to any of the cutoffs" at level ``delta`` divided by
the number of strata (Bonferroni). Steps are nested and tested from the mildest
on, so one stratum's steps need no further correction, and with probability
``1 - delta`` no stratum loses more than ``risk`` of its good documents. Among the
safe steps, the one with the largest share of bad less share of good holdout
documents rejected is taken (the mildest of equals), so no good document is lost
without a bad one to show for it; a stratum without bad labels takes its strictest
safe step. A stratum with too few labels to certify anything gets no cutoff.

Metrics are whole per-mille values from 0 to 1000, so the holdout is summed into
at most 1001 bins per metric and stratum for the family, and into ``STEPS + 1``
bins per stratum for the test. Everything is DataFrame expressions; documents are
never exploded.

Edge cases: NULL or blank text has no words and fails the base rules. A NULL
language is a stratum of its own. Repeated rows are judged one by one; labels of
one id that disagree count as bad. Columns beyond doc_id, text and lang are
ignored by ``judge`` and carried by ``keep_good``. An empty table gives an empty
result; no labels give base rules only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_CLASS, stored, text_or_empty, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
RISK = 0.02
DELTA = 0.05
MAX_BROADCAST_STRATA = 10_000
#: First hex digits of SHA-256(doc_id) of the documents that shape the family.
FIT_DIGITS = "0123"
#: Steps above the largest fitted value: per mille of the way up to 1000.
WIDE = (*(round(1000 * 0.8**i) for i in range(31)), 0)
#: Steps into the fitted values: tails of equal width, the last twice the risk.
TAILS = 32
STEPS = len(WIDE) + TAILS
# Fixed value: the characters counted as symbols.
SYMBOLS = "[#*$%&|<>]"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
METRICS = ("m_symbols", "m_punct", "m_upper", "m_dup_lines", "m_repeat", "m_long_words")
_W, _K, _L, _H, _T = "_words", "_word_hashes", "_lines", "_windows", "_text"


def _covered(starts: Column) -> Column:
    """Words inside the windows that begin at the ascending ``starts``."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def step(acc: Column, at: Column) -> Column:
        fresh = F.lit(WINDOW) - F.greatest(F.lit(0), acc["end"] - at)
        return F.struct((at + WINDOW).alias("end"), (acc["n"] + fresh).alias("n"))

    return F.aggregate(starts, zero, step, lambda acc: acc["n"])


def _repeat_words(win: Column) -> Column:
    """Words covered by windows (given as hashes in text order) found twice.
    Sorting happens only in documents that repeat a window at all."""
    tagged = F.array_sort(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice(tagged, 1, F.size(win) - 1))
    after = F.concat(F.slice(tagged, 2, F.size(win) - 1), F.array(F.lit(None).cast("struct<h:bigint,i:int>")))
    near = F.arrays_zip(tagged.alias("a"), before.alias("b"), after.alias("c"))
    twice = F.filter(near, lambda x: x["a"]["h"].eqNullSafe(x["b"]["h"]) | x["a"]["h"].eqNullSafe(x["c"]["h"]))
    starts = F.array_sort(F.transform(twice, lambda x: x["a"]["i"]))
    return F.when(F.size(F.array_distinct(win)) < F.size(win), _covered(starts)).otherwise(F.lit(0))


def _share(part: Column, rest: Column) -> Column:
    """``part / (part + rest)`` in whole per mille; 0 where both are 0."""
    return F.when(part + rest > 0, F.floor(F.lit(1000) * part / (part + rest))).otherwise(F.lit(0)).cast("int")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts and the metrics added."""
    steps = docs.withColumn(_T, text_or_empty(text)).withColumns(
        {_W: words(F.col(_T)), _L: F.filter(F.split(F.col(_T), "\n"), lambda line: line.rlike(WORD_CLASS))}
    )
    steps = steps.withColumn(_K, F.transform(_W, lambda w: F.xxhash64(w)))
    n = F.size(_W)
    windows = F.when(
        n >= WINDOW,
        # Item by item: ``slice`` would copy the whole array at every position.
        F.transform(
            F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(F.col(_K), i + j) for j in range(WINDOW)])
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    steps = steps.withColumn(_H, windows)
    steps = steps.withColumns(
        {
            "n_words": F.size(_W).cast("long"),
            "word_chars": F.length(F.array_join(_W, "")).cast("long"),
            "n_symbols": F.regexp_count(_T, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": (F.size(_L) - F.size(F.array_distinct(_L))).cast("long"),
            "n_repeat_words": _repeat_words(F.col(_H)).cast("long"),
            "_n_lines": F.size(_L).cast("long"),
            "_upper": F.regexp_count(_T, F.lit(r"\p{Lu}")).cast("long"),
            "_punct": F.regexp_count(_T, F.lit(r"\p{P}")).cast("long"),
        }
    )
    return steps.withColumns(
        {
            "m_symbols": _share(F.col("n_symbols"), F.col("n_words")),
            "m_punct": _share(F.col("_punct"), F.col("n_words")),
            "m_upper": _share(F.col("_upper"), F.col("word_chars") - F.col("_upper")),
            "m_dup_lines": _share(F.col("n_dup_lines"), F.col("_n_lines") - F.col("n_dup_lines")),
            "m_repeat": _share(F.col("n_repeat_words"), F.col("n_words") - F.col("n_repeat_words")),
            "m_long_words": _share(F.col("word_chars"), 10 * F.col("n_words")),
        }
    ).drop(_T, _W, _K, _L, _H, "_n_lines", "_upper", "_punct")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _log_factorial(x: Column) -> Column:
    """Stirling's series; exact to 1e-14 from 100 on."""
    return x * F.log(x) - x + F.log(x * F.lit(2 * math.pi)) / 2 + 1 / (12 * x) - 1 / (360 * x * x * x)


def allowed_losses(n: Column, risk: float, level: Column) -> Column:
    """The largest k with P(Binomial(n, risk) <= k) <= level, or -1.

    The terms are built by their ratio in logarithms, so large ``n`` does not
    underflow. k cannot pass the mean, so the walk ends there; where the mean is
    large it begins 12 deviations below (what lies lower is under 1e-30), so its
    length grows with the square root of ``n``."""
    odds = math.log(risk) - math.log1p(-risk)
    mean = n * F.lit(risk)
    begin = F.when(mean > 400, F.floor(mean - 12 * F.sqrt(mean))).otherwise(F.lit(0)).cast("long")
    x, size = begin.cast("double"), n.cast("double")
    choose = F.when(begin > 0, _log_factorial(size) - _log_factorial(x) - _log_factorial(size - x)).otherwise(F.lit(0.0))
    first = choose + x * F.lit(odds) + size * F.lit(math.log1p(-risk))
    start = F.struct(first.alias("log_term"), F.lit(0.0).alias("cdf"), (begin - 1).alias("k"))

    def step(acc: Column, j: Column) -> Column:
        cdf = acc["cdf"] + F.exp(acc["log_term"])
        nxt = acc["log_term"] + F.log((n - j).cast("double")) - F.log((j + 1).cast("double")) + F.lit(odds)
        return F.struct(
            F.when(n > j, nxt).otherwise(F.lit(float("-inf"))).alias("log_term"),
            cdf.alias("cdf"),
            F.when(cdf <= level, j).otherwise(acc["k"]).alias("k"),
        )

    walk = F.sequence(begin, F.floor(mean).cast("long"))
    return F.aggregate(walk, start, step, lambda acc: acc["k"])


def tails(risk: float) -> list[int]:
    """The shares (per million) of the fitted documents above the cutoffs of the
    last steps, per metric."""
    return [round(2_000_000 * risk * (i + 1) / TAILS) for i in range(TAILS)]


def _families(fit: DataFrame, risk: float) -> DataFrame:
    """One row per stratum: for each metric its ``STEPS`` cutoffs, falling."""
    metric = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS]))
    bins = fit.select("_stratum", metric.alias("m")).groupBy("_stratum", "m.metric", "m.value").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("_stratum", "metric")
    above = by.orderBy(F.col("value").desc()).rowsBetween(Window.unboundedPreceding, -1)
    scored = bins.withColumns({"good": F.sum("n").over(by), "above": F.coalesce(F.sum("n").over(above), F.lit(0))})
    groups = scored.groupBy("_stratum", "metric").agg(
        F.max("good").alias("good"), F.max("value").alias("top"), F.collect_list(F.struct("value", "above")).alias("bins")  # at most 1001
    )
    wide = F.transform(F.array(*map(F.lit, WIDE)), lambda s: F.col("top") + F.floor((1000 - F.col("top")) * s / 1000).cast("int"))
    tail = F.transform(
        F.array(*map(F.lit, tails(risk))),
        lambda p: F.array_min(
            F.transform(F.filter("bins", lambda b: b["above"] <= F.floor(F.col("good") * p / 1_000_000)), lambda b: b["value"])
        ),
    )
    family = groups.select("_stratum", "metric", F.concat(wide, tail).alias("cuts"))
    return family.groupBy("_stratum").pivot("metric", list(METRICS)).agg(F.first("cuts"))


def _per_stratum(strata: DataFrame, name: str) -> DataFrame:
    """A table of one row per stratum, ready to be joined: its columns renamed
    ``_of_<column>``, stored and counted, so that the other side needs no shuffle;
    more strata than the bound are joined by a shuffle."""
    strata = stored(strata.select([F.col(c).alias(f"_of_{c}") for c in strata.columns]), name)
    return F.broadcast(strata) if strata.count() <= MAX_BROADCAST_STRATA else strata


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per stratum that has certified cutoffs, one column per metric.

    ``labels`` (doc_id, quality) marks the holdout. Only documents that pass the
    base rules count: those rules come first."""
    marks = labels.groupBy("doc_id").agg((F.min("quality") == 1).alias("_good")).filter("_good IS NOT NULL")
    passed = measured.filter(~base_failed()).select("doc_id", F.col(stratum).alias("_stratum"), *METRICS)
    digit = F.substring(F.sha2(F.col("doc_id").cast("string"), 256), 1, 1)
    held = passed.join(marks, "doc_id").withColumn("_fit", F.col("_good") & digit.isin(*FIT_DIGITS)).drop("doc_id")
    held = stored(held, "quality_holdout")
    families = _per_stratum(_families(held.filter("_fit"), risk), "quality_families")
    judged = held.filter(~F.col("_fit")).join(families, F.col("_stratum").eqNullSafe(F.col("_of__stratum")))

    def steps_survived(metric: str) -> Column:
        return F.size(F.filter(f"_of_{metric}", lambda cut: cut >= F.col(metric)))

    survived = F.least(*map(steps_survived, METRICS))
    hist = (
        judged.groupBy("_stratum", survived.alias("step"))
        .agg(F.count_if("_good").alias("good"), F.count_if(~F.col("_good")).alias("bad"))
        .groupBy("_stratum")
        .agg(
            F.sum("good").alias("n"),
            F.sum("bad").alias("n_bad"),
            F.collect_list(F.struct("step", "good", "bad")).alias("hist"),  # at most STEPS + 1
        )
        .filter("n > 0")
    )
    hist = stored(hist, "quality_tests")
    one = F.lit(1).alias("_one")
    strata = hist.groupBy(one).agg(F.count(F.lit(1)).alias("_strata"))
    tested = hist.select("*", one).join(F.broadcast(strata), "_one")  # one row
    tested = tested.withColumn("k", allowed_losses(F.col("n"), risk, F.lit(delta) / F.col("_strata")))

    def until(step: Column, kind: str) -> Column:
        return F.aggregate(
            "hist", F.lit(0).cast("long"), lambda acc, h: acc + F.when(h["step"] <= step, h[kind]).otherwise(F.lit(0))
        )

    def score(step: Column) -> Column:
        lost, caught = until(step, "good"), until(step, "bad")
        gain = F.when(F.col("n_bad") > 0, caught / F.col("n_bad") - lost / F.col("n")).otherwise(step.cast("double"))
        return F.struct(gain.alias("gain"), (-step).alias("mild"), lost.alias("lost"))

    steps = F.transform(F.sequence(F.lit(0), F.lit(STEPS - 1)), score)
    best = F.array_max(F.filter(steps, lambda s: s["lost"] <= F.col("k")))
    picked = tested.withColumn("_step", -best["mild"]).filter("_step IS NOT NULL")
    chosen = picked.select("_stratum", "_step").join(families, F.col("_stratum").eqNullSafe(F.col("_of__stratum")))
    return chosen.select("_stratum", *[F.get(F.col(f"_of_{m}"), F.col("_step")).alias(m) for m in METRICS])


def _verdict(measured: DataFrame, cuts: DataFrame, stratum: str) -> DataFrame:
    joined = measured.join(_per_stratum(cuts, "quality_cutoffs"), F.col(stratum).eqNullSafe(F.col("_of__stratum")), "left")
    over = F.lit(False)
    for m in METRICS:
        over = over | F.coalesce(F.col(m) > F.col(f"_of_{m}"), F.lit(False))
    # One CASE, not a conjunction: no part of it can move below the join.
    return joined.withColumn("base_failed", base_failed()).withColumn(
        "kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(~over)
    )


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per document: doc_id, base counts, metrics, base_failed, kept.

    The measured (narrow) table is stored once and used both for the cutoffs
    and for the verdicts, so each text is read once."""
    narrow = measure(docs.select("doc_id", F.col(stratum), "text")).drop("text")
    narrow = stored(narrow, "quality_measured")
    cuts = cutoffs(narrow, labels, stratum, risk, delta)
    return _verdict(narrow, cuts, stratum).select("doc_id", *BASE, "base_failed", "kept", *METRICS)


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The documents that pass, with the columns of ``docs``. The cutoffs come
    from a narrow table of the measures; the documents are measured once more
    where they are filtered, which costs less than storing their texts."""
    narrow = stored(measure(docs.select("doc_id", F.col(stratum), "text")).drop("text"), "quality_measured")
    cuts = cutoffs(narrow, labels, stratum, risk, delta)
    # Columns that the measures would replace are carried under other names.
    carried = {c: f"_carried_{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(c).alias(name) for c, name in carried.items()], F.col(stratum).alias("_doc_stratum"), F.col("text").alias("_doc_text"))
    measured = measure(renamed, "_doc_text").drop("_doc_text")
    kept = _verdict(measured, cuts, "_doc_stratum").filter("kept")
    return kept.select(*[F.col(name).alias(c) for c, name in carried.items()])
