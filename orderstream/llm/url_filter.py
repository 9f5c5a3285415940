"""URL filter: host and path rules, then a learned verdict (operator 5).

A rule ``suffix/path`` fits a url whose host is the suffix or a subdomain of it
and whose path starts with the rule's path; the longest fitting rule decides.
Every other url is judged by a logistic regression on hashed character n-grams
of its host and path, trained from a small labelled URL table. Training uses the
DataFrame-based ML library on that table alone; scoring sums the weights of a
url's n-grams with built-in functions (no join, no shuffle).

Edge cases: a NULL url, or one without ``://``, has an empty host and path, fits
no rule and is judged from no n-grams, i.e. by the bias alone. Repeated rows are
judged one by one; other columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 4096
GRAMS = (3, 4, 5)
SCALE = 20.0
#: Probability from which a url is blocked; high, so that unknown names stay.
BLOCK_AT = 0.8

# The rules (verdict, rule).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

# The small labelled URL table: each name below with each ending.
BAD_NAMES = (
    "cheap-pills", "casino-win", "ads-track", "adult-x", "free-bets", "spam-farm", "online-poker", "pills-shop",
    "xxx-cams", "win-prize", "fast-loans", "replica-watch", "click-track", "bet-bonus", "adult-chat", "viagra-sale",
)
GOOD_NAMES = (
    "library", "news", "history", "science", "garden", "weather", "kitchen", "travel",
    "music", "school", "museum", "health", "thening", "tioner", "blog-notes", "data-archive",
    "that-thing", "therest", "theatre", "nation", "estate", "reheat", "thousand", "hearing",
    "shone", "than-and", "thread", "winter", "addison", "tablet", "farmhouse", "spanish",
)
ENDINGS = (
    "http://{}.example.com/en/417", "https://www.{}.example.net/fr/28/", "http://blog.{}.example.org/de/903.html",
    "https://m.{}.example.com/es/56?page=2", "https://{}.example.net/en/7718#top", "http://www.{}.example.com/",
)


def labelled_urls(spark: SparkSession) -> DataFrame:
    rows = [(end.format(name), float(bad)) for bad, names in ((0, GOOD_NAMES), (1, BAD_NAMES)) for name in names for end in ENDINGS]
    return spark.createDataFrame(rows, "url string, label double")


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    ascii_lower = F.translate(
        F.regexp_extract(url, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    return F.coalesce(ascii_lower, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or NULL."""
    choice = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        suffix, _, rest = rule.partition("/")
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith("/" + rest)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        choice = F.when(fits, value) if choice is None else choice.when(fits, value)
    return choice if choice is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _grams(text: Column, tag: str) -> Column:
    """Bucket numbers of the n-grams of a text, its ends marked."""
    chars = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")

    def bucket(n: int) -> Callable[[Column], Column]:
        def at(i: Column) -> Column:
            gram = [F.get(chars, i + j) for j in range(n)]
            return F.pmod(F.xxhash64(F.lit(tag), *gram), F.lit(BUCKETS)).cast("int")

        return at

    found = []
    for n in GRAMS:
        at = F.transform(F.sequence(F.lit(0), F.size(chars) - n), bucket(n))
        found.append(F.when(F.size(chars) >= n, at).otherwise(F.array().cast("array<int>")))
    return F.concat(*found)


def features(urls: DataFrame) -> DataFrame:
    """``urls`` with host, path and the buckets of their n-grams."""
    host, path = host_and_path(F.col("url"))
    split = urls.withColumns({"host": host, "path": path})
    empty = F.array().cast("array<int>")
    return split.withColumn(
        "_grams",
        F.concat(
            F.when(F.col("host") != "", _grams(F.col("host"), "host")).otherwise(empty),
            F.when(F.col("path") != "", _grams(F.col("path"), "path")).otherwise(empty),
        ),
    )


def train(labelled: DataFrame, reg: float = 0.001) -> tuple[float, list[float]]:
    """(bias, weight of each bucket). The table is small by contract (some
    hundred rows), hence one partition and dense vectors (``BUCKETS`` cells each)."""
    each = F.lit(SCALE) / F.size("_grams")
    hit = features(labelled).select("label", "url", "_grams").filter(F.size("_grams") > 0)
    counts = hit.select("label", "url", each.alias("v"), F.explode("_grams").alias("b")).groupBy("label", "url", "b").agg(F.sum("v").alias("v"))
    cells = hit.select("label", "url", F.explode(F.sequence(F.lit(0), F.lit(BUCKETS - 1))).alias("b")).join(counts, ["label", "url", "b"], "left")
    by_url = cells.groupBy("label", "url").agg(F.sort_array(F.collect_list(F.struct("b", F.coalesce("v", F.lit(0.0)).alias("v")))).alias("cells"))
    rows = by_url.select("label", array_to_vector(F.transform("cells", lambda c: c["v"])).alias("features")).coalesce(1)
    model = LogisticRegression(regParam=reg, maxIter=30, standardization=False).fit(rows)
    return float(model.intercept), [round(float(w), 6) for w in model.coefficients]


def judge(pages: DataFrame, model: tuple[float, list[float]], rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and the method's probability of ``block``."""
    bias, weights = model
    table = F.from_json(F.lit("[" + ",".join(map(repr, weights)) + "]"), "array<double>")  # BUCKETS numbers
    total = F.aggregate("_grams", F.lit(0.0), lambda acc, b: acc + F.get(table, b))
    score = F.lit(bias) + F.when(F.size("_grams") > 0, F.lit(SCALE) * total / F.size("_grams")).otherwise(F.lit(0.0))
    scored = features(pages.select("page_id", "url")).withColumn("p_block", F.lit(1.0) / (F.lit(1.0) + F.exp(-score)))
    ruled = scored.withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
    learned = F.when(F.col("p_block") >= BLOCK_AT, F.lit("block")).otherwise(F.lit("allow"))
    return ruled.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), learned).alias("verdict"), F.round("p_block", 6).alias("p_block"),
    )
