import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from orderstream.llm import quality


def base(text):
    text = text or ""
    words = re.findall(r"[^ \t-\r]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^ \t-\r]", x)]
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit)


def texts():
    rng = random.Random(3)
    vocab = ["ab", "é", "c#", "|", "x\u3000y", "long" * 9]
    out = [None, "", " \n\t", "a", "a b c d e f g h " * 3, "a " * 40, "one\n\n one\none\r\none\n", "w " * 7, "q" * 30000]
    for _ in range(60):
        line = " ".join(rng.choice(vocab) for _ in range(rng.randrange(40)))
        out.append("\n".join([line] * rng.randrange(1, 4)) + rng.choice(["", "\x0b\x0c", " \x85 z"]))
    return out


def test_base_counts(docs, spark):
    rows = list(enumerate(texts())) + [(None, "x y")] + [(0, None)]
    df = docs(rows).withColumn("n_words", F.lit("clash")).withColumn("kept", F.lit(1))
    got = quality.judge(df, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    want = sorted(((i is None, i or 0), *base(t)) for i, t in rows)
    assert sorted(((r.doc_id is None, r.doc_id or 0), *[r[b] for b in quality.BASE]) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed)  # no labels: base rules only
    assert quality.keep_good(df, spark.createDataFrame([], "doc_id long, quality int")).columns == df.columns


def test_exact_binomial_bound(spark):
    rows = [(n,) for n in (1, 10, 200, 299, 300, 1000, 5000)]
    df = spark.createDataFrame(rows, "n long").select("n", quality.allowed_losses(F.col("n"), 0.01, F.lit(0.05)).alias("k"))
    for n, k in df.collect():
        term = lambda j: math.comb(n, j) * 0.01**j * 0.99 ** (n - j)  # noqa: B023, E731
        best, cdf = -1, 0.0
        for j in range(n // 100 + 1):
            cdf += term(j)
            if cdf <= 0.05:
                best = j
        assert k == best


def log_binomial(n, j, p):
    return math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p)


def allowed(n, p, level):
    best, cdf = -1, 0.0
    for j in range(int(n * p) + 1):
        cdf += math.exp(log_binomial(n, j, p))
        if cdf <= level:
            best = j
    return best


def test_binomial_bound_of_many_labels(spark):
    rows = [(n,) for n in (19_999, 20_050, 60_000, 1_000_000)]
    df = spark.createDataFrame(rows, "n long").select("n", quality.allowed_losses(F.col("n"), 0.02, F.lit(0.0125)).alias("k"))
    assert {n: k for n, k in df.collect()} == {n: allowed(n, 0.02, 0.0125) for (n,) in rows}


def joint_cutoffs(rows, marks, risk=quality.RISK, delta=quality.DELTA):
    """rows: (doc_id, stratum, metrics); marks: doc_id -> good."""
    fits, tests = {}, {}
    for i, stratum, metrics in rows:
        if i in marks:
            fit = marks[i] and hashlib.sha256(str(i).encode()).hexdigest()[0] in quality.FIT_DIGITS
            (fits if fit else tests).setdefault(stratum, []).append((metrics, marks[i]))
    families, steps = {}, {}
    for stratum, fit in fits.items():
        families[stratum] = []
        for m in range(len(quality.METRICS)):
            values = [metrics[m] for metrics, _ in fit]
            top = max(values)
            cuts = [top + (1000 - top) * share // 1000 for share in quality.WIDE]
            for ppm in quality.tails(risk):
                cuts.append(min(v for v in values if sum(x > v for x in values) <= len(values) * ppm // 1_000_000))
            assert cuts == sorted(cuts, reverse=True)
            families[stratum].append(cuts)
    tests = {s: t for s, t in tests.items() if s in fits and any(good for _, good in t)}
    for stratum, test in tests.items():
        n = sum(good for _, good in test)
        k, best = allowed(n, risk, delta / len(tests)), None
        for step in range(quality.STEPS):
            cut = [cuts[step] for cuts in families[stratum]]
            out = [good for metrics, good in test if any(v > c for v, c in zip(metrics, cut))]
            lost, caught = sum(out), len(out) - sum(out)
            gain = caught / (len(test) - n) - lost / n if len(test) > n else step
            if lost <= k and (best is None or gain > best[0]):
                best = gain, cut
        if best:
            steps[stratum] = best[1]
    return steps


def test_joint_cutoffs_against_brute_force(spark):
    rng = random.Random(21)
    rows, marks, labels = [], {}, []
    # A large stratum, a rare one, one without bad labels, a NULL one, one too
    # small to certify and one whose documents are all alike.
    for stratum, size, bad_share in (("en", 2500, 0.1), ("rare", 460, 0.1), ("clean", 900, 0), (None, 800, 0.2), ("few", 60, 0.3), ("same", 900, 0.4)):
        for _ in range(size):
            i = len(rows)
            good = rng.random() >= bad_share
            if stratum == "same":
                metrics = [7] * 6
            else:
                metrics = [min(1000, int(rng.expovariate(1 / scale))) for scale in (2, 90, 30, 1, 5, 60)]
                if not good:
                    metrics[rng.randrange(6)] = rng.choice([150, 400, 1000])
            rows.append((i, stratum, metrics))
            if rng.random() < 0.9:
                marks[i] = good
                labels += [(i, int(good))] + ([(i, 1)] if not good else [])  # labels that disagree count as bad
    rows.append((None, "en", [1000] * 6))
    labels += [(None, 1), (0, None), (-5, 1)]
    data = [(i, s, 30, 0, *m) for i, s, m in rows] + [(10**6, "en", 5, 0, *[1000] * 6)]
    schema = "doc_id long, lang string, n_words long, n_repeat_words long, " + ", ".join(f"{m} int" for m in quality.METRICS)
    got = quality.cutoffs(spark.createDataFrame(data, schema), spark.createDataFrame(labels + [(10**6, 1)], "doc_id long, quality int")).collect()
    want = joint_cutoffs(rows, marks)
    assert {r["_stratum"]: [r[m] for m in quality.METRICS] for r in got} == want
    assert set(want) == {"en", "rare", "clean", None, "same"}


def test_a_rare_stratum_gets_cutoffs(docs, spark):
    """380 good labels certify a joint step; six separate tests would need 1,200."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, labels = [], []
    for i in range(430):
        bad = i >= 380
        rows.append((i, " ".join(word() + ("###" if bad else "") for _ in range(30)), "xx", "s"))
        labels.append((i, 0 if bad else 1, 0))
    got = {r.doc_id: r.kept for r in quality.judge(docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert [i for i, k in got.items() if not k and i < 380] == []
    assert not any(got[i] for i in range(380, 430))


def test_cutoff_limits_losses_and_catches_junk(docs, spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, labels = [], []
    for i in range(4000):
        bad = i % 8 == 0
        rows.append((i, " ".join(word() + ("###" if bad else "") for _ in range(30)), "en", "s"))
        labels.append((i, 0 if bad else 1, 0))
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in quality.judge(docs(rows), frame).collect()}
    assert not any(got[i] for i, q, _ in labels if not q)
    lost = sum(not got[i] for i, q, _ in labels if q)
    assert lost <= quality.RISK * 3500


def test_empty(docs, spark):
    assert quality.judge(docs([]), spark.createDataFrame([], "doc_id long, quality int")).count() == 0
