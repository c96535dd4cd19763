"""The covariance estimate and the distances against plain numpy concentration steps; groups and their fall-backs."""

import math

import numpy as np
from pyspark.sql import functions as F

from kalends.llm import quality as Q

FLOOR = np.array([Q.FLOORS[n] for n in Q.NAMES]) ** 2


def rank(values, p):
    return np.sort(values)[math.ceil(p * len(values)) - 1]


def floored(cov):
    cov = cov.copy()
    np.fill_diagonal(cov, np.maximum(np.diag(cov), FLOOR))
    return cov


def distances(x, centre, cov):
    return (np.linalg.solve(np.linalg.cholesky(floored(cov)), (x - centre).T) ** 2).sum(axis=0)


def by_loop(x):
    """The least determinant over three starts, each concentrated a little; the least of them some steps more."""
    d = x.shape[1]
    median = np.array([rank(c, 0.5) for c in x.T])
    spread = np.array([(rank(c, 0.75) - rank(c, 0.25)) / 1.349 for c in x.T])
    reach = np.maximum(spread, np.sqrt(FLOOR)) * Q.PULLED_IN
    pulled = np.clip(x, median - reach, median + reach)
    starts = [(median, np.diag(spread ** 2)), (x.mean(axis=0), np.cov(x.T, bias=True)), (median, np.cov(pulled.T, bias=True))]
    factor = Q.COVERED / Q.chi_square_cdf(Q.chi_square_quantile(Q.COVERED, d), d + 2)
    def step(centre, cov):
        dist = distances(x, centre, cov)
        near = x[dist <= rank(dist, Q.COVERED)]
        return near.mean(axis=0), np.cov(near.T, bias=True) * factor

    found = []
    for number, (centre, cov) in enumerate(starts):
        for _ in range(Q.EARLY_STEPS):
            centre, cov = step(centre, cov)
        found.append((round(np.linalg.slogdet(floored(cov))[1], 6), number, centre, cov))
    _, number, centre, cov = min(found, key=lambda f: f[:2])
    for _ in range(Q.LATER_STEPS):
        centre, cov = step(centre, cov)
    return np.linalg.slogdet(floored(cov))[1], number, centre, cov


def cloud(seed, rows=300, outliers=40):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(5, 5)) * 0.6
    x = rng.normal(size=(rows, 5)) @ mix + rng.normal(size=5)
    x[:outliers] += np.array([9, -7, 6, 8, -9])
    return x


def frame(spark, groups):
    rows = [(lang, "=s", *map(float, v)) for lang, x in groups.items() for v in x]
    return spark.createDataFrame(rows, "_lang string, _source string, " + ", ".join(f"{n} double" for n in Q.NAMES))


def test_estimates_are_those_of_plain_steps(spark):
    groups = {"=a": cloud(1), "=b": cloud(2, 80, 0), "=c": cloud(3, 500, 100)}
    good = frame(spark, groups)
    found = {r["_lang"]: r for r in Q.estimates_of(good).collect()}
    for lang, x in groups.items():
        log_det, number, centre, cov = by_loop(x)
        row = found[lang]
        assert np.allclose([row[f"m{i}"] for i in range(5)], centre, atol=1e-6)
        factor = np.array([[row[f"l{i}{j}"] if j <= i else 0 for j in range(5)] for i in range(5)])
        assert np.allclose(factor @ factor.T, floored(cov), atol=1e-6)
        assert abs(row["log_determinant"] - log_det) < 1e-5 and row["group_rows"] == len(x) and row["_start"] == number
    judged = Q._with_distance(good, Q.estimates_of(good), Q.KEY)
    for lang, x in groups.items():
        _, _, centre, cov = by_loop(x)
        got = sorted(r["distance"] for r in judged.where(F.col("_lang") == lang).collect())
        assert np.allclose(got, np.sort(distances(x, centre, cov)), rtol=1e-5)
        far = int((distances(x, centre, cov) > Q.chi_square_quantile(Q.INSIDE, 5)).sum())
        assert far >= {"=a": 40, "=b": 0, "=c": 100}[lang]  # every planted outlier


def test_a_step_reads_rows_against_one_small_table_at_a_time(spark):
    good = Q.materialise(frame(spark, {"=a": cloud(5), "=b": cloud(6)}), "good")
    started = good.withColumn("_start", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    starts = Q.materialise(Q._starts(good), "starts")
    for rows, estimates, keys in ((started, starts, Q.STARTED), (good, starts.where("_start = 1"), Q.KEY)):
        step = Q._concentrate(rows, estimates, keys)
        plan = step._jdf.queryExecution().optimizedPlan().toString()
        assert sum("Join " in line for line in plan.split("\n")) == 1
        assert {r["_start"] for r in step.collect()} == {r["_start"] for r in estimates.collect()}


def test_small_groups_are_judged_by_larger_ones(spark):
    rng = np.random.default_rng(4)
    text = lambda: " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(70))
    usual = [("en", "big", text()) for _ in range(70)] + [("en", "small", text()) for _ in range(5)] + [("xx", "rare", text()) for _ in range(3)]
    odd = [("en", "small", " ".join(["a" * 30] * 1 + ["".join(rng.choice(list("abcdefgh"), 25)) for _ in range(70)])),
           ("xx", None, " ".join("".join(rng.choice(list("#*$%"), 6)) + text()[:4].strip() + "x" for _ in range(70)))]
    df = spark.createDataFrame([(i, t, l, s) for i, (l, s, t) in enumerate(usual + odd)], "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r for r in Q.outlier_verdicts(df).collect()}
    assert all(r.distance is not None for r in out.values())
    assert not out[len(usual)].kept and not out[len(usual) + 1].kept
    assert sum(out[i].kept for i in range(len(usual))) >= len(usual) - 2
    only = Q.outlier_verdicts(df.limit(3)).collect()
    assert len(only) == 3 and all(r.distance is not None for r in only)
    assert Q.outlier_verdicts(df.limit(0)).collect() == []
