"""Robust multivariate outliers: documents far from what is usual in their language and source.

Each document becomes a vector of transformed text statistics. For every (language, source) the
minimum covariance determinant estimate is found by concentration steps: the three quarters of the documents nearest
to a centre give the next centre and covariance, and so on. The first steps run from several fixed starts (see
``_starts``); that with the least determinant then goes on. Documents whose squared Mahalanobis distance
exceeds a chi-square quantile are rejected.

All of it is DataFrame expressions: statistics are read off each text inside its row, estimates are
grouped aggregates (moments and mergeable quantile sketches, combined before the shuffle, so a source with
a third of all rows is no hot spot), and the 5 x 5 algebra is unrolled into column arithmetic on
one row per group.
"""

from __future__ import annotations

import math
import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends.llm.common import SPACES, words_of
from kalends.storage import materialise, temporary

#: Base rules: fewer words fail, and so do texts of which more than this share lies in repeated 3-word windows.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Share of each group that the estimate rests on, and the probability that a normal vector stays within the
#: cutoff: one in a thousand of a normal cloud is rejected.
COVERED = 0.75
INSIDE = 0.999
#: Every start is concentrated EARLY_STEPS times, the one with the least determinant by then LATER_STEPS times more, at every
#: size of the table. If an entry of its estimate still moves by more than SETTLED in the last step, a warning says so.
EARLY_STEPS = 2
LATER_STEPS = 4
SETTLED = 1e-6

#: Smallest group with an estimate of its own. The rows of smaller ones are judged by the estimate of all good rows of their
#: language, and where even the language has fewer, by that of all good rows there are.
MIN_GROUP = 60

#: The vector's components, each with the least standard deviation that is believed. Most texts have no
#: symbols and no repeated lines at all, so without a floor the covariance would be singular. Each is small enough
#: that its component alone can pass the cutoff: x_lines is at most 1, x_repeats at most sqrt(0.5) after the base rules.
FLOORS = {"x_length": 0.08, "x_symbols": 0.06, "x_lines": 0.15, "x_repeats": 0.12, "x_upper": 0.06}
NAMES = list(FLOORS)


def chi_square_cdf(x: float, k: int) -> float:
    """P(X <= x) for a chi-square variable with k degrees of freedom, by the series of the incomplete gamma."""
    if x <= 0:
        return 0.0
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= z / n
        total += term
    return total * math.exp(a * math.log(z) - z - math.lgamma(a))


def chi_square_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, k) < p else (low, middle)
    return (low + high) / 2


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """How many words lie in 3-word windows that occur at least twice in the array."""
    inner = F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    hashes = F.transform(inner, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    windows = F.transform(
        inner,
        lambda w, i: F.struct(F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)).alias("t"), i.alias("at")),
    )

    def starts(ordered: Column) -> Column:
        same = lambda x, k: F.get(ordered, k)["t"].eqNullSafe(x["t"])
        return F.sort_array(F.transform(
            F.filter(ordered, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["at"].cast("long")
        ))

    covered = F.aggregate(
        _let(F.sort_array(windows), starts),
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total")),
        lambda acc, s: F.struct(
            (s + 3).alias("end"), (acc["total"] + s + 3 - F.greatest(s, acc["end"])).alias("total")
        ),
        lambda acc: acc["total"],
    )
    # Equal windows have equal hashes, so a text without equal hashes needs no sort.
    return _let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered).otherwise(F.lit(0).cast("long")),
    )


def text_statistics(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source, the base counts of the whole text and the transformed vector."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(F.btrim(line, F.lit(SPACES))) > 0)
    counted = (
        documents.select("doc_id", "lang", "source", text.alias("text"))
        .select("doc_id", "lang", "source", "text", words_of(F.col("text")).alias("_words"), lines.alias("_lines"))
        .select(
            "doc_id", "lang", "source",
            F.size("_words").cast("long").alias("n_words"),
            F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            _repeated_words(F.col("_words")).alias("n_repeat_words"),
            F.size("_lines").cast("long").alias("n_lines"),
            F.length(F.regexp_replace("text", r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        )
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return counted.select(
        "*",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        F.log(F.greatest(ratio("word_chars", "n_words"), F.lit(1.0))).alias("x_length"),
        F.sqrt(ratio("n_symbols", "word_chars")).alias("x_symbols"),
        F.sqrt(ratio("n_dup_lines", "n_lines")).alias("x_lines"),
        F.sqrt(ratio("n_repeat_words", "n_words")).alias("x_repeats"),
        F.sqrt(F.least(ratio("n_upper", "word_chars"), F.lit(1.0))).alias("x_upper"),
    )


ANY = "*"


def _grouped(stats: DataFrame) -> DataFrame:
    """Give every row the group that judges it (``_lang``, ``_source``), and the groups to whose estimates it adds (``_adds``).

    That is its language and source, or all of its language, or everything: the first with ``MIN_GROUP`` good rows.
    """
    lang, source = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")), F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    keyed = stats.withColumns({"_l": lang, "_s": source})
    sizes = materialise(
        keyed.where(~F.col("base_failed")).groupBy("_l", "_s").agg(F.count(F.lit(1)).alias("_rows")), "group-sizes"
    )
    langs = sizes.groupBy("_l").agg(F.sum("_rows").alias("_of_lang"), F.min("_rows").alias("_least"))
    rare = langs.agg(F.coalesce(F.max((F.col("_of_lang") < MIN_GROUP).cast("int")), F.lit(0))).scalar() == 1
    known = sizes.join(langs, "_l").select(F.col("_l").alias("_kl"), F.col("_s").alias("_ks"), "_rows", "_of_lang", "_least")
    own, whole = F.coalesce(F.col("_rows") >= MIN_GROUP, F.lit(False)), F.coalesce(F.col("_of_lang") >= MIN_GROUP, F.lit(False))
    group = lambda l, s: F.struct(l.alias("l"), s.alias("s"))
    by_lang, by_any = group(F.col("_l"), F.lit(ANY)), group(F.lit(ANY), F.lit(ANY))
    judge = F.when(own, group(F.col("_l"), F.col("_s"))).when(whole, by_lang).otherwise(by_any)
    adds = F.array_compact(F.array(
        F.when(own, group(F.col("_l"), F.col("_s"))), F.when(whole & (F.col("_least") < MIN_GROUP), by_lang), F.when(rare, by_any)
    ))
    return (
        keyed.join(known, (F.col("_l") == F.col("_kl")) & (F.col("_s") == F.col("_ks")), "left")
        .withColumns({"_judge": judge, "_adds": adds})
        .withColumns({"_lang": F.col("_judge.l"), "_source": F.col("_judge.s")})
        .drop("_l", "_s", "_kl", "_ks", "_rows", "_of_lang", "_least", "_judge")
    )


KEY = ["_lang", "_source"]
#: Estimates in the making are told apart by their start as well.
STARTED = [*KEY, "_start"]
#: Values are pulled in to this many robust standard deviations for the third start.
PULLED_IN = 2.0


def _mu(i: int) -> Column:
    return F.col(f"m{i}")


def _factor(estimates: DataFrame) -> DataFrame:
    """Replace the covariances s{i}{j} by their Cholesky factor l{i}{j}; variances below their floor are raised to it.

    One row per estimate, one column per entry; each row of the factor is a projection of its own. ``log_determinant`` is that of
    the covariance with its floors, ``floored`` the number of variances that were raised.
    """
    d = len(NAMES)
    raised = [(F.col(f"s{i}{i}") < F.lit(FLOORS[NAMES[i]] ** 2)).cast("int") for i in range(d)]
    estimates = estimates.withColumn("floored", sum(raised[1:], raised[0]))
    for j in range(d):  # a column of the factor depends on those before it only
        def entry(i: int, j: int = j) -> Column:
            value = F.greatest(F.col(f"s{i}{j}"), F.lit(FLOORS[NAMES[i]] ** 2)) if i == j else F.col(f"s{i}{j}")
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            return value

        estimates = estimates.withColumn(f"l{j}{j}", F.sqrt(F.greatest(entry(j), F.lit(1e-12))))
        if j + 1 < d:
            estimates = estimates.withColumns({f"l{i}{j}": entry(i) / F.col(f"l{j}{j}") for i in range(j + 1, d)})
    logs = [F.log(F.col(f"l{i}{i}")) * 2 for i in range(d)]
    return estimates.select(
        *STARTED, "group_rows", "floored", sum(logs[1:], logs[0]).alias("log_determinant"), *_entries()
    )


def _equal(keys: list[str], prefix: str) -> Column:
    """The keys equal those of the other side, which carry a prefix."""
    return reduce(lambda a, b: a & b, [F.col(k) == F.col(f"{prefix}{k}") for k in keys])


def _entries() -> list[str]:
    d = len(NAMES)
    return [*[f"m{i}" for i in range(d)], *[f"l{i}{j}" for i in range(d) for j in range(i + 1)]]


def _with_distance(stats: DataFrame, estimates: DataFrame, keys: list[str], *more: str) -> DataFrame:
    """Add the squared Mahalanobis distance ``distance`` by forward substitution; null without an estimate.

    ``more`` columns of the estimates are added too.
    """
    factors = estimates.select(*[F.col(k).alias(f"e{k}") for k in keys], *_entries(), *more)
    joined = stats.join(factors, _equal(keys, "e"), "left")
    for i, name in enumerate(NAMES):
        rest = F.col(name) - _mu(i)
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"_y{k}")
        joined = joined.withColumn(f"_y{i}", rest / F.col(f"l{i}{i}"))
    squares = [F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(len(NAMES))]
    return joined.withColumn("distance", sum(squares[1:], squares[0])).select(*stats.columns, "distance", *more)


def _moments(names: list[Column], factor: float) -> list[Column]:
    """Means of the vector, and the covariances of ``names`` (the vector, or values derived from it), times a factor."""
    d = len(NAMES)
    return [
        *[F.avg(name).alias(f"m{i}") for i, name in enumerate(NAMES)],
        *[(F.covar_pop(names[i], names[j]) * factor).alias(f"s{i}{j}") for i in range(d) for j in range(i + 1)],
    ]


def _starts(good: DataFrame) -> DataFrame:
    """Three first estimates of every group.

    Medians with interquartile ranges as standard deviations; means with the covariance of all rows; medians with the
    covariance of values pulled in towards them, to ``PULLED_IN`` robust standard deviations.
    """
    d = len(NAMES)
    quartiles = materialise(good.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("group_rows"),
        *[F.percentile_approx(name, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 2000).alias(f"q{i}") for i, name in enumerate(NAMES)],
    ), "mcd-quartiles")
    spread = lambda i: (F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349
    medians = [F.col(f"q{i}")[1].alias(f"m{i}") for i in range(d)]
    first = quartiles.select(
        *KEY, F.lit(0).alias("_start"), "group_rows", *medians,
        *[(F.pow(spread(i), F.lit(2.0)) if i == j else F.lit(0.0)).alias(f"s{i}{j}") for i in range(d) for j in range(i + 1)],
    )
    second = good.groupBy(*KEY).agg(F.count(F.lit(1)).alias("group_rows"), *_moments([F.col(n) for n in NAMES], 1.0)).withColumn("_start", F.lit(1))
    named = quartiles.select(F.col("_lang").alias("k_lang"), F.col("_source").alias("k_source"), *[f"q{i}" for i in range(d)])
    placed = good.join(named, (F.col("_lang") == F.col("k_lang")) & (F.col("_source") == F.col("k_source")))
    reach = [F.greatest(spread(i), F.lit(FLOORS[NAMES[i]])) * PULLED_IN for i in range(d)]
    pulled = [F.least(F.greatest(F.col(n), F.col(f"q{i}")[1] - reach[i]), F.col(f"q{i}")[1] + reach[i]) for i, n in enumerate(NAMES)]
    third = placed.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("group_rows"), *_moments(pulled, 1.0), *[F.first(F.col(f"q{i}")[1]).alias(f"c{i}") for i in range(d)]
    ).withColumns({f"m{i}": F.col(f"c{i}") for i in range(d)}).drop(*[f"c{i}" for i in range(d)]).withColumn("_start", F.lit(2))
    return _factor(first.unionByName(second).unionByName(third))


def _concentrate(good: DataFrame, estimates: DataFrame, keys: list[str] = STARTED) -> DataFrame:
    """One concentration step: mean and covariance of the nearest ``COVERED`` share of each group (and start)."""
    d = len(NAMES)
    started = [] if "_start" in keys else ["_start"]
    whole = estimates.withColumn("_estimate", F.struct(*_entries(), *started))
    far = _with_distance(good, whole, keys, "_estimate").where(F.col("distance").isNotNull())
    # Written first, so that Spark knows its size and broadcasts it while it is small; documents then stay in place. Estimates go
    # along with their limits, so that rows meet one small table and not one after the other: each broadcast and each stage
    # takes several MB of the driver's memory, whatever its size.
    limits = materialise(far.groupBy(*keys).agg(
        F.percentile_approx("distance", COVERED, 10000).alias("_limit"), F.count(F.lit(1)).alias("group_rows"), F.first("_estimate").alias("_estimate")
    ).select(*keys, "_limit", "group_rows", "_estimate.*"), "mcd-limits")
    near = _with_distance(good, limits, keys, "_limit", "group_rows", *started).where(F.col("distance") <= F.col("_limit"))
    # The trimmed covariance of a normal cloud is too small by a known factor.
    cut = chi_square_quantile(COVERED, d)
    factor = COVERED / chi_square_cdf(cut, d + 2)
    return _factor(near.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in ("group_rows", *started)], *_moments([F.col(n) for n in NAMES], factor)
    ))


def _moved(before: DataFrame, after: DataFrame) -> bool:
    """Whether any entry of any estimate has moved by more than ``SETTLED``."""
    old = before.select(*STARTED, *[F.col(c).alias(f"_{c}") for c in _entries()])
    far = F.greatest(*[F.abs(F.col(c) - F.col(f"_{c}")) for c in _entries()])
    return not after.join(old, STARTED).where(far > SETTLED).isEmpty()


def estimates_of(good: DataFrame) -> DataFrame:
    """The estimate with the least determinant of every group: ``_lang``, ``_source``, the start it came from, group_rows, floored,
    log_determinant, the centre m{i} and the Cholesky factor l{i}{j} of the covariance.

    ``good`` has ``_lang``, ``_source`` and the vector.
    """
    started = good.withColumn("_start", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    estimates = _starts(good)
    for _ in range(EARLY_STEPS):
        estimates = _concentrate(started, materialise(estimates, "mcd-start"))
    others = [c for c in estimates.columns if c not in KEY]
    # Determinants that differ by rounding only count as equal; the first start is then taken.
    order = F.struct(F.round("log_determinant", 6).alias("d"), F.col("_start").alias("s"))
    best = estimates.groupBy(*KEY).agg(F.min_by(F.struct(*others), order).alias("x"))
    estimates = materialise(best.select(*KEY, *[F.col(f"x.{c}").alias(c) for c in others]), "mcd-best")
    for _ in range(LATER_STEPS):
        before, estimates = estimates, materialise(_concentrate(good, estimates, KEY), "mcd-step")
    if _moved(before, estimates):
        warnings.warn(f"estimates still move after {LATER_STEPS} concentration steps", stacklevel=2)
    return estimates


def outlier_verdicts(documents: DataFrame) -> DataFrame:
    """Judge every document by the base rules and by its distance from its group.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and
    distance (squared Mahalanobis distance; null where no estimate exists). Only documents that pass the
    base rules form the estimates; the others are not kept.

    Defined cases: a null or empty text has no words and fails; null languages and sources are groups of
    their own; repeated rows are judged one by one and all count; rows of a group with under ``MIN_GROUP``
    good rows are judged by all good rows of their language, or by all there are; an empty table gives an empty result;
    columns other than doc_id, text, lang and source are ignored.
    """
    spark = documents.sparkSession
    with temporary(spark, keep=lambda folder: "/verdicts-" in folder):
        return materialise(_verdicts(documents), "verdicts")


def _verdicts(documents: DataFrame) -> DataFrame:
    stats = materialise(_grouped(materialise(text_statistics(documents), "text-statistics")), "grouped-statistics")
    good = materialise(stats.where(~F.col("base_failed")).select(F.explode("_adds").alias("_group"), *NAMES).select(
        F.col("_group.l").alias("_lang"), F.col("_group.s").alias("_source"), *NAMES
    ), "good-statistics")
    estimates = estimates_of(good)
    cutoff = chi_square_quantile(INSIDE, len(NAMES))
    return _with_distance(stats.drop("_adds"), estimates, KEY).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cutoff)).alias("kept"),
        "distance",
    )
