"""Quality rules: base rules on counts, then robust multivariate outliers by minimum covariance determinant.

Every document's counts are transformed into a short vector. For each (lang, source) the covariance of the ``core``
share of vectors with the least determinant is sought by concentration steps from three starts (medians with median
deviations, spatial signs about the medians, and all rows' moments): each goes on until no determinant changes any more,
and of a group's three results the least determinant counts. Steps are plain grouped aggregations: a group may be of any
size, as each task only sends sums and sketches. A vector whose squared Mahalanobis distance from its group's estimate is
above the chi-squared quantile that leaves ``tail`` is rejected. The noise that counts have by chance, at the prior's
size, is added to the variances: without it one symbol is an outlier where most texts have none.

Groups of fewer rows than ``least_rows``, twice what a covariance of full rank needs, are judged with the others of their
language, or else with all such rows; judged_by says which (null: too few rows in all, so the base rules alone decide).

Nulls: a null text is empty; a null lang or source is a group of its own; null ids are kept as they are. Repeated rows
are judged one by one, alike. An empty table gives an empty result. Columns of the names added are replaced; others may
have any names.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import erf, exp, lgamma, log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import need, written
from .text_stats import base_statistics, fields, with_statistics

#: Words and characters of the prior.
WORDS, CHARS = 50.0, 300.0
#: Standard deviations that are added: of roots of rates by the law of small counts at the prior's size, of a mean of
#: logs of word lengths and of the share of distinct words at four times that size.
FLOORS = {
    "z_length": 0.5 / sqrt(4 * WORDS),
    "z_symbols": 0.5 / sqrt(CHARS),
    "z_lines": 0.5 / sqrt(WORDS),
    "z_repeats": 0.5 / sqrt(WORDS),
    "z_variety": 0.5 / sqrt(4 * WORDS) / log(4 * WORDS),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words")
SALTS = 32


@dataclass(frozen=True)
class Rules:
    least_words: int = 10
    most_repeat_percent: int = 20
    core: float = 0.75
    most_steps: int = 30
    settled: float = 1e-3
    least_rows: int = 12
    tail: float = 1e-7
    most_sent: int = 10_000

    def cutoff(self) -> float:
        return chi2_quantile(1 - self.tail, len(FLOORS))


def base_failed(rules: Rules) -> Column:
    few = F.col("n_words") < rules.least_words
    return few | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.most_repeat_percent)


def vector() -> dict[str, Column]:
    """Transformed statistics: ratios held towards a prior of 50 words, so short texts don't scatter; roots of rates."""
    words, chars = F.col("n_words") + WORDS, F.col("word_chars") + CHARS
    return {
        "z_length": F.log(chars / words),
        "z_symbols": F.sqrt(F.col("n_symbols") / chars),
        "z_lines": F.sqrt(F.col("n_dup_lines") / words),
        "z_repeats": F.sqrt(F.col("n_repeat_words") / words),
        "z_variety": F.log(F.col("n_distinct_words") + WORDS) / F.log(words),
    }


Z = list(FLOORS)
PAIRS = [(a, b) for i, a in enumerate(Z) for b in Z[: i + 1]]


def chi2_below(x: float, p: int) -> float:
    """P(chi-squared of an odd p degrees of freedom <= x)."""
    tail = sum(exp((k + 0.5) * log(x / 2) - x / 2 - lgamma(k + 1.5)) for k in range((p - 1) // 2))
    return erf(sqrt(x / 2)) - tail


def chi2_quantile(share: float, p: int) -> float:
    low, high = 1e-6, 200.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_below(mid, p) < share else (low, mid)
    return low


def consistency(core: float, p: int) -> float:
    """Factor by which the covariance of the core share of a normal cloud is too small."""
    return core / chi2_below(chi2_quantile(core, p), p + 2)


def _joined(rows: DataFrame, small: DataFrame, keys: list[str], few: bool, how: str = "left") -> DataFrame:
    """``rows`` with the row of ``small`` of their group: sent to all if ``few`` groups were counted, else salted, so that
    a group of any share of the rows is split."""
    if few:
        return rows.join(F.broadcast(small), keys, how)
    salted = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return rows.join(salted, [*keys, "salt"], how).drop("salt")


def _moments(rows: DataFrame) -> DataFrame:
    """Means and covariances of each group and start; the sums are taken map-side first."""
    sums = rows.groupBy("stratum", "start").agg(
        *[F.avg(z).alias(f"m_{z}") for z in Z], *[F.avg(F.col(a) * F.col(b)).alias(f"c_{a}_{b}") for a, b in PAIRS]
    )
    cov = [(F.col(f"c_{a}_{b}") - F.col(f"m_{a}") * F.col(f"m_{b}")).alias(f"c_{a}_{b}") for a, b in PAIRS]
    return sums.select("stratum", "start", *[f"m_{z}" for z in Z], *cov)


def _floored(cov: DataFrame, scale: float = 1.0) -> DataFrame:
    """Cholesky factors of the covariances times ``scale`` with the floors on their diagonal, and the log determinant."""
    own = [(F.lit(scale) * F.col(f"c_{a}_{b}") + F.lit(FLOORS[a] ** 2 if a == b else 0.0)).alias(f"c_{a}_{b}") for a, b in PAIRS]
    return _factor(cov.select("stratum", "start", *[f"m_{z}" for z in Z], *own))


def _factor(cov: DataFrame) -> DataFrame:
    """Columns l_a_b of the lower Cholesky factor in place of c_a_b; floors on the diagonal keep it positive."""
    for i, a in enumerate(Z):
        for j, b in enumerate(Z[: i + 1]):
            rest = F.col(f"c_{a}_{b}")
            for k in Z[:j]:
                rest = rest - F.col(f"l_{a}_{k}") * F.col(f"l_{b}_{k}")
            root = F.sqrt(F.greatest(rest, F.lit(1e-9))) if a == b else rest / F.col(f"l_{b}_{b}")
            cov = cov.withColumn(f"l_{a}_{b}", root)
    det = sum((F.log(f"l_{z}_{z}") * 2 for z in Z), F.lit(0.0)).alias("log_det")
    return cov.select("stratum", "start", *[f"m_{z}" for z in Z], *[f"l_{a}_{b}" for a, b in PAIRS], det)


def _distances(rows: DataFrame, params: DataFrame, name: str, keys: list[str], few: bool) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance by forward substitution; null where the stratum has no estimate."""
    df = _joined(rows, params, keys, few)
    for i, a in enumerate(Z):
        rest = F.col(a) - F.col(f"m_{a}")
        for b in Z[:i]:
            rest = rest - F.col(f"l_{a}_{b}") * F.col(f"y_{b}")
        df = df.withColumn(f"y_{a}", rest / F.col(f"l_{a}_{a}"))
    return df.select(*rows.columns, sum((F.col(f"y_{z}") * F.col(f"y_{z}") for z in Z), F.lit(0.0)).alias(name))


def _few(groups: DataFrame, rules: Rules) -> bool:
    """Whether a table of a row for each group is small enough to send, by its counted rows."""
    return groups.limit(rules.most_sent + 1).count() <= rules.most_sent


def _strata(rows: DataFrame, rules: Rules) -> tuple[DataFrame, bool]:
    """``rows`` with the column stratum, the finest of source, language and all whose own rows suffice (null if none), and
    whether there are few groups."""
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null"))
    fine = F.concat_ws("\x1f", key("lang"), key("source"))
    sizes = rows.where("not base_failed").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    groups = written(sizes.select(fine.alias("fine"), key("lang").alias("by_lang"), "n"))
    by_source = F.when(F.col("n") >= rules.least_rows, F.concat(F.lit("s"), F.col("fine")))
    rest = groups.where(F.col("n") < rules.least_rows)
    langs = rest.groupBy("by_lang").agg(F.sum("n").alias("n_lang"))
    all_n = langs.where(F.col("n_lang") < rules.least_rows).agg(F.sum("n_lang").alias("n_all"))
    langs = langs.join(F.broadcast(all_n))  # one row
    by_lang = F.when(F.col("n_lang") >= rules.least_rows, F.concat(F.lit("l"), F.col("by_lang"))).when(
        F.col("n_all") >= rules.least_rows, F.lit("a")
    )
    named = written(groups.join(langs, "by_lang", "left").select("fine", F.coalesce(by_source, by_lang).alias("stratum")))
    few = _few(named, rules)
    return _joined(rows.withColumn("fine", fine), named, ["fine"], few).drop("fine"), few


def _starts(rows: DataFrame, few: bool) -> DataFrame:
    """Means and covariances to start from: 0 medians and median deviations, 1 spatial signs, 2 the moments of all rows."""
    middle = written(rows.groupBy("stratum").agg(*[F.percentile_approx(z, 0.5, 10_000).alias(f"m_{z}") for z in Z]))
    off = _joined(rows, middle, ["stratum"], few)
    apart = [F.percentile_approx(F.abs(F.col(z) - F.col(f"m_{z}")), 0.5, 10_000).alias(f"d_{z}") for z in Z]
    spread = written(off.groupBy("stratum").agg(*[F.first(f"m_{z}").alias(f"m_{z}") for z in Z], *apart))
    means, side = [f"m_{z}" for z in Z], lambda z: 1.4826 * F.col(f"d_{z}") + FLOORS[z]
    plain = [(F.pow(side(a), 2) if a == b else F.lit(0.0)).alias(f"c_{a}_{b}") for a, b in PAIRS]
    unit = _joined(rows, spread, ["stratum"], few).select(
        "stratum", *means, *[f"d_{z}" for z in Z], *[((F.col(z) - F.col(f"m_{z}")) / side(z)).alias(z) for z in Z]
    )
    norm = F.greatest(sum((F.col(z) * F.col(z) for z in Z), F.lit(0.0)), F.lit(1e-12))
    signs = unit.groupBy("stratum").agg(
        *[F.first(c).alias(c) for c in (*means, *[f"d_{z}" for z in Z])],
        *[(F.avg(F.col(a) * F.col(b) / norm) * len(Z)).alias(f"c_{a}_{b}") for a, b in PAIRS],
    )
    shaped = [(F.col(f"c_{a}_{b}") * side(a) * side(b)).alias(f"c_{a}_{b}") for a, b in PAIRS]
    start = lambda k: F.lit(k).alias("start")
    first = spread.select("stratum", start(0), *means, *plain)
    return first.union(signs.select("stratum", start(1), *means, *shaped)).union(_moments(rows.withColumn("start", start(2))))


def robust_estimates(rows: DataFrame, rules: Rules, few: bool) -> DataFrame:
    """Mean and Cholesky factor of each stratum of ``rows`` (stratum, z): the least determinant that the starts lead to."""
    rows = written(rows)
    params = written(_floored(_starts(rows, few)))
    thrice = rows.withColumn("start", F.explode(F.array(*[F.lit(k) for k in range(3)])))
    keys = ["stratum", "start"]
    for _ in range(rules.most_steps):
        near = _distances(thrice, params, "d2", keys, few)
        edges = written(near.groupBy(*keys).agg(F.percentile_approx("d2", rules.core, 10_000).alias("edge")))
        core = _joined(near, edges, keys, few, "inner").where(F.col("d2") <= F.col("edge"))
        covs = written(_moments(core))
        now = _floored(covs)
        change = now.select(*keys, F.col("log_det").alias("now")).join(params, keys).agg(F.max(F.abs(F.col("now") - F.col("log_det"))))
        params, change = now, change.first()[0]
        if change is None or change <= rules.settled:
            break
    least = written(params.groupBy("stratum").agg(F.min(F.struct("log_det", "start")).alias("b")).select("stratum", "b.start"))
    best = covs.join(least, keys, "left_semi")
    return written(_floored(best, consistency(rules.core, len(Z))).drop("start", "log_det"))


def _rows(docs: DataFrame, rules: Rules, text: str) -> DataFrame:
    """``docs`` as the struct __doc, with lang, source, the counts, their vector and base_failed."""
    counted = with_statistics(docs, base_statistics, text)
    df = counted.select("__doc", F.col("__doc")["lang"].alias("lang"), F.col("__doc")["source"].alias("source"), "__s.*")
    return df.select("*", *[c.alias(n) for n, c in vector().items()], base_failed(rules).alias("base_failed"))


def _judged(rows: DataFrame, rules: Rules) -> DataFrame:
    """Written ``rows`` with stratum, distance and kept."""
    rows, few = _strata(rows, rules)
    fit = rows.where("not base_failed and stratum is not null").select("stratum", *Z)
    judged = _distances(rows, robust_estimates(fit, rules, few), "distance", ["stratum"], few)
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= rules.cutoff(), F.lit(True))
    return judged.withColumn("kept", kept)


def judge(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with the counts, base_failed, distance (double, null without estimate), judged_by
    (source, language or all; null without estimate) and kept."""
    need(docs, text, "lang", "source")
    rows = _rows(docs, rules, text)
    rows = written(rows.withColumn("__doc", F.struct(*fields(rows, "__doc", text))))
    df = _judged(rows, rules)
    made = [*COUNTS, "base_failed", "distance", "judged_by", "kept"]
    first = F.left("stratum", F.lit(1))
    by = F.when(first == "s", "source").when(first == "l", "language").when(first == "a", "all").alias("judged_by")
    return df.select(*fields(df, "__doc", *made), *[by if c == "judged_by" else F.col(c) for c in made])


def passing(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """``docs`` that are kept, unchanged: written once with their counts, so that texts are counted once."""
    need(docs, text, "lang", "source")
    df = _judged(written(_rows(docs, rules, text)), rules).where("kept")
    return df.select(*fields(df, "__doc"))
