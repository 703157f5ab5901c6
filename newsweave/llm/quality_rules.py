"""Operator 5: quality rules with robust multivariate outliers, built-in functions only.

Every text is reduced to a few statistics (``statistics``). Texts that pass the base rules are
compared with their language and source: a minimum-covariance-determinant estimate of the
transformed statistics is fitted per group by concentration steps from two starts, the one with
the smaller determinant is kept, and a text is rejected when its Mahalanobis distance is large.

A group with fewer than ``min_rows`` texts uses the estimate of its language, or that of the
whole table. Estimates are grouped sums with map-side combine, so a source with a third of the
rows is no hot spot; one row per group is joined back.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Smallest standard deviation that an estimate may give each transformed statistic: most
#: texts have no symbol or repeat at all, so plain estimates would be singular. In a group
#: without repeats, x_line (at most 2.40) and x_repeat (at most 1.39 by the base rules) exceed
#: the cutoff alone from 46 % duplicate lines and 20 % repeated words on.
FLOORS = {"x_word": 0.10, "x_symbol": 0.35, "x_line": 0.40, "x_repeat": 0.25}
#: The 0.999 quantile of chi2_4.
CUTOFF = 18.467
DIMS = list(FLOORS)
#: Share of a group in the concentrated half and the factor that makes its covariance
#: consistent for normal data in four dimensions: 0.75 / P(chi2_6 <= q) with q the 0.75
#: quantile of chi2_4 (5.385).
SHARE = 0.75
_Q = 5.3853
FACTOR = SHARE / (1 - math.exp(-_Q / 2) * (1 + _Q / 2 + (_Q / 2) ** 2 / 2))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: a lambda argument is a bound value."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: Column, width: int = 8) -> Column:
    """Number of words inside windows of ``width`` words that occur twice or more."""
    def windows(w: Column) -> Column:
        return F.when(F.size(w) >= width, F.transform(F.sequence(F.lit(1), F.size(w) - (width - 1)), lambda i: F.xxhash64(F.slice(w, i, width)))).otherwise(F.array().cast("array<bigint>"))

    def count(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        places = _let(ordered, lambda s: F.array_sort(F.transform(
            F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"])))
        covered = _let(places, lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width)))), F.lit(0), lambda a, x: a + x))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), covered).otherwise(F.lit(0))
    return _let(F.transform(words, lambda w: F.xxhash64(w)), lambda w: _let(windows(w), count)).cast("long")


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words and base_failed. A null text counts as an empty one; columns of these
    names are replaced."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # the array is made once in a bound value, all word statistics are read from it
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    found = _let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        repeat_words(w).alias("n_repeat_words")))
    lines = _let(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
                 lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    rest = [c for c in docs.columns if c not in (text_col, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed")]
    d = docs.select(*[docs[c] for c in rest], found.alias("__w"), F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"), lines.alias("__l"))
    d = d.select(*rest, "__w.n_words", "__w.word_chars", "n_symbols", "__l.n_lines", "__l.n_dup_lines", "__w.n_repeat_words")
    return d.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def transformed() -> dict[str, Column]:
    """Statistics on scales where clean texts are close to normal."""
    return {"x_word": F.log(F.col("word_chars") / F.col("n_words")),
            "x_symbol": F.log1p(100.0 * F.col("n_symbols") / F.col("word_chars")),
            "x_line": F.log1p(10.0 * F.col("n_dup_lines") / F.col("n_lines")),
            "x_repeat": F.log1p(10.0 * F.col("n_repeat_words") / F.col("n_words"))}


def _cholesky(cov) -> dict[tuple[int, int], Column]:
    """Columns of the lower Cholesky factor; cov(i, j) gives a column for j <= i."""
    low: dict[tuple[int, int], Column] = {}
    for i in range(len(DIMS)):
        for j in range(i + 1):
            rest = cov(i, j)
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            low[i, j] = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}")
    return low


def _factor(est: DataFrame, cov) -> DataFrame:
    for (i, j), c in _cholesky(cov).items():
        est = est.withColumn(f"l{i}{j}", c)
    det = F.lit(0.0)
    for i in range(len(DIMS)):
        det = det + 2 * F.log(F.col(f"l{i}{i}"))
    return est.withColumn("logdet", det)


_EST = [f"m{i}" for i in range(len(DIMS))] + [f"l{i}{j}" for i in range(len(DIMS)) for j in range(i + 1)]


def distance2(rows: DataFrame) -> DataFrame:
    """Add d2, the squared Mahalanobis distance from the estimate columns of the same row."""
    total = F.lit(0.0)
    for i, c in enumerate(DIMS):
        rest = F.col(c) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"__y{j}")
        rows = rows.withColumn(f"__y{i}", rest / F.col(f"l{i}{i}"))
        total = total + F.col(f"__y{i}") * F.col(f"__y{i}")
    return rows.withColumn("d2", total).drop(*[f"__y{i}" for i in range(len(DIMS))])


def _moments(rows: DataFrame, factor: float) -> DataFrame:
    """Mean and regularised covariance factor per (grp, start)."""
    n = F.count("*").alias("n")
    first = [F.avg(c).alias(f"m{i}") for i, c in enumerate(DIMS)]
    second = [F.covar_pop(a, b).alias(f"c{i}{j}") for i, a in enumerate(DIMS) for j, b in enumerate(DIMS[:i + 1])]
    est = rows.groupBy("grp", "start").agg(n, *first, *second)
    floor = list(FLOORS.values())
    return _factor(est, lambda i, j: F.col(f"c{i}{j}") * factor + (F.lit(floor[i] ** 2) if i == j else F.lit(0.0))).select("grp", "start", "n", "logdet", *_EST)


def _groups(lang: str, source: str) -> Column:
    """The keys of a row's three groups: language and source, language, all."""
    def part(c):
        return [F.col(c).isNull(), F.coalesce(F.col(c).cast("string"), F.lit(""))]
    return F.array(F.xxhash64(F.lit(2), *part(lang), *part(source)), F.xxhash64(F.lit(1), *part(lang)), F.xxhash64(F.lit(0)))


def fit(rows: DataFrame, steps: int = 3) -> DataFrame:
    """Estimates (grp, n, mean, covariance factor) of rows with ``grps`` and DIMS columns."""
    long = cut(rows.select(F.explode("grps").alias("grp"), *DIMS).withColumn("start", F.explode(F.array(F.lit(0), F.lit(1)))))
    middle = long.where("start = 0").groupBy("grp").agg(F.count("*").alias("n"), *[F.percentile_approx(c, 0.5, 2000).alias(f"m{i}") for i, c in enumerate(DIMS)])
    # start 0: coordinate medians with mean absolute deviations; start 1: moments of all rows
    spread = (long.where("start = 0").join(middle.drop("n"), "grp").groupBy("grp")
              .agg(*[F.avg(F.abs(F.col(c) - F.col(f"m{i}"))).alias(f"s{i}") for i, c in enumerate(DIMS)]))
    floor = list(FLOORS.values())
    robust = _factor(middle.join(spread, "grp").withColumn("start", F.lit(0)),
                     lambda i, j: F.greatest(F.col(f"s{i}"), F.lit(floor[i])) ** 2 if i == j else F.lit(0.0)).select("grp", "start", "n", "logdet", *_EST)
    est = cut(robust.unionByName(_moments(long.where("start = 1"), 1.0)))
    for _ in range(steps):
        near = distance2(long.join(est.select("grp", "start", *_EST), ["grp", "start"])).select("grp", "start", *DIMS, "d2")
        limit = near.groupBy("grp", "start").agg(F.percentile_approx("d2", SHARE, 2000).alias("top"), F.count("*").alias("total"))
        inner = near.join(limit, ["grp", "start"]).where("d2 <= top")
        est = cut(_moments(inner, FACTOR).drop("n").join(limit.select("grp", "start", F.col("total").alias("n")), ["grp", "start"]))
    best = est.groupBy("grp").agg(F.min_by("start", F.struct("logdet", "start")).alias("start"))
    return cut(est.join(best, ["grp", "start"]).drop("start", "logdet"))


def judge(docs: DataFrame, cutoff: float = CUTOFF, min_rows: int = 60, lang: str = "lang", source: str = "source", text_col: str = "text") -> DataFrame:
    """Columns of ``docs`` without the text, the statistics, base_failed, d2 and kept.

    kept is false for texts that fail the base rules (d2 is null) and for texts whose squared
    distance exceeds ``cutoff``. A null text counts as empty and fails. Null languages and
    sources form groups of their own. An empty table stays empty; repeated rows get equal
    answers. Columns of the added names are replaced.
    """
    stats = cut(statistics(docs.drop("d2", "kept"), text_col).withColumn("__row", F.monotonically_increasing_id()))
    rest = [c for c in stats.columns if c != "__row"]
    rows = stats.where(~F.col("base_failed")).select("__row", _groups(lang, source).alias("grps"), *[c.alias(k) for k, c in transformed().items()])
    est = fit(rows)
    tried = rows.select("__row", F.posexplode("grps").alias("level", "grp"), *DIMS).join(est, "grp").where((F.col("n") >= min_rows) | (F.col("level") == 2))
    judged = distance2(tried).groupBy("__row").agg(F.min_by("d2", "level").alias("d2"))
    return (stats.join(judged, "__row", "left").select(*rest, "d2")
            .withColumn("kept", F.coalesce(~F.col("base_failed") & (F.col("d2") <= cutoff), F.lit(False))))
