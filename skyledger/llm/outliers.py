"""Quality rules: robust multivariate outliers per language and source.

Everything here is DataFrame and SQL functions. Each text gives statistics, and
these a vector of five transformed ones. Per group (language and source, nulls
included) location and scatter are estimated by minimum covariance determinant:
from medians and median deviations, concentration steps keep the ``SUPPORT`` share
of the vectors nearest to the estimate and take mean and covariance anew from
these. Scatter is scaled up where the median squared distance exceeds that of a
normal distribution. A text whose squared Mahalanobis distance exceeds ``CUTOFF`` is
rejected.

A group with fewer than ``LEAST_ROWS`` texts that pass the base rules is pooled
with the other small ones; if all of these are too few, none of them is rejected.
Texts that fail the base rules are not used for the estimates.

Null and empty texts have no words and fail the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import stored

WHITE = "[\\x20\\x09-\\x0D]+"
RUN = 8
STEPS, SUPPORT, LEAST_ROWS = 4, 0.75, 50
# The median and the 1 - 1e-6 quantile of chi-squared with five degrees of freedom.
MEDIAN, CUTOFF = 4.3515, 35.89
# The transformed statistics, each with the variance that is added to its scatter: a
# statistic that hardly varies in a group must not reject by its smallest steps.
RIDGE = {"length": 0.5, "word_length": 0.02, "symbols": 0.01, "dup_lines": 0.01, "repeats": 0.02}
VECTOR = tuple(RIDGE)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Windows of ``RUN`` words are compared by 64-bit hashes within their text. The
    hashes are sorted with their positions only in texts where one occurs twice; the
    words covered follow from the distances between the starts of those windows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, WHITE), "")
    has_word = lambda line: line.rlike("[^\\x20\\x09-\\x0D]")
    one = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        words.alias("_words"),
        F.filter(F.split(text, "\n"), has_word).alias("_lines"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).alias("n_symbols"),
    )
    two = one.select(
        "doc_id",
        "lang",
        "source",
        "n_symbols",
        F.size("_words").alias("n_words"),
        F.length(F.array_join("_words", "")).alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    starts = F.when(F.col("n_words") >= RUN, F.sequence(F.lit(1), F.col("n_words") - RUN + 1))
    windows = F.transform(starts, lambda i: F.xxhash64(F.slice("_hashes", i, RUN)))
    three = two.withColumn("_windows", windows).drop("_hashes")
    several = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.when(
        several,
        F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    four = three.withColumn("_placed", placed).drop("_windows")
    # Sorted pairs beside their neighbours: equal hashes lie next to one another.
    n = F.size("_placed")
    shifted = lambda by: F.slice("_placed", by, n - 1)
    beside = F.zip_with(
        shifted(1), shifted(2), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))
    )
    found = F.array_sort(F.array_distinct(F.flatten(F.filter(beside, lambda p: p.isNotNull()))))
    five = four.withColumn("_starts", F.when(F.col("_placed").isNotNull(), found)).drop("_placed")
    m = F.size("_starts")
    steps = F.zip_with(
        F.slice("_starts", 1, m - 1),
        F.slice("_starts", 2, m - 1),
        lambda a, b: F.least(b - a, F.lit(RUN)),
    )
    covered = F.aggregate(steps, F.lit(RUN), lambda total, x: total + x)
    return five.select(
        "doc_id",
        "lang",
        "source",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.col("word_chars").cast("bigint").alias("word_chars"),
        F.col("n_symbols").cast("bigint").alias("n_symbols"),
        F.col("n_dup_lines").cast("bigint").alias("n_dup_lines"),
        F.coalesce(F.when(m > 0, covered), F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    few = F.col("n_words") < 20
    return few | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def vectors(stats: DataFrame) -> DataFrame:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return stats.withColumns(
        {
            "length": F.log1p("n_words"),
            "word_length": F.log((F.col("word_chars") + 1) / words),
            "symbols": F.sqrt(F.col("n_symbols") / words),
            "dup_lines": F.sqrt(F.col("n_dup_lines") / words),
            "repeats": F.sqrt(F.col("n_repeat_words") / words),
        }
    )


def _covariances() -> list[Column]:
    """Mean and covariance, the latter with its ridge."""
    out = [F.avg(x).alias(f"m_{x}") for x in VECTOR]
    for i, x in enumerate(VECTOR):
        for y in VECTOR[: i + 1]:
            ridge = RIDGE[x] if x == y else 0.0
            out.append((F.covar_pop(x, y) + ridge).alias(f"c_{x}_{y}"))
    return out


def _factored(estimates: DataFrame) -> DataFrame:
    """The Cholesky factor of each group's covariance, column by column."""
    for j, y in enumerate(VECTOR):
        rest = [F.col(f"l_{y}_{z}") * F.col(f"l_{y}_{z}") for z in VECTOR[:j]]
        left = sum(rest, F.lit(0.0))
        diagonal = F.sqrt(F.greatest(F.col(f"c_{y}_{y}") - left, F.lit(RIDGE[y] / 10)))
        estimates = estimates.withColumn(f"l_{y}_{y}", diagonal)
        below = {}
        for x in VECTOR[j + 1 :]:
            left = sum((F.col(f"l_{x}_{z}") * F.col(f"l_{y}_{z}") for z in VECTOR[:j]), F.lit(0.0))
            below[f"l_{x}_{y}"] = (F.col(f"c_{x}_{y}") - left) / F.col(f"l_{y}_{y}")
        estimates = estimates.withColumns(below) if below else estimates
    return estimates.select(
        "_group",
        *(f"m_{x}" for x in VECTOR),
        *(f"l_{x}_{y}" for i, x in enumerate(VECTOR) for y in VECTOR[: i + 1]),
    )


def _measured(rows: DataFrame, factors: DataFrame) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance, by forward substitution."""
    out = rows.join(factors, "_group", "left")
    for i, x in enumerate(VECTOR):
        left = sum((F.col(f"l_{x}_{y}") * F.col(f"_z{j}") for j, y in enumerate(VECTOR[:i])), F.lit(0.0))
        out = out.withColumn(f"_z{i}", (F.col(x) - F.col(f"m_{x}") - left) / F.col(f"l_{x}_{x}"))
    distance = sum((F.col(f"_z{i}") * F.col(f"_z{i}") for i in range(len(VECTOR))), F.lit(0.0))
    return out.withColumn("_distance", distance).select(*rows.columns, "_distance")


def _median(x) -> Column:
    return F.percentile_approx(x, 0.5, 10_000)


def _start(rows: DataFrame) -> DataFrame:
    """Medians and median deviations per group, as a diagonal covariance."""
    middle = rows.groupBy("_group").agg(*(_median(x).alias(f"m_{x}") for x in VECTOR))
    off = rows.join(middle, "_group")
    spread = off.groupBy("_group").agg(
        *(F.first(f"m_{x}").alias(f"m_{x}") for x in VECTOR),
        *(_median(F.abs(F.col(x) - F.col(f"m_{x}"))).alias(f"d_{x}") for x in VECTOR),
    )
    columns = {}
    for i, x in enumerate(VECTOR):
        for y in VECTOR[: i + 1]:
            own = F.pow(1.4826 * F.col(f"d_{x}"), 2) + RIDGE[x]
            columns[f"c_{x}_{y}"] = own if x == y else F.lit(0.0)
    return _factored(spread.withColumns(columns))


def minimum_covariance(rows: DataFrame) -> DataFrame:
    """Per ``_group``: means, Cholesky factor, and the scale of the squared distances."""
    factors = stored(_start(rows), "scatter")
    for _ in range(STEPS):
        near = _measured(rows, factors)
        reach = near.groupBy("_group").agg(
            F.percentile_approx("_distance", SUPPORT, 10_000).alias("_reach")
        )
        support = near.join(reach, "_group").filter("_distance <= _reach")
        factors = stored(_factored(support.groupBy("_group").agg(*_covariances())), "scatter")
    scale = _measured(rows, factors).groupBy("_group").agg(
        F.greatest(_median("_distance") / MEDIAN, F.lit(1.0)).alias("_scale")
    )
    return factors.join(scale, "_group")


def judged(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Per row of ``docs``: the statistics, base_failed, distance, kept."""
    stats = stored(vectors(statistics(docs)).withColumn("base_failed", base_failed()), "statistics")
    passed = stats.filter("NOT base_failed")
    sizes = passed.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("_n"))
    group = F.when(F.col("_n") >= LEAST_ROWS, F.to_json(F.struct("lang", "source"))).otherwise("")
    groups = stored(
        sizes.select(
            F.col("lang").alias("_lang"), F.col("source").alias("_source"), group.alias("_group"), "_n"
        ),
        "groups",
    )
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    placed = stored(
        passed.join(groups.drop("_n"), same).select("_group", *VECTOR, "doc_id"), "vectors"
    )
    enough = groups.groupBy("_group").agg(F.sum("_n").alias("_n")).filter(F.col("_n") >= LEAST_ROWS)
    factors = minimum_covariance(placed).join(enough.select("_group"), "_group", "left_semi")
    factors = stored(factors, "estimates")
    named = stats.join(groups.drop("_n"), same, "left").drop("_lang", "_source")
    measured = _measured(named, factors.drop("_scale")).join(
        factors.select("_group", "_scale"), "_group", "left"
    )
    distance = F.col("_distance") / F.col("_scale")
    inside = F.coalesce(distance <= cutoff, F.lit(True))
    return measured.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.when(~F.col("base_failed"), distance).alias("distance"),
        (~F.col("base_failed") & inside).alias("kept"),
    )
