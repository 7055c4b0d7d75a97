"""Silver -> gold: daily metrics, monthly (and yearly) summaries, risk events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.functions.numbers import round_total
from skyledger.functions.rules import STANDARD, RuleSet, day_count

SCORE = "weather_severity_score"


def to_daily(
    silver: DataFrame, rules: RuleSet = STANDARD, carry: Sequence[str] = ()
) -> DataFrame:
    """One row per silver row, with its severity score. No shuffle.

    ``carry`` names silver columns to keep beside the contract's.
    """
    kept = [name for name in schemas.DAILY.names if name != SCORE]
    extra = [name for name in rules.flags if name not in kept]
    return silver.select(*kept, *extra, *carry, rules.severity_score().alias(SCORE))


def _day_counts(rules: RuleSet) -> list:
    """is_<kind>_day -> <kind>_days, how many days have the flag set."""
    return [F.count_if(F.col(flag)).alias(day_count(flag)) for flag in rules.flags]


def _summary(silver: DataFrame, keys: tuple[str, ...], rules: RuleSet) -> DataFrame:
    # Partial aggregation runs before the exchange, so a city that holds a large
    # share of all days sends one row per group and map task, not its days.
    return silver.groupBy(*keys).agg(
        round_total(F.avg("mean_temp_c")).alias("avg_mean_temp_c"),
        F.max("max_temp_c").alias("max_temp_c"),
        F.min("min_temp_c").alias("min_temp_c"),
        round_total(F.sum("precipitation_mm")).alias("total_precipitation_mm"),
        *_day_counts(rules),
        round_total(F.avg("max_wind_speed_kmh")).alias("avg_wind_speed_kmh"),
    )


def to_monthly(silver: DataFrame, rules: RuleSet = STANDARD) -> DataFrame:
    """City, year and month summary.

    Not sorted: order is not a property of a stored table, and a global sort
    costs one more exchange. Sort where the rows are read (:func:`by_key`).
    """
    return _summary(silver, schemas.MONTHLY_KEY, rules)


def to_yearly(silver: DataFrame, rules: RuleSet = STANDARD) -> DataFrame:
    """City and year summary over days (not over monthly averages)."""
    return _summary(silver, ("city", "year"), rules)


def to_risk(silver: DataFrame, rules: RuleSet = STANDARD) -> DataFrame:
    """One row per city, date and risk raised. One scan, no shuffle."""
    return rules.risk_events(silver, ("city", "weather_date"))


def with_created_at(risk: DataFrame) -> DataFrame:
    """Risks with the time of the job that writes them, one for all rows."""
    return risk.withColumn(schemas.CREATED_AT, F.current_timestamp())


def by_key(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    return df.orderBy(*key)
