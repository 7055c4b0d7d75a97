"""Raw -> bronze -> silver. Narrow: each layer is one scan, filter and project."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.functions.rules import STANDARD, RuleSet

DEFAULT_SOURCE = "open_meteo"  # fixed value of the source column

# Raw metric -> silver metric (fixed values).
SILVER_METRICS = {
    "temperature_2m_max": "max_temp_c",
    "temperature_2m_min": "min_temp_c",
    "temperature_2m_mean": "mean_temp_c",
    "precipitation_sum": "precipitation_mm",
    "rain_sum": "rain_mm",
    "snowfall_sum": "snowfall_cm",
    "wind_speed_10m_max": "max_wind_speed_kmh",
}


def to_bronze(
    raw: DataFrame, source: str = DEFAULT_SOURCE, ingested_at: Column | None = None
) -> DataFrame:
    """Raw rows untouched, plus where they came from and when (default: now)."""
    when = F.current_timestamp() if ingested_at is None else ingested_at
    return raw.withColumns({"source": F.lit(source), "ingestion_timestamp": when})


def to_silver(
    bronze: DataFrame, on_bad_date: str = "fail", rules: RuleSet = STANDARD
) -> DataFrame:
    """Typed, renamed and flagged rows; rows without city or time are dropped.

    A malformed ``time`` fails the job (ANSI mode, Spark's default) or, with
    ``on_bad_date="null"``, gives a null date for the quality checks to find.
    Duplicates of a city and date are kept: the quality checks report them.
    """
    if on_bad_date not in ("fail", "null"):
        raise ValueError(f"on_bad_date must be 'fail' or 'null', not {on_bad_date!r}")
    time = F.col("time")
    date = F.to_date(time) if on_bad_date == "fail" else time.try_cast("date")
    extra = [name for name in rules.flags if name not in schemas.SILVER.names]
    dated = (
        bronze.filter(F.col("city").isNotNull() & time.isNotNull())
        .withColumnsRenamed(SILVER_METRICS)
        .withColumn("weather_date", date)
    )
    derived = {
        "year": F.year("weather_date"),
        "month": F.month("weather_date"),
        "day_of_week": F.dayofweek("weather_date"),
        "temperature_range_c": F.round(F.col("max_temp_c") - F.col("min_temp_c"), 2),
    }
    return rules.with_flags(dated.withColumns(derived)).select(*schemas.SILVER.names, *extra)
