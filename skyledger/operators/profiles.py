"""Profiles: the summary queries run after each layer is built.

All are hash aggregates with map-side partials; the sort that follows is over
one row per city, city-year or risk type.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.numbers import round_total
from skyledger.functions.rules import STANDARD, RuleSet
from skyledger.operators.gold import SCORE, _day_counts


def raw_by_city(raw: DataFrame) -> DataFrame:
    """Rows and time span per named city."""
    return (
        raw.filter(F.col("city").isNotNull())
        .groupBy("city")
        .agg(
            F.count("time").alias("rows"),
            F.min("time").alias("min_date"),
            F.max("time").alias("max_date"),
        )
        .orderBy("city")
    )


def _span() -> list:
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.min("weather_date").alias("min_date"),
        F.max("weather_date").alias("max_date"),
    ]


def silver_by_city(silver: DataFrame, rules: RuleSet = STANDARD) -> DataFrame:
    return silver.groupBy("city").agg(*_span(), *_day_counts(rules)).orderBy("city")


def daily_by_city(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("city")
        .agg(*_span(), round_total(F.avg(SCORE)).alias("avg_severity"))
        .orderBy("city")
    )


def monthly_by_year(monthly: DataFrame) -> DataFrame:
    """Yearly roll-up of the monthly table: the average is over months, not days."""
    return (
        monthly.groupBy("city", "year")
        .agg(
            F.count(F.lit(1)).alias("num_months"),
            round_total(F.avg("avg_mean_temp_c")).alias("year_avg_temp"),
            round_total(F.sum("total_precipitation_mm")).alias("year_total_precip"),
        )
        .orderBy("city", "year")
    )


def risk_by_type(risk: DataFrame) -> DataFrame:
    return (
        risk.groupBy("risk_type")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy("risk_type")
    )


def risk_by_city(risk: DataFrame) -> DataFrame:
    """Most events first; cities with equally many in name order."""
    return (
        risk.groupBy("city")
        .agg(F.count(F.lit(1)).alias("total_risks"))
        .orderBy(F.desc("total_risks"), "city")
    )


def duplicate_keys(df: DataFrame, key: Iterable[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset, row_count) for each frame."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("dataset"), "row_count"
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows; with an order, a top-k that never sorts everything."""
    return (df.orderBy(*order) if order else df).limit(n)
