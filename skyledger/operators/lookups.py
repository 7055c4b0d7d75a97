"""Lookups over the serving tables, with bound parameters.

Parameters are checked before a plan is built, so a bad request starts no job.
Every lookup filters on the columns the serving copy is partitioned and sorted
by (see ``sinks.publish``); on a table without such a column it scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.functions.dates import date_range, iso_text
from skyledger.sinks.publish import CITY_PARTS, PERIOD, PLACE


def camel_case(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(word.capitalize() for word in rest)


def _response(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns in camelCase, dates as YYYY-MM-DD text."""
    return df.select(
        *(
            (iso_text(F.col(n)) if n == "weather_date" else F.col(n)).alias(camel_case(n))
            for n in names
        )
    )


def _require(**parameters) -> None:
    absent = [name for name, value in parameters.items() if value in (None, "")]
    if absent:
        raise ValueError(f"required: {', '.join(absent)}")


def _matching(df: DataFrame, condition: str, args: dict) -> DataFrame:
    return df.sparkSession.sql(f"SELECT * FROM {{df}} WHERE {condition}", args=args, df=df)


def _of_city(df: DataFrame, condition: str = "", **args) -> DataFrame:
    """Rows of a city; in a copy cut by city, from the part that holds it."""
    part = f"AND {PLACE} = pmod(xxhash64(:city), {CITY_PARTS})" if PLACE in df.columns else ""
    return _matching(df, f"city = :city {part} {condition}", args)


def list_cities(daily: DataFrame) -> DataFrame:
    return daily.select("city").distinct().orderBy("city")


def _daily_between(daily: DataFrame, city: str, start: str, end: str) -> DataFrame:
    _require(city=city, start=start, end=end)
    first, last = date_range(start, end)
    pruned = (
        f"AND {PERIOD} BETWEEN trunc(:first, 'month') AND :last" if PERIOD in daily.columns else ""
    )
    return _matching(
        daily,
        f"city = :city AND weather_date BETWEEN :first AND :last {pruned}",
        {"city": city, "first": first, "last": last},
    )


def daily_range(daily: DataFrame, city: str, start: str, end: str) -> DataFrame:
    """Daily metrics of a city from ``start`` to ``end``, both included, by date."""
    rows = _daily_between(daily, city, start, end).orderBy("weather_date")
    return _response(rows, schemas.DAILY.names)


def daily_range_meta(daily: DataFrame, city: str, start: str, end: str) -> DataFrame:
    """The request and how many rows answer it."""
    return _daily_between(daily, city, start, end).agg(
        F.lit(city).alias("city"),
        F.lit(start).alias("from"),
        F.lit(end).alias("to"),
        F.count(F.lit(1)).alias("count"),
    )


def monthly_of_year(monthly: DataFrame, city: str, year: int) -> DataFrame:
    """Monthly summaries of a city in one year, by month."""
    _require(city=city, year=year)
    rows = _of_city(monthly, "AND year = :year", city=city, year=int(year)).orderBy("month")
    return _response(rows, schemas.MONTHLY.names)


def risks_of_city(risk: DataFrame, city: str, risk_type: str | None = None) -> DataFrame:
    """Risk events of a city, of one type or all, by date and type."""
    _require(city=city)
    if risk_type:
        rows = _of_city(risk, "AND risk_type = :risk_type", city=city, risk_type=risk_type)
    else:
        rows = _of_city(risk, city=city)
    return _response(rows.orderBy("weather_date", "risk_type"), schemas.RISK.names)
