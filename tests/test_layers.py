from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.contracts import contract_problems
from skyledger.operators.gold import by_key, to_daily, to_monthly, to_risk, to_yearly
from skyledger.operators.layers import to_bronze, to_silver


def jan(day):
    return date(2024, 1, day)


def test_bronze_keeps_rows_and_adds_audit_columns(raw):
    bronze = to_bronze(raw)
    assert bronze.count() == 8
    assert not contract_problems(bronze.schema, schemas.BRONZE)
    assert bronze.select("source").distinct().collect() == [("open_meteo",)]
    assert bronze.select("ingestion_timestamp").distinct().count() == 1


def test_silver_flags_on_the_thresholds(silver, rows):
    assert silver.columns == schemas.SILVER.names
    columns = (
        "weather_date",
        "is_rainy_day",
        "is_hot_day",
        "is_freezing_day",
        "day_of_week",
        "temperature_range_c",
    )
    assert rows(silver, *columns) == [
        (jan(1), False, False, False, 2, 29.98),
        (jan(2), True, True, True, 3, 30.0),
        (jan(3), True, True, False, 4, 15.0),
        (jan(4), True, True, True, 5, 50.0),
        (jan(5), None, None, None, 6, None),
        (date(2024, 2, 29), False, False, False, 5, 4.44),
    ]


def test_daily_severity(silver, rows):
    daily = to_daily(silver)
    assert daily.columns == schemas.DAILY.names
    assert not daily.schema["weather_severity_score"].nullable
    scores = rows(daily, "weather_date", "weather_severity_score")
    assert [score for _, score in scores] == [0, 4, 2, 4, 0, 0]


def test_monthly(silver, rows):
    monthly = to_monthly(silver)
    assert not contract_problems(monthly.schema, schemas.MONTHLY)
    assert [tuple(r) for r in by_key(monthly, schemas.MONTHLY_KEY).collect()] == [
        ("Austin", 2024, 1, 18.13, 40.0, -10.0, 72.01, 3, 3, 2, 37.5),
        ("New York", 2024, 2, 3.33, 5.555, 1.111, 0.0, 0, 0, 0, 12.34),
    ]
    assert rows(to_yearly(silver), "city", "year", "avg_mean_temp_c", "rainy_days") == [
        ("Austin", 2024, 18.13, 3),
        ("New York", 2024, 3.33, 0),
    ]


def test_risk_events(silver, rows):
    risk = to_risk(silver)
    assert not contract_problems(risk.schema, schemas.RISK)
    assert rows(risk) == [
        ("Austin", jan(1), "STRONG_WIND", "MEDIUM", 40.0, "Wind speed >= 40 km/h"),
        ("Austin", jan(2), "FREEZING", "MEDIUM", 0.0, "Min temp <= 0 C"),
        ("Austin", jan(2), "STRONG_WIND", "MEDIUM", 40.01, "Wind speed >= 40 km/h"),
        ("Austin", jan(3), "HEAVY_RAIN", "MEDIUM", 20.0, "Precipitation >= 20 mm"),
        ("Austin", jan(3), "HOT_DAY", "MEDIUM", 35.0, "Max temp >= 35 C"),
        ("Austin", jan(4), "FREEZING", "HIGH", -10.0, "Min temp <= 0 C"),
        ("Austin", jan(4), "HEAVY_RAIN", "HIGH", 50.0, "Precipitation >= 20 mm"),
        ("Austin", jan(4), "HOT_DAY", "HIGH", 40.0, "Max temp >= 35 C"),
        ("Austin", jan(4), "STRONG_WIND", "HIGH", 60.0, "Wind speed >= 40 km/h"),
    ]


def test_nan_sorts_above_every_number(raw):
    nan = F.lit(float("nan"))
    spoiled = raw.filter("time = '2024-01-03'").withColumns(
        {"wind_speed_10m_max": nan, "temperature_2m_max": nan}
    )
    silver = to_silver(to_bronze(spoiled))
    assert to_daily(silver).first().weather_severity_score == 3
    levels = {r.risk_type: r.risk_level for r in to_risk(silver).collect()}
    assert levels == {"STRONG_WIND": "HIGH", "HOT_DAY": "HIGH", "HEAVY_RAIN": "MEDIUM"}
    monthly = to_monthly(silver).first()
    assert monthly.max_temp_c != monthly.max_temp_c  # NaN
    assert monthly.avg_wind_speed_kmh != monthly.avg_wind_speed_kmh


def test_bad_date_fails_or_becomes_null(raw):
    bronze = to_bronze(raw.limit(1).withColumn("time", F.lit("bad")))
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        to_silver(bronze).collect()
    assert to_silver(bronze, on_bad_date="null").first().weather_date is None
    with pytest.raises(ValueError):
        to_silver(bronze, on_bad_date="drop")


def test_silver_keeps_duplicates(raw):
    assert to_silver(to_bronze(raw.unionByName(raw))).count() == 12


def test_rounding_does_not_depend_on_summation_order(spark):
    from skyledger.functions.numbers import round_total

    tie = spark.createDataFrame([(14.925,), (14.924999999999997,), (2.675,)], "x double")
    assert [r[0] for r in tie.select(round_total(F.col("x"))).collect()] == [14.93, 14.93, 2.68]
