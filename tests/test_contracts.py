import pytest
from pyspark.sql import functions as F

from skyledger import contracts, schemas
from skyledger.operators.gold import to_daily


def test_all_problems_in_one_error(silver):
    spoiled = (
        to_daily(silver)
        .drop("rain_mm", "city")
        .withColumn("humidity", F.lit(1.0))
        .withColumn("snowfall_cm", F.col("snowfall_cm").cast("float"))
    )
    with pytest.raises(ValueError) as error:
        contracts.require_contract(spoiled, schemas.DAILY, "daily")
    assert str(error.value) == (
        "daily breaks its contract (missing: city, rain_mm; unexpected: humidity; "
        "retyped: snowfall_cm is float, not double)"
    )


def test_order_and_nullability_are_not_part_of_a_contract(silver):
    daily = to_daily(silver)
    backwards = daily.select(*reversed(daily.columns))
    nullable = daily.withColumn(
        "weather_severity_score", F.when(F.lit(True), F.col("weather_severity_score"))
    )
    for frame in (backwards, nullable):
        assert contracts.require_contract(frame, schemas.DAILY, "daily") is frame


def test_dictionary(spark):
    dictionary = contracts.data_dictionary(spark).collect()
    assert len(dictionary) == sum(len(s) for s in schemas.LAYERS.values()) == 74
    assert dictionary == sorted(dictionary, key=lambda r: (r.layer, r.position))
    last = ("silver_weather_daily_clean", 20, "ingestion_timestamp", "timestamp", False)
    assert tuple(dictionary[-1]) == last
    assert dictionary[0].position == 1


def test_required_columns(raw):
    assert contracts.require_columns(raw, schemas.RAW.names) is raw
    with pytest.raises(ValueError, match="rain_sum, city"):
        contracts.require_columns(raw.drop("city", "rain_sum"), schemas.RAW.names)


def test_missing_values_include_nan(raw):
    nan = F.when(F.col("time") == "2024-01-01", float("nan")).otherwise(F.col("rain_sum"))
    counts = contracts.missing_counts(raw.withColumn("rain_sum", nan), schemas.RAW.names).first()
    assert counts.time == 1 and counts.city == 1 and counts.latitude == 0
    assert counts.snowfall_sum == 1 and counts.rain_sum == 2


def test_no_missing_values(raw):
    with pytest.raises(ValueError, match=r"time=1, .*city=1"):
        contracts.require_no_missing(raw, schemas.RAW.names)
    whole = raw.na.drop()
    assert contracts.require_no_missing(whole, schemas.RAW.names) is whole
