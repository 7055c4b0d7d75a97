"""What the physical plans must look like, whatever the size of the data."""

import pytest

from skyledger import schemas
from skyledger.operators import lookups, profiles
from skyledger.operators.gold import by_key, to_daily, to_monthly, to_risk
from skyledger.operators.layers import to_bronze, to_silver
from skyledger.plans.registry import CITY, FROM, QUERIES, TO
from skyledger.sinks import tables
from skyledger.sinks.publish import PERIOD, publish
from skyledger.sources.shipments import raw_observations

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    from skyledger.session import scratch_path

    place = scratch_path(spark, "warehouse")
    wh = tables.Warehouse("plans_" + place.rsplit("-", 1)[1], place)
    tables.create_namespace(spark, wh)
    silver = to_silver(to_bronze(raw_observations(spark, SF)))
    silver = tables.write_layer(silver, wh, schemas.SILVER_NAME)
    tables.write_layer(to_daily(silver), wh, schemas.DAILY_NAME)
    return wh


@pytest.fixture
def silver_table(spark, stored):
    return spark.table(stored.name(schemas.SILVER_NAME))


def test_narrow_layers_do_not_shuffle(raw, silver_table):
    for df in (to_silver(to_bronze(raw)), to_daily(silver_table), to_risk(silver_table)):
        assert "Exchange" not in plan(df)


def test_no_python_and_no_cross_join_anywhere(spark):
    for name in ("gold_daily", "gold_monthly", "gold_risk", "json_flatten", "dry_day_risk"):
        text = plan(QUERIES[name](spark, SF))
        assert not any(word in text for word in ("Python", "Cartesian", "NestedLoop")), name


def test_risk_scans_silver_once_with_its_filter_pushed(silver_table):
    text = plan(to_risk(silver_table))
    assert text.count("FileScan") == 1
    assert "GreaterThanOrEqual(max_temp_c,35.0)" in text
    assert "temperature_range_c" not in text.split("ReadSchema")[1]


def test_monthly_aggregates_before_its_only_exchange(silver_table):
    text = plan(to_monthly(silver_table))
    assert text.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in text
    assert text.count("HashAggregate") == 2
    assert "rangepartitioning" in plan(by_key(to_monthly(silver_table), schemas.MONTHLY_KEY))


def test_profiles_read_the_columns_they_need(spark, stored):
    text = plan(profiles.daily_by_city(spark.table(stored.name(schemas.DAILY_NAME))))
    assert "ReadSchema: struct<city:string,weather_date:date,weather_severity_score:int>" in text


def test_preview_is_a_top_k(spark, stored):
    daily = spark.table(stored.name(schemas.DAILY_NAME))
    assert "TakeOrderedAndProject" in plan(profiles.preview(daily, 5, *schemas.DAILY_KEY))


def test_lookup_prunes_months_and_row_groups(spark, stored):
    served = publish(spark, stored)[schemas.SERVING[schemas.DAILY_NAME][0]]
    found = lookups.daily_range(served, CITY, FROM, TO)
    text = plan(found)
    assert f"{PERIOD}" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert f"EqualTo(city,{CITY})" in text
    assert "GreaterThanOrEqual(weather_date,1997-03-01)" in text
