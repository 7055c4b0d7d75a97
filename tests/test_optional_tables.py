"""Yearly table and creation time of risks as stored, checked and published tables."""

import pytest

from skyledger import schemas
from skyledger.contracts import layer_contracts, missing_counts
from skyledger.functions.rules import STANDARD, WINDY
from skyledger.operators.gold import to_daily, to_risk, to_yearly
from skyledger.operators.layers import to_bronze, to_silver
from skyledger.plans import batch
from skyledger.plans.registry import observed_layers
from skyledger.sinks import tables

Y, R = schemas.YEARLY_NAME, schemas.RISK_NAME


def test_contracts_of_optional_tables():
    assert Y not in layer_contracts(STANDARD)
    windy = layer_contracts(WINDY, yearly=True, created_at=True)
    assert windy[Y]["windy_days"].dataType.simpleString() == "bigint"
    assert windy[R].names == [*schemas.RISK.names, "created_at"]
    assert "created_at" not in schemas.RISK.names


def test_yearly_is_stored_checked_and_published(spark, raw, wh, rows):
    verdict = batch.run(raw, wh, rules=WINDY, yearly=True, publish_tables=(Y,))
    assert verdict.summary() == "13/13 checks passed"
    silver = spark.table(wh.name(schemas.SILVER_NAME))
    served = spark.table(wh.name("weather_yearly_summary"))
    columns = [*schemas.YEARLY.names, "windy_days"]
    assert rows(served, *columns) == rows(to_yearly(silver, WINDY), *columns)
    for _ in range(3):
        batch.build_layers(raw, wh, yearly=True)
    assert len(spark.catalog.listTables(wh.namespace, f"{Y}__v*")) == wh.keep


def test_broken_yearly_tables_are_found_and_not_published(spark, raw, wh):
    batch.build_layers(raw, wh, yearly=True)
    yearly = to_yearly(spark.table(wh.name(schemas.SILVER_NAME)))
    for broken, rule in (
        (yearly.unionAll(yearly), "unique key"),
        (yearly.limit(0), "not empty"),
        (yearly.drop("hot_days"), "schema"),
    ):
        tables.overwrite_table(broken, wh, Y)
        verdict = batch.check_layers(spark, wh, yearly=True)
        assert [r.rule for r in verdict.failures] == [rule]
        assert not batch.publish_if_passed(spark, wh, (Y,))


def test_a_yearly_table_no_check_was_about_is_not_published(spark, raw, wh):
    batch.build_layers(raw, wh, yearly=True)
    assert batch.check_layers(spark, wh).dq_passed
    assert not batch.publish_if_passed(spark, wh, (Y,))
    assert batch.check_layers(spark, wh, yearly=True).dq_passed
    assert batch.publish_if_passed(spark, wh, (Y,))


def test_empty_input_fails_the_yearly_checks(raw, wh):
    with pytest.raises(RuntimeError, match=f"{Y} not empty: 0 rows"):
        batch.run(raw.limit(0), wh, yearly=True)


def test_creation_time_is_stored_and_published(spark, raw, wh, rows):
    batch.run(raw, wh, created_at=True, publish_tables=(R,))
    served = spark.table(wh.name("weather_risk_days"))
    assert rows(served, *schemas.RISK.names) == rows(
        to_risk(spark.table(wh.name(schemas.SILVER_NAME)))
    )
    first = {r.created_at for r in served.collect()}
    assert len(first) == 1 and None not in first
    assert {r.created_at for r in spark.table(wh.name(R)).collect()} == first  # not made anew
    assert not batch.check_layers(spark, wh).dq_passed  # without the option it is one too many
    assert batch.check_layers(spark, wh, created_at=True).dq_passed


def test_one_scan_counts_the_narrow_layers(spark, raw, tmp_path):
    raw.write.parquet(str(tmp_path / "raw"))
    stored = spark.read.schema(schemas.RAW).parquet(str(tmp_path / "raw"))
    risk, counted = observed_layers(stored)
    plan = risk._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert plan.count("CollectMetrics") == len(counted) == 5
    risk.write.format("noop").mode("overwrite").save()
    bronze = to_bronze(stored)
    silver = to_silver(bronze)
    frames = {
        schemas.RAW_NAME: stored,
        schemas.BRONZE_NAME: bronze,
        schemas.SILVER_NAME: silver,
        schemas.DAILY_NAME: to_daily(silver),
        schemas.RISK_NAME: to_risk(silver),
    }
    for layer, df in frames.items():
        assert counted[layer].get == missing_counts(df, df.columns).first().asDict()
