import pytest
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.operators.gold import to_daily, to_monthly
from skyledger.sinks import tables


def test_ensure_creates_empty_and_keeps_rows(spark, wh, silver):
    created = tables.ensure_table(spark, wh, schemas.DAILY_NAME, schemas.DAILY)
    assert created.count() == 0
    tables.write_layer(to_daily(silver), wh, schemas.DAILY_NAME)
    assert tables.ensure_table(spark, wh, schemas.DAILY_NAME, schemas.DAILY).count() == 6


def test_ensure_checks_what_is_there(spark, wh, silver):
    tables.overwrite_table(to_monthly(silver), wh, schemas.DAILY_NAME)
    with pytest.raises(ValueError, match="missing: is_freezing_day"):
        tables.ensure_table(spark, wh, schemas.DAILY_NAME, schemas.DAILY)


def test_ensure_layers(spark, wh):
    tables.ensure_layers(spark, wh)
    for name, schema in schemas.TABLES.items():
        stored = spark.table(wh.name(name))
        assert stored.columns == schema.names and not stored.count()


def test_overwrite_replaces_rows_and_schema(spark, wh, silver, raw, rows):
    name = schemas.MONTHLY_NAME
    tables.overwrite_table(raw, wh, name)
    monthly = to_monthly(silver)
    for _ in range(2):
        stored = tables.write_layer(monthly, wh, name)
        assert rows(stored) == rows(monthly) and stored.columns == monthly.columns


def test_write_refuses_a_broken_contract(wh, silver, spark):
    with pytest.raises(ValueError, match="breaks its contract"):
        tables.write_layer(silver, wh, schemas.DAILY_NAME)
    assert not tables.table_exists(spark, wh.name(schemas.DAILY_NAME))


def test_namespace_is_created_in_its_folder(spark, wh):
    tables.create_namespace(spark, wh)
    assert spark.catalog.databaseExists(wh.namespace)
    assert spark.catalog.getDatabase(wh.namespace).locationUri.endswith(wh.location)


def test_a_failed_overwrite_leaves_the_table_as_it_was(spark, wh, silver, rows):
    stored = tables.write_layer(to_daily(silver), wh, schemas.DAILY_NAME)
    before = rows(stored)
    fails = to_daily(silver).withColumn("city", F.raise_error(F.lit("bad row")).cast("string"))
    with pytest.raises(Exception, match="bad row"):
        tables.write_layer(fails, wh, schemas.DAILY_NAME)
    assert rows(spark.table(wh.name(schemas.DAILY_NAME))) == before


def test_old_versions_go(spark, wh, silver):
    for _ in range(4):
        tables.write_layer(to_daily(silver), wh, schemas.DAILY_NAME)
    versions = spark.catalog.listTables(wh.namespace, f"{schemas.DAILY_NAME}__v*")
    assert len(versions) == wh.keep == 2


def test_tables_of_others_are_not_versions(spark, wh, silver):
    spark.range(7).write.saveAsTable(wh.name("t__v0_backup"))
    spark.range(3).write.saveAsTable(wh.name("t__v1"))  # named like one, but not marked
    for _ in range(4):
        tables.overwrite_table(silver, wh, "t")
    assert spark.table(wh.name("t__v0_backup")).count() == 7
    assert spark.table(wh.name("t__v1")).count() == 3


def test_a_slow_writer_is_seen_and_stays(spark, wh):
    slow = tables._write_version(spark.range(1), wh, "t")
    for n in (2, 3):
        tables.overwrite_table(spark.range(n), wh, "t")
    tables._show(spark, wh, "t", slow, "CREATE OR REPLACE VIEW")
    tables._retire(spark, wh, "t")
    assert spark.table(wh.name("t")).count() == 1
    assert tables.overwrite_table(spark.range(4), wh, "t").count() == 4


def test_ensure_keeps_a_table_filled_meanwhile(spark, wh, silver, monkeypatch):
    name = schemas.DAILY_NAME
    monkeypatch.setattr(tables, "table_exists", lambda *_: False)
    monkeypatch.setattr(tables, "current_version", lambda *_: "another")
    tables.overwrite_table(to_daily(silver), wh, name)
    assert tables.ensure_table(spark, wh, name, schemas.DAILY).count() == 6
    assert len(spark.catalog.listTables(wh.namespace, f"{name}__v*")) == 1


def test_a_plain_table_is_refused_before_writing(spark, wh, silver):
    spark.range(5).write.saveAsTable(wh.name("plain"))
    with pytest.raises(ValueError, match="is a table"):
        tables.overwrite_table(silver, wh, "plain")
    assert spark.table(wh.name("plain")).count() == 5
    assert not spark.catalog.listTables(wh.namespace, "plain__v*")


def test_a_failed_switch_leaves_no_version(spark, wh, monkeypatch):
    tables.overwrite_table(spark.range(2), wh, "t")
    monkeypatch.setattr(tables, "_REPLACE", "CREATE NOTHING")
    with pytest.raises(Exception, match="PARSE"):
        tables.overwrite_table(spark.range(3), wh, "t")
    assert spark.table(wh.name("t")).count() == 2
    assert len(spark.catalog.listTables(wh.namespace, "t__v*")) == 1


def test_versions_stay_for_as_long_as_asked(spark, wh):
    long = tables.Warehouse(wh.namespace, wh.location, retain_seconds=3600)
    for n in range(4):
        tables.overwrite_table(spark.range(n), long, "t")
    assert len(spark.catalog.listTables(wh.namespace, "t__v*")) == 4
    with pytest.raises(ValueError, match="keep"):
        tables.Warehouse(keep=0)
