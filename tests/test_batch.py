from pathlib import Path

import pytest

from skyledger import schemas
from skyledger.plans import batch
from skyledger.sinks import tables
from skyledger.sources import payloads
from skyledger.sources.csv import read_raw
from skyledger.sources.shipments import as_documents

SERVED = schemas.SERVING[schemas.DAILY_NAME][0]


def test_run_builds_checks_and_publishes(spark, raw, wh, rows):
    verdict = batch.run(raw, wh)
    assert verdict.summary() == "10/10 checks passed"
    counts = {name: spark.table(wh.name(name)).count() for name in schemas.TABLES}
    assert list(counts.values()) == [8, 6, 6, 2, 9]
    assert rows(spark.table(wh.name(SERVED)), *schemas.DAILY.names) == rows(
        spark.table(wh.name(schemas.DAILY_NAME))
    )
    assert spark.table(wh.name(batch.RESULTS_NAME)).count() == 10


def test_second_run_gives_the_same_gold(spark, raw, wh, rows):
    gold = list(schemas.SERVING)
    batch.run(raw, wh)
    first = [rows(spark.table(wh.name(name))) for name in gold]
    batch.run(raw, wh)
    assert [rows(spark.table(wh.name(name))) for name in gold] == first


def test_failed_check_keeps_verdict_and_served_snapshot(spark, raw, wh, rows):
    batch.run(raw, wh)
    served = rows(spark.table(wh.name(SERVED)))
    doubled = payloads.concat(raw, raw.filter("city = 'New York'"))
    with pytest.raises(RuntimeError, match="9/10 checks passed.*1 repeated keys"):
        batch.run(doubled, wh)
    verdict = spark.table(wh.name(batch.VERDICT_NAME)).first()
    assert tuple(verdict) == (False, 9, 10)
    assert rows(spark.table(wh.name(SERVED))) == served


def test_gate_refuses_after_a_bad_verdict(spark, raw, wh):
    with pytest.raises(RuntimeError):
        batch.run(payloads.concat(raw, raw), wh)
    assert not batch.publish_if_passed(spark, wh)
    assert not tables.table_exists(spark, wh.name(SERVED))


def test_gate_refuses_layers_built_since_the_check(spark, raw, wh, rows):
    batch.run(raw, wh)
    served = rows(spark.table(wh.name(SERVED)))
    batch.build_layers(raw.limit(0), wh)
    assert not batch.publish_if_passed(spark, wh)
    assert rows(spark.table(wh.name(SERVED))) == served
    batch.build_layers(raw, wh)
    batch.check_layers(spark, wh)
    assert batch.publish_if_passed(spark, wh)


def test_bad_dates_can_reach_the_checks(spark, raw, wh):
    spoiled = raw.replace({"2024-02-29": "2024-02-30"}, subset="time")
    with pytest.raises(RuntimeError, match="1 rows without weather_date"):
        batch.run(spoiled, wh, on_bad_date="null")


CITIES = [("Austin", 30.2672, -97.7431), ("New York", 40.7128, -74.006)]


def test_payloads_become_csv_files(spark, raw, rows, tmp_path):
    path = str(tmp_path / "raw")
    whole = raw.na.drop()
    profile = batch.export_raw(
        as_documents(whole), payloads.city_dimension(spark, CITIES), path
    )
    assert [(r.city, r.rows) for r in profile.collect()] == [("Austin", 4), ("New York", 1)]
    assert rows(read_raw(spark, path)) == rows(whole)


def test_payloads_with_missing_values_are_not_written(spark, raw, tmp_path):
    path = tmp_path / "raw"
    documents = as_documents(raw.filter("city IS NOT NULL AND time IS NOT NULL"))
    with pytest.raises(ValueError, match="temperature_2m_max=1"):
        batch.export_raw(documents, payloads.city_dimension(spark, CITIES), str(path))
    assert not Path(path).exists()
