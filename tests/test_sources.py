import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import EDGE_CSV
from skyledger import schemas
from skyledger.sources import payloads
from skyledger.sources.csv import read_raw, write_raw
from skyledger.sources.shipments import as_documents

CITIES = [("Austin", 30.2672, -97.7431), ("New York", 40.7128, -74.006)]


@pytest.fixture
def cities(spark):
    return payloads.city_dimension(spark, CITIES)


def document(**changes):
    daily = {"time": ["2024-01-01", "2024-01-02"]}
    daily |= {name: [1.5, None] for name in schemas.METRICS} | changes
    return json.dumps({"daily": {k: v for k, v in daily.items() if v is not ...}})


def test_csv_round_trip(spark, raw, rows, tmp_path):
    write_raw(raw, str(tmp_path / "out"))
    assert rows(read_raw(spark, str(tmp_path / "out"))) == rows(raw)


def test_csv_many_paths(spark, raw, rows, tmp_path):
    for name in "ab":
        write_raw(raw, str(tmp_path / name))
    both = read_raw(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert rows(both) == rows(payloads.concat(raw, raw))


def test_csv_reordered_header_fails(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    low, high = "temperature_2m_min", "temperature_2m_max"
    path.write_text(EDGE_CSV.replace(f"{high},{low}", f"{low},{high}"))
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        read_raw(spark, str(path)).collect()


def test_csv_bad_number_is_null(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(EDGE_CSV.replace("29.99", "xx"))
    first = read_raw(spark, str(path)).filter("time = '2024-01-01'").first()
    assert first.temperature_2m_max is None and first.temperature_2m_min == 0.01


def test_city_dimension(spark):
    assert payloads.city_dimension(spark).count() == 5


def test_flatten(spark, cities, rows):
    docs = spark.createDataFrame([("Austin", document())], "city string, payload string")
    raw = payloads.flatten(docs, cities)
    assert raw.columns == schemas.RAW.names
    values = ([1.5] * 7, [None] * 7)
    assert rows(raw) == [
        (f"2024-01-0{day}", *metrics, *CITIES[0]) for day, metrics in enumerate(values, 1)
    ]


def test_flatten_keeps_days_of_an_unknown_city(spark, cities):
    docs = spark.createDataFrame([("Oslo", document())], "city string, payload string")
    found = payloads.flatten(docs, cities).collect()
    assert [(r.city, r.latitude) for r in found] == [("Oslo", None)] * 2


@pytest.mark.parametrize(
    "payload",
    ["{not json", "{}", document(rain_sum=[1.0]), document(rain_sum=...), document(time=...)],
)
def test_flatten_never_loses_a_bad_document(spark, cities, payload):
    docs = spark.createDataFrame([("Austin", payload)], "city string, payload string")
    with pytest.raises(Exception, match="MALFORMED_RECORD|payload without equal daily arrays"):
        payloads.flatten(docs, cities).collect()


def test_documents_round_trip(spark, raw, cities, rows, tmp_path):
    named = raw.filter("city IS NOT NULL AND time IS NOT NULL")
    as_documents(named).write.json(str(tmp_path / "docs"))
    docs = payloads.read_documents(spark, str(tmp_path / "docs"))
    assert rows(payloads.flatten(docs, cities)) == rows(named)


def test_concat_matches_by_name(raw, rows):
    shuffled = raw.select(*reversed(raw.columns))
    assert rows(payloads.concat(raw, shuffled)) == rows(raw.union(raw))
    with pytest.raises(PySparkException):
        payloads.concat(raw, raw.withColumn("extra", F.lit(1)))


def test_a_repeated_city_fails_instead_of_multiplying_its_days(spark):
    arrays = {"time": ["2024-01-01", "2024-01-02"], **{m: [1.0, 2.0] for m in schemas.METRICS}}
    documents = spark.createDataFrame([("Austin", json.dumps({"daily": arrays}))], "city STRING, payload STRING")
    cities = [("Austin", 30.0, -97.0), ("Oslo", 59.9, 10.7), (None, 0.0, 0.0), (None, 1.0, 1.0)]
    known = payloads.city_dimension(spark, cities)
    assert payloads.flatten(documents, known).count() == 2
    for twice in (("Austin", 30.0, -97.0), ("Oslo", 60.0, 10.7)):
        with pytest.raises(Exception, match=f"more than once in the dimension: {twice[0]}"):
            payloads.flatten(documents, payloads.city_dimension(spark, [*cities, twice])).collect()
