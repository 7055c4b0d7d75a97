"""Every registered query against DuckDB, on the given tables and on skewed ones."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from skyledger.plans.oracle import ORACLE as SQL
from skyledger.plans.registry import QUERIES

SF = Path("/root/testdata/sf0.001")
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def oracle(name, folder):
    with duckdb.connect() as db:
        for file in Path(folder).glob("*.parquet"):
            pattern = f"{file}/*.parquet" if file.is_dir() else file
            db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{pattern}'")
        found = db.execute(SQL[name])
        return {c[0]: str(c[1]) for c in found.description}, found.fetchall()


def compare(spark, name, folder):
    df = QUERIES[name](spark, str(folder))
    types, expected = oracle(name, folder)
    assert {column: TYPES[kind] for column, kind in df.dtypes} == types
    order = list(types)
    found = [tuple(row) for row in df.select(*order).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    return found


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, name):
    assert compare(spark, name, SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


def test_entry_returns_rows(spark):
    assert entry(spark).count() > 0


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Over a third of all rows belong to one supplier."""
    folder = tmp_path_factory.mktemp("skewed")
    lineitem = spark.read.parquet(str(SF / "lineitem.parquet"))
    hot = F.when(F.col("l_orderkey") % 5 < 2, F.lit(7)).otherwise(F.col("l_suppkey"))
    lineitem.withColumn("l_suppkey", hot.cast("bigint")).write.parquet(
        str(folder / "lineitem.parquet")
    )
    spark.read.parquet(str(SF / "supplier.parquet")).write.parquet(str(folder / "supplier.parquet"))
    return folder


@pytest.mark.parametrize(
    "name", ["gold_daily", "gold_monthly", "gold_risk", "risk_by_city", "json_flatten", "dq_faults"]
)
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_skewed_city_without_a_small_side(spark, skewed, name, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        assert compare(spark, name, skewed)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
