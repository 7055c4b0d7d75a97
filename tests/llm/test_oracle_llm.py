"""The corpus queries that SQL can express, against DuckDB."""

from pathlib import Path

import duckdb
import pytest

from skyledger.llm.queries import ORACLE, QUERIES

SF = Path("/root/testdata/sf0.001")
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_sql(spark, name):
    with duckdb.connect() as db:
        for file in SF.glob("*.parquet"):
            db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        answer = db.execute(ORACLE[name])
        types, expected = {c[0]: str(c[1]) for c in answer.description}, answer.fetchall()
    df = QUERIES[name](spark, str(SF))
    assert {column: TYPES[kind] for column, kind in df.dtypes} == types
    found = [tuple(row) for row in df.select(*types).collect()]
    assert found and sorted(map(repr, found)) == sorted(map(repr, expected))
