"""Catalog tables: namespace, first creation, overwrite."""

from __future__ import annotations

import re
import sys
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from skyledger import schemas
from skyledger.contracts import require_contract


@dataclass(frozen=True)
class Warehouse:
    """Where the tables live.

    ``location`` is the folder of a namespace created here; without it the
    catalog's own warehouse folder is used. ``provider`` is any table format the
    session has. ``keep`` versions of a table stay, and older ones until they have been
    replaced for ``retain_seconds``: set it to the time of the longest query.
    """

    namespace: str = "default"
    location: str | None = None
    provider: str = "parquet"
    keep: int = 2
    retain_seconds: int = 0

    def __post_init__(self) -> None:
        if self.keep < 1 or self.retain_seconds < 0:
            raise ValueError("keep must be at least 1, retain_seconds at least 0")

    def name(self, table: str) -> str:
        return f"{self.namespace}.{table}"


def create_namespace(spark: SparkSession, wh: Warehouse) -> None:
    place = f" LOCATION '{wh.location}'" if wh.location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {wh.namespace}{place}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


_REPLACE, _CREATE = "CREATE OR REPLACE VIEW", "CREATE VIEW IF NOT EXISTS"

# Marks of a version: the table it belongs to, and when readers were switched to it.
# The view names the version it shows.
OWNER, SWITCHED, VERSION = "skyledger.table", "skyledger.switched", "skyledger.version"


def _marks(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def current_version(spark: SparkSession, wh: Warehouse, table: str) -> str | None:
    """The version readers of ``table`` see; None where it is no view on versions."""
    name = wh.name(table)
    if not table_exists(spark, name) or spark.catalog.getTable(name).tableType != "VIEW":
        return None
    return _marks(spark, name).get(VERSION)


def _write_version(df: DataFrame, wh: Warehouse, table: str, parts: Sequence[str] = ()) -> str:
    """Store ``df`` as a version that nobody reads yet; returns its name."""
    version = wh.name(f"{table}__v{time.time_ns()}")
    df.write.format(wh.provider).partitionBy(*parts).saveAsTable(version)
    return version


def _show(spark: SparkSession, wh: Warehouse, table: str, version: str, create: str) -> None:
    """Point the view at ``version``, which goes if the view does not come to show it."""
    try:
        marks = f"'{OWNER}' = '{table}', '{SWITCHED}' = '{time.time_ns()}'"
        spark.sql(f"ALTER TABLE {version} SET TBLPROPERTIES ({marks})")
        spark.sql(
            f"{create} {wh.name(table)} TBLPROPERTIES ('{VERSION}' = '{version}') "
            f"AS SELECT * FROM {version}"
        )
    finally:
        if create != _REPLACE or sys.exc_info()[0]:
            if current_version(spark, wh, table) != version:
                spark.sql(f"DROP TABLE IF EXISTS {version}")


def _retire(spark: SparkSession, wh: Warehouse, table: str) -> None:
    """Drop old versions of ``table``: known by name *and* mark, and not the one shown.

    A version that is still being written has no mark yet.
    """
    named = re.compile(re.escape(table) + r"__v[0-9]+", re.IGNORECASE)
    known = []
    for t in spark.catalog.listTables(wh.namespace, f"{table}__v*"):
        if not t.isTemporary and named.fullmatch(t.name):
            try:
                marks = _marks(spark, wh.name(t.name))
            except AnalysisException:  # another writer has dropped it meanwhile
                continue
            if marks.get(OWNER) == table and SWITCHED in marks:
                known.append((int(marks[SWITCHED]), wh.name(t.name)))
    known.sort()
    shown = (current_version(spark, wh, table) or "").lower()
    limit = time.time_ns() - wh.retain_seconds * 1_000_000_000
    for (_, old), (replaced, _) in zip(known[: -wh.keep], known[1:], strict=False):
        if old.lower() != shown and replaced <= limit:
            spark.sql(f"DROP TABLE IF EXISTS {old}")


def swap_in(df: DataFrame, wh: Warehouse, table: str, parts: Sequence[str] = ()) -> DataFrame:
    """Store ``df`` as a new version of ``table``, then switch readers to it.

    ``table`` is a view on its latest version. Plain file tables are dropped
    before they are overwritten, so a job that fails would take the old rows with
    it; here readers have the old version until the new one is whole. Of several
    writers the last to finish is seen. A plain table of that name is refused before
    anything is written. Returns the table as stored: later steps neither recompute
    ``df`` nor depend on the executors that did.
    """
    spark, name = df.sparkSession, wh.name(table)
    if table_exists(spark, name) and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table, not a view on versions: move its rows and drop it")
    version = _write_version(df, wh, table, parts)
    _show(spark, wh, table, version, _REPLACE)
    _retire(spark, wh, table)
    return spark.table(name)


def overwrite_table(df: DataFrame, wh: Warehouse, table: str) -> DataFrame:
    """Replace rows and schema of ``table``; returns it as stored."""
    if wh.provider != "delta":
        return swap_in(df, wh, table)
    writer = df.write.format("delta").mode("overwrite").option("overwriteSchema", True)
    writer.saveAsTable(wh.name(table))
    return df.sparkSession.table(wh.name(table))


def ensure_table(
    spark: SparkSession, wh: Warehouse, table: str, schema: StructType
) -> DataFrame:
    """Create ``table`` empty if it is absent, keep its rows if not; check it.

    A table that another job creates or fills meanwhile stays as that job left it.
    """
    name = wh.name(table)
    if not table_exists(spark, name):
        empty = spark.createDataFrame([], schema)
        if wh.provider == "delta":
            empty.write.format("delta").mode("ignore").saveAsTable(name)
        else:
            version = _write_version(empty, wh, table)
            _show(spark, wh, table, version, _CREATE)
    return require_contract(spark.table(name), schema, name)


def ensure_layers(spark: SparkSession, wh: Warehouse) -> None:
    create_namespace(spark, wh)
    for table, schema in schemas.TABLES.items():
        ensure_table(spark, wh, table, schema)


def write_layer(
    df: DataFrame, wh: Warehouse, table: str, schema: StructType | None = None
) -> DataFrame:
    """Check ``df`` against the contract of its layer, then overwrite the table.

    ``schema`` is the contract where optional rules have changed it.
    """
    expected = schemas.TABLES[table] if schema is None else schema
    return overwrite_table(require_contract(df, expected, table), wh, table)
