"""The batch run: raw frame -> tables -> checks -> verdict -> serving copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from skyledger import schemas
from skyledger.contracts import layer_contracts, require_columns, require_no_missing
from skyledger.functions.rules import STANDARD, RuleSet
from skyledger.operators import quality
from skyledger.operators.gold import to_daily, to_monthly, to_risk, to_yearly, with_created_at
from skyledger.operators.layers import to_bronze, to_silver
from skyledger.operators.profiles import raw_by_city
from skyledger.sinks.publish import publish
from skyledger.sinks.tables import (
    Warehouse,
    create_namespace,
    current_version,
    overwrite_table,
    table_exists,
    write_layer,
)
from skyledger.sources.csv import read_raw, write_raw
from skyledger.sources.payloads import flatten

RESULTS_NAME = "dq_results"
VERDICT_NAME = "dq_verdict"
CHECKED_NAME = "dq_checked_versions"
MEASURED_NAME = "dq_measured"


def export_raw(documents: DataFrame, cities: DataFrame, path: str) -> DataFrame:
    """JSON payloads -> raw CSV files; returns the profile per city.

    Nothing is written unless every raw column is there and holds no missing
    value.
    """
    raw = require_columns(flatten(documents, cities), schemas.RAW.names)
    write_raw(require_no_missing(raw, schemas.RAW.names), path)
    return raw_by_city(read_raw(documents.sparkSession, path))


def build_layers(
    raw: DataFrame,
    wh: Warehouse,
    on_bad_date: str = "fail",
    rules: RuleSet = STANDARD,
    yearly: bool = False,
    created_at: bool = False,
) -> dict[str, DataFrame]:
    """Write bronze, silver and the three gold tables, under the contracts of ``rules``.

    ``yearly`` writes the yearly summary too, ``created_at`` the creation time of risks.

    Each layer is read back from its table: lineage ends at every write, and the
    gold tables share one stored silver instead of computing it three times. What the
    quality checks want to know of the rows is counted while they are written, and kept
    with the version it was counted of.
    """
    spark = raw.sparkSession
    create_namespace(spark, wh)
    contracts, measured = layer_contracts(rules, yearly, created_at), []

    def write(df: DataFrame, table: str) -> DataFrame:
        df, observed = quality.observed(df, table)
        stored = write_layer(df, wh, table, contracts[table])
        if observed:
            version = current_version(spark, wh, table)
            measured.extend((table, version, fact, n) for fact, n in observed.get.items())
        return stored

    bronze = write(to_bronze(raw), schemas.BRONZE_NAME)
    silver = write(to_silver(bronze, on_bad_date, rules), schemas.SILVER_NAME)
    risk = to_risk(silver, rules)
    layers = {
        schemas.BRONZE_NAME: bronze,
        schemas.SILVER_NAME: silver,
        schemas.DAILY_NAME: write(to_daily(silver, rules), schemas.DAILY_NAME),
        schemas.MONTHLY_NAME: write(to_monthly(silver, rules), schemas.MONTHLY_NAME),
        schemas.RISK_NAME: write(
            with_created_at(risk) if created_at else risk, schemas.RISK_NAME
        ),
    }
    if yearly:
        layers[schemas.YEARLY_NAME] = write(to_yearly(silver, rules), schemas.YEARLY_NAME)
    facts = spark.createDataFrame(measured, "dataset STRING, version STRING, fact STRING, n BIGINT")
    overwrite_table(facts, wh, MEASURED_NAME)
    return layers


def _measured(spark: SparkSession, wh: Warehouse, versions: dict) -> dict[str, dict[str, int]]:
    """What was counted while the present versions were written."""
    found: dict[str, dict[str, int]] = {}
    if table_exists(spark, wh.name(MEASURED_NAME)):
        for row in spark.table(wh.name(MEASURED_NAME)).collect():
            if row.version and row.version == versions.get(row.dataset):
                found.setdefault(row.dataset, {})[row.fact] = row.n
    return found


def check_layers(
    spark: SparkSession,
    wh: Warehouse,
    rules: RuleSet = STANDARD,
    severity_check: bool = False,
    yearly: bool = False,
    created_at: bool = False,
) -> quality.Verdict:
    """Run the checks on the stored tables and store results and verdict.

    The verdict is stored whether it is good or bad, so that a gate in another
    job can read it even though this run then fails. With it goes the version of
    each table that was checked.
    """
    contracts = layer_contracts(rules, yearly, created_at)
    versions = {name: current_version(spark, wh, name) for name in contracts}
    results = quality.run_checks(
        lambda name: spark.table(versions[name] or wh.name(name)),
        severity_check=severity_check,
        contracts=contracts,
        measured=_measured(spark, wh, versions),
    )
    verdict = quality.judge(results)
    overwrite_table(quality.results_frame(spark, results), wh, RESULTS_NAME)
    overwrite_table(quality.verdict_frame(spark, verdict), wh, VERDICT_NAME)
    rows = [(name, version, verdict.dq_passed) for name, version in versions.items()]
    checked = spark.createDataFrame(rows, "dataset STRING, version STRING, dq_passed BOOLEAN")
    overwrite_table(checked, wh, CHECKED_NAME)
    return verdict


def publish_if_passed(
    spark: SparkSession, wh: Warehouse, tables: Sequence[str] = (schemas.DAILY_NAME,)
) -> bool:
    """Publish only what a passing verdict was about; says whether it did.

    The gate refuses a table that has been written since its check, and one that was
    never checked. A provider without versions of ours (delta) is judged by the stored
    verdict alone.
    """
    if not table_exists(spark, wh.name(CHECKED_NAME)):
        return False
    checked = {r.dataset: r for r in spark.table(wh.name(CHECKED_NAME)).collect()}
    for table in tables:
        row = checked.get(table)
        if not row or not row.dq_passed or row.version != current_version(spark, wh, table):
            return False
    versions = {table: checked[table].version for table in tables}
    publish(spark, wh, tables, checked=quality.KEYED, versions=versions)
    return True


def run(
    raw: DataFrame,
    wh: Warehouse,
    on_bad_date: str = "fail",
    publish_tables: Sequence[str] = (schemas.DAILY_NAME,),
    rules: RuleSet = STANDARD,
    severity_check: bool = False,
    yearly: bool = False,
    created_at: bool = False,
) -> quality.Verdict:
    """Everything, in order. A failed check fails the run and publishes nothing."""
    spark = raw.sparkSession
    build_layers(raw, wh, on_bad_date, rules, yearly, created_at)
    verdict = check_layers(spark, wh, rules, severity_check, yearly, created_at)
    publish_if_passed(spark, wh, publish_tables)
    quality.require_passed(verdict)
    return verdict
