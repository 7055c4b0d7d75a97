"""Schema contracts: what a frame must look like before it is written.

Everything here but :func:`missing_counts` works on driver-side metadata and
starts no job. Nullability and column order are not part of a contract: file
tables report every column as nullable once they are read back.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from skyledger import schemas
from skyledger.functions.rules import RuleSet, day_count

DICTIONARY_SCHEMA = (
    "layer STRING, position INT, column_name STRING, data_type STRING, nullable BOOLEAN"
)


def contract_problems(actual: StructType, expected: StructType) -> list[str]:
    """Every way ``actual`` breaks ``expected``; empty when it holds."""
    have = {f.name: f.dataType.simpleString() for f in actual}
    want = {f.name: f.dataType.simpleString() for f in expected}
    retyped = {n for n in want.keys() & have.keys() if have[n] != want[n]}
    groups = {
        "missing": sorted(want.keys() - have.keys()),
        "unexpected": sorted(have.keys() - want.keys()),
        "retyped": [f"{n} is {have[n]}, not {want[n]}" for n in sorted(retyped)],
    }
    return [f"{kind}: {', '.join(found)}" for kind, found in groups.items() if found]


def layer_contracts(
    rules: RuleSet, yearly: bool = False, created_at: bool = False
) -> dict[str, StructType]:
    """The contract of every stored layer under ``rules``.

    A flag beyond the standard ones is one more column of silver and daily, and its day
    count one more of monthly and yearly. ``yearly`` adds the yearly table, ``created_at``
    that column to the risks.
    """

    def more(schema: StructType, columns: dict[str, str]) -> StructType:
        extended = StructType(list(schema.fields))
        for name, kind in columns.items():
            if name not in schema.names:
                extended.add(name, kind)
        return extended

    flags = dict.fromkeys(rules.flags, "boolean")
    counts = {day_count(flag): "long" for flag in rules.flags}
    extra = {
        schemas.SILVER_NAME: flags,
        schemas.DAILY_NAME: flags,
        schemas.MONTHLY_NAME: counts,
        schemas.YEARLY_NAME: counts,
        schemas.RISK_NAME: {schemas.CREATED_AT: "timestamp"} if created_at else {},
    }
    tables = {**schemas.TABLES, **({schemas.YEARLY_NAME: schemas.YEARLY} if yearly else {})}
    return {name: more(schema, extra.get(name, {})) for name, schema in tables.items()}


def require_contract(df: DataFrame, expected: StructType, name: str) -> DataFrame:
    """``df`` itself, or one ValueError that lists all problems."""
    problems = contract_problems(df.schema, expected)
    if problems:
        raise ValueError(f"{name} breaks its contract ({'; '.join(problems)})")
    return df


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    absent = [name for name in columns if name not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {', '.join(absent)}")
    return df


def _is_missing(df: DataFrame, name: str):
    value = F.col(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def _missing(df: DataFrame, columns: Iterable[str]) -> list:
    return [F.count_if(_is_missing(df, name)).alias(name) for name in columns]


def missing_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row: per column, how many values are null (or NaN, for floats)."""
    return df.agg(*_missing(df, columns))


def missing_observed(df: DataFrame, columns: Iterable[str]) -> tuple[DataFrame, Observation]:
    """``df`` with the same counts taken by whatever job goes over it.

    Several layers of one plan can be observed so, in a single scan.
    """
    observation = Observation()
    return df.observe(observation, *_missing(df, columns)), observation


def require_no_missing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``df`` itself, or a ValueError with the count of each offending column."""
    counts = missing_counts(df, columns).first().asDict()
    bad = {name: n for name, n in counts.items() if n}
    if bad:
        raise ValueError(
            "missing values: " + ", ".join(f"{name}={n}" for name, n in bad.items())
        )
    return df


def data_dictionary(
    spark: SparkSession, layers: Mapping[str, StructType] = schemas.LAYERS
) -> DataFrame:
    """Layer, position, column, type and nullability of every contract column."""
    rows = [
        (layer, position, f.name, f.dataType.simpleString(), f.nullable)
        for layer, schema in layers.items()
        for position, f in enumerate(schema, start=1)
    ]
    return spark.createDataFrame(rows, DICTIONARY_SCHEMA).orderBy("layer", "position")
