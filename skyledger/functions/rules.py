"""The rule set: day flags, severity points and risk events, as data.

A rule set is plain values, so thresholds can come from configuration
(:meth:`RuleSet.from_mapping`), and every rule turns into a native column
expression. Nulls follow SQL: a null metric gives a null flag, adds no severity
point and raises no risk. NaN sorts above every number, as everywhere in Spark.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Collection, Mapping
from dataclasses import dataclass, replace
from functools import reduce
from operator import add, and_, eq, ge, gt, le, lt, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from skyledger import schemas

# The flags every rule set must define: contract columns of silver.
FLAGS = tuple(f.name for f in schemas.SILVER if isinstance(f.dataType, BooleanType))

_COMPARE = {">": gt, ">=": ge, "<": lt, "<=": le, "=": eq}


@dataclass(frozen=True)
class Test:
    """``metric op value``; with no op, ``metric`` is a boolean column."""

    __test__ = False  # not a pytest class

    metric: str
    op: str | None = None
    value: float | None = None

    def column(self) -> Column:
        metric = F.col(self.metric)
        return metric if self.op is None else _COMPARE[self.op](metric, F.lit(self.value))


@dataclass(frozen=True)
class Risk:
    """A risk event: raised when every trigger holds, HIGH when ``high`` does."""

    risk_type: str
    metric: str
    triggers: tuple[Test, ...]
    high: Test | None
    description: str

    def raised(self) -> Column:
        return reduce(and_, (t.column() for t in self.triggers))

    def level(self) -> Column:
        if self.high is None:
            return F.lit("MEDIUM")
        return F.when(self.high.column(), "HIGH").otherwise("MEDIUM")


@dataclass(frozen=True)
class RuleSet:
    flags: Mapping[str, Test]
    severity: tuple[Test, ...]
    risks: tuple[Risk, ...]

    @staticmethod
    def from_mapping(config: Mapping) -> RuleSet:
        """Build a rule set from parsed JSON/YAML: tests are [metric, op, value] or [flag].

        Names and types are looked up in the silver layer; all problems come in one
        ValueError. No severity tests give the score 0, no risks no events.
        """
        problems = rule_problems(config)
        if problems:
            raise ValueError("faulty rules: " + "; ".join(problems))
        return RuleSet(
            flags={name: Test(*test) for name, test in config["flags"].items()},
            severity=tuple(Test(*test) for test in config["severity"]),
            risks=tuple(
                Risk(
                    risk_type=r["risk_type"],
                    metric=r["metric"],
                    triggers=tuple(Test(*test) for test in r["triggers"]),
                    high=Test(*r["high"]) if r.get("high") else None,
                    description=r["description"],
                )
                for r in config["risks"]
            ),
        )

    def with_flags(self, df: DataFrame) -> DataFrame:
        return df.withColumns({name: test.column() for name, test in self.flags.items()})

    def severity_score(self) -> Column:
        """Integer, never null: one point per test that is true."""
        points = (F.when(t.column(), F.lit(1)).otherwise(F.lit(0)) for t in self.severity)
        return reduce(add, points) if self.severity else F.lit(0)

    def risk_events(self, df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        """One row per (input row, raised risk), in a single pass over ``df``.

        ``stack`` fans each row out to one candidate per rule inside the scan's
        codegen stage; the leading filter keeps only rows that raise something
        and reaches the file scan.
        """
        if not self.risks:
            none = {"risk_type": "string", "risk_level": "string", "metric_value": "double"}
            columns = (F.lit(None).cast(kind).alias(name) for name, kind in none.items())
            description = F.lit(None).cast("string").alias("description")
            return df.select(*keys, *columns, description).filter(F.lit(False))
        candidates = [
            column
            for r in self.risks
            for column in (
                F.lit(r.risk_type),
                F.when(r.raised(), r.level()),
                F.col(r.metric),
                F.lit(r.description),
            )
        ]
        return (
            df.filter(reduce(or_, (r.raised() for r in self.risks)))
            .select(
                *keys,
                F.stack(F.lit(len(self.risks)), *candidates).alias(
                    "risk_type", "risk_level", "metric_value", "description"
                ),
            )
            .filter(F.col("risk_level").isNotNull())
        )


def day_count(flag: str) -> str:
    """is_<kind>_day -> <kind>_days, the column that counts the days with the flag."""
    return flag.removeprefix("is_") + "s"


_FLAG = re.compile(r"is_[a-z0-9_]+_day")
_RISK_PARTS = ("risk_type", "metric", "triggers", "description")


def _numeric(name: object, where: str) -> list[str]:
    """Problems of ``name`` as a numeric silver column."""
    if not isinstance(name, str) or name not in schemas.SILVER.names:
        return [f"{where}: no column {name}"]
    if not isinstance(schemas.SILVER[name].dataType, NumericType):
        return [f"{where}: {name} is not a numeric column"]
    return []


def _test_problems(test: object, where: str, flags: Collection[str]) -> list[str]:
    """Problems of a test; ``flags`` may stand alone as one."""
    if not isinstance(test, (list, tuple)) or len(test) not in (1, 3):
        return [f"{where}: must be [flag] or [metric, op, value], not {test!r}"]
    if len(test) == 1:
        if flags and test[0] in flags:
            return []
        return _numeric(test[0], where) or [f"{where}: {test[0]} is not a flag"]
    metric, op, value = test
    problems = _numeric(metric, where)
    if op not in _COMPARE:
        problems.append(f"{where}: unknown operator {op!r}")
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if not number or not math.isfinite(value):
        problems.append(f"{where}: {value!r} is not a number")
    return problems


def _risk_problems(risk: object, where: str, flags: Collection[str]) -> list[str]:
    if not isinstance(risk, Mapping):
        return [f"{where}: must be a mapping, not {risk!r}"]
    problems = [f"{where}: {part} is missing" for part in _RISK_PARTS if part not in risk]
    unknown = [part for part in risk if part not in (*_RISK_PARTS, "high")]
    problems += [f"{where}: {part} is unknown" for part in unknown]
    for part in ("risk_type", "description"):
        if part in risk and (not isinstance(risk[part], str) or not risk[part]):
            problems.append(f"{where}.{part}: must be a text")
    if "metric" in risk:
        problems += _numeric(risk["metric"], f"{where}.metric")
    if "triggers" in risk:
        triggers = risk["triggers"]
        if not isinstance(triggers, (list, tuple)):
            problems.append(f"{where}.triggers: must be a list")
        elif not triggers:
            problems.append(f"{where}.triggers: must not be empty")
        else:
            for k, test in enumerate(triggers):
                problems += _test_problems(test, f"{where}.triggers[{k}]", flags)
    if risk.get("high"):
        problems += _test_problems(risk["high"], f"{where}.high", flags)
    return problems


def rule_problems(config: Mapping) -> list[str]:
    """Everything that keeps ``config`` from being a rule set over the silver layer."""
    parts = {"flags": Mapping, "severity": (list, tuple), "risks": (list, tuple)}
    problems = [f"{part}: missing" for part in parts if part not in config]
    problems += [f"{part}: unknown" for part in config if part not in parts]
    sound = {}
    for part, kind in parts.items():
        if part in config and not isinstance(config[part], kind):
            problems.append(f"{part}: must be a {'mapping' if kind is Mapping else 'list'}")
        else:
            sound[part] = config.get(part, {} if kind is Mapping else ())
    flags = sound.get("flags", {})
    if "flags" in config:
        problems += [f"flags: {name} is missing" for name in FLAGS if name not in flags]
    for name, test in flags.items():
        if not _FLAG.fullmatch(str(name)):
            problems.append(f"flags.{name}: must be named is_<kind>_day")
        problems += _test_problems(test, f"flags.{name}", ())
    for k, test in enumerate(sound.get("severity", ())):
        problems += _test_problems(test, f"severity[{k}]", flags)
    risks = sound.get("risks", ())
    for k, risk in enumerate(risks):
        problems += _risk_problems(risk, f"risks[{k}]", flags)
    named = (r.get("risk_type") for r in risks if isinstance(r, Mapping))
    types = Counter(t for t in named if isinstance(t, str))
    return problems + [f"risks: {t} occurs {n} times" for t, n in types.items() if n > 1]


# Thresholds, strictness, type names and descriptions are fixed values. The wind
# tests differ on purpose: 40 km/h is a risk but adds no severity point.
STANDARD = RuleSet(
    flags={
        "is_rainy_day": Test("precipitation_mm", ">", 1.0),
        "is_hot_day": Test("max_temp_c", ">=", 30.0),
        "is_freezing_day": Test("min_temp_c", "<=", 0.0),
    },
    severity=(
        Test("is_rainy_day"),
        Test("is_hot_day"),
        Test("is_freezing_day"),
        Test("max_wind_speed_kmh", ">", 40.0),
    ),
    risks=(
        Risk(
            "HOT_DAY",
            "max_temp_c",
            (Test("max_temp_c", ">=", 35.0),),
            Test("max_temp_c", ">=", 40.0),
            "Max temp >= 35 C",
        ),
        Risk(
            "FREEZING",
            "min_temp_c",
            (Test("is_freezing_day"),),
            Test("min_temp_c", "<=", -10.0),
            "Min temp <= 0 C",
        ),
        Risk(
            "HEAVY_RAIN",
            "precipitation_mm",
            (Test("precipitation_mm", ">=", 20.0),),
            Test("precipitation_mm", ">=", 50.0),
            "Precipitation >= 20 mm",
        ),
        Risk(
            "STRONG_WIND",
            "max_wind_speed_kmh",
            (Test("max_wind_speed_kmh", ">=", 40.0),),
            Test("max_wind_speed_kmh", ">=", 60.0),
            "Wind speed >= 40 km/h",
        ),
    ),
)

# Optional rules, off unless asked for: a windy-day flag that also scores, and a
# dry-day risk (its level is unspecified upstream; it is always MEDIUM here).
WINDY = replace(
    STANDARD,
    flags={**STANDARD.flags, "is_windy_day": Test("max_wind_speed_kmh", ">=", 30.0)},
    severity=(*STANDARD.severity, Test("is_windy_day")),
)
DRY = replace(
    STANDARD,
    risks=(
        *STANDARD.risks,
        Risk(
            "DRY_DAY",
            "max_temp_c",
            (Test("precipitation_mm", "=", 0.0), Test("max_temp_c", ">=", 30.0)),
            None,
            "No precipitation and max temp >= 30 C",
        ),
    ),
)
