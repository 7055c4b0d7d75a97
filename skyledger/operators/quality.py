"""Ten data-quality checks, their verdict, and the gate it controls.

What the checks need to know of a table is measured once, or taken from what was counted
while the table was written (:func:`observed`). A check that cannot run is a failed check:
the others still report.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger import schemas
from skyledger.contracts import require_contract
from skyledger.operators.gold import SCORE

# Tables whose key the checks cover.
KEYED = (schemas.DAILY_NAME, schemas.RISK_NAME, schemas.YEARLY_NAME)

RESULT_SCHEMA = "check_id INT, dataset STRING, rule STRING, passed BOOLEAN, detail STRING"


@dataclass(frozen=True)
class Result:
    check_id: int
    dataset: str
    rule: str
    passed: bool
    detail: str


@dataclass(frozen=True)
class Verdict:
    total: int
    failures: tuple[Result, ...]

    @property
    def dq_passed(self) -> bool:
        return not self.failures

    def summary(self) -> str:
        return f"{self.total - len(self.failures)}/{self.total} checks passed"


def _facts(name: str) -> list[Column]:
    """What one pass over a table's rows can count for its checks."""
    rows = F.count(F.lit(1)).alias("rows")
    if name == schemas.SILVER_NAME:
        return [rows, F.count_if(F.col("weather_date").isNull()).alias("no_date")]
    if name == schemas.DAILY_NAME:
        return [rows, F.count_if(F.col(SCORE) < 0).alias("negative")]
    return [rows]


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation | None]:
    """``df`` of table ``name`` with its facts counted by whatever writes it.

    The counts ride along with the write: no second scan of the stored rows. A retried
    task counts once.
    """
    if name == schemas.BRONZE_NAME:
        return df, None
    observation = Observation()
    return df.observe(observation, *_facts(name)), observation


def _repeated(df: DataFrame, key: Iterable[str]) -> dict:
    """Rows and repeated keys, from one aggregation by key."""
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
            F.count_if(F.col("_copies") > 1).alias("repeated"),
        )
        .first()
        .asDict()
    )


def _first_line(error: Exception) -> str:
    return (str(error) or type(error).__name__).splitlines()[0]


def _once(measure: Callable[[], object]) -> Callable[[], object]:
    """``measure`` run at most once; what it gave or raised comes again on later calls."""
    kept: list = []

    def call():
        if not kept:
            try:
                kept.append((measure(), None))
            except Exception as error:  # noqa: BLE001 - raised again for every check that asks
                kept.append((None, error))
        value, error = kept[0]
        if error is not None:
            raise error
        return value

    return call


class _Table:
    """One table under check: loaded once, each fact measured once, failures too."""

    def __init__(
        self,
        name: str,
        load: Callable[[str], DataFrame],
        key: Iterable[str] | None,
        measured: Mapping[str, int],
    ):
        self.name, self._measured = name, measured
        self.frame = _once(lambda: load(name))
        self._facts = _once(lambda: self.frame().agg(*_facts(name)).first().asDict())
        self._counted = _once(lambda: self.frame().count())
        self._keys = _once(lambda: _repeated(self.frame(), key))
        self._keyed = key is not None

    def fact(self, fact: str) -> int:
        return self._measured[fact] if fact in self._measured else self._facts()[fact]

    def repeated(self) -> int:
        return self._keys()["repeated"]

    def rows(self) -> int:
        """Row count, even where a column that the facts or the key need is missing."""
        if "rows" in self._measured:
            return self._measured["rows"]
        for known in (self._keys if self._keyed else self._facts, self._facts):
            try:
                return known()["rows"]
            except Exception:  # noqa: BLE001 - the check of that column reports the cause
                continue
        return self._counted()


def run_checks(
    load: Callable[[str], DataFrame],
    severity_check: bool = False,
    contracts: Mapping[str, StructType] = schemas.TABLES,
    measured: Mapping[str, Mapping[str, int]] | None = None,
) -> list[Result]:
    """Run every check on the tables ``load`` returns by name, each loaded once.

    ``measured`` has, by table, what was counted while it was written; only keys are then
    left to be looked at. ``severity_check`` adds an optional check: no negative score.
    A yearly table among the ``contracts`` is checked like the monthly one, and for its key.
    """
    results: list[Result] = []

    def check(dataset: _Table, rule: str, run: Callable[[], tuple[bool, str]]) -> None:
        try:
            passed, detail = run()
        except Exception as error:  # noqa: BLE001 - any failure is this check's result
            passed, detail = False, _first_line(error)
        results.append(Result(len(results) + 1, dataset.name, rule, passed, detail))

    def table(name: str, key: Iterable[str] | None = None) -> _Table:
        return _Table(name, load, key, (measured or {}).get(name, {}))

    def schema(t: _Table) -> tuple[bool, str]:
        require_contract(t.frame(), contracts[t.name], t.name)
        return True, "as declared"

    def not_empty(t: _Table) -> tuple[bool, str]:
        rows = t.rows()
        return rows > 0, f"{rows} rows"

    def none(n: int, what: str) -> tuple[bool, str]:
        return n == 0, f"{n} {what}"

    silver, monthly = table(schemas.SILVER_NAME), table(schemas.MONTHLY_NAME)
    daily = table(schemas.DAILY_NAME, schemas.DAILY_KEY)
    risk = table(schemas.RISK_NAME, schemas.RISK_KEY)
    check(silver, "not empty", lambda: not_empty(silver))
    check(
        silver,
        "weather_date not null",
        lambda: none(silver.fact("no_date"), "rows without weather_date"),
    )
    check(daily, "schema", lambda: schema(daily))
    check(daily, "not empty", lambda: not_empty(daily))
    check(daily, "unique key", lambda: none(daily.repeated(), "repeated keys"))
    check(monthly, "schema", lambda: schema(monthly))
    check(monthly, "not empty", lambda: not_empty(monthly))
    check(risk, "schema", lambda: schema(risk))
    check(risk, "can be queried", lambda: (True, f"{risk.rows()} rows"))
    check(risk, "unique key", lambda: none(risk.repeated(), "repeated keys"))
    if severity_check:
        negative = lambda: none(daily.fact("negative"), "negative scores")
        check(daily, "severity not negative", negative)
    if schemas.YEARLY_NAME in contracts:
        yearly = table(schemas.YEARLY_NAME, schemas.YEARLY_KEY)
        check(yearly, "schema", lambda: schema(yearly))
        check(yearly, "not empty", lambda: not_empty(yearly))
        check(yearly, "unique key", lambda: none(yearly.repeated(), "repeated keys"))
    return results


def results_frame(spark: SparkSession, results: list[Result]) -> DataFrame:
    rows = [(r.check_id, r.dataset, r.rule, r.passed, r.detail) for r in results]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def judge(results: list[Result]) -> Verdict:
    return Verdict(len(results), tuple(r for r in results if not r.passed))


def verdict_frame(spark: SparkSession, verdict: Verdict) -> DataFrame:
    row = (verdict.dq_passed, verdict.total - len(verdict.failures), verdict.total)
    return spark.createDataFrame([row], "dq_passed BOOLEAN, passed INT, total INT")


def require_passed(verdict: Verdict) -> None:
    if not verdict.dq_passed:
        failed = "; ".join(f"{r.dataset} {r.rule}: {r.detail}" for r in verdict.failures)
        raise RuntimeError(f"{verdict.summary()}: {failed}")
