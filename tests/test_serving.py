"""The serving copies: their layouts, what a lookup opens, rules and facts in stored layers."""

import pytest
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.contracts import layer_contracts
from skyledger.functions.rules import DRY, STANDARD, WINDY, RuleSet, rule_problems
from skyledger.operators import lookups, quality
from skyledger.operators.gold import to_daily, to_monthly, to_risk
from skyledger.plans import batch
from skyledger.plans.registry import CITY, FROM, TO, YEAR, served
from skyledger.sinks import tables
from skyledger.sinks.publish import CITY_PARTS, PERIOD, PLACE, guarded, publish

SF = "/root/testdata/sf0.001"
D, M, R = schemas.DAILY_NAME, schemas.MONTHLY_NAME, schemas.RISK_NAME


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def part_of(text, name):
    return text.split(f"{name}: [")[1].split("]")[0]


# What lookups open


def test_daily_lookups_prune_months_and_row_groups(spark):
    for lookup in (lookups.daily_range, lookups.daily_range_meta):
        text = plan(lookup(served(spark, SF, D), CITY, FROM, TO))
        assert PERIOD in part_of(text, "PartitionFilters")
        assert f"EqualTo(city,{CITY})" in part_of(text, "PushedFilters")
        assert "GreaterThanOrEqual(weather_date,1997-03-01)" in part_of(text, "PushedFilters")


def test_cities_are_read_as_one_column_of_the_copy(spark):
    assert "ReadSchema: struct<city:string>" in plan(lookups.list_cities(served(spark, SF, D)))


@pytest.mark.parametrize(
    "lookup",
    [
        lambda spark: lookups.risks_of_city(served(spark, SF, R), CITY),
        lambda spark: lookups.risks_of_city(served(spark, SF, R), CITY, "HEAVY_RAIN"),
        lambda spark: lookups.monthly_of_year(served(spark, SF, M), CITY, YEAR),
    ],
)
def test_lookups_by_city_open_the_files_of_its_part_only(spark, lookup):
    found = lookup(spark)
    text = plan(found)
    assert PLACE in part_of(text, "PartitionFilters")
    assert f"EqualTo(city,{CITY})" in part_of(text, "PushedFilters")
    rows = found.count()
    assert rows > 0
    copy = served(spark, SF, R if "riskType" in found.columns else M)
    part = copy.filter(F.col("city") == CITY).select(PLACE).distinct().collect()
    assert len(part) == 1
    opened = [f for f in copy.inputFiles() if f"{PLACE}={part[0][0]}/" in f]
    assert 0 < len(opened) < len(copy.inputFiles())


def test_a_copy_is_published_once(spark):
    assert served(spark, SF, R).inputFiles() == served(spark, SF, R).inputFiles()


def test_a_large_city_spreads_over_files(spark, wh):
    """All rows of one city: its part is cut by the key."""
    days = spark.range(4000).select(
        F.lit("Austin").alias("city"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("weather_date"),
        F.lit("HOT_DAY").alias("risk_type"),
        F.lit("HIGH").alias("risk_level"),
        F.lit(40.0).alias("metric_value"),
        F.lit("hot").alias("description"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_layer(days, wh, R)
        copy = publish(spark, wh, [R])["weather_risk_days"]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(copy.inputFiles()) > 4
    assert len({f.split(f"{PLACE}=")[1].split("/")[0] for f in copy.inputFiles()}) == 1
    assert lookups.risks_of_city(copy, "Austin").count() == 4000


def test_layouts_need_their_column(silver):
    with pytest.raises(ValueError, match="needs weather_date"):
        guarded(to_monthly(silver), schemas.MONTHLY_KEY, "month")
    assert CITY_PARTS > 1 and set(schemas.SERVING_LAYOUT) == set(schemas.SERVING)


# Facts counted while writing


class Loads:
    """Counts how often each table is loaded, and the jobs that reading it starts."""

    def __init__(self, spark, wh):
        self.spark, self.wh, self.n = spark, wh, {}

    def __call__(self, name):
        self.n[name] = self.n.get(name, 0) + 1
        return self.spark.table(self.wh.name(name))


def test_each_table_is_loaded_once_and_written_facts_are_not_counted_again(spark, raw, wh):
    batch.build_layers(raw, wh)
    versions = {name: tables.current_version(spark, wh, name) for name in schemas.TABLES}
    measured = batch._measured(spark, wh, versions)
    assert measured == {
        schemas.SILVER_NAME: {"rows": 6, "no_date": 0},
        D: {"rows": 6, "negative": 0},
        M: {"rows": 2},
        R: {"rows": 9},
    }
    loads = Loads(spark, wh)
    results = quality.run_checks(loads, severity_check=True, measured=measured)
    assert all(r.passed for r in results) and len(results) == 11
    # Silver is not even opened; monthly only for its schema.
    assert loads.n == {D: 1, M: 1, R: 1}
    loads = Loads(spark, wh)
    assert quality.run_checks(loads, severity_check=True) == results
    assert loads.n == {schemas.SILVER_NAME: 1, D: 1, M: 1, R: 1}


def test_failed_measurements_are_not_repeated(silver):
    calls = []

    def load(name):
        calls.append(name)
        raise OSError(f"{name} is gone")

    results = quality.run_checks(load)
    assert len(calls) == 4 and not any(r.passed for r in results)
    assert {r.detail for r in results if r.dataset == R} == {f"{R} is gone"}


def test_facts_of_another_version_do_not_count(spark, raw, wh):
    batch.build_layers(raw, wh)
    tables.write_layer(to_daily(spark.table(wh.name(schemas.SILVER_NAME))).limit(0), wh, D)
    verdict = batch.check_layers(spark, wh)
    assert [r.detail for r in verdict.failures] == ["0 rows"]


def test_gate_without_any_check_refuses(spark, raw, wh):
    batch.build_layers(raw, wh)
    assert not batch.publish_if_passed(spark, wh)


# Rules in stored layers


def test_rules_reach_the_stored_layers(spark, raw, wh, rows):
    verdict = batch.run(raw, wh, rules=WINDY, severity_check=True, publish_tables=(D, M))
    assert verdict.summary() == "11/11 checks passed"
    daily = spark.table(wh.name(D))
    assert "is_windy_day" in daily.columns
    assert spark.table(wh.name("weather_monthly_summary")).columns.count("windy_days") == 1
    silver = spark.table(wh.name(schemas.SILVER_NAME))
    assert rows(daily, "city", "weather_severity_score") == rows(
        to_daily(silver, WINDY), "city", "weather_severity_score"
    )


def test_a_warehouse_can_change_its_rules(spark, raw, wh):
    batch.run(raw, wh)
    assert batch.run(raw, wh, rules=DRY).dq_passed
    assert batch.run(raw, wh, rules=WINDY).dq_passed
    with pytest.raises(ValueError, match="unexpected: is_windy_day"):
        tables.ensure_table(spark, wh, D, schemas.DAILY)
    assert not batch.check_layers(spark, wh).dq_passed  # not the contract of these rules
    assert batch.check_layers(spark, wh, WINDY).dq_passed


def test_contracts_follow_the_rules():
    assert layer_contracts(STANDARD) == schemas.TABLES
    windy = layer_contracts(WINDY)
    assert windy[schemas.SILVER_NAME]["is_windy_day"].dataType.simpleString() == "boolean"
    assert windy[D]["is_windy_day"].dataType.simpleString() == "boolean"
    assert windy[M]["windy_days"].dataType.simpleString() == "bigint"
    assert windy[R] == schemas.RISK


# Rules from configuration

SOUND = {
    "flags": {
        "is_rainy_day": ["precipitation_mm", ">", 1],
        "is_hot_day": ["max_temp_c", ">=", 30],
        "is_freezing_day": ["min_temp_c", "<=", 0],
    },
    "severity": [["is_rainy_day"], ["max_wind_speed_kmh", ">", 40.0]],
    "risks": [
        {
            "risk_type": "HOT_DAY",
            "metric": "max_temp_c",
            "triggers": [["max_temp_c", ">=", 35]],
            "high": ["max_temp_c", ">=", 40],
            "description": "hot",
        }
    ],
}


def changed(path, value):
    """SOUND with one place replaced; ``...`` deletes it."""

    def at(node, rest):
        node = dict(node) if isinstance(node, dict) else list(node)
        if len(rest) > 1:
            node[rest[0]] = at(node[rest[0]], rest[1:])
        elif value is ...:
            del node[rest[0]]
        else:
            node[rest[0]] = value
        return node

    return at(SOUND, path)


PROBLEMS = {
    "no flags": (["flags"], ..., "flags: missing"),
    "unknown part": (["rules"], [], "rules: unknown"),
    "flag lost": (["flags", "is_hot_day"], ..., "flags: is_hot_day is missing"),
    "flag name": (["flags", "wet"], ["rain_mm", ">", 1], "flags.wet: must be named is_<kind>_day"),
    "flag of a flag": (["flags", "is_odd_day"], ["is_hot_day"], "is_hot_day is not a numeric column"),
    "unknown metric": (["severity", 1, 0], "wind", "severity[1]: no column wind"),
    "text metric": (["severity", 1, 0], "city", "severity[1]: city is not a numeric column"),
    "operator": (["severity", 1, 1], "!=", "severity[1]: unknown operator '!='"),
    "value": (["severity", 1, 2], "forty", "severity[1]: 'forty' is not a number"),
    "boolean value": (["severity", 1, 2], True, "severity[1]: True is not a number"),
    "nan": (["severity", 1, 2], float("nan"), "severity[1]: nan is not a number"),
    "half a test": (["severity", 1], ["max_temp_c", ">"], "severity[1]: must be [flag] or"),
    "number as flag": (["severity", 0], ["rain_mm"], "severity[0]: rain_mm is not a flag"),
    "no triggers": (["risks", 0, "triggers"], [], "risks[0].triggers: must not be empty"),
    "risk lacks": (["risks", 0, "metric"], ..., "risks[0]: metric is missing"),
    "risk metric": (["risks", 0, "metric"], "is_hot_day", "is_hot_day is not a numeric column"),
    "risk part": (["risks", 0, "colour"], "red", "risks[0]: colour is unknown"),
    "risk type": (["risks", 0, "risk_type"], "", "risks[0].risk_type: must be a text"),
    "repeated type": (["risks"], SOUND["risks"] * 2, "risks: HOT_DAY occurs 2 times"),
}


@pytest.mark.parametrize("case", PROBLEMS)
def test_a_faulty_configuration_is_refused(case):
    path, value, told = PROBLEMS[case]
    with pytest.raises(ValueError) as error:
        RuleSet.from_mapping(changed(path, value))
    assert told in str(error.value)


def test_all_problems_come_in_one_error():
    faulty = changed(["severity"], [["wind", ">", 1], ["max_temp_c", "!", "x"], 7])
    faulty["risks"] = "none"
    found = rule_problems(faulty)
    assert len(found) == 5
    with pytest.raises(ValueError, match=r"risks: .*severity.0.*severity.1.*severity.1.*severity.2."):
        RuleSet.from_mapping(faulty)


def test_empty_lists_are_defined(silver):
    rules = RuleSet.from_mapping({**SOUND, "severity": [], "risks": []})
    scored = to_daily(silver, rules)
    assert {r.weather_severity_score for r in scored.collect()} == {0}
    risk = to_risk(silver, rules)
    assert risk.count() == 0
    assert [(f.name, f.dataType) for f in risk.schema] == [
        (f.name, f.dataType) for f in schemas.RISK
    ]
    assert rule_problems(SOUND) == []
