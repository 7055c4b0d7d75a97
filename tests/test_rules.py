import json

from pyspark.sql import functions as F

from skyledger.functions.rules import DRY, STANDARD, WINDY, RuleSet
from skyledger.operators.gold import to_daily, to_monthly, to_risk, with_created_at
from skyledger.operators.layers import to_bronze, to_silver
from skyledger.operators.profiles import silver_by_city


def as_config(rules):
    def test(t):
        return [t.metric] if t.op is None else [t.metric, t.op, t.value]

    return {
        "flags": {name: test(t) for name, t in rules.flags.items()},
        "severity": [test(t) for t in rules.severity],
        "risks": [
            {
                "risk_type": r.risk_type,
                "metric": r.metric,
                "triggers": [test(t) for t in r.triggers],
                "high": test(r.high) if r.high else None,
                "description": r.description,
            }
            for r in rules.risks
        ],
    }


def test_rules_survive_configuration():
    for rules in (STANDARD, WINDY, DRY):
        assert RuleSet.from_mapping(json.loads(json.dumps(as_config(rules)))) == rules


def test_configured_thresholds_apply(raw, rows):
    config = as_config(STANDARD)
    config["flags"]["is_hot_day"] = ["max_temp_c", ">", 30.0]
    rules = RuleSet.from_mapping(config)
    silver = to_silver(to_bronze(raw), rules=rules)
    assert [hot for _, hot in rows(silver, "weather_date", "is_hot_day")] == [
        False,
        False,
        True,
        True,
        None,
        False,
    ]


def test_windy_days(raw, rows):
    silver = to_silver(to_bronze(raw), rules=WINDY)
    assert rows(silver_by_city(silver, WINDY), "city", "windy_days") == [
        ("Austin", 3),
        ("New York", 0),
    ]
    assert rows(to_monthly(silver, WINDY), "city", "windy_days") == [
        ("Austin", 3),
        ("New York", 0),
    ]
    scores = rows(to_daily(silver, WINDY), "weather_date", "weather_severity_score")
    assert [score for _, score in scores] == [1, 5, 2, 5, 0, 0]


def test_dry_day(silver, rows):
    dry = silver.filter("day_of_week = 4").withColumn("precipitation_mm", F.lit(0.0))
    found = rows(to_risk(dry, DRY), "risk_type", "risk_level", "metric_value")
    assert ("DRY_DAY", "MEDIUM", 35.0) in found
    assert not to_risk(silver, DRY).filter("risk_type = 'DRY_DAY'").count()


def test_created_at(silver):
    assert with_created_at(to_risk(silver)).filter("created_at IS NULL").count() == 0
