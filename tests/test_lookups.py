import uuid

import pytest

from skyledger.operators import lookups
from skyledger.operators.gold import to_daily, to_monthly, to_risk

DAILY_COLUMNS = (
    "city weatherDate maxTempC minTempC meanTempC precipitationMm rainMm snowfallCm "
    "maxWindSpeedKmh isRainyDay isHotDay isFreezingDay weatherSeverityScore"
).split()


@pytest.fixture
def daily(silver):
    return to_daily(silver)


def test_cities(daily):
    assert lookups.list_cities(daily).collect() == [("Austin",), ("New York",)]


def test_daily_range_is_inclusive_and_sorted(daily):
    found = lookups.daily_range(daily, "Austin", "2024-01-01", "2024-01-02")
    assert found.columns == DAILY_COLUMNS
    assert [r.weatherDate for r in found.collect()] == ["2024-01-01", "2024-01-02"]
    types = dict(found.dtypes)
    assert types["weatherDate"] == "string" and types["weatherSeverityScore"] == "int"


def test_meta(daily):
    meta = lookups.daily_range_meta(daily, "Austin", "2024-01-02", "2024-12-31").first()
    assert meta.asDict() == {"city": "Austin", "from": "2024-01-02", "to": "2024-12-31", "count": 4}
    assert lookups.daily_range_meta(daily, "Oslo", "2024-01-01", "2024-01-01").first()["count"] == 0


def test_parameters_are_bound_not_spliced(daily):
    assert lookups.daily_range(daily, "x' OR '1'='1", "2024-01-01", "2024-12-31").count() == 0


@pytest.mark.parametrize(
    "parameters",
    [
        ("", "2024-01-01", "2024-01-02"),
        ("Austin", None, None),
        ("Austin", "2024-01-01", ""),
        ("Austin", "2024-02-01", "2024-01-01"),
        ("Austin", "2024-1-1", "2024-01-02"),
        ("Austin", "2024-01-01\n", "2024-01-02"),
        ("Austin", "2024-01-01", "01/02/2024"),
        ("Austin", "2024-02-30", "2024-03-01"),
        ("Austin", "٢٠٢٤-01-01", "٢٠٢٤-01-02"),
    ],
)
def test_bad_parameters_start_no_job(spark, daily, parameters):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "validation")
    try:
        for lookup in (lookups.daily_range, lookups.daily_range_meta):
            with pytest.raises(ValueError):
                lookup(daily, *parameters)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_monthly(silver):
    found = lookups.monthly_of_year(to_monthly(silver), "Austin", 2024).collect()
    assert [(r.month, r.avgMeanTempC, r.rainyDays) for r in found] == [(1, 18.13, 3)]
    with pytest.raises(ValueError, match="required: year"):
        lookups.monthly_of_year(to_monthly(silver), "Austin", None)


def test_risks(silver):
    risk = to_risk(silver)
    found = lookups.risks_of_city(risk, "Austin")
    assert found.columns == "city weatherDate riskType riskLevel metricValue description".split()
    assert found.count() == 9
    rain = lookups.risks_of_city(risk, "Austin", "HEAVY_RAIN").collect()
    assert [(r.weatherDate, r.riskLevel) for r in rain] == [
        ("2024-01-03", "MEDIUM"),
        ("2024-01-04", "HIGH"),
    ]
