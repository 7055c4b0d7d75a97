from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.operators import profiles
from skyledger.operators.gold import to_daily, to_monthly, to_risk
from skyledger.plans.registry import QUERIES

SF = "/root/testdata/sf0.01"


def test_raw_profile_leaves_out_unnamed_cities(raw):
    assert [tuple(r) for r in profiles.raw_by_city(raw).collect()] == [
        ("Austin", 5, "2024-01-01", "2024-01-05"),
        ("New York", 1, "2024-02-29", "2024-02-29"),
    ]


def test_silver_and_daily_profiles(silver):
    by_city = profiles.silver_by_city(silver).drop("city", "min_date", "max_date")
    assert [tuple(r) for r in by_city.collect()] == [(5, 3, 3, 2), (1, 0, 0, 0)]
    scores = profiles.daily_by_city(to_daily(silver)).collect()
    assert [r.avg_severity for r in scores] == [2.0, 0.0]


def test_yearly_rollup_averages_months_not_days(spark):
    months = [("A", 2024, 1, 10.0, 1.111), ("A", 2024, 2, 20.01, 2.222)]
    columns = (
        "city string, year int, month int, "
        "avg_mean_temp_c double, total_precipitation_mm double"
    )
    monthly = spark.createDataFrame(months, columns)
    assert tuple(profiles.monthly_by_year(monthly).first()) == ("A", 2024, 2, 15.01, 3.33)


def test_risk_profiles(silver):
    risk = to_risk(silver)
    assert [tuple(r) for r in profiles.risk_by_type(risk).collect()] == [
        ("FREEZING", 2),
        ("HEAVY_RAIN", 2),
        ("HOT_DAY", 2),
        ("STRONG_WIND", 3),
    ]
    assert [tuple(r) for r in profiles.risk_by_city(risk).collect()] == [("Austin", 9)]


def test_duplicate_keys(silver):
    doubled = silver.unionByName(silver.filter("city = 'New York'"))
    assert [r.cnt for r in profiles.duplicate_keys(doubled, schemas.DAILY_KEY).collect()] == [2]


def test_row_counts_and_preview(silver):
    counts = profiles.row_counts({"silver": silver, "none": silver.limit(0)})
    assert sorted(map(tuple, counts.collect())) == [("none", 0), ("silver", 6)]
    assert [r.month for r in profiles.preview(silver, 1, "month").collect()] == [1]
    assert profiles.preview(silver, 2).count() == 2


def test_invariants_on_the_given_tables(spark):
    daily = QUERIES["gold_daily"](spark, SF).cache()
    monthly = QUERIES["gold_monthly"](spark, SF)
    flags = daily.agg(
        F.count_if("is_rainy_day").alias("rainy"),
        F.count_if("is_hot_day").alias("hot"),
        F.count_if("is_freezing_day").alias("freezing"),
        F.min("weather_severity_score").alias("least"),
        F.max("weather_severity_score").alias("most"),
    ).first()
    assert (flags.least, flags.most) == (0, 4)
    assert (flags.rainy, flags.hot, flags.freezing) == (51009, 18355, 14237)
    days = monthly.agg(F.sum("rainy_days"), F.sum("hot_days"), F.sum("freezing_days"))
    assert tuple(days.first()) == (flags.rainy, flags.hot, flags.freezing)
    assert monthly.count() == 8261 and daily.count() == 53307
    daily.unpersist()
    events = {r.risk_type: r.event_count for r in QUERIES["risk_by_type"](spark, SF).collect()}
    assert events == {
        "HOT_DAY": 12712,
        "FREEZING": 14237,
        "HEAVY_RAIN": 36148,
        "STRONG_WIND": 20806,
    }


def test_gold_is_identical_on_every_run(spark):
    def monthly():
        return sorted(map(tuple, QUERIES["gold_monthly"](spark, SF).collect()), key=repr)

    first = monthly()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert monthly() == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_monthly_contract_matches_columns(silver):
    assert to_monthly(silver).columns == schemas.MONTHLY.names
