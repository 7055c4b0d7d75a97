"""Registered queries. Each derives its input from the tables in ``sf_dir``."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import contracts, schemas
from skyledger.functions.dates import is_iso_date
from skyledger.functions.rules import DRY, STANDARD, WINDY, RuleSet
from skyledger.operators import lookups, profiles, quality
from skyledger.operators.gold import (
    by_key,
    to_daily,
    to_monthly,
    to_risk,
    to_yearly,
    with_created_at,
)
from skyledger.operators.layers import to_bronze, to_silver
from skyledger.plans.batch import (
    RESULTS_NAME,
    VERDICT_NAME,
    build_layers,
    check_layers,
    publish_if_passed,
    run,
)
from skyledger.session import drop_scratch, remembered, scratch_path, tidy_session
from skyledger.sinks import tables
from skyledger.sinks.publish import PERIOD, publish, publish_snapshot
from skyledger.sources import payloads
from skyledger.sources.csv import (
    LINE,
    quarantine,
    read_raw,
    sound,
    stream_raw,
    unreadable_counts,
    write_raw,
)
from skyledger.sources.shipments import as_documents, stations
from skyledger.sources.shipments import raw_observations as _raw
from skyledger.streaming.continuous import read_target, start

# Parameters of the registered lookups.
CITY, FROM, TO, YEAR = "Supplier#000000007", "1997-03-01", "1998-09-30", 1998

# Silver without the run's own timestamp: what two runs have in common.
SILVER_STABLE = [name for name in schemas.SILVER.names if name != "ingestion_timestamp"]

# A rule set as configuration, with thresholds other than the standard ones.
CONFIGURED = RuleSet.from_mapping(
    json.loads("""{
      "flags": {"is_rainy_day": ["precipitation_mm", ">", 12.0],
                "is_hot_day": ["max_temp_c", ">=", 25.0],
                "is_freezing_day": ["min_temp_c", "<=", -5.0]},
      "severity": [["is_rainy_day"], ["is_hot_day"], ["is_freezing_day"],
                   ["max_wind_speed_kmh", ">", 24.0]],
      "risks": [{"risk_type": "HOT_DAY", "metric": "max_temp_c",
                 "triggers": [["max_temp_c", ">=", 38.0]],
                 "high": ["max_temp_c", ">=", 44.0],
                 "description": "Max temp >= 38 C"},
                {"risk_type": "FREEZING", "metric": "min_temp_c",
                 "triggers": [["is_freezing_day"]],
                 "high": ["min_temp_c", "<=", -9.0],
                 "description": "Min temp <= -5 C"}]
    }""")
)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(_raw(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str, rules: RuleSet = STANDARD) -> DataFrame:
    return to_silver(_bronze(spark, sf_dir), rules=rules)


def _daily(spark: SparkSession, sf_dir: str, rules: RuleSet = STANDARD) -> DataFrame:
    return to_daily(_silver(spark, sf_dir, rules), rules)


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_monthly(_silver(spark, sf_dir))


def _risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_risk(_silver(spark, sf_dir))


def _warehouse(spark: SparkSession) -> tables.Warehouse:
    """A namespace of its own, in a fresh scratch folder."""
    place = scratch_path(spark, "warehouse")
    wh = tables.Warehouse(namespace="run_" + place.rsplit("-", 1)[1], location=place)
    tables.create_namespace(spark, wh)
    return wh


def _stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back, for queries that go over it repeatedly."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_GOLD = {
    schemas.DAILY_NAME: _daily,
    schemas.MONTHLY_NAME: _monthly,
    schemas.RISK_NAME: _risk,
}


def _publish_gold(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The serving copy of a gold table, after its layer has been written."""
    wh = _warehouse(spark)
    tables.write_layer(_GOLD[source](spark, sf_dir), wh, source)
    return publish(spark, wh, [source])[schemas.SERVING[source][0]]


def served(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The serving copy of a gold table; published once, until the scratch is cleared."""
    kept = remembered(spark)
    if (sf_dir, source) not in kept:
        kept[sf_dir, source] = _publish_gold(spark, sf_dir, source)
    return kept[sf_dir, source]


# --- layers ------------------------------------------------------------------


def bronze_audit(spark, sf_dir):
    return _bronze(spark, sf_dir).drop("ingestion_timestamp")


def silver_clean(spark, sf_dir):
    return _silver(spark, sf_dir).select(*SILVER_STABLE)


def gold_daily(spark, sf_dir):
    return _daily(spark, sf_dir)


def gold_monthly(spark, sf_dir):
    return by_key(_monthly(spark, sf_dir), schemas.MONTHLY_KEY)


def gold_risk(spark, sf_dir):
    return _risk(spark, sf_dir)


# --- profiles ----------------------------------------------------------------


def profile_raw_city(spark, sf_dir):
    return profiles.raw_by_city(_raw(spark, sf_dir))


def profile_silver_city(spark, sf_dir):
    return profiles.silver_by_city(_silver(spark, sf_dir))


def profile_daily_city(spark, sf_dir):
    return profiles.daily_by_city(_daily(spark, sf_dir))


def yearly_rollup(spark, sf_dir):
    return profiles.monthly_by_year(_monthly(spark, sf_dir))


def risk_by_type(spark, sf_dir):
    return profiles.risk_by_type(_risk(spark, sf_dir))


def risk_by_city(spark, sf_dir):
    return profiles.risk_by_city(_risk(spark, sf_dir))


def preview_limit(spark, sf_dir):
    return profiles.preview(_daily(spark, sf_dir), 10, *schemas.DAILY_KEY)


# --- lookups -----------------------------------------------------------------


def list_cities(spark, sf_dir):
    return lookups.list_cities(served(spark, sf_dir, schemas.DAILY_NAME))


def daily_range(spark, sf_dir):
    return lookups.daily_range(served(spark, sf_dir, schemas.DAILY_NAME), CITY, FROM, TO)


def daily_range_meta(spark, sf_dir):
    return lookups.daily_range_meta(served(spark, sf_dir, schemas.DAILY_NAME), CITY, FROM, TO)


# --- contracts and quality ---------------------------------------------------


def observed_layers(raw: DataFrame) -> tuple[DataFrame, dict]:
    """Raw to risk as one narrow plan, the missing values of each layer counted on the way.

    Daily rows have all that the risks are told by, so the risks go over them.
    """
    counted: dict = {}

    def observed(df: DataFrame, layer: str) -> DataFrame:
        df, counted[layer] = contracts.missing_observed(df, schemas.LAYERS[layer].names)
        return df

    bronze = observed(to_bronze(observed(raw, schemas.RAW_NAME)), schemas.BRONZE_NAME)
    silver = observed(to_silver(bronze), schemas.SILVER_NAME)
    daily = observed(to_daily(silver), schemas.DAILY_NAME)
    return observed(to_risk(daily), schemas.RISK_NAME), counted


def data_dictionary(spark, sf_dir):
    """The dictionary, with the missing values each column really has.

    One scan counts those of all layers but monthly, which aggregates.
    """
    raw = _stored(_raw(spark, sf_dir), "raw")
    risk, counted = observed_layers(raw)
    risk.write.format("noop").mode("overwrite").save()
    found = [
        (layer, column, n) for layer, counts in counted.items() for column, n in counts.get.items()
    ]
    names = schemas.MONTHLY.names
    monthly = contracts.missing_counts(to_monthly(to_silver(to_bronze(raw))), names)
    missing = spark.createDataFrame(found, "layer STRING, column_name STRING, missing BIGINT")
    return contracts.data_dictionary(spark).join(
        missing.unionByName(
            monthly.unpivot([], names, "column_name", "missing").withColumn(
                "layer", F.lit(schemas.MONTHLY_NAME)
            )
        ),
        ["layer", "column_name"],
    )


def raw_nulls(spark, sf_dir):
    return contracts.missing_counts(_raw(spark, sf_dir), schemas.RAW.names)


def null_counts(spark, sf_dir):
    return contracts.missing_counts(_daily(spark, sf_dir), schemas.DAILY.names)


def duplicate_keys(spark, sf_dir):
    """Keys that repeat once the January rows are added a second time."""
    daily = _daily(spark, sf_dir)
    january = daily.filter(F.month("weather_date") == 1)
    return profiles.duplicate_keys(payloads.concat(daily, january), schemas.DAILY_KEY)


def iso_date_rows(spark, sf_dir):
    """Date texts, some spoiled: 13ths use slashes, 30ths become 31sts."""
    time = F.col("time")
    spoiled = (
        F.when(time.endswith("-13"), F.replace(time, F.lit("-"), F.lit("/")))
        .when(time.endswith("-30"), F.concat(F.substring(time, 1, 8), F.lit("31")))
        .otherwise(time)
    )
    iso = is_iso_date(F.col("time"))
    return (
        _raw(spark, sf_dir)
        .select("city", spoiled.alias("time"))
        .select(
            "city",
            "time",
            iso.alias("is_iso"),
            F.when(iso, F.col("time").try_cast("date")).alias("weather_date"),
        )
    )


def _checked(spark: SparkSession, frames: dict[str, DataFrame], **options) -> DataFrame:
    return quality.results_frame(spark, quality.run_checks(frames.__getitem__, **options))


def _silver_and_facts(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict]:
    """Silver stored, the gold frames over it, and what was counted while it was written."""
    silver, observation = quality.observed(_silver(spark, sf_dir), schemas.SILVER_NAME)
    silver = _stored(silver, "silver")
    frames = {
        schemas.SILVER_NAME: silver,
        schemas.DAILY_NAME: to_daily(silver),
        schemas.MONTHLY_NAME: to_monthly(silver),
        schemas.RISK_NAME: to_risk(silver),
    }
    return frames, {schemas.SILVER_NAME: observation.get}


def dq_results(spark, sf_dir):
    frames, measured = _silver_and_facts(spark, sf_dir)
    return _checked(spark, frames, measured=measured)


def dq_faults(spark, sf_dir):
    """The checks on spoiled tables: null dates in March, daily with a column too
    few, one too many, one retyped and January twice, no monthly rows, and the
    HIGH risks twice."""
    silver = _stored(_silver(spark, sf_dir), "silver")
    date = F.col("weather_date")
    daily = to_daily(silver)
    risk = to_risk(silver)
    spoiled_daily = (
        payloads.concat(daily, daily.filter(F.month(date) == 1))
        .drop("rain_mm")
        .withColumn("humidity", F.lit(None).cast("double"))
        .withColumn("snowfall_cm", F.col("snowfall_cm").cast("float"))
    )
    return _checked(
        spark,
        {
            schemas.SILVER_NAME: silver.withColumn(
                "weather_date", F.when(F.month(date) != 3, date)
            ),
            schemas.DAILY_NAME: spoiled_daily,
            schemas.MONTHLY_NAME: to_monthly(silver).filter(F.col("month") > 12),
            schemas.RISK_NAME: payloads.concat(risk, risk.filter("risk_level = 'HIGH'")),
        },
    )


# --- sources and sinks -------------------------------------------------------


def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_raw(_raw(spark, sf_dir), path)
    return read_raw(spark, path)


def city_dimension(spark, sf_dir):
    """Cities, coordinates and how many days each has."""
    days = _raw(spark, sf_dir).groupBy("city").agg(F.count(F.lit(1)).alias("days"))
    cities = stations(spark, sf_dir).drop("s_suppkey")
    return cities.join(days, "city", "left").withColumn(
        "days", F.coalesce("days", F.lit(0)).cast("bigint")
    )


def json_flatten(spark, sf_dir):
    return payloads.flatten(as_documents(_raw(spark, sf_dir)), stations(spark, sf_dir))


def payload_union(spark, sf_dir):
    """Documents written to two folders, read back in one scan and flattened."""
    documents = _stored(as_documents(_raw(spark, sf_dir)), "documents")
    first = F.crc32(F.col("city").cast("binary")) % 2 == 0
    paths = []
    for part in (documents.filter(first), documents.filter(~first)):
        paths.append(scratch_path(spark, "payloads"))
        part.write.json(paths[-1])
    return payloads.flatten(payloads.read_documents(spark, *paths), stations(spark, sf_dir))


def table_counts(spark, sf_dir):
    """Rows of every stored layer after a full build."""
    return profiles.row_counts(build_layers(_raw(spark, sf_dir), _warehouse(spark)))


def ensure_table(spark, sf_dir):
    """Created empty, filled, and left alone when ensured again."""
    wh = _warehouse(spark)
    tables.ensure_table(spark, wh, schemas.DAILY_NAME, schemas.DAILY)
    tables.write_layer(_daily(spark, sf_dir), wh, schemas.DAILY_NAME)
    return tables.ensure_table(spark, wh, schemas.DAILY_NAME, schemas.DAILY)


def overwrite_table(spark, sf_dir):
    """Rows and schema of a table that held something else before."""
    wh = _warehouse(spark)
    tables.overwrite_table(_raw(spark, sf_dir), wh, schemas.MONTHLY_NAME)
    return tables.write_layer(_monthly(spark, sf_dir), wh, schemas.MONTHLY_NAME)


def snapshot_publish(spark, sf_dir):
    """Serving copy after two publishes; the second replaces the first."""
    wh = _warehouse(spark)
    daily = tables.write_layer(_daily(spark, sf_dir), wh, schemas.DAILY_NAME)
    target, key = schemas.SERVING[schemas.DAILY_NAME]
    tables.overwrite_table(daily.filter(F.month("weather_date") == 1), wh, "january")
    publish_snapshot(spark, wh, "january", target, key)
    serving = publish_snapshot(spark, wh, schemas.DAILY_NAME, target, key)
    return serving.select(*schemas.DAILY.names)


def publish_monthly(spark, sf_dir):
    """The serving copy of the monthly summaries, cut by city."""
    return served(spark, sf_dir, schemas.MONTHLY_NAME).select(*schemas.MONTHLY.names)


def publish_risk(spark, sf_dir):
    """The serving copy of the risk events, cut by city."""
    return served(spark, sf_dir, schemas.RISK_NAME).select(*schemas.RISK.names)


def gated_publish(spark, sf_dir):
    """What is served after a bad run and then a good one, with both verdicts.

    Between the two nothing may be served: the bad verdict covers doubled keys.
    """
    raw, wh = _stored(_raw(spark, sf_dir), "raw"), _warehouse(spark)
    target = schemas.SERVING[schemas.DAILY_NAME][0]
    verdicts = []
    for attempt, rows in enumerate((payloads.concat(raw, raw), raw), start=1):
        build_layers(rows, wh)
        check_layers(spark, wh)
        published = publish_if_passed(spark, wh)
        days = spark.table(wh.name(target)).count() if tables.table_exists(spark, wh.name(target)) else 0
        # Read now: the next run replaces the table.
        verdict = spark.table(wh.name(VERDICT_NAME)).first()
        verdicts.append((attempt, *verdict, published, days))
    return spark.createDataFrame(
        verdicts,
        "attempt INT, dq_passed BOOLEAN, passed INT, total INT, published BOOLEAN, served_rows BIGINT",
    )


def windy_pipeline(spark, sf_dir):
    """Daily rows re-read from the tables of a whole run with the windy rules."""
    wh = _warehouse(spark)
    run(_raw(spark, sf_dir), wh, rules=WINDY, severity_check=True)
    target = schemas.SERVING[schemas.DAILY_NAME][0]
    return spark.table(wh.name(target)).drop(PERIOD)


def windy_verdict(spark, sf_dir):
    """The eleven stored results of such a run."""
    wh = _warehouse(spark)
    build_layers(_raw(spark, sf_dir), wh, rules=WINDY)
    check_layers(spark, wh, WINDY, severity_check=True)
    return spark.table(wh.name(RESULTS_NAME))


def _spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows as texts: on 13ths no maximum is a number, on 30ths wind and rain are not,
    and 31sts end in one field too many."""
    day = F.substring("time", 9, 2)
    text = _raw(spark, sf_dir).select(
        *(F.coalesce(F.col(f.name).cast("string"), F.lit("")).alias(f.name) for f in schemas.RAW)
    )
    spoiled = {
        "temperature_2m_max": F.when(day == "13", "n/a"),
        "wind_speed_10m_max": F.when(day == "30", "calm"),
        "rain_sum": F.when(day == "30", "trace"),
        "longitude": F.when(day == "31", F.concat("longitude", F.lit(",?"))),
    }
    return text.withColumns({name: F.coalesce(bad, F.col(name)) for name, bad in spoiled.items()})


def _marked_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spoiled rows written as lines of CSV files and read back with marks."""
    path = scratch_path(spark, "spoiled")
    rows = _spoiled(spark, sf_dir)
    header = ",".join(schemas.RAW.names)
    # Fields hold no commas or quotes; the header option of the text writer is a CSV column name.
    line = F.concat_ws(",", *schemas.RAW.names).alias(header)
    rows.select(line).write.option("header", True).option("quote", "").option("sep", "\t").csv(path)
    return read_raw(spark, path, on_bad="mark")


def csv_bad_rows(spark, sf_dir):
    """What is left of each raw row after spoiling, with its unreadable fields and, for a
    bad row, its line."""
    raw = _marked_csv(spark, sf_dir)
    told = ["time", "city", "temperature_2m_max", "rain_sum", "wind_speed_10m_max"]
    good = sound(raw).select(*told, F.lit("").alias("unreadable"), F.lit(None).cast("string").alias("line"))
    bad = quarantine(raw).select(
        *told, F.array_join("unreadable", ",").alias("unreadable"), F.col(LINE).alias("line")
    )
    return payloads.concat(good, bad)


def csv_bad_fields(spark, sf_dir):
    """Per field, in how many of the spoiled rows it cannot be read."""
    return unreadable_counts(_marked_csv(spark, sf_dir))


def continuous_publish(spark, sf_dir):
    """Serving copy after a stream of files that come out of order.

    First all rows with a wrong January, then January corrected; last a file that is older
    than both and wrong everywhere, and one whose rows cannot be read. Then everything once
    more from a fresh checkpoint, in other batches.

    All deliveries are on disk at once, so they are compressed, and a station's rows stand
    together in them; what is not read again is deleted.
    """
    tidy, place = tidy_session(spark), scratch_path(spark, "raw")
    _raw(tidy, sf_dir).sortWithinPartitions("city", "time").write.parquet(place)
    raw = tidy.read.schema(schemas.RAW).parquet(place)
    january = F.substring("time", 6, 2) == "01"
    high = F.col("temperature_2m_max") + 50
    incoming, target = scratch_path(spark, "incoming"), scratch_path(spark, "target")
    work, again = scratch_path(spark, "stream"), scratch_path(spark, "replay")
    # A delivery's folder names the time it was made at; that orders the rows.
    made_at = F.regexp_extract("_metadata.file_path", "made_at=([0-9]+)", 1).cast("bigint")
    ingested_at = F.timestamp_seconds(made_at)

    def deliver(rows: DataFrame, at: int) -> None:
        rows.write.option("header", True).option("compression", "gzip").csv(f"{incoming}/made_at={at}")

    def copy(checkpoint: str, files: int) -> None:
        stream = stream_raw(spark, f"{incoming}/*", files, on_bad="mark")
        start(stream, target, checkpoint, available_now=True, ingested_at=ingested_at).awaitTermination()

    wrong = F.when(january, high).otherwise(F.col("temperature_2m_max"))
    deliver(raw.withColumn("temperature_2m_max", wrong), 1_700_000_200)
    copy(work, 1000)
    deliver(raw.filter(january), 1_700_000_300)
    copy(work, 1000)
    deliver(raw.withColumn("temperature_2m_max", high), 1_700_000_100)
    deliver(raw.filter(~january).withColumn("temperature_2m_max", F.lit("n/a")), 1_700_000_400)
    drop_scratch(spark, place)
    copy(work, 1000)
    copy(again, 3)
    drop_scratch(spark, incoming)
    return read_target(spark, target).select(*schemas.DAILY.names)


# --- optional rules and lookups ----------------------------------------------


def windy_days(spark, sf_dir):
    return profiles.silver_by_city(_silver(spark, sf_dir, WINDY), WINDY)


def severity_windy(spark, sf_dir):
    return _daily(spark, sf_dir, WINDY)


def monthly_windy(spark, sf_dir):
    return to_monthly(_silver(spark, sf_dir, WINDY), WINDY)


def severity_check(spark, sf_dir):
    frames, measured = _silver_and_facts(spark, sf_dir)
    return _checked(spark, frames, measured=measured, severity_check=True).filter("check_id = 11")


def dry_day_risk(spark, sf_dir):
    return to_risk(_silver(spark, sf_dir), DRY)


def risk_created(spark, sf_dir):
    """Risk rows with their creation time, reduced to whether it is set."""
    return with_created_at(_risk(spark, sf_dir)).withColumn(
        "created_at", F.col("created_at").isNotNull()
    )


def yearly_summary(spark, sf_dir):
    return to_yearly(_silver(spark, sf_dir))


def yearly_table(spark, sf_dir):
    """The yearly summary as served after a whole run that stores, checks and publishes it."""
    wh = _warehouse(spark)
    run(_raw(spark, sf_dir), wh, yearly=True, publish_tables=(schemas.YEARLY_NAME,))
    return spark.table(wh.name(schemas.ALL_SERVING[schemas.YEARLY_NAME][0])).select(*schemas.YEARLY.names)


def risk_created_table(spark, sf_dir):
    """The risks as served after a run that stores their creation time, reduced to whether
    it is set."""
    wh = _warehouse(spark)
    run(_raw(spark, sf_dir), wh, created_at=True, publish_tables=(schemas.RISK_NAME,))
    risk = spark.table(wh.name(schemas.SERVING[schemas.RISK_NAME][0]))
    return risk.select(*schemas.RISK.names, F.col(schemas.CREATED_AT).isNotNull().alias("created_at"))


def monthly_lookup(spark, sf_dir):
    return lookups.monthly_of_year(served(spark, sf_dir, schemas.MONTHLY_NAME), CITY, YEAR)


def risks_lookup(spark, sf_dir):
    return lookups.risks_of_city(served(spark, sf_dir, schemas.RISK_NAME), CITY)


def risks_lookup_type(spark, sf_dir):
    return lookups.risks_of_city(served(spark, sf_dir, schemas.RISK_NAME), CITY, "HEAVY_RAIN")


def daily_configured(spark, sf_dir):
    return _daily(spark, sf_dir, CONFIGURED)


def risk_configured(spark, sf_dir):
    return to_risk(_silver(spark, sf_dir, CONFIGURED), CONFIGURED)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        bronze_audit,
        silver_clean,
        gold_daily,
        gold_monthly,
        gold_risk,
        profile_raw_city,
        profile_silver_city,
        profile_daily_city,
        yearly_rollup,
        risk_by_type,
        risk_by_city,
        preview_limit,
        list_cities,
        daily_range,
        daily_range_meta,
        data_dictionary,
        raw_nulls,
        null_counts,
        duplicate_keys,
        iso_date_rows,
        dq_results,
        dq_faults,
        csv_round_trip,
        csv_bad_rows,
        csv_bad_fields,
        city_dimension,
        json_flatten,
        payload_union,
        table_counts,
        ensure_table,
        overwrite_table,
        snapshot_publish,
        publish_monthly,
        publish_risk,
        gated_publish,
        windy_pipeline,
        windy_verdict,
        continuous_publish,
        windy_days,
        severity_windy,
        monthly_windy,
        severity_check,
        dry_day_risk,
        risk_created,
        yearly_summary,
        yearly_table,
        risk_created_table,
        monthly_lookup,
        risks_lookup,
        risks_lookup_type,
        daily_configured,
        risk_configured,
    )
}
