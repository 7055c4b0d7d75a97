"""Raw observations derived from ``lineitem`` and ``supplier``.

One supplier is one station, one ship date is one day. Only max and min are
used, so every engine derives bit-identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import schemas


# The columns read, so that no file is opened only to infer a schema.
SUPPLIER = "s_suppkey BIGINT, s_name STRING"
LINEITEM = (
    "l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_discount DOUBLE, "
    "l_tax DOUBLE, l_shipdate TIMESTAMP_NTZ"
)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City dimension: a name and coordinates per supplier."""
    key = F.col("s_suppkey").cast("double")
    return spark.read.schema(SUPPLIER).parquet(f"{sf_dir}/supplier.parquet").select(
        "s_suppkey",
        F.col("s_name").alias("city"),
        key.alias("latitude"),
        (-key).alias("longitude"),
    )


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows, one per station and day.

    Aggregated before the join: the exchange carries numbers only, is keyed by
    station *and* day, and leaves at most one row per day of a station, so a
    station with a large share of all rows skews neither step. Whether the
    station side is broadcast is left to its size.
    """
    q_max, q_min = F.col("q_max"), F.col("q_min")
    # Written so that the optimizer can tell the text is null only where the date
    # is: a later "time is not null" then reaches the scan as a test of the date,
    # instead of formatting the date of every input row.
    day = F.col("l_shipdate")
    text = F.coalesce(day.cast("date").cast("string"), F.lit(""))
    time = F.when(day.isNotNull(), text).otherwise(None)
    days = (
        spark.read.schema(LINEITEM)
        .parquet(f"{sf_dir}/lineitem.parquet")
        .groupBy("l_suppkey", "l_shipdate")
        .agg(
            F.max("l_quantity").alias("q_max"),
            F.min("l_quantity").alias("q_min"),
            F.max("l_discount").alias("discount"),
            F.max("l_tax").alias("tax"),
            F.max("l_linenumber").alias("line"),
        )
    )
    return days.join(stations(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey")).select(
        time.alias("time"),
        (q_max - 5.0).alias("temperature_2m_max"),
        (q_min - 12.0).alias("temperature_2m_min"),
        ((q_max + q_min) / 2.0 - 8.5).alias("temperature_2m_mean"),
        (F.col("discount") * 600.0).alias("precipitation_sum"),
        (F.col("discount") * 500.0).alias("rain_sum"),
        (F.col("discount") * 10.0).alias("snowfall_sum"),
        F.when(F.col("line") == 7, None)
        .otherwise(F.col("tax") * 800.0)
        .alias("wind_speed_10m_max"),
        "city",
        "latitude",
        "longitude",
    )


def as_documents(raw: DataFrame) -> DataFrame:
    """(city, payload) documents, one per station and month.

    A document holds at most the days of one month, however much of the data a
    single station has.
    """
    month = F.substring("time", 1, 7)
    days = F.array_sort(F.collect_list(F.struct("time", *schemas.METRICS)))
    arrays = [F.col(f"days.{name}").alias(name) for name in ("time", *schemas.METRICS)]
    return (
        raw.groupBy("city", month.alias("month"))
        .agg(days.alias("days"))
        .select("city", F.to_json(F.struct(F.struct(*arrays).alias("daily"))).alias("payload"))
    )
