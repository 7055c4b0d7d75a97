"""JSON payloads with parallel daily arrays, flattened to raw rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import schemas

PAYLOAD_SCHEMA = "daily STRUCT<time: ARRAY<STRING>, {}>".format(
    ", ".join(f"{name}: ARRAY<DOUBLE>" for name in schemas.METRICS)
)

# City, latitude, longitude (fixed values).
CITIES = (
    ("San Francisco", 37.7749, -122.4194),
    ("New York", 40.7128, -74.0060),
    ("Seattle", 47.6062, -122.3321),
    ("Austin", 30.2672, -97.7431),
    ("Chicago", 41.8781, -87.6298),
)


def city_dimension(spark: SparkSession, cities=CITIES) -> DataFrame:
    return spark.createDataFrame(cities, "city STRING, latitude DOUBLE, longitude DOUBLE")


def keyed_cities(cities: DataFrame) -> DataFrame:
    """``cities`` with one row per city; a repeated one fails the job that meets it.

    A join on a repeated city would multiply its days. The test is part of the plan: one
    aggregation of the dimension, no job of its own.
    """
    repeated = F.concat(F.lit("city more than once in the dimension: "), F.col("city"))
    single = F.when(F.col("_n") > 1, F.raise_error(repeated).cast("boolean")).otherwise(True)
    return (
        cities.filter(F.col("city").isNotNull())
        .groupBy("city")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.first("latitude").alias("latitude"),
            F.first("longitude").alias("longitude"),
        )
        .filter(single)
        .drop("_n")
    )


def flatten(documents: DataFrame, cities: DataFrame) -> DataFrame:
    """Raw rows from (city, payload text), coordinates looked up in ``cities``.

    A document that does not parse, lacks an array or has arrays of different
    lengths fails the job: none of its days may be lost quietly, and none multiplied by a
    city that ``cities`` has twice. The lookup is a
    left join on whole documents, before they are opened, without a broadcast
    hint: Spark broadcasts ``cities`` only while its size allows.
    """
    arrays = ("time", *schemas.METRICS)
    parsed = documents.select(
        "city",
        F.from_json("payload", PAYLOAD_SCHEMA, {"mode": "FAILFAST"})["daily"].alias("daily"),
    )
    days = F.size(F.col("daily.time"))
    sound = reduce(
        and_,
        (F.col(f"daily.{a}").isNotNull() & (F.size(f"daily.{a}") == days) for a in arrays),
    )
    checked = F.when(sound, F.col("daily")).otherwise(
        F.raise_error(F.concat(F.lit("payload without equal daily arrays: "), F.col("city")))
    )
    return (
        parsed.withColumn("daily", checked)
        .join(keyed_cities(cities), "city", "left")
        .select(
            "city",
            "latitude",
            "longitude",
            F.inline(F.arrays_zip(*(F.col(f"daily.{a}").alias(a) for a in arrays))),
        )
        .select(*schemas.RAW.names)
    )


def read_documents(spark: SparkSession, *paths: str) -> DataFrame:
    """(city, payload) from JSON-lines files, all paths in one scan."""
    return spark.read.schema("city STRING, payload STRING").json(list(paths))


def concat(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, matched by column name; duplicates stay."""
    return reduce(DataFrame.unionByName, frames)
