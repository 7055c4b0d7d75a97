"""Column contracts of every layer, and the key each layer is unique on.

Column names, types, order and table names are fixed values: stored tables and
the consumers of the lookups depend on them.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

METRICS = (
    "temperature_2m_max",
    "temperature_2m_min",
    "temperature_2m_mean",
    "precipitation_sum",
    "rain_sum",
    "snowfall_sum",
    "wind_speed_10m_max",
)


def contract(columns: str) -> StructType:
    """A schema from ``name type`` pairs; ``!`` marks a column never null."""
    schema = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        schema.add(name, kind.rstrip("!"), nullable=not kind.endswith("!"))
    return schema


_OBSERVED = f"""
    time string, {", ".join(f"{name} double" for name in METRICS)},
    city string, latitude double, longitude double
"""
_AUDIT = "source string!, ingestion_timestamp timestamp!"

RAW = contract(_OBSERVED)
BRONZE = contract(f"{_OBSERVED}, {_AUDIT}")
SILVER = contract(f"""
    city string, weather_date date, year integer, month integer, day_of_week integer,
    latitude double, longitude double,
    max_temp_c double, min_temp_c double, mean_temp_c double,
    temperature_range_c double,
    precipitation_mm double, rain_mm double, snowfall_cm double,
    max_wind_speed_kmh double,
    is_rainy_day boolean, is_hot_day boolean, is_freezing_day boolean,
    {_AUDIT}
""")
DAILY = contract("""
    city string, weather_date date,
    max_temp_c double, min_temp_c double, mean_temp_c double,
    precipitation_mm double, rain_mm double, snowfall_cm double,
    max_wind_speed_kmh double,
    is_rainy_day boolean, is_hot_day boolean, is_freezing_day boolean,
    weather_severity_score integer!
""")
MONTHLY = contract("""
    city string, year integer, month integer,
    avg_mean_temp_c double, max_temp_c double, min_temp_c double,
    total_precipitation_mm double,
    rainy_days long, hot_days long, freezing_days long,
    avg_wind_speed_kmh double
""")
RISK = contract("""
    city string, weather_date date,
    risk_type string!, risk_level string!,
    metric_value double, description string!
""")
YEARLY = contract("""
    city string, year integer,
    avg_mean_temp_c double, max_temp_c double, min_temp_c double,
    total_precipitation_mm double,
    rainy_days long, hot_days long, freezing_days long,
    avg_wind_speed_kmh double
""")
CREATED_AT = "created_at"  # optional column of RISK

# Table names (fixed values).
RAW_NAME = "raw_weather_csv"
BRONZE_NAME = "bronze_weather_daily_raw"
SILVER_NAME = "silver_weather_daily_clean"
DAILY_NAME = "gold_city_daily_weather_metrics"
MONTHLY_NAME = "gold_city_monthly_weather_summary"
RISK_NAME = "gold_weather_risk_days"
YEARLY_NAME = "gold_city_yearly_weather_summary"  # optional, not among TABLES

LAYERS = {
    RAW_NAME: RAW,
    BRONZE_NAME: BRONZE,
    SILVER_NAME: SILVER,
    DAILY_NAME: DAILY,
    MONTHLY_NAME: MONTHLY,
    RISK_NAME: RISK,
}
TABLES = {name: schema for name, schema in LAYERS.items() if name != RAW_NAME}

DAILY_KEY = ("city", "weather_date")
MONTHLY_KEY = ("city", "year", "month")
RISK_KEY = ("city", "weather_date", "risk_type")
YEARLY_KEY = ("city", "year")

# Gold table -> (serving copy, primary key). Names are fixed values.
SERVING = {
    DAILY_NAME: ("weather_daily_metrics", DAILY_KEY),
    MONTHLY_NAME: ("weather_monthly_summary", MONTHLY_KEY),
    RISK_NAME: ("weather_risk_days", RISK_KEY),
}

# How the serving copies are cut (see ``sinks.publish``): by what lookups name.
SERVING_LAYOUT = {
    DAILY_NAME: "month",
    MONTHLY_NAME: "city",
    RISK_NAME: "city",
}

# The same with the tables that only some runs store.
ALL_SERVING = {**SERVING, YEARLY_NAME: ("weather_yearly_summary", YEARLY_KEY)}
ALL_LAYOUTS = {**SERVING_LAYOUT, YEARLY_NAME: "city"}
