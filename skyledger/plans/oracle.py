"""The registered queries in DuckDB SQL, over the same tables.

Written independently of the Spark code: one CTE chain for the layers, one
SELECT per query. Casts give DuckDB's results Spark's types.

``half_up(x)`` stands for rounding to two places the way Spark defines it for
doubles: half up on the decimal text (16.775 -> 16.78). DuckDB's own ``round``
works on the binary value (16.775 -> 16.77), so the text is rounded as a decimal.
"""

from __future__ import annotations

import re

from skyledger.plans.registry import CITY, FROM, TO, YEAR

_LAYERS = """
WITH raw AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS time,
         max(l_quantity) - 5.0 AS temperature_2m_max,
         min(l_quantity) - 12.0 AS temperature_2m_min,
         (max(l_quantity) + min(l_quantity)) / 2.0 - 8.5 AS temperature_2m_mean,
         max(l_discount) * 600.0 AS precipitation_sum,
         max(l_discount) * 500.0 AS rain_sum,
         max(l_discount) * 10.0 AS snowfall_sum,
         CASE WHEN max(l_linenumber) = 7 THEN NULL ELSE max(l_tax) * 800.0 END
           AS wind_speed_10m_max,
         s_name AS city,
         CAST(s_suppkey AS DOUBLE) AS latitude,
         -CAST(s_suppkey AS DOUBLE) AS longitude
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY s_suppkey, s_name, l_shipdate
), dated AS (
  SELECT *, CAST(time AS DATE) AS weather_date FROM raw
  WHERE city IS NOT NULL AND time IS NOT NULL
), silver AS (
  SELECT city, weather_date,
         CAST(year(weather_date) AS INTEGER) AS year,
         CAST(month(weather_date) AS INTEGER) AS month,
         CAST(dayofweek(weather_date) + 1 AS INTEGER) AS day_of_week,
         latitude, longitude,
         temperature_2m_max AS max_temp_c,
         temperature_2m_min AS min_temp_c,
         temperature_2m_mean AS mean_temp_c,
         half_up(temperature_2m_max - temperature_2m_min) AS temperature_range_c,
         precipitation_sum AS precipitation_mm,
         rain_sum AS rain_mm,
         snowfall_sum AS snowfall_cm,
         wind_speed_10m_max AS max_wind_speed_kmh,
         precipitation_sum > {rain} AS is_rainy_day,
         temperature_2m_max >= {hot} AS is_hot_day,
         temperature_2m_min <= {cold} AS is_freezing_day,
         wind_speed_10m_max >= 30 AS is_windy_day,
         'open_meteo' AS source
  FROM dated
), scored AS (
  SELECT *,
         CAST((CASE WHEN is_rainy_day THEN 1 ELSE 0 END)
            + (CASE WHEN is_hot_day THEN 1 ELSE 0 END)
            + (CASE WHEN is_freezing_day THEN 1 ELSE 0 END)
            + (CASE WHEN max_wind_speed_kmh > {wind} THEN 1 ELSE 0 END) AS INTEGER)
           AS weather_severity_score
  FROM silver
), daily AS (
  SELECT city, weather_date, max_temp_c, min_temp_c, mean_temp_c, precipitation_mm,
         rain_mm, snowfall_cm, max_wind_speed_kmh, is_rainy_day, is_hot_day,
         is_freezing_day, weather_severity_score
  FROM scored
), monthly AS (
  SELECT city, year, month,
         half_up(avg(mean_temp_c)) AS avg_mean_temp_c,
         max(max_temp_c) AS max_temp_c,
         min(min_temp_c) AS min_temp_c,
         half_up(sum(precipitation_mm)) AS total_precipitation_mm,
         CAST(sum(CASE WHEN is_rainy_day THEN 1 ELSE 0 END) AS BIGINT) AS rainy_days,
         CAST(sum(CASE WHEN is_hot_day THEN 1 ELSE 0 END) AS BIGINT) AS hot_days,
         CAST(sum(CASE WHEN is_freezing_day THEN 1 ELSE 0 END) AS BIGINT) AS freezing_days,
         half_up(avg(max_wind_speed_kmh)) AS avg_wind_speed_kmh
  FROM silver GROUP BY city, year, month
), risk AS (
  SELECT city, weather_date, 'HOT_DAY' AS risk_type,
         CASE WHEN max_temp_c >= 40 THEN 'HIGH' ELSE 'MEDIUM' END AS risk_level,
         max_temp_c AS metric_value, 'Max temp >= 35 C' AS description
  FROM silver WHERE max_temp_c >= 35
  UNION ALL
  SELECT city, weather_date, 'FREEZING',
         CASE WHEN min_temp_c <= -10 THEN 'HIGH' ELSE 'MEDIUM' END,
         min_temp_c, 'Min temp <= 0 C'
  FROM silver WHERE is_freezing_day
  UNION ALL
  SELECT city, weather_date, 'HEAVY_RAIN',
         CASE WHEN precipitation_mm >= 50 THEN 'HIGH' ELSE 'MEDIUM' END,
         precipitation_mm, 'Precipitation >= 20 mm'
  FROM silver WHERE precipitation_mm >= 20
  UNION ALL
  SELECT city, weather_date, 'STRONG_WIND',
         CASE WHEN max_wind_speed_kmh >= 60 THEN 'HIGH' ELSE 'MEDIUM' END,
         max_wind_speed_kmh, 'Wind speed >= 40 km/h'
  FROM silver WHERE max_wind_speed_kmh >= 40
)
"""


def _over_layers(select: str, rain=1.0, hot=30.0, cold=0.0, wind=40.0) -> str:
    sql = _LAYERS.format(rain=rain, hot=hot, cold=cold, wind=wind) + select
    as_decimal = r"CAST(round(CAST(\1 AS DECIMAL(38, 10)), 2) AS DOUBLE) AS"
    return re.sub(r"half_up\((.+?)\) AS", as_decimal, sql)


_RAW = "SELECT * FROM raw"
_DAILY = "SELECT * FROM daily"

_WINDY_DAILY = """
SELECT city, weather_date, max_temp_c, min_temp_c, mean_temp_c, precipitation_mm,
       rain_mm, snowfall_cm, max_wind_speed_kmh, is_rainy_day, is_hot_day,
       is_freezing_day, is_windy_day,
       CAST(weather_severity_score + CASE WHEN is_windy_day THEN 1 ELSE 0 END AS INTEGER)
         AS weather_severity_score
FROM scored
"""

_RESPONSE = """
SELECT city, CAST(weather_date AS VARCHAR) AS "weatherDate",
       max_temp_c AS "maxTempC", min_temp_c AS "minTempC", mean_temp_c AS "meanTempC",
       precipitation_mm AS "precipitationMm", rain_mm AS "rainMm",
       snowfall_cm AS "snowfallCm", max_wind_speed_kmh AS "maxWindSpeedKmh",
       is_rainy_day AS "isRainyDay", is_hot_day AS "isHotDay",
       is_freezing_day AS "isFreezingDay",
       weather_severity_score AS "weatherSeverityScore"
FROM daily
"""
_IN_RANGE = (
    f"WHERE city = '{CITY}' AND weather_date BETWEEN DATE '{FROM}' AND DATE '{TO}'"
)
_RISK_RESPONSE = """
SELECT city, CAST(weather_date AS VARCHAR) AS "weatherDate", risk_type AS "riskType",
       risk_level AS "riskLevel", metric_value AS "metricValue", description
FROM risk
"""

# What a check reports when it passes or fails, per table.
_CHECKS = """
SELECT CAST(check_id AS INTEGER) AS check_id, dataset, rule, passed, detail FROM (
  SELECT 1 AS check_id, 'silver_weather_daily_clean' AS dataset, 'not empty' AS rule,
         count(*) > 0 AS passed, count(*) || ' rows' AS detail FROM s
  UNION ALL
  SELECT 2, 'silver_weather_daily_clean', 'weather_date not null',
         count(*) = count(weather_date),
         count(*) - count(weather_date) || ' rows without weather_date' FROM s
  UNION ALL
  SELECT 3, 'gold_city_daily_weather_metrics', 'schema', {daily_schema}
  UNION ALL
  SELECT 4, 'gold_city_daily_weather_metrics', 'not empty', count(*) > 0,
         count(*) || ' rows' FROM d
  UNION ALL
  SELECT 5, 'gold_city_daily_weather_metrics', 'unique key', count(*) = 0,
         count(*) || ' repeated keys'
  FROM (SELECT city, weather_date FROM d GROUP BY ALL HAVING count(*) > 1)
  UNION ALL
  SELECT 6, 'gold_city_monthly_weather_summary', 'schema', true, 'as declared'
  UNION ALL
  SELECT 7, 'gold_city_monthly_weather_summary', 'not empty', count(*) > 0,
         count(*) || ' rows' FROM m
  UNION ALL
  SELECT 8, 'gold_weather_risk_days', 'schema', true, 'as declared'
  UNION ALL
  SELECT 9, 'gold_weather_risk_days', 'can be queried', true, count(*) || ' rows' FROM r
  UNION ALL
  SELECT 10, 'gold_weather_risk_days', 'unique key', count(*) = 0,
         count(*) || ' repeated keys'
  FROM (SELECT city, weather_date, risk_type FROM r GROUP BY ALL HAVING count(*) > 1)
)
"""
_SOUND = """, s AS (SELECT * FROM silver), d AS (SELECT * FROM daily),
m AS (SELECT * FROM monthly), r AS (SELECT * FROM risk)
"""
_FAULTY = """, s AS (
  SELECT * REPLACE (CASE WHEN month(weather_date) <> 3 THEN weather_date END AS weather_date)
  FROM silver
), d AS (
  SELECT * FROM daily UNION ALL SELECT * FROM daily WHERE month(weather_date) = 1
), m AS (SELECT * FROM monthly WHERE month > 12),
r AS (SELECT * FROM risk UNION ALL SELECT * FROM risk WHERE risk_level = 'HIGH')
"""
_FAULTY_SCHEMA = (
    "false, 'gold_city_daily_weather_metrics breaks its contract (missing: rain_mm; "
    "unexpected: humidity; retyped: snowfall_cm is float, not double)'"
)

# Contract columns as (name, type, nullable), in order.
_STATION = "city string, latitude double, longitude double"
_OBSERVED = (
    "time string, temperature_2m_max double, temperature_2m_min double, "
    "temperature_2m_mean double, precipitation_sum double, rain_sum double, "
    f"snowfall_sum double, wind_speed_10m_max double, {_STATION}"
)
_STAMPED = "source string!, ingestion_timestamp timestamp!"
_DICTIONARY = {
    "raw_weather_csv": ("raw", _OBSERVED),
    "bronze_weather_daily_raw": ("bronze", f"{_OBSERVED}, {_STAMPED}"),
    "silver_weather_daily_clean": (
        "stamped",
        "city string, weather_date date, year int, month int, day_of_week int, "
        "latitude double, longitude double, max_temp_c double, min_temp_c double, "
        "mean_temp_c double, temperature_range_c double, precipitation_mm double, "
        "rain_mm double, snowfall_cm double, max_wind_speed_kmh double, "
        f"is_rainy_day boolean, is_hot_day boolean, is_freezing_day boolean, {_STAMPED}",
    ),
    "gold_city_daily_weather_metrics": (
        "daily",
        "city string, weather_date date, max_temp_c double, min_temp_c double, "
        "mean_temp_c double, precipitation_mm double, rain_mm double, "
        "snowfall_cm double, max_wind_speed_kmh double, is_rainy_day boolean, "
        "is_hot_day boolean, is_freezing_day boolean, weather_severity_score int!",
    ),
    "gold_city_monthly_weather_summary": (
        "monthly",
        "city string, year int, month int, avg_mean_temp_c double, max_temp_c double, "
        "min_temp_c double, total_precipitation_mm double, rainy_days bigint, "
        "hot_days bigint, freezing_days bigint, avg_wind_speed_kmh double",
    ),
    "gold_weather_risk_days": (
        "risk",
        "city string, weather_date date, risk_type string!, risk_level string!, "
        "metric_value double, description string!",
    ),
}


def _dictionary() -> str:
    selects = []
    for layer, (relation, columns) in _DICTIONARY.items():
        for position, column in enumerate(columns.split(", "), start=1):
            name, kind = column.split(" ")
            selects.append(
                f"SELECT '{layer}' AS layer, '{name}' AS column_name, "
                f"CAST({position} AS INTEGER) AS position, "
                f"'{kind.rstrip('!')}' AS data_type, {not kind.endswith('!')} AS nullable, "
                f"count(*) - count({name}) AS missing FROM {relation}"
            )
    stamps = """, bronze AS (
      SELECT *, 'open_meteo' AS source, 1 AS ingestion_timestamp FROM raw
    ), stamped AS (SELECT *, 1 AS ingestion_timestamp FROM silver)
    """
    return _over_layers(stamps + "\nUNION ALL\n".join(selects))


def _missing(relation: str, columns: str) -> str:
    counts = ", ".join(
        f"count(*) - count({name}) AS {name}"
        for name in (c.split(" ")[0] for c in columns.split(", "))
    )
    return _over_layers(f"SELECT {counts} FROM {relation}")


_SILVER_COLUMNS = "* EXCLUDE (is_windy_day)"
_SILVER_PROFILE = """
SELECT city, count(*) AS row_count, min(weather_date) AS min_date,
       max(weather_date) AS max_date,
       CAST(sum(CASE WHEN is_rainy_day THEN 1 ELSE 0 END) AS BIGINT) AS rainy_days,
       CAST(sum(CASE WHEN is_hot_day THEN 1 ELSE 0 END) AS BIGINT) AS hot_days,
       CAST(sum(CASE WHEN is_freezing_day THEN 1 ELSE 0 END) AS BIGINT) AS freezing_days{more}
FROM silver GROUP BY city ORDER BY city
"""
_WINDY_DAYS = (
    ", CAST(sum(CASE WHEN is_windy_day THEN 1 ELSE 0 END) AS BIGINT) AS windy_days"
)

# Spoiled CSV lines; numbers as Spark writes them.
_TEXTS = ", ".join(
    f"coalesce(CASE WHEN {n} = trunc({n}) AND abs({n}) < 1e7 THEN CAST(CAST({n} AS BIGINT) AS VARCHAR)"
    f" || '.0' ELSE CAST({n} AS VARCHAR) END, '') AS {n}_text"
    for n in (c.split(" ")[0] for c in _OBSERVED.split(", "))
    if n not in ("time", "city")
)
_SPOILED = f""", texts AS (
  SELECT *, right(time, 2) AS day, {_TEXTS} FROM raw
), lines AS (
  SELECT * REPLACE (
    CASE WHEN day = '13' THEN 'n/a' ELSE temperature_2m_max_text END AS temperature_2m_max_text,
    CASE WHEN day = '30' THEN 'calm' ELSE wind_speed_10m_max_text END AS wind_speed_10m_max_text,
    CASE WHEN day = '30' THEN 'trace' ELSE rain_sum_text END AS rain_sum_text,
    '-' || latitude_text || CASE WHEN day = '31' THEN ',?' ELSE '' END AS longitude_text)
  FROM texts
), judged AS (
  SELECT time, city, day,
    CASE WHEN day <> '13' THEN temperature_2m_max END AS temperature_2m_max,
    CASE WHEN day <> '30' THEN rain_sum END AS rain_sum,
    CASE WHEN day <> '30' THEN wind_speed_10m_max END AS wind_speed_10m_max,
    CASE day WHEN '13' THEN 'temperature_2m_max' WHEN '30' THEN 'rain_sum,wind_speed_10m_max'
      ELSE '' END AS unreadable,
    CASE WHEN day IN ('13', '30', '31') THEN concat_ws(',', time, temperature_2m_max_text,
      temperature_2m_min_text, temperature_2m_mean_text, precipitation_sum_text, rain_sum_text,
      snowfall_sum_text, wind_speed_10m_max_text, city, latitude_text, longitude_text) END AS line
  FROM lines
)
"""
_BAD_FIELDS = {
    **{c.split(" ")[0]: "false" for c in _OBSERVED.split(", ") if not c.endswith(" string")},
    "temperature_2m_max": "day = '13'",
    "rain_sum": "day = '30'",
    "wind_speed_10m_max": "day = '30'",
    "n_fields": "day = '31'",
}

_YEARLY = """
    SELECT city, year, half_up(avg(mean_temp_c)) AS avg_mean_temp_c,
    max(max_temp_c) AS max_temp_c, min(min_temp_c) AS min_temp_c,
    half_up(sum(precipitation_mm)) AS total_precipitation_mm,
    CAST(sum(CASE WHEN is_rainy_day THEN 1 ELSE 0 END) AS BIGINT) AS rainy_days,
    CAST(sum(CASE WHEN is_hot_day THEN 1 ELSE 0 END) AS BIGINT) AS hot_days,
    CAST(sum(CASE WHEN is_freezing_day THEN 1 ELSE 0 END) AS BIGINT) AS freezing_days,
    half_up(avg(max_wind_speed_kmh)) AS avg_wind_speed_kmh
    FROM silver GROUP BY city, year
"""

ORACLE: dict[str, str] = {
    "bronze_audit": _over_layers("SELECT *, 'open_meteo' AS source FROM raw"),
    "silver_clean": _over_layers(f"SELECT {_SILVER_COLUMNS} FROM silver"),
    "gold_daily": _over_layers(_DAILY),
    "gold_monthly": _over_layers("SELECT * FROM monthly ORDER BY city, year, month"),
    "gold_risk": _over_layers("SELECT * FROM risk"),
    "profile_raw_city": _over_layers(
        """SELECT city, count(time) AS rows, min(time) AS min_date, max(time) AS max_date
        FROM raw WHERE city IS NOT NULL GROUP BY city ORDER BY city"""
    ),
    "profile_silver_city": _over_layers(_SILVER_PROFILE.format(more="")),
    "profile_daily_city": _over_layers(
        """SELECT city, count(*) AS row_count, min(weather_date) AS min_date,
        max(weather_date) AS max_date, half_up(avg(weather_severity_score)) AS avg_severity
        FROM daily GROUP BY city ORDER BY city"""
    ),
    "yearly_rollup": _over_layers(
        """SELECT city, year, count(*) AS num_months,
        half_up(avg(avg_mean_temp_c)) AS year_avg_temp,
        half_up(sum(total_precipitation_mm)) AS year_total_precip
        FROM monthly GROUP BY city, year ORDER BY city, year"""
    ),
    "risk_by_type": _over_layers(
        """SELECT risk_type, count(*) AS event_count FROM risk
        GROUP BY risk_type ORDER BY risk_type"""
    ),
    "risk_by_city": _over_layers(
        """SELECT city, count(*) AS total_risks FROM risk
        GROUP BY city ORDER BY total_risks DESC, city"""
    ),
    "preview_limit": _over_layers("SELECT * FROM daily ORDER BY city, weather_date LIMIT 10"),
    "list_cities": _over_layers("SELECT DISTINCT city FROM daily ORDER BY city"),
    "daily_range": _over_layers(f"{_RESPONSE} {_IN_RANGE} ORDER BY weather_date"),
    "daily_range_meta": _over_layers(
        f"""SELECT '{CITY}' AS city, '{FROM}' AS "from", '{TO}' AS "to",
        count(*) AS count FROM daily {_IN_RANGE}"""
    ),
    "data_dictionary": _dictionary(),
    "raw_nulls": _missing("raw", _OBSERVED),
    "null_counts": _missing("daily", _DICTIONARY["gold_city_daily_weather_metrics"][1]),
    "duplicate_keys": _over_layers(
        """SELECT city, weather_date, count(*) AS cnt FROM (
        SELECT * FROM daily UNION ALL SELECT * FROM daily WHERE month(weather_date) = 1)
        GROUP BY city, weather_date HAVING count(*) > 1"""
    ),
    "iso_date_rows": _over_layers(
        """, spoiled AS (
          SELECT city, CASE WHEN time LIKE '%-13' THEN replace(time, '-', '/')
                            WHEN time LIKE '%-30' THEN left(time, 8) || '31'
                            ELSE time END AS time
          FROM raw
        ), tested AS (
          SELECT *, regexp_full_match(time, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AS is_iso FROM spoiled
        )
        SELECT city, time, is_iso,
               CASE WHEN is_iso THEN try_cast(time AS DATE) END AS weather_date FROM tested"""
    ),
    "dq_results": _over_layers(
        _SOUND + _CHECKS.format(daily_schema="true, 'as declared'")
    ),
    "dq_faults": _over_layers(_FAULTY + _CHECKS.format(daily_schema=_FAULTY_SCHEMA)),
    "csv_round_trip": _over_layers(_RAW),
    "csv_bad_rows": _over_layers(f"{_SPOILED} SELECT time, city, temperature_2m_max, rain_sum, "
        "wind_speed_10m_max, unreadable, line FROM judged"),
    "csv_bad_fields": _over_layers(
        _SPOILED
        + " UNION ALL ".join(
            f"SELECT '{name}' AS column_name, CAST(count_if({condition}) AS BIGINT) AS bad_rows "
            "FROM judged"
            for name, condition in _BAD_FIELDS.items()
        )
    ),
    "city_dimension": _over_layers(
        """SELECT s_name AS city, CAST(s_suppkey AS DOUBLE) AS latitude,
        -CAST(s_suppkey AS DOUBLE) AS longitude,
        (SELECT count(*) FROM raw WHERE raw.city = s_name) AS days FROM supplier"""
    ),
    "json_flatten": _over_layers(_RAW),
    "payload_union": _over_layers(_RAW),
    "table_counts": _over_layers(
        """SELECT 'bronze_weather_daily_raw' AS dataset, count(*) AS row_count FROM raw
        UNION ALL SELECT 'silver_weather_daily_clean', count(*) FROM silver
        UNION ALL SELECT 'gold_city_daily_weather_metrics', count(*) FROM daily
        UNION ALL SELECT 'gold_city_monthly_weather_summary', count(*) FROM monthly
        UNION ALL SELECT 'gold_weather_risk_days', count(*) FROM risk"""
    ),
    "ensure_table": _over_layers(_DAILY),
    "overwrite_table": _over_layers("SELECT * FROM monthly"),
    "snapshot_publish": _over_layers(_DAILY),
    "publish_monthly": _over_layers("SELECT * FROM monthly"),
    "publish_risk": _over_layers("SELECT * FROM risk"),
    "gated_publish": _over_layers(
        """SELECT CAST(1 AS INTEGER) AS attempt, count(*) = 0 AS dq_passed,
        CAST(CASE WHEN count(*) = 0 THEN 10 ELSE 8 END AS INTEGER) AS passed,
        CAST(10 AS INTEGER) AS total, false AS published, CAST(0 AS BIGINT) AS served_rows FROM daily
        UNION ALL
        SELECT 2, true, 10, 10, true, count(*) FROM daily"""
    ),
    "windy_pipeline": _over_layers(_WINDY_DAILY),
    "windy_verdict": _over_layers(
        _SOUND
        + _CHECKS.format(daily_schema="true, 'as declared'")
        + """UNION ALL SELECT 11, 'gold_city_daily_weather_metrics', 'severity not negative',
        count_if(weather_severity_score < 0) = 0,
        count_if(weather_severity_score < 0) || ' negative scores' FROM daily"""
    ),
    "continuous_publish": _over_layers(_DAILY),
    "windy_days": _over_layers(_SILVER_PROFILE.format(more=_WINDY_DAYS)),
    "severity_windy": _over_layers(_WINDY_DAILY),
    "monthly_windy": _over_layers(
        f""", windy AS (
          SELECT city, year, month{_WINDY_DAYS} FROM silver GROUP BY city, year, month
        )
        SELECT * FROM monthly JOIN windy USING (city, year, month)"""
    ),
    "severity_check": _over_layers(
        """SELECT CAST(11 AS INTEGER) AS check_id,
        'gold_city_daily_weather_metrics' AS dataset, 'severity not negative' AS rule,
        count_if(weather_severity_score < 0) = 0 AS passed,
        count_if(weather_severity_score < 0) || ' negative scores' AS detail FROM daily"""
    ),
    "dry_day_risk": _over_layers(
        """SELECT * FROM risk UNION ALL
        SELECT city, weather_date, 'DRY_DAY', 'MEDIUM', max_temp_c,
               'No precipitation and max temp >= 30 C'
        FROM silver WHERE precipitation_mm = 0 AND max_temp_c >= 30"""
    ),
    "risk_created": _over_layers("SELECT *, true AS created_at FROM risk"),
    "yearly_summary": _over_layers(_YEARLY),
    "yearly_table": _over_layers(_YEARLY),
    "risk_created_table": _over_layers("SELECT *, true AS created_at FROM risk"),
    "monthly_lookup": _over_layers(
        f"""SELECT city, year, month, avg_mean_temp_c AS "avgMeanTempC",
        max_temp_c AS "maxTempC", min_temp_c AS "minTempC",
        total_precipitation_mm AS "totalPrecipitationMm", rainy_days AS "rainyDays",
        hot_days AS "hotDays", freezing_days AS "freezingDays",
        avg_wind_speed_kmh AS "avgWindSpeedKmh"
        FROM monthly WHERE city = '{CITY}' AND year = {YEAR} ORDER BY month"""
    ),
    "risks_lookup": _over_layers(
        f"{_RISK_RESPONSE} WHERE city = '{CITY}' ORDER BY weather_date, risk_type"
    ),
    "risks_lookup_type": _over_layers(
        f"""{_RISK_RESPONSE} WHERE city = '{CITY}' AND risk_type = 'HEAVY_RAIN'
        ORDER BY weather_date, risk_type"""
    ),
    "daily_configured": _over_layers(_DAILY, rain=12.0, hot=25.0, cold=-5.0, wind=24.0),
    "risk_configured": _over_layers(
        """SELECT city, weather_date, 'HOT_DAY' AS risk_type,
        CASE WHEN max_temp_c >= 44 THEN 'HIGH' ELSE 'MEDIUM' END AS risk_level,
        max_temp_c AS metric_value, 'Max temp >= 38 C' AS description
        FROM silver WHERE max_temp_c >= 38
        UNION ALL
        SELECT city, weather_date, 'FREEZING',
        CASE WHEN min_temp_c <= -9 THEN 'HIGH' ELSE 'MEDIUM' END,
        min_temp_c, 'Min temp <= -5 C' FROM silver WHERE is_freezing_day""",
        rain=12.0, hot=25.0, cold=-5.0, wind=24.0,
    ),
}
