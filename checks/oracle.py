"""The SQL that must give the same rows as the query of the same name, for DuckDB on the same tables.

Doubles are rounded as in ``registry.comparable``, ties upwards."""

from __future__ import annotations

_MEASUREMENTS = """
measurements AS (
    SELECT lower(n_name) AS city,
           CASE WHEN event_id % 97 <> 0 THEN CAST(floor(value) AS INTEGER) END AS aqi,
           TRY_CAST(user_id AS INTEGER) AS station_id,
           event_type AS dominant_pollutant,
           CASE WHEN event_id % 89 <> 0 THEN value END AS pm25,
           CASE WHEN event_id % 83 <> 0 AND event_id % 89 <> 0
                THEN 2 * CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS pm10,
           value / 10 AS temperature,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity,
           c_name AS station_name,
           CAST(n_nationkey AS DOUBLE) AS latitude,
           CAST(n_regionkey AS DOUBLE) AS longitude,
           'raw.airquality.' || lower(n_name) AS topic,
           event_id AS "offset",
           ts AS kafka_time,
           ts + INTERVAL 7 HOUR AS measurement_time
    FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

_DIMENSION = """
dimension AS (
    SELECT lower(n_name) AS city, n_name AS city_name, 'Testland' AS country, r_name AS region,
           CAST(1000 * (n_nationkey + 1) AS BIGINT) AS population, 'Asia/Bangkok' AS timezone,
           50 AS aqi_threshold_good, 100 AS aqi_threshold_moderate,
           150 AS aqi_threshold_unhealthy_sensitive, 200 AS aqi_threshold_unhealthy,
           300 AS aqi_threshold_very_unhealthy
    FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE r_name <> 'EUROPE'
)"""

_HEALTH = """
    CASE WHEN aqi IS NULL THEN 'Unknown' WHEN aqi <= 50 THEN 'Good' WHEN aqi <= 100 THEN 'Moderate'
         WHEN aqi <= 150 THEN 'Unhealthy for Sensitive' WHEN aqi <= 200 THEN 'Unhealthy'
         WHEN aqi <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END AS health_status"""

_LEVEL = """
    CASE WHEN pm25 IS NULL AND pm10 IS NULL THEN 'Unknown'
         WHEN greatest(coalesce(pm25, 0), coalesce(pm10, 0)) < 50 THEN 'Low'
         WHEN greatest(coalesce(pm25, 0), coalesce(pm10, 0)) < 100 THEN 'Medium'
         WHEN greatest(coalesce(pm25, 0), coalesce(pm10, 0)) < 150 THEN 'High'
         ELSE 'Severe' END AS pollution_level"""

_PARTICLES = ["pm25", "pm10"]
_WEATHER = ["temperature", "humidity"]


def _extent(name: str, of: str = "{0}") -> str:
    """Mean, highest and lowest of a quantity; ``of`` shapes the input column from name and statistic."""
    return ", ".join(f"{stat}({of.format(name, stat)}) AS {name}_{stat}" for stat in ("avg", "max", "min"))


_HOURLY = f"""
hourly AS (
    SELECT city, CAST(date_trunc('hour', measurement_time) AS TIMESTAMP) AS hour_start,
           {_extent("aqi")}, stddev_pop(aqi) AS aqi_stddev,
           {", ".join(_extent(name) for name in _PARTICLES)},
           {", ".join(f"avg({name}) AS {name}_avg" for name in _WEATHER)},
           CAST(count(*) AS INTEGER) AS record_count
    FROM measurements GROUP BY ALL
)"""

_COARSER = ", ".join(
    [_extent(name, "{0}_{1}") for name in ("aqi", *_PARTICLES)]
    + [f"avg({name}_avg) AS {name}_avg" for name in _WEATHER]
)

_DAILY = f"""
daily AS (
    SELECT city, CAST(hour_start AS DATE) AS date, {_COARSER}, CAST(sum(record_count) AS BIGINT) AS total_records
    FROM hourly GROUP BY ALL
)"""

_WEEKLY = f"""
weekly AS (
    SELECT city, CAST(date_trunc('week', date) AS DATE) AS week_start, {_COARSER},
           CAST(sum(total_records) AS BIGINT) AS total_records
    FROM daily GROUP BY ALL
)"""


def _rounded(*names: str) -> str:
    return ", ".join(f"round({name} + 1e-10, 6) AS {name}" for name in names)


def _over(*tables: str) -> str:
    return "WITH " + ",".join(tables) + "\n"


_PM = [f"{name}_{stat}" for name in _PARTICLES for stat in ("avg", "max", "min")] + [f"{name}_avg" for name in _WEATHER]

_HOUR_ROW = f"""city, hour_start, {_rounded("aqi_avg")}, aqi_max, aqi_min, {_rounded("aqi_stddev", *_PM)}, record_count"""

_DAY_ROW = f"""city, date, {_rounded("aqi_avg")}, aqi_max, aqi_min, {_rounded(*_PM)}, total_records"""

_READING = """
    "offset", city, aqi, station_id, dominant_pollutant, round(pm25 + 1e-10, 6) AS pm25, round(pm10 + 1e-10, 6) AS pm10,
    round(temperature + 1e-10, 6) AS temperature, round(humidity + 1e-10, 6) AS humidity, measurement_time,
    station_name, latitude, longitude"""

_DIMENSION_ROW = """
    city_name, country, region, population, timezone, aqi_threshold_good, aqi_threshold_moderate,
    aqi_threshold_unhealthy_sensitive, aqi_threshold_unhealthy, aqi_threshold_very_unhealthy"""

_ENRICHED = _over(_MEASUREMENTS, _DIMENSION) + "SELECT {extra}" + f"""{_READING}, {_HEALTH}, {_LEVEL}, {_DIMENSION_ROW}
    FROM measurements LEFT JOIN dimension USING (city)"""

_ALL_HOURS = _over(_MEASUREMENTS, _HOURLY) + f"SELECT {_HOUR_ROW} FROM hourly"

_ALL_DAYS = _over(_MEASUREMENTS, _HOURLY, _DAILY) + f"SELECT {_DAY_ROW} FROM daily"

_ONCE = _over(_MEASUREMENTS) + """
    SELECT topic, CAST(0 AS INTEGER) AS "partition", "offset", city, aqi, round(pm25 + 1e-10, 6) AS pm25, measurement_time
    FROM (SELECT DISTINCT * FROM (SELECT * FROM measurements UNION ALL SELECT * FROM measurements))"""

_ARCHIVE_COUNTS = _over(_MEASUREMENTS) + """
    SELECT city, CAST(year(kafka_time) AS INTEGER) AS year, CAST(month(kafka_time) AS INTEGER) AS month,
           CAST(day(kafka_time) AS INTEGER) AS day, count(*) AS records, min("offset") AS first_offset,
           max(kafka_time) AS last_time, CAST(sum(station_id) AS BIGINT) AS stations,
           CAST(sum(aqi) AS BIGINT) AS index_total, count(*) AS of_the_city
    FROM measurements GROUP BY ALL"""

# Readings of the earlier run, and those that the later one computes again.
_BEFORE = "measurement_time <= TIMESTAMP '2024-01-16 05:30:00'"
_AFTER = "measurement_time >= TIMESTAMP '2024-01-16 00:00:00'"


def _replaced(rollup: str, table: str, keys: str, row: str) -> str:
    """Rows of the earlier run without the keys of the later one, then the rows of the later one. A roll-up
    runs on the readings of its run, under names of its own."""
    def run(name: str, condition: str) -> str:
        chosen = f"\nm_{name} AS (SELECT * FROM measurements WHERE {condition})"
        hours = _HOURLY.replace("hourly AS", f"h_{name} AS").replace("FROM measurements", f"FROM m_{name}")
        days = _DAILY.replace("daily AS", f"d_{name} AS").replace("FROM hourly", f"FROM h_{name}")
        return ",".join([chosen, hours, days])

    return _over(_MEASUREMENTS, run("before", _BEFORE), run("after", _AFTER)) + f"""
        SELECT {row} FROM (
            SELECT * FROM {table}_before ANTI JOIN {table}_after USING ({keys})
            UNION ALL SELECT * FROM {table}_after
        )"""


def _pattern(period: str) -> str:
    return _over(_MEASUREMENTS) + f"""
        SELECT city, {period}, round(avg(aqi) + 1e-10, 6) AS aqi_avg, round(avg(pm25) + 1e-10, 6) AS pm25_avg,
               round(avg(pm10) + 1e-10, 6) AS pm10_avg, max(aqi) AS aqi_max, count(*) AS records
        FROM measurements GROUP BY ALL"""


ORACLE: dict[str, str] = {
    "publish_rows": _over(_MEASUREMENTS) + """
        SELECT "offset", city AS key, topic, city, aqi, station_id, dominant_pollutant, round(pm25 + 1e-10, 6) AS pm25,
               round(pm10 + 1e-10, 6) AS pm10, round(temperature + 1e-10, 6) AS temperature,
               round(humidity + 1e-10, 6) AS humidity, station_name, round(latitude + 1e-10, 6) AS latitude,
               round(longitude + 1e-10, 6) AS longitude
        FROM measurements""",
    "wrap_payload": """
        SELECT event_id, event_type AS city, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
               md5('{"city":"' || event_type || '","payload":' || props || '}') AS digest
        FROM events""",
    "parse_envelope": _over(_MEASUREMENTS) + f"SELECT {_READING} FROM measurements",
    "quarantine": _over(_MEASUREMENTS) + """
        SELECT "offset", CASE WHEN dominant_pollutant <> 'error' THEN city END AS city,
               CASE WHEN dominant_pollutant <> 'error' THEN aqi END AS aqi,
               CASE WHEN dominant_pollutant <> 'error' THEN round(pm25 + 1e-10, 6) END AS pm25,
               dominant_pollutant = 'error' AS rejected
        FROM measurements""",
    "local_time": """SELECT event_id AS "offset", ts + INTERVAL 7 HOUR AS measurement_time FROM events""",
    "feed_slug": _over(_MEASUREMENTS) + """
        SELECT "offset",
               CASE city WHEN 'nation_0' THEN 'can-tho' WHEN 'nation_1' THEN 'nha-trang'
                         WHEN 'nation_2' THEN 'vung-tau' ELSE city END AS slug,
               'raw.airquality.' || CASE city WHEN 'nation_0' THEN 'cantho' WHEN 'nation_1' THEN 'nhatrang'
                         WHEN 'nation_2' THEN 'vungtau' ELSE city END AS topic
        FROM measurements""",
    "health_status": _over(_MEASUREMENTS) + f"""SELECT "offset", aqi, {_HEALTH} FROM measurements""",
    "pollution_level": _over(_MEASUREMENTS) + f"""
        SELECT "offset", round(pm25 + 1e-10, 6) AS pm25, round(pm10 + 1e-10, 6) AS pm10, {_LEVEL} FROM measurements""",
    "classify": _over(_MEASUREMENTS) + f"""
        SELECT health_status, pollution_level, count(*) AS records
        FROM (SELECT {_HEALTH}, {_LEVEL} FROM measurements) GROUP BY ALL""",
    "enrich_city": _over(_MEASUREMENTS, _DIMENSION) + f"""
        SELECT "offset", city, aqi, {_DIMENSION_ROW} FROM measurements LEFT JOIN dimension USING (city)""",
    "health_by_city": _over(_MEASUREMENTS, _DIMENSION) + """
        , bounds AS (
            SELECT city, population / 1000 AS step,
                   CASE WHEN region <> 'ASIA' THEN population / 1000 END AS moderate_step
            FROM dimension
        )
        SELECT "offset", city,
               CASE WHEN aqi IS NULL THEN 'Unknown'
                    WHEN aqi <= coalesce(50 + step, 50) THEN 'Good'
                    WHEN aqi <= coalesce(100 + moderate_step, 100) THEN 'Moderate'
                    WHEN aqi <= coalesce(150 + step, 150) THEN 'Unhealthy for Sensitive'
                    WHEN aqi <= coalesce(200 + step, 200) THEN 'Unhealthy'
                    WHEN aqi <= coalesce(300 + step, 300) THEN 'Very Unhealthy'
                    ELSE 'Hazardous' END AS health_status
        FROM measurements LEFT JOIN bounds USING (city)""",
    "dedup_replay": _ONCE,
    "dedup_intervals": _ONCE,
    "held_intervals": _over(_MEASUREMENTS) + """
        SELECT topic, CAST(0 AS INTEGER) AS "partition", min("offset") AS first, max("offset") AS last
        FROM (
            SELECT topic, "offset", "offset" - row_number() OVER (PARTITION BY topic ORDER BY "offset") AS run
            FROM measurements WHERE ("offset" // 700) % 3 = 0 OR ("offset" // 900) % 4 = 1
        )
        GROUP BY topic, run""",
    "stream_dedup": _ONCE,
    "hourly_rollup": _ALL_HOURS,
    "sql_hourly": _ALL_HOURS,
    "stream_hourly": _ALL_HOURS,
    "moments_hourly": _ALL_HOURS,
    "daily_rollup": _ALL_DAYS,
    "sql_daily": _ALL_DAYS,
    "batch_jobs": _ALL_DAYS,
    "daily_weighted": _over(_MEASUREMENTS) + """
        SELECT city, CAST(measurement_time AS DATE) AS date, round(avg(aqi) + 1e-10, 6) AS aqi_avg,
               round(avg(pm25) + 1e-10, 6) AS pm25_avg, round(avg(pm10) + 1e-10, 6) AS pm10_avg,
               round(avg(temperature) + 1e-10, 6) AS temperature_avg, round(avg(humidity) + 1e-10, 6) AS humidity_avg,
               count(*) AS total_records
        FROM measurements GROUP BY ALL""",
    "weekly_rollup": _over(_MEASUREMENTS, _HOURLY, _DAILY, _WEEKLY) + f"""
        SELECT {_DAY_ROW.replace("date,", "week_start,")} FROM weekly""",
    "union_cities": _over(_MEASUREMENTS, _DIMENSION, _HOURLY) + f"""
        SELECT {_HOUR_ROW} FROM hourly WHERE city IN (SELECT city FROM dimension)""",
    "overlap_keys": _over(_MEASUREMENTS) + f"""
        SELECT DISTINCT city, CAST(date_trunc('hour', measurement_time) AS TIMESTAMP) AS hour_start
        FROM measurements WHERE {_BEFORE}
        INTERSECT
        SELECT DISTINCT city, CAST(date_trunc('hour', measurement_time) AS TIMESTAMP)
        FROM measurements WHERE {_AFTER}""",
    "upsert_hourly": _replaced("hourly", "h", "city, hour_start", _HOUR_ROW),
    "upsert_daily": _replaced("daily", "d", "city, date", _DAY_ROW),
    "measurements_sink": _ENRICHED.format(
        extra="kafka_time AS processed_time, CAST(kafka_time AS DATE) AS processed_date, "
    ),
    "stream_enrich": _ENRICHED.format(extra=""),
    "compact_measurements": _ENRICHED.format(extra=""),
    "clustered_rows": _ENRICHED.format(extra=""),
    "clustered_scan": _over(_MEASUREMENTS) + f"""SELECT {_READING} FROM measurements
        WHERE city BETWEEN 'nation_12' AND 'nation_14'
          AND measurement_time BETWEEN TIMESTAMP '2024-01-09 12:00:00' AND TIMESTAMP '2024-01-14 06:30:00'""",
    "archive_rows": _over(_MEASUREMENTS) + """
        SELECT city, CAST(year(kafka_time) AS INTEGER) AS year, CAST(month(kafka_time) AS INTEGER) AS month,
               CAST(day(kafka_time) AS INTEGER) AS day, topic, "offset" AS kafka_offset,
               kafka_time AS kafka_timestamp, station_id
        FROM measurements""",
    "archive_parquet": _ARCHIVE_COUNTS,
    "stream_archive": _ARCHIVE_COUNTS,
    "archive_replay": _over(_MEASUREMENTS) + f"SELECT {_READING} FROM measurements",
    "archive_bundle": _over(_MEASUREMENTS) + """
        SELECT 'archive/' || city || '/' || strftime(any_value(kafka_time), '%Y/%m/%d') || '/batch_raw.airquality.' || city || '_0_'
                   || CAST("offset" // 1000 AS VARCHAR) || '.json' AS object_key,
               city, strftime(kafka_time, '%Y') AS year, strftime(kafka_time, '%m') AS month,
               strftime(kafka_time, '%d') AS day, CAST(count(*) AS INTEGER) AS messages,
               min("offset") AS first_offset, max("offset") AS last_offset,
               string_agg(CAST(station_id AS VARCHAR), ',' ORDER BY "offset") AS stations,
               CAST(count(*) AS INTEGER) AS elements
        FROM measurements
        GROUP BY city, strftime(kafka_time, '%Y'), strftime(kafka_time, '%m'), strftime(kafka_time, '%d'),
                 "offset" // 1000""",
    "latest_by_city": _over(_MEASUREMENTS) + """
        SELECT city, measurement_time, "offset", aqi, round(pm25 + 1e-10, 6) AS pm25, round(pm10 + 1e-10, 6) AS pm10, station_name
        FROM measurements
        QUALIFY row_number() OVER (PARTITION BY city ORDER BY measurement_time DESC, "offset" DESC) = 1""",
    "trend_24h": _over(_MEASUREMENTS, _HOURLY) + """
        SELECT city, hour_start, round(aqi_avg + 1e-10, 6) AS aqi_avg,
               round(avg(aqi_avg) OVER (PARTITION BY city ORDER BY hour_start
                     RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW) + 1e-10, 6) AS aqi_avg_24h
        FROM hourly""",
    "weekly_pattern": _pattern("CAST(date_trunc('week', measurement_time) AS DATE) AS week_start"),
    "monthly_pattern": _pattern("CAST(date_trunc('month', measurement_time) AS DATE) AS month_start"),
    "weekday_pattern": _pattern(
        "CAST(isodow(measurement_time) - 1 AS INTEGER) AS weekday, CAST(hour(measurement_time) AS INTEGER) AS hour"
    ),
    "level_share": _over(_MEASUREMENTS) + f"""
        SELECT city, count(*) AS records,
               round(count(*) FILTER (pollution_level = 'Low') / count(*) + 1e-10, 6) AS low_share,
               round(count(*) FILTER (pollution_level = 'Medium') / count(*) + 1e-10, 6) AS medium_share,
               round(count(*) FILTER (pollution_level = 'High') / count(*) + 1e-10, 6) AS high_share,
               round(count(*) FILTER (pollution_level = 'Severe') / count(*) + 1e-10, 6) AS severe_share,
               round(count(*) FILTER (pollution_level = 'Unknown') / count(*) + 1e-10, 6) AS unknown_share
        FROM (SELECT city, {_LEVEL} FROM measurements) GROUP BY city""",
    "city_comparison": _over(_MEASUREMENTS, _DIMENSION) + """
        SELECT city, city_name, region, round(avg(aqi) + 1e-10, 6) AS aqi_avg, round(avg(pm25) + 1e-10, 6) AS pm25_avg,
               round(avg(pm10) + 1e-10, 6) AS pm10_avg, round(avg(temperature) + 1e-10, 6) AS temperature_avg,
               round(avg(humidity) + 1e-10, 6) AS humidity_avg, max(aqi) AS aqi_max, min(aqi) AS aqi_min,
               count(*) AS records
        FROM measurements LEFT JOIN dimension USING (city) GROUP BY ALL""",
    "region_rollup": _over(_MEASUREMENTS, _DIMENSION) + """
        SELECT region, city, CAST(grouping(region, city) AS INTEGER) AS depth, round(avg(aqi) + 1e-10, 6) AS aqi_avg,
               round(avg(pm25) + 1e-10, 6) AS pm25_avg, round(avg(pm10) + 1e-10, 6) AS pm10_avg, max(aqi) AS aqi_max,
               count(*) AS records
        FROM measurements LEFT JOIN dimension USING (city) GROUP BY ROLLUP (region, city)""",
    "city_rank": _over(_MEASUREMENTS, _HOURLY, _DAILY) + """
        SELECT date, city, round(aqi_avg + 1e-10, 6) AS aqi_avg,
               CAST(rank() OVER (PARTITION BY date ORDER BY aqi_avg) AS INTEGER) AS best_rank,
               CAST(rank() OVER (PARTITION BY date ORDER BY aqi_avg DESC) AS INTEGER) AS worst_rank
        FROM daily WHERE aqi_avg IS NOT NULL""",
    "alert_hours": _over(_MEASUREMENTS, _HOURLY) + """
        SELECT city, hour_start, aqi_max, round(aqi_avg + 1e-10, 6) AS aqi_avg FROM hourly WHERE aqi_max > 200""",
    "alerts": _over(_MEASUREMENTS, _HOURLY) + """
        SELECT city, min(hour_start) AS first_hour, max(hour_start) AS last_hour,
               CAST(count(*) AS INTEGER) AS hours, max(aqi_max) AS aqi_max
        FROM (
            SELECT *, sum(fresh) OVER (PARTITION BY city ORDER BY hour_start) AS run
            FROM (
                SELECT *, CASE WHEN hour_start - INTERVAL 1 HOUR
                               = lag(hour_start) OVER (PARTITION BY city ORDER BY hour_start)
                          THEN 0 ELSE 1 END AS fresh
                FROM hourly WHERE aqi_max > 200
            )
        )
        GROUP BY city, run""",
    "weather_corr": _over(_MEASUREMENTS) + """
        SELECT city, round(corr(aqi, temperature) + 1e-10, 6) AS aqi_temperature_corr,
               round(corr(aqi, humidity) + 1e-10, 6) AS aqi_humidity_corr,
               round(corr(pm25, temperature) + 1e-10, 6) AS pm25_temperature_corr,
               round(corr(pm25, humidity) + 1e-10, 6) AS pm25_humidity_corr,
               round(corr(pm10, temperature) + 1e-10, 6) AS pm10_temperature_corr,
               round(corr(pm10, humidity) + 1e-10, 6) AS pm10_humidity_corr
        FROM measurements GROUP BY city""",
    "aqi_trend_fit": _over(_MEASUREMENTS, _HOURLY) + """
        SELECT city, CAST(regr_count(aqi_avg, x) AS BIGINT) AS hours, round(regr_slope(aqi_avg, x) + 1e-10, 6) AS slope,
               round(regr_intercept(aqi_avg, x) + 1e-10, 6) AS intercept, round(regr_r2(aqi_avg, x) + 1e-10, 6) AS r2
        FROM (SELECT *, (epoch(hour_start) - epoch(TIMESTAMP '2024-01-01 00:00:00')) / 3600 AS x FROM hourly)
        GROUP BY city""",
}

ORACLE["stream_alerts"] = ORACLE["alerts"]

# Hours that are known and the 24 after each city's last one, with means that lie a day back.
_FEATURES = """
    , wanted AS (
        SELECT city, hour_start, aqi_avg, true AS known FROM hourly
        UNION ALL
        SELECT city, unnest(generate_series(last + INTERVAL 1 HOUR, last + INTERVAL 24 HOUR, INTERVAL 1 HOUR)), NULL, false
        FROM (SELECT city, max(hour_start) AS last FROM hourly WHERE aqi_avg IS NOT NULL GROUP BY city)
    ), looked AS (
        SELECT *,
               max(aqi_avg) OVER (by_hour RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 24 HOUR PRECEDING) AS yesterday,
               avg(aqi_avg) OVER (by_hour RANGE BETWEEN INTERVAL 47 HOUR PRECEDING AND INTERVAL 24 HOUR PRECEDING) AS recent,
               avg(aqi_avg) OVER (by_hour RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 24 HOUR PRECEDING) AS past,
               avg(aqi_avg) OVER (PARTITION BY city) AS whole
        FROM wanted WINDOW by_hour AS (PARTITION BY city ORDER BY hour_start)
    ), meant AS (
        SELECT *, coalesce(recent, past, CASE WHEN NOT known THEN whole END) AS mean_before FROM looked
    ), features AS (
        SELECT city, hour_start, aqi_avg, known, coalesce(yesterday, mean_before) AS same_hour_yesterday,
               mean_before AS day_mean, sin(hour(hour_start) * 2 * pi() / 24) AS hour_sin,
               cos(hour(hour_start) * 2 * pi() / 24) AS hour_cos
        FROM meant WHERE mean_before IS NOT NULL OR NOT known
    ), learnt AS (
        SELECT *, CAST(hour_start AS DATE) AS origin FROM features WHERE known AND aqi_avg IS NOT NULL
    )"""

ORACLE["forecast_features"] = _over(_MEASUREMENTS, _HOURLY) + _FEATURES + f"""
    SELECT city, hour_start, known, {_rounded("aqi_avg", "same_hour_yesterday", "day_mean", "hour_sin", "hour_cos")} FROM features"""

# Least squares by the normal equations: the sums, then one column eliminated after the other.
_TERMS = ["1.0::DOUBLE", "same_hour_yesterday", "day_mean", "hour_sin", "hour_cos", "aqi_avg"]
_EXPECTED = " + ".join(f"w{i} * {term}" for i, term in enumerate(_TERMS[:-1]))


def _least_squares(sums: str, key: str) -> str:
    """``fitted``: key and weights w0 to w4, from a table of the sums s<row>_<column>."""
    parts, size = [], len(_TERMS) - 1
    cells = ", ".join(f"s{min(i, j)}_{max(i, j)} AS a{i}_{j}" for i in range(size) for j in range(size + 1))
    parts.append(f", step0 AS (SELECT {key}, {cells} FROM {sums})")
    for k in range(size):
        cells = ", ".join(
            (f"a{k}_{j} / a{k}_{k}" if i == k else f"a{i}_{j} - a{i}_{k} * (a{k}_{j} / a{k}_{k})") + f" AS a{i}_{j}"
            for i in range(size) for j in range(k + 1, size + 1)
        )
        parts.append(f", step{k + 1} AS (SELECT {key}, {cells} FROM step{k})")
    weights = ", ".join(f"a{i}_{size} AS w{i}" for i in range(size))
    return "\n".join([*parts, f", fitted AS (SELECT {key}, {weights} FROM step{size})"])


_SUMS = ", ".join(
    f"sum({_TERMS[i]} * {_TERMS[j]}) AS s{i}_{j}" for i in range(len(_TERMS) - 1) for j in range(i, len(_TERMS))
)
_RUNNING = ", ".join(
    f"sum(s{i}_{j}) OVER before AS s{i}_{j}" for i in range(len(_TERMS) - 1) for j in range(i, len(_TERMS))
)

_FITTED = _over(_MEASUREMENTS, _HOURLY) + _FEATURES + f", sums AS (SELECT 0 AS one, {_SUMS} FROM learnt)" + _least_squares("sums", "one")

ORACLE["aqi_forecast"] = _FITTED + f"""
    , rmse AS (SELECT sqrt(avg(pow(aqi_avg - ({_EXPECTED}), 2))) AS error FROM learnt, fitted)
    SELECT city, hour_start, round({_EXPECTED}, 3) AS aqi_expected, round(({_EXPECTED}) - 1.96 * error, 3) AS aqi_low,
           round(({_EXPECTED}) + 1.96 * error, 3) AS aqi_high
    FROM features, fitted, rmse WHERE NOT known"""

ORACLE["forecast_importance"] = _FITTED + """
    SELECT unnest(['same_hour_yesterday', 'day_mean', 'hour_sin', 'hour_cos', 'intercept']) AS feature,
           round(unnest([w1, w2, w3, w4, w0]) + 1e-10, 6) AS weight
    FROM fitted"""

# Every hour from the 8th on, forecast from what was known at its midnight.
_ERRORS = (
    _over(_MEASUREMENTS, _HOURLY) + _FEATURES + f"""
    , daily_sums AS (SELECT origin, {_SUMS} FROM learnt GROUP BY origin)
    , sums AS (
        SELECT origin, {_RUNNING} FROM daily_sums
        WINDOW before AS (ORDER BY origin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        QUALIFY origin >= DATE '2024-01-08'
    )""" + _least_squares("sums", "origin") + f"""
    , errors AS (
        SELECT origin, CAST(hour(hour_start) + 1 AS INTEGER) AS horizon, abs(aqi_avg - ({_EXPECTED})) AS error
        FROM learnt JOIN fitted USING (origin)
    )"""
)


def _bands(errors: str) -> str:
    return f"""
    , ordered AS (
        SELECT horizon, ceil(error * 1000) / 1000 AS width, row_number() OVER (PARTITION BY horizon ORDER BY error) AS place,
               count(*) OVER (PARTITION BY horizon) AS calibrated
        FROM {errors}
    ), bands AS (
        SELECT horizon, calibrated, min(width) FILTER (place >= ((calibrated + 1) * 95 + 99) // 100) AS band
        FROM ordered GROUP BY ALL
    )"""


ORACLE["forecast_backtest"] = _ERRORS + _bands("(FROM errors WHERE origin < DATE '2024-01-20')") + """
    SELECT horizon, calibrated, round(band, 3) AS band, count(*) AS tested,
           count(*) FILTER (band IS NULL OR error <= band) AS covered, round(avg(error), 3) AS mean_error
    FROM errors JOIN bands USING (horizon) WHERE origin >= DATE '2024-01-20' GROUP BY ALL"""

ORACLE["forecast_banded"] = _ERRORS + _bands("errors") + f"""
    , whole AS (SELECT 0 AS one, {_SUMS} FROM learnt)""" + _least_squares("whole", "one").replace("step", "round").replace("fitted", "final") + f"""
    , coming AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY city ORDER BY hour_start) AS INTEGER) AS horizon
        FROM features, final WHERE NOT known
    )
    SELECT city, hour_start, horizon, round({_EXPECTED}, 3) AS aqi_expected, round(({_EXPECTED}) - band, 3) AS aqi_low,
           round(({_EXPECTED}) + band, 3) AS aqi_high
    FROM coming LEFT JOIN bands USING (horizon)"""

ORACLE["stream_replay"] = _ONCE

ORACLE["stream_metrics"] = _over(_MEASUREMENTS, _DIMENSION) + """
    SELECT "offset" % 3 AS batch_id, count(*) AS rows, count(*) FILTER (broken) AS without_city,
           count(*) FILTER (broken OR aqi IS NULL) AS without_index,
           count(*) FILTER (NOT broken AND city_name IS NULL) AS unlisted,
           min(measurement_time) AS first_time, max(measurement_time) AS last_time
    FROM (SELECT *, dominant_pollutant = 'error' AS broken FROM measurements LEFT JOIN dimension USING (city)) GROUP BY ALL"""

ORACLE["quarantine_reasons"] = _over(_MEASUREMENTS) + """
    SELECT "offset", CASE WHEN "offset" % 8 > 2 THEN city END AS city,
           CASE "offset" % 8 WHEN 0 THEN 'not_json' WHEN 1 THEN 'not_object' WHEN 2 THEN 'no_city' WHEN 3 THEN 'no_payload'
                WHEN 4 THEN 'bad_field' END AS reason,
           CASE WHEN "offset" % 8 = 4 THEN 'idx,city.geo' END AS bad_fields
    FROM measurements"""

# Fields that a message has, and their kinds. A missing number leaves its object behind, without a field.
ORACLE["payload_fields"] = _over(_MEASUREMENTS) + """
    , sent AS (
        SELECT *, "offset" % 8 = 4 AS faulty, CASE WHEN "offset" % 8 <> 2 THEN city END AS named FROM measurements
        WHERE "offset" % 8 IN (2, 4, 5, 6, 7)
    ), found AS (
        SELECT named, unnest([
            CASE WHEN aqi IS NOT NULL THEN {'field': 'aqi', 'kind': 'number'} END,
            {'field': 'idx', 'kind': CASE WHEN faulty THEN 'text' ELSE 'number' END},
            CASE WHEN faulty THEN {'field': 'was', 'kind': 'number'} END,
            {'field': 'dominentpol', 'kind': 'text'},
            {'field': 'iaqi', 'kind': 'object'}, {'field': 'iaqi.pm25', 'kind': 'object'},
            {'field': 'iaqi.pm10', 'kind': 'object'}, {'field': 'iaqi.t', 'kind': 'object'}, {'field': 'iaqi.h', 'kind': 'object'},
            CASE WHEN pm25 IS NOT NULL THEN {'field': 'iaqi.pm25.v', 'kind': 'number'} END,
            CASE WHEN pm10 IS NOT NULL THEN {'field': 'iaqi.pm10.v', 'kind': 'number'} END,
            {'field': 'iaqi.t.v', 'kind': 'number'}, {'field': 'iaqi.h.v', 'kind': 'number'},
            {'field': 'city', 'kind': 'object'}, {'field': 'city.name', 'kind': 'text'},
            {'field': 'city.geo', 'kind': CASE WHEN faulty THEN 'number' ELSE 'array' END},
            CASE WHEN faulty THEN {'field': 'city.at', 'kind': 'array'} END
        ]) AS one
        FROM sent
    )
    SELECT named AS city, one.field AS field, one.kind AS kind, count(*) AS messages FROM found WHERE one IS NOT NULL GROUP BY ALL"""

# Bounds as of the reading's time: none before the 2nd, the common ones until the city's own day.
ORACLE["enrich_as_of"] = _over(_MEASUREMENTS, _DIMENSION) + """
    , placed AS (
        SELECT "offset", city, aqi, measurement_time, city_name, region, CAST(population / 1000 AS INTEGER) AS step
        FROM measurements LEFT JOIN dimension USING (city)
    ), dated AS (
        SELECT *, measurement_time >= TIMESTAMP '2024-01-02' AS there,
               coalesce(CASE WHEN measurement_time >= TIMESTAMP '2024-01-02' + to_days(step) THEN step END, 0) AS moved
        FROM placed
    )
    SELECT "offset", city, CASE WHEN there THEN city_name END AS city_name,
           CAST(CASE WHEN there AND city_name IS NOT NULL THEN 50 + moved END AS INTEGER) AS aqi_threshold_good,
           CASE WHEN aqi IS NULL THEN 'Unknown'
                WHEN aqi <= 50 + moved THEN 'Good'
                WHEN aqi <= 100 + CASE WHEN region = 'ASIA' THEN 0 ELSE moved END THEN 'Moderate'
                WHEN aqi <= 150 + moved THEN 'Unhealthy for Sensitive'
                WHEN aqi <= 200 + moved THEN 'Unhealthy'
                WHEN aqi <= 300 + moved THEN 'Very Unhealthy'
                ELSE 'Hazardous' END AS health_status
    FROM dated"""
