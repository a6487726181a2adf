"""DuckDB SQL with the results of the named queries."""

from __future__ import annotations

# ---------------------------------------------------------------- shared views

_CITY = "CASE WHEN user_id % 2 = 0 THEN 'msc' ELSE 'spb' END"
_RUN = "CAST(CAST(floor(epoch({ts}) / 3600) AS BIGINT) AS VARCHAR)"


def _run(ts: str) -> str:
    return _RUN.format(ts=ts)


_TRAFFIC = f"""
traffic AS (
  SELECT CAST(event_id AS VARCHAR) AS id, {_CITY} AS city_name, {_run('ts')} AS scheduler_id, ts AS date,
         event_id % 7 AS likes, event_id % 3 AS dislikes,
         CAST(30 AS DOUBLE) + CAST(user_id % 10 AS DOUBLE) / CAST(10 AS DOUBLE) AS longitude,
         CAST(55 AS DOUBLE) + CAST(user_id % 10 AS DOUBLE) / CAST(10 AS DOUBLE) AS latitude
  FROM events WHERE event_type IN ('error', 'purchase', 'signup'))"""

_REPEATED = f"""
repeated AS (
  SELECT *, date AS collected_at FROM traffic
  UNION ALL
  SELECT * REPLACE ({_run("date + INTERVAL 1 HOUR")} AS scheduler_id), date + INTERVAL 1 HOUR AS collected_at
  FROM traffic WHERE CAST(id AS BIGINT) % 10 = 0)"""

_WEATHER = f"""
weather AS (
  SELECT event_id, {_CITY} AS city_name, {_run('ts')} AS scheduler_id, ts AS date,
         CAST(event_id % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS humidity,
         CAST(730 + event_id % 40 AS INTEGER) AS pressure,
         CAST(event_id % 41 - 20 AS INTEGER) AS temperature,
         CAST(event_id % 150 AS DOUBLE) / CAST(10 AS DOUBLE) AS wind_speed,
         ['clear', 'cloudy', 'rain', 'snow'][user_id % 4 + 1] AS weather_type,
         ['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'][user_id % 8 + 1] AS wind_direction
  FROM events WHERE event_type IN ('click', 'view'))"""

_FIRST = """
first_reading AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY scheduler_id, city_name ORDER BY date, event_id) AS rn FROM weather)
  WHERE rn = 1)"""

_COUNTED = """
on_time AS (
  SELECT * FROM traffic WHERE date + INTERVAL 300 SECONDS > (SELECT min(date) FROM weather)),
counted AS (
  SELECT w.city_name, w.scheduler_id, CAST(count(t.id) AS BIGINT) AS crashes, w.date, w.humidity, w.pressure,
         w.temperature, w.weather_type, w.wind_direction, w.wind_speed
  FROM first_reading w LEFT JOIN on_time t ON t.city_name = w.city_name AND t.scheduler_id = w.scheduler_id
  GROUP BY ALL)"""

_PREDICTIONS = """
predictions AS (
  SELECT city_name AS city, CAST(event_id % 25 AS INTEGER) AS crashes, date AS "startDate",
         date + INTERVAL 1 HOUR AS "endDate"
  FROM first_reading)"""


def _decoded(column: str) -> str:
    """Character references decoded, the ampersand last. Named ones may lack the semicolon."""
    references = (("&quot;?", '"'), ("&#x27;", "''"), ("&#39;", "''"), ("&lt;?", "<"), ("&gt;?", ">"), ("&amp;?", "&"))
    for reference, character in references:
        column = f"regexp_replace({column}, '{reference}', '{character}', 'g')"
    return column


def _bucket(ts: str) -> str:
    return f"CAST(floor(epoch({ts}) / 900) AS BIGINT)"


def _mode(name: str, rows: str, keys: str, column: str) -> str:
    """CTE ``name``: most frequent non-NULL value, the lowest on a tie."""
    return f"""
{name} AS (
  SELECT {keys}, {column} FROM (
    SELECT {keys}, {column}, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {column}) AS rn
    FROM {rows} WHERE {column} IS NOT NULL GROUP BY {keys}, {column})
  WHERE rn = 1)"""


_BUCKETS = f"""
placed AS (SELECT *, {_bucket('date')} AS time_interval FROM weather),
{_mode('type_mode', 'placed', 'time_interval, city_name', 'weather_type')},
{_mode('wind_mode', 'placed', 'time_interval, city_name', 'wind_direction')},
bucket_avg AS (
  SELECT time_interval, city_name, avg(humidity) AS humidity, avg(pressure) AS pressure,
         avg(temperature) AS temperature, avg(wind_speed) AS wind_speed
  FROM placed GROUP BY ALL),
buckets AS (
  SELECT * FROM bucket_avg LEFT JOIN type_mode USING (time_interval, city_name)
  LEFT JOIN wind_mode USING (time_interval, city_name))"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _r(column: str, alias: str | None = None) -> str:
    return f"round(CAST({column} AS DOUBLE), 6) AS {alias or column.split('.')[-1]}"


_ROUNDED = ", ".join(_r(c) for c in ("humidity", "pressure", "temperature", "wind_speed"))
_EVENT_COLUMNS = f"""id, city_name, scheduler_id, epoch_us(date) AS date, likes, dislikes,
  {_r('longitude')}, {_r('latitude')}"""
_COUNT_COLUMNS = f"""city_name, crashes, epoch_us(date) AS date, {_r('humidity')}, pressure, temperature,
  weather_type, wind_direction, {_r('wind_speed')}"""
_SHOWN_PREDICTION = 'city, crashes, epoch_us("startDate") AS "startDate", epoch_us("endDate") AS "endDate"'
_FIRST_PREDICTIONS = _with(_WEATHER, _FIRST, _PREDICTIONS)
_LISTED = f"""{_FIRST_PREDICTIONS}
SELECT {_SHOWN_PREDICTION} FROM predictions
WHERE "endDate" >= TIMESTAMP '2024-01-21 12:00:00' - INTERVAL 10 DAYS AND "endDate" < TIMESTAMP '2024-01-21 12:00:00'
ORDER BY "endDate" DESC"""

_RIGHT_WORD = """CASE WHEN crashes % 10 BETWEEN 2 AND 4 AND crashes % 100 NOT BETWEEN 12 AND 14 THEN 'аварии'
  WHEN crashes % 10 = 1 AND crashes % 100 <> 11 THEN 'авария' ELSE 'аварий' END"""
_COMPAT_WORD = """CASE WHEN crashes % 100 BETWEEN 2 AND 4 THEN 'аварии'
  WHEN crashes % 10 = 1 THEN 'авария' ELSE 'аварий' END"""
_BOTH_LABELS = "CASE city WHEN 'msc' THEN 'Москва' WHEN 'spb' THEN 'Санкт-Петербург' ELSE city END"


def _display(label: str, word: str) -> str:
    return f"""{_FIRST_PREDICTIONS},
shown AS (
  SELECT {label} AS city, CAST(crashes AS VARCHAR) || ' ' || {word} AS crashes,
         strftime("startDate", '%d.%m.%Y %H:%M:%S') AS "startDate", strftime("endDate", '%d.%m.%Y %H:%M:%S') AS "endDate"
  FROM predictions)
SELECT city, crashes, "startDate", "endDate" FROM shown"""


_DEDUPED = f"""{_with(_TRAFFIC, _REPEATED)}
SELECT {{columns}} FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY collected_at) AS rn FROM repeated)
WHERE rn = 1"""

_FORGETTING = f"""{_with(_TRAFFIC, _REPEATED)},
early AS (SELECT * FROM repeated WHERE collected_at < TIMESTAMP '2024-01-16'),
late AS (
  SELECT * FROM repeated WHERE collected_at >= TIMESTAMP '2024-01-16'
  UNION ALL
  SELECT * REPLACE (TIMESTAMP '2024-01-26' AS collected_at) FROM early WHERE CAST(id AS BIGINT) % 25 = 0 AND collected_at = date),
first_batch AS (SELECT * FROM early QUALIFY row_number() OVER (PARTITION BY id ORDER BY collected_at) = 1),
kept AS (
  SELECT id FROM first_batch
  WHERE floor(epoch(date) / 86400) >= (SELECT quantile_disc(CAST(floor(epoch(date) / 86400) AS INTEGER), 0.5) - 1 FROM first_batch)),
second_batch AS (
  SELECT * FROM late WHERE id NOT IN (SELECT id FROM kept)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY collected_at) = 1)
SELECT {_EVENT_COLUMNS}, epoch_us(collected_at) AS collected_at FROM (FROM first_batch UNION ALL FROM second_batch)"""

_STREAM_DEDUPED = f"""{_with(_TRAFFIC)}
SELECT id, city_name, epoch_us(date) AS date, likes, dislikes, {_r('longitude')}, {_r('latitude')} FROM traffic"""

_MALFORMED = "event_id % 50 = 0"
_FLOAT_RATIO = "CAST(CAST(event_id % 100 AS FLOAT) AS DOUBLE) / CAST(100 AS DOUBLE)"

_HOURLY = f"""
dated AS (
  SELECT *, CASE WHEN hour(date) = 0 THEN 24 ELSE hour(date) END AS clock, year(date) AS y, dayofyear(date) AS d FROM counted),
{_mode('type_mode', 'dated', 'city_name, y, d, clock', 'weather_type')},
{_mode('wind_mode', 'dated', 'city_name, y, d, clock', 'wind_direction')},
rolled AS (
  SELECT city_name, y, d, clock, CAST(sum(crashes) AS BIGINT) AS crashes, avg(humidity) AS humidity,
         avg(pressure) AS pressure, avg(temperature) AS temperature, avg(wind_speed) AS wind_speed,
         min(month(date)) AS month, min(strftime(date, '%a')) AS weekday
  FROM dated GROUP BY ALL)"""

# Windows are emitted once the watermark, the newest event time less the delay, has passed their end.
_CLOSED_READINGS = "(SELECT max(date) FROM weather) - INTERVAL 300 SECONDS"
_CLOSED_BOTH = "(SELECT least((SELECT max(date) FROM weather), (SELECT max(date) FROM traffic))) - INTERVAL 300 SECONDS"
_WINDOW_END = "make_timestamp((time_interval + 1) * 900000000)"

_HOURLY_ROWS = f"""
hourly AS (
  SELECT city_name, clock, crashes, humidity, pressure, temperature, wind_speed, month, weekday, weather_type, wind_direction
  FROM rolled LEFT JOIN type_mode USING (city_name, y, d, clock) LEFT JOIN wind_mode USING (city_name, y, d, clock))"""


_JOINED = f"""
SELECT t.id, t.city_name, epoch_us(t.date) AS date, t.likes, t.dislikes, {_r('t.longitude')}, {_r('t.latitude')},
  {_ROUNDED}, weather_type, wind_direction
FROM traffic t JOIN buckets b ON b.time_interval = {_bucket('t.date')} AND b.city_name = t.city_name"""


def _index(column: str) -> str:
    """CTE ``<column>_codes``: 0 for the most frequent value, ties in value order."""
    return f"""
{column}_codes AS (
  SELECT {column}, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS {column}_code
  FROM hourly WHERE {column} IS NOT NULL GROUP BY {column})"""


_INDEXED = ("city_name", "weekday", "weather_type", "wind_direction")

# ---------------------------------------------------------------- queries

ORACLES: dict[str, str] = {
    "clean_weather_text": f"""{_with(_WEATHER)}
SELECT CASE WHEN {_MALFORMED} THEN NULL ELSE round({_FLOAT_RATIO}, 6) END AS humidity,
  CASE WHEN {_MALFORMED} THEN NULL ELSE pressure END AS pressure, temperature, weather_type, wind_direction,
  {_r('wind_speed')},
  CASE WHEN {_MALFORMED} THEN epoch_us(date_trunc('second', date)) ELSE epoch_us(date) END AS date,
  city_name, scheduler_id
FROM weather""",
    "flatten_event": f"""{_with(_TRAFFIC)}
SELECT id, {_r('latitude')}, {_r('longitude')}, dislikes, likes, epoch_us(date) AS date, city_name, scheduler_id
FROM traffic""",
    "typed_event_explode": f"""
SELECT CAST(event_id AS VARCHAR) || '-crash' AS id, 'crash' AS type, {_CITY} AS city_name, {_run('ts')} AS scheduler_id
FROM events WHERE event_id % 3 = 0
UNION ALL
SELECT CAST(event_id AS VARCHAR), 'error', {_CITY}, {_run('ts')}
FROM events, range(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END) WHERE event_type = 'error'""",
    "calendar_parts": """
WITH dates AS (
  SELECT 'orders' AS source, o_orderkey AS id, o_orderdate AS date FROM orders
  UNION ALL SELECT 'events', event_id, ts FROM events)
SELECT source, id, CAST(CASE WHEN hour(date) = 0 THEN 24 ELSE hour(date) END AS INTEGER) AS utc_hour,
  CAST(CASE WHEN hour(date + INTERVAL 9 HOURS) = 0 THEN 24 ELSE hour(date + INTERVAL 9 HOURS) END AS INTEGER) AS tokyo_hour,
  CAST(month(date) AS INTEGER) AS month, strftime(date, '%a') AS utc_weekday, CAST(year(date) AS INTEGER) AS year,
  CAST(dayofyear(date) AS INTEGER) AS day_of_year
FROM dates""",
    "dedup_events": _DEDUPED.format(columns=f"{_EVENT_COLUMNS}, epoch_us(collected_at) AS collected_at"),
    "dedup_first_order": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, {_r('o_totalprice')}, epoch_us(o_orderdate) AS o_orderdate, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1""",
    "drop_seen": f"""{_with(_TRAFFIC, _REPEATED)}
SELECT {_EVENT_COLUMNS}, epoch_us(collected_at) AS collected_at FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY collected_at) AS rn FROM repeated
  WHERE collected_at >= TIMESTAMP '2024-01-16')
WHERE rn = 1 AND id NOT IN (SELECT id FROM repeated WHERE collected_at < TIMESTAMP '2024-01-16')""",
    "run_count": f"{_with(_TRAFFIC, _WEATHER, _FIRST, _COUNTED)} SELECT {_COUNT_COLUMNS} FROM counted",
    "late_filter": f"""{_with(_TRAFFIC, _WEATHER)}
SELECT {_EVENT_COLUMNS} FROM traffic WHERE date + INTERVAL 300 SECONDS > (SELECT min(date) FROM weather)""",
    "bucket_means": f"""{_with(_WEATHER, _BUCKETS)}
SELECT time_interval, city_name, {_ROUNDED}, weather_type, wind_direction FROM buckets""",
    "bucket_join": f"""{_with(_TRAFFIC, _WEATHER, _BUCKETS)}
SELECT t.id, t.city_name, epoch_us(t.date) AS date, t.likes, t.dislikes, {_r('t.longitude')}, {_r('t.latitude')},
  {_ROUNDED}, weather_type, wind_direction
FROM traffic t JOIN buckets b ON b.time_interval = {_bucket('t.date')} AND b.city_name = t.city_name""",
    "lookup_records": """
WITH once AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS schedule_id, 'customer:' || CAST(o_custkey + 10 AS VARCHAR) AS cache_id,
         o_orderstatus AS crawler_type, o_orderkey FROM orders),
messages AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE o_orderkey % 10 = 0)
SELECT schedule_id, cache_id, crawler_type, c_name, c_mktsegment
FROM messages LEFT JOIN customer ON cache_id = 'customer:' || CAST(c_custkey AS VARCHAR)""",
    "mode_per_group": f"""{_with(_mode('best', 'lineitem', 'l_suppkey', 'l_returnflag'))}
SELECT l_suppkey, l_returnflag FROM best""",
    "zero_fill_count": """
SELECT c_custkey, c_mktsegment, CAST(count(o_orderkey) AS BIGINT) AS n_orders
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL""",
    "calendar_rollup": f"""{_with(_TRAFFIC, _WEATHER, _FIRST, _COUNTED, _HOURLY)}
SELECT city_name, CAST(clock AS INTEGER) AS hour, crashes, {_ROUNDED}, CAST(month AS INTEGER) AS month, weekday,
  weather_type, wind_direction
FROM rolled LEFT JOIN type_mode USING (city_name, y, d, clock) LEFT JOIN wind_mode USING (city_name, y, d, clock)""",
    "calendar_rollup_all_years": f"""
WITH dated AS (
  SELECT *, o_orderpriority AS city_name, dayofyear(o_orderdate) AS d,
         CASE WHEN hour(o_orderdate) = 0 THEN 24 ELSE hour(o_orderdate) END AS clock FROM orders),
{_mode('status_mode', 'dated', 'city_name, d, clock', 'o_orderstatus')},
rolled AS (
  SELECT city_name, d, clock, count(*) AS crashes, avg(floor(o_totalprice)) AS o_totalprice,
         min(month(o_orderdate)) AS month, min(strftime(o_orderdate, '%a')) AS weekday
  FROM dated GROUP BY ALL)
SELECT city_name, CAST(clock AS INTEGER) AS hour, CAST(crashes AS BIGINT) AS crashes, {_r('o_totalprice')},
  CAST(month AS INTEGER) AS month, weekday, o_orderstatus, CAST(d AS INTEGER) AS day_of_year
FROM rolled LEFT JOIN status_mode USING (city_name, d, clock)""",
    "rmse": """
SELECT round(sqrt(avg((l_quantity - l_extendedprice / 1000) * (l_quantity - l_extendedprice / 1000))), 6) AS rmse
FROM lineitem""",
    "category_index": """
SELECT p_type, CAST(n AS BIGINT) AS n, CAST(row_number() OVER (ORDER BY n DESC, p_type) - 1 AS BIGINT) AS index
FROM (SELECT p_type, count(*) AS n FROM part WHERE p_type IS NOT NULL GROUP BY p_type)""",
    "feature_vectors": f"""{_with(_TRAFFIC, _WEATHER, _FIRST, _COUNTED, _HOURLY, _HOURLY_ROWS, *map(_index, _INDEXED))}
SELECT CAST(crashes AS DOUBLE) AS label, city_name_code AS city_index, {_ROUNDED}, CAST(clock AS DOUBLE) AS hour,
  weekday_code AS weekday_index, CAST(month AS DOUBLE) AS month, weather_type_code AS weather_type_index,
  wind_direction_code AS wind_direction_index
FROM hourly {" ".join(f"LEFT JOIN {c}_codes USING ({c})" for c in _INDEXED)}""",
    "unscorable_rows": f"""{_with(_TRAFFIC, _WEATHER, _FIRST, _COUNTED, _HOURLY, _HOURLY_ROWS)}
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE city_name <> 'msc') AS BIGINT) AS dropped FROM hourly""",
    "prediction_rows": f"""
SELECT {_CITY} AS city, CAST(round(CAST(floor(value * 2) / 2 AS DOUBLE)) AS INTEGER) AS crashes,
  epoch_us(ts) AS "startDate", epoch_us(ts + INTERVAL 1 HOUR) AS "endDate"
FROM events""",
    "recent_predictions": _LISTED,
    "display_predictions": _display("CASE city WHEN 'msc' THEN 'Москва' ELSE city END", _RIGHT_WORD),
    "display_predictions_compat": _display(_BOTH_LABELS, _COMPAT_WORD),
    "search_predictions": _display(_BOTH_LABELS, _RIGHT_WORD)
    + """ WHERE contains(lower(city), 'петербург') OR contains(lower(crashes), 'петербург')
  OR contains("startDate", 'петербург') OR contains("endDate", 'петербург')""",
    "page_fields": rf"""
WITH found AS (
  SELECT page_id, regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 's') AS title,
         regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 's') AS heading FROM pages)
SELECT page_id, trim(regexp_replace({_decoded('title')}, '\s+', ' ', 'g')) AS title,
  trim(regexp_replace({_decoded('heading')}, '\s+', ' ', 'g')) AS heading, 'calm' AS wind_speed
FROM found""",
    "page_parts": rf"""
WITH found AS (
  SELECT page_id, regexp_extract(html, '<div class="ad">(.*?)</div>', 1, 's') AS notice,
         regexp_extract(html, '<nav>.*?<li><a[^>]*>(.*?)</a>', 1, 's') AS first_link,
         regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 's') AS heading,
         CASE WHEN page_id % 2 = 0 THEN replace(replace(
           regexp_extract(html, '<footer>(.*?)</footer>', 1, 's'), '&copy;', '©'), '&middot;', '·')
         ELSE 'unnamed' END AS ending
  FROM pages)
SELECT page_id, trim(regexp_replace({_decoded('notice')}, '\s+', ' ', 'g')) AS notice,
  trim(regexp_replace({_decoded('first_link')}, '\s+', ' ', 'g')) AS first_link,
  trim(regexp_replace({_decoded('heading')}, '\s+', ' ', 'g')) AS heading,
  'none' AS not_a_child, trim(regexp_replace({_decoded('ending')}, '\s+', ' ', 'g')) AS ending
FROM found""",
    "route_by_kind": f"""
SELECT CASE WHEN event_type IN ('error', 'purchase') THEN 'traffic_events' ELSE 'weather_forecast' END AS crawler_type,
  CAST(event_id AS VARCHAR) AS scheduler_id, {_CITY} AS city_name
FROM events WHERE event_type <> 'signup'""",
    "landing_roundtrip": f"""{_with(_WEATHER)},
landed AS (
  SELECT 'weather_forecast:' || city_name || ':' || scheduler_id AS key,
    replace(CAST(temperature AS VARCHAR), '-', '−') AS temperature, weather_type,
    CAST(NULL AS VARCHAR) AS temperature_feelings,
    replace(printf('%.1f', wind_speed), '.', ',') AS wind_speed, wind_direction,
    CASE WHEN {_MALFORMED} THEN 'n/a' ELSE CAST(event_id % 100 AS VARCHAR) || '%' END AS humidity,
    CASE WHEN {_MALFORMED} THEN '' ELSE CAST(pressure AS VARCHAR) || ' mm' END AS pressure,
    CAST(NULL AS VARCHAR) AS water_temperature,
    CASE WHEN {_MALFORMED} THEN strftime(date + INTERVAL 3 HOURS, '%Y-%m-%dT%H:%M:%S')
      ELSE strftime(date + INTERVAL 3 HOURS, '%Y-%m-%dT%H:%M:%S.%f') END || '+03:00' AS datetime,
    city_name FROM weather)
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY datetime DESC) AS rn FROM landed)
WHERE rn = 1""",
    "csv_append_roundtrip": f"{_with(_TRAFFIC, _WEATHER, _FIRST, _COUNTED)} SELECT {_COUNT_COLUMNS} FROM counted",
    "prediction_sink_roundtrip": _LISTED,
    "stream_dedup": _STREAM_DEDUPED,
    "stream_dedup_limited": _DEDUPED.format(columns=f"{_EVENT_COLUMNS}, epoch_us(collected_at) AS collected_at"),
    "stream_dedup_forgetting": _FORGETTING,
    "stream_dedup_table": _DEDUPED.format(columns=f"{_EVENT_COLUMNS}, epoch_us(collected_at) AS collected_at"),
    "stream_bucket_agg": f"""{_with(_WEATHER, _BUCKETS)}
SELECT time_interval * 900000000 AS window_start, city_name, {_ROUNDED}, weather_type, wind_direction
FROM buckets""",
    "stream_bucket_join": f"{_with(_TRAFFIC, _WEATHER, _BUCKETS)} {_JOINED}",
    "stream_bucket_agg_closed": f"""{_with(_WEATHER, _BUCKETS)}
SELECT time_interval * 900000000 AS window_start, city_name, {_ROUNDED}, weather_type, wind_direction
FROM buckets WHERE {_WINDOW_END} <= {_CLOSED_READINGS}""",
    "stream_bucket_join_closed": f"{_with(_TRAFFIC, _WEATHER, _BUCKETS)} {_JOINED} WHERE {_WINDOW_END} <= {_CLOSED_BOTH}",
    "stream_micro_batch": f"{_with(_TRAFFIC, _WEATHER, _FIRST, _COUNTED)} SELECT {_COUNT_COLUMNS} FROM counted",
    "stream_event_weather": f"""{_with(_TRAFFIC, _WEATHER, _FIRST, _BUCKETS.replace("FROM weather)", "FROM first_reading)", 1))}
{_JOINED}""",
    "csv_as_text": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
  CAST(o_custkey + 1 AS BIGINT) AS next, 'string,string,string,int,int,string' AS kinds
FROM orders""",
    "event_times": """
SELECT event_id, epoch_us(CASE event_id % 5 WHEN 0 THEN ts WHEN 1 THEN date_trunc('minute', ts)
  WHEN 2 THEN date_trunc('day', ts + INTERVAL 3 HOURS) - INTERVAL 3 HOURS ELSE date_trunc('second', ts) END) AS date
FROM events""",
    "forest_tuned_score": f"""{_with(_WEATHER)}
SELECT city_name AS city, epoch_us(date) AS "startDate", epoch_us(date + INTERVAL 1 HOUR) AS "endDate", TRUE AS in_range, TRUE AS agrees
FROM weather""",
    "forest_grid": """SELECT CAST(trees AS INTEGER) AS trees, CAST(depth AS INTEGER) AS depth, TRUE AS rmse_follows, TRUE AS choice_follows
FROM range(2, 6) AS a(trees), range(5, 9) AS b(depth)""",
    "forest_promotion": """SELECT CAST(1 AS BIGINT) AS version, 0 AS decision, CAST(NULL AS DOUBLE) AS old_rmse_rounded, CAST(NULL AS BOOLEAN) AS rmse_follows
UNION ALL SELECT 2, 1, 100, TRUE""",
    "promotion_decision": f"""{_with(_TRAFFIC, _WEATHER, _FIRST, _COUNTED, _HOURLY)},
errors AS (
  SELECT sqrt(avg(CAST(4 AS DOUBLE))) AS two, sqrt(avg(CAST(crashes AS DOUBLE) * crashes / 16)) AS quarter, sqrt(avg(CAST(9 AS DOUBLE))) AS three
  FROM rolled WHERE d % 5 = 0),
steps AS (
  SELECT 1 AS step, two AS new_rmse, CAST(NULL AS DOUBLE) AS old_rmse FROM errors
  UNION ALL SELECT 2, two, two FROM errors
  UNION ALL SELECT 3, quarter, two FROM errors
  UNION ALL SELECT 4, three, least(two, quarter) FROM errors),
decided AS (SELECT *, CASE WHEN old_rmse IS NULL THEN 0 WHEN new_rmse < old_rmse THEN 1 ELSE -1 END AS decision FROM steps)
SELECT 1 + CAST(sum(CASE decision WHEN 1 THEN 1 ELSE 0 END) OVER (ORDER BY step) AS BIGINT) AS version, decision,
  {_r('new_rmse')}, {_r('old_rmse')}, CAST(NULL AS VARCHAR) AS tz
FROM decided""",
    "stream_score": f"""{_with(_WEATHER)}
SELECT city_name AS city, CAST(CASE WHEN hour(date) = 0 THEN 24 ELSE hour(date) END + month(date) AS INTEGER) AS crashes,
  epoch_us(date) AS "startDate", epoch_us(date + INTERVAL 1 HOUR) AS "endDate"
FROM weather""",
}
