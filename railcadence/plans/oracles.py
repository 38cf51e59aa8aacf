"""The same questions as ``queries.py`` in plain SQL (DuckDB dialect)."""

from __future__ import annotations

STOPS = ("click", "error", "purchase", "signup", "view")

_TYPE = "lpad(CAST(user_id % 10000 AS VARCHAR), 4, '0')"
_NORTH = "('E','I','J','O','Q','N','M','G','A')"


def _direction(code: str) -> str:
    return f"CASE WHEN substr({code}, 1, 1) IN {_NORTH} THEN 'Nord' ELSE 'Sud' END"


def _p(unit: str = "hour") -> str:
    return f"""
p AS (
  SELECT {_TYPE} || '-' || user_id || '-' || strftime(ts, '%Y-%m-%d') AS mission,
         {_TYPE} AS mission_type,
         CASE WHEN user_id % 2 = 0 THEN 'Nord' ELSE 'Sud' END AS direction,
         event_type AS stop_key, ts AS planned_t,
         ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS real_t,
         CAST(date_trunc('{unit}', ts) AS TIMESTAMP) AS observed_at
  FROM events)"""


def _headway(src: str) -> str:
    return f"""
  SELECT *, CAST(round((epoch_us(t) - epoch_us(
           lag(t) OVER (PARTITION BY direction, stop_key ORDER BY t, mission))) / 6e7) AS INTEGER) AS headway_min
  FROM {src}"""


_PLANNED_CALLS = """
first_seen AS (SELECT *, min(observed_at) OVER (PARTITION BY mission) AS first_at FROM p),
planned_calls AS (
  SELECT mission, direction, stop_key, planned_t AS t, count(*) AS copies
  FROM first_seen WHERE observed_at = first_at GROUP BY ALL)"""

_REAL_CALLS = """
real_calls AS (
  SELECT mission, direction, stop_key, max(real_t) AS t FROM p GROUP BY ALL)"""

_PAIRS = f"""
re AS ({_headway('real_calls')}),
th AS ({_headway('planned_calls')}),
pairs AS (
  SELECT re.direction, re.stop_key, re.t,
         CAST(greatest(0.0, (re.headway_min - th.headway_min) / CAST(th.headway_min AS DOUBLE))
              AS DECIMAL(28, 12)) AS excess
  FROM re JOIN th ON re.mission = th.mission AND re.stop_key = th.stop_key
  WHERE re.headway_min IS NOT NULL AND th.headway_min > 0)"""

_SCORE = """count(*) AS n_pairs,
       round(CAST(sum(excess) AS DOUBLE) / count(*), 9) AS avg_excess,
       CAST(greatest(0, floor(CAST(200 * (count(*) - sum(excess)) + count(*) AS DOUBLE) / (2 * count(*)))) AS INTEGER) AS score"""

_DUE = "t BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 43200 MINUTE"

_SCORES = f"""
WITH {_p()}, {_REAL_CALLS}, {_PLANNED_CALLS}, {_PAIRS},
scores AS (SELECT direction, stop_key, {_SCORE} FROM pairs WHERE {_DUE} GROUP BY direction, stop_key)"""

# both sides at the last call of a mission
_LAST_CALL_SCORES = f"""
WITH {_p()}, {_REAL_CALLS},
planned_calls AS (SELECT mission, direction, stop_key, max(planned_t) AS t FROM p GROUP BY ALL), {_PAIRS},
scores AS (SELECT direction, stop_key, {_SCORE} FROM pairs WHERE {_DUE} GROUP BY direction, stop_key)"""

_WIDE = ", ".join(f"max(score) FILTER (WHERE stop_key = '{s}') AS score_{s}" for s in STOPS)

_GAPS = f"""
WITH {_p('day')},
trips AS (SELECT mission, mission_type, direction, observed_at, count(DISTINCT stop_key) AS n_served
          FROM p GROUP BY ALL),
ref AS (SELECT mission_type, direction, max(n_served) AS n_stops FROM trips GROUP BY ALL),
newest AS (SELECT mission, max(observed_at) AS observed_at FROM p GROUP BY mission),
running AS (
  SELECT p.*, ref.direction AS ref_direction
  FROM p JOIN newest USING (mission, observed_at)
         JOIN trips USING (mission, observed_at)
         JOIN ref ON ref.mission_type = p.mission_type
  WHERE trips.n_served < ref.n_stops),
gaps AS (
  SELECT mission, ref_direction AS direction, stop_key,
         CAST(round((epoch_us(max(real_t)) - epoch_us(max(planned_t))) / 6e7) AS INTEGER) AS gap_min
  FROM running GROUP BY ALL),
mission_gaps AS (SELECT mission, direction, max(gap_min) AS max_gap_min FROM gaps GROUP BY ALL)"""

_OBS = """
obs AS (
  SELECT CAST(user_id AS VARCHAR) AS mission,
         CASE WHEN user_id % 2 = 0 THEN 'Nord' ELSE 'Sud' END AS direction,
         CAST(date_trunc('day', ts) AS TIMESTAMP) AS observed_at,
         CAST(round(value / 60) AS INTEGER) AS max_gap_min
  FROM events)"""

_HISTORY = f"""{_OBS},
history AS (SELECT mission, direction, observed_at, max(max_gap_min) AS max_gap_min FROM obs GROUP BY ALL)"""


def _drift(src: str) -> str:
    """First and last rows by self-join on mission and stamp."""
    return f"""
ends AS (SELECT mission, direction, min(observed_at) AS first_at, max(observed_at) AS last_at
         FROM {src} GROUP BY ALL),
drifts AS (
  SELECT e.mission, e.direction, e.first_at, e.last_at, a.max_gap_min AS first_gap, b.max_gap_min AS last_gap,
         CAST((epoch_us(e.last_at) - epoch_us(e.first_at)) // 60000000 AS BIGINT) AS minutes,
         coalesce(b.max_gap_min - a.max_gap_min, 0)
           / CAST((epoch_us(e.last_at) - epoch_us(e.first_at)) // 60000000 + 1 AS DOUBLE) AS drift
  FROM ends e
  JOIN {src} a ON a.mission = e.mission AND a.observed_at = e.first_at
  JOIN {src} b ON b.mission = e.mission AND b.observed_at = e.last_at
  WHERE e.last_at = (SELECT max(observed_at) FROM {src}))"""


_DAILY = f"""
WITH {_HISTORY},
daily AS (
  SELECT observed_at, direction, avg(greatest(0, max_gap_min)) AS mean_gap,
         quantile_cont(greatest(0, max_gap_min), 0.5) AS median_gap,
         max(greatest(0, max_gap_min)) AS max_gap
  FROM history WHERE max_gap_min IS NOT NULL AND max_gap_min < 30 GROUP BY ALL),
served AS (
  SELECT observed_at AS date_observation, direction, round(mean_gap, 9) AS ecart_moyen,
         CAST(median_gap AS DOUBLE) AS ecart_median, CAST(max_gap AS DOUBLE) AS ecart_max
  FROM daily)"""

_ORDER_TRIPS = """
WITH trips AS (
  SELECT o_orderkey, o_orderpriority, ends_at
  FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS ends_at FROM lineitem GROUP BY 1)
       ON l_orderkey = o_orderkey)"""

_FILES = """
WITH files AS (
  SELECT CASE WHEN event_type IN ('view', 'click') THEN 'horaires_reels' ELSE 'horaires_theoriques' END
         || '_' || strftime(ts, '%Y%m%d_%H%M%S')
         || CASE WHEN event_type = 'error' THEN '_mauvais.csv' ELSE '.csv' END AS file_name,
         user_id, ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS modified
  FROM events)"""

_LINES = """
WITH lines AS (
  SELECT 'f' || (event_id // 100) AS file_name, event_type, event_id, 'M' || event_id AS mission,
         'a, "b"' || chr(10) AS destination,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN ''
           ELSE rtrim('.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0'), '0') END || '+00:00' AS iso
  FROM events)"""

_WIDE_CALLS = "wide AS (SELECT l_orderkey, " + ", ".join(
    f"arg_max(l_shipdate, (l_partkey, l_suppkey, l_shipdate)) FILTER (WHERE l_linenumber = {i}) AS stop_{i}"
    for i in range(1, 8)
) + " FROM lineitem GROUP BY l_orderkey)"


def _ref_rows(shift: int, word: str, with_nulls: bool) -> str:
    code = f"p_type || '-' || (p_size + {shift})"
    origin = f"CASE WHEN p_brand <> 'Brand#1' THEN {word} END" if with_nulls else word
    return f"""SELECT DISTINCT {code} AS mission_type, {_direction(code)} AS direction, {origin} AS origin,
         p_brand AS destination, p_size + {shift} AS n_stops FROM part"""


_KEY = r"""trim(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(
  regexp_replace(name, '\([^\n]*?\)', '', 'g'))), '[ -]', '_', 'g'),
  '[^\p{L}\p{N}_]', '', 'g'), '_+', '_', 'g'), '_')"""

_BOUNDS = (1, 5, 10, 25, 50, 100, 250, 500)


def _panes(keys: str, aggs: str, src: str = "events", length: int = 5) -> str:
    """Windows of ``length`` minutes starting every minute, each event in all of its windows."""
    return f"""
  SELECT time_bucket(INTERVAL 1 MINUTE, ts, TIMESTAMP '1970-01-01') - k * INTERVAL 1 MINUTE AS window_start,
         {keys} {aggs}
  FROM {src}, (SELECT unnest(range({length})) AS k) GROUP BY ALL"""


def _quantile_sql() -> str:
    whens = []
    for i, b in enumerate(_BOUNDS):
        low = 0.0 if i == 0 else float(_BOUNDS[i - 1])
        below = "0" if i == 0 else f"le{i - 1}"
        whens.append(
            f"WHEN le{i} >= 0.95::DOUBLE * n THEN {low}::DOUBLE + ({float(b)}::DOUBLE - {low}::DOUBLE)"
            f" * ((0.95::DOUBLE * n - {below}) / (le{i} - {below}))"
        )
    counts = ", ".join(f"count(*) FILTER (WHERE value <= {b}) AS le{i}" for i, b in enumerate(_BOUNDS))
    return f"""
WITH w AS ({_panes('event_type,', counts + ', count(value) AS n')})
SELECT window_start, event_type, n, round(CASE {' '.join(whens)} ELSE {float(_BOUNDS[-1])} END, 9) AS quantile
FROM w"""


_CARD_ROWS = " UNION ALL ".join(
    f"SELECT direction, 'Stop {s}' AS label, score_{s} AS score FROM wide" for s in STOPS
)

_STREAM_FIRST = f"""{_p()},
firsts AS (
  SELECT mission, direction, stop_key, CAST(date_trunc('day', observed_at) AS TIMESTAMP) AS service_day,
         arg_min(planned_t, (observed_at, planned_t)) AS first_t, min(observed_at) AS first_observed_at
  FROM p GROUP BY ALL)"""


# four snapshots a day; cycle by cycle from all rows seen so far
_CYCLES = f"""
WITH c AS (
  SELECT user_id, event_type AS stop_key, CAST(ts AS DATE) AS day, max(ts) AS planned, arg_max(value, ts) AS late
  FROM events GROUP BY ALL),
listed AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'E' ELSE 'S' END || lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') AS type,
         CASE WHEN user_id % 2 = 0 THEN 'Nord' ELSE 'Sud' END AS direction,
         user_id || '-' || day AS mission, stop_key, day, CAST(day AS TIMESTAMP) + hour * INTERVAL 1 HOUR AS s, planned,
         planned + to_microseconds(CAST(round(late * 1000000) AS BIGINT) * (k + 1)) AS re
  FROM c, (VALUES (0, 9), (1, 12), (2, 15), (3, 18)) AS h(k, hour) WHERE user_id % 3 <= k),
r AS (SELECT *, count(*) OVER (PARTITION BY s, mission) AS n FROM listed WHERE re >= s),
p AS (SELECT * FROM r QUALIFY max(planned) OVER (PARTITION BY s, mission) >= s),
cycles AS (SELECT DISTINCT day, s AS c_at FROM r),
real_calls AS (
  SELECT c_at, mission, direction, stop_key, max(re) AS t FROM cycles JOIN r ON r.day = cycles.day AND s <= c_at GROUP BY ALL),
firsts AS (SELECT * FROM p QUALIFY s = min(s) OVER (PARTITION BY mission)),
planned_calls AS (
  SELECT c_at, mission, direction, stop_key, planned AS t FROM cycles JOIN firsts ON firsts.day = cycles.day AND s <= c_at),
re AS (SELECT *, CAST(round((epoch_us(t) - epoch_us(lag(t) OVER (PARTITION BY c_at, direction, stop_key ORDER BY t, mission))) / 6e7) AS INTEGER) AS m FROM real_calls),
th AS (SELECT *, CAST(round((epoch_us(t) - epoch_us(lag(t) OVER (PARTITION BY c_at, direction, stop_key ORDER BY t, mission))) / 6e7) AS INTEGER) AS m FROM planned_calls),
pairs AS (
  SELECT re.c_at, re.direction, re.stop_key,
         CAST(greatest(0.0, (re.m - th.m) / CAST(th.m AS DOUBLE)) AS DECIMAL(28, 12)) AS excess
  FROM re JOIN th ON re.c_at = th.c_at AND re.mission = th.mission AND re.stop_key = th.stop_key
  WHERE re.m IS NOT NULL AND th.m > 0 AND re.t BETWEEN re.c_at AND re.c_at + INTERVAL 180 MINUTE),
scores AS (SELECT epoch_us(c_at) AS as_of_us, direction, stop_key, {_SCORE} FROM pairs GROUP BY c_at, direction, stop_key),
limits AS (SELECT type, max(n) AS most FROM p WHERE s = (SELECT min(q.s) FROM p q WHERE q.type = p.type) GROUP BY type),
newest AS (
  SELECT c_at, cycles.day, max(s) FILTER (kind = 'p') AS sp, max(s) FILTER (kind = 'r') AS sr
  FROM cycles JOIN (SELECT day, s, 'p' AS kind FROM p UNION SELECT day, s, 'r' FROM r) x ON x.day = cycles.day AND s <= c_at
  GROUP BY ALL),
sides AS (
  SELECT c_at, p.type, p.mission, p.direction, stop_key, n, planned, NULL AS real_t FROM newest JOIN p ON p.s = sp
  UNION ALL SELECT c_at, r.type, r.mission, r.direction, stop_key, n, NULL, re FROM newest JOIN r ON r.s = sr),
gaps AS (
  SELECT c_at, mission, direction, stop_key, CAST(round((epoch_us(max(real_t)) - epoch_us(max(planned))) / 6e7) AS INTEGER) AS gap
  FROM sides JOIN limits USING (type) WHERE n < most GROUP BY ALL),
history AS (
  SELECT c_at, CAST(c_at AS DATE) AS day, mission, direction, max(gap) AS g FROM gaps GROUP BY ALL HAVING max(gap) IS NOT NULL),
stats AS (
  SELECT epoch_us(c_at) AS as_of_us, direction, round(avg(greatest(0, g)), 9) AS ecart_moyen,
         CAST(quantile_cont(greatest(0, g), 0.5) AS DOUBLE) AS ecart_median, max(greatest(0, g)) AS ecart_max
  FROM history WHERE g < 30 GROUP BY c_at, direction),
seen AS (
  SELECT cycles.c_at, h.*, max(h_at) OVER (PARTITION BY cycles.c_at) AS last, min(h_at) OVER w AS first_at,
         arg_min(h.g, h_at) OVER w AS first_g
  FROM cycles JOIN (SELECT c_at AS h_at, * EXCLUDE (c_at) FROM history) h ON h.day = cycles.day AND h.h_at <= cycles.c_at
  WINDOW w AS (PARTITION BY cycles.c_at, h.mission)),
drifts AS (
  SELECT epoch_us(c_at) AS as_of_us, direction,
         round(CAST(sum(CAST((g - first_g) / CAST((epoch_us(h_at) - epoch_us(first_at)) // 60000000 + 1 AS DOUBLE) AS DECIMAL(28, 12))) AS DOUBLE)
               / count(*), 9) AS moyenne_allongement
  FROM seen WHERE h_at = last GROUP BY c_at, direction)"""


def all_oracles() -> dict[str, str]:
    return {
        "headway_planned": f"""WITH {_p()}, {_PLANNED_CALLS}
SELECT mission, direction, stop_key, t, headway_min, copies FROM ({_headway('planned_calls')})""",
        "headway_real": f"""WITH {_p()}, {_REAL_CALLS}
SELECT mission, direction, stop_key, t, headway_min FROM ({_headway('real_calls')})""",
        "regularity_scores": f"{_SCORES} SELECT * FROM scores",
        "regularity_scores_wide": f"{_SCORES} SELECT direction, {_WIDE} FROM scores GROUP BY direction",
        "rolling_horizon_scores": f"""
WITH {_p()}, {_REAL_CALLS}, {_PLANNED_CALLS}, {_PAIRS},
cycles AS (
  SELECT unnest(generate_series(
    (SELECT time_bucket(INTERVAL 5 MINUTE, min(t), TIMESTAMP '1970-01-01') - INTERVAL 60 MINUTE FROM pairs),
    (SELECT max(t) FROM pairs), INTERVAL 5 MINUTE)) AS cycle_at)
SELECT cycle_at, direction, stop_key, {_SCORE}
FROM cycles JOIN pairs ON t BETWEEN cycle_at AND cycle_at + INTERVAL 60 MINUTE
GROUP BY cycle_at, direction, stop_key""",
        "schedule_gaps": f"{_GAPS} SELECT * FROM gaps",
        "mission_gap_max": f"{_GAPS} SELECT * FROM mission_gaps",
        "gaps_wide": f"{_GAPS} SELECT mission, direction, " + ", ".join(
            f"max(gap_min) FILTER (WHERE stop_key = '{s}') AS {s}" for s in STOPS
        ) + ", max(gap_min) AS max_gap_min FROM gaps GROUP BY mission, direction",
        "gap_stats": f"""{_GAPS}
SELECT direction, round(avg(greatest(0, max_gap_min)), 9) AS mean_gap,
       CAST(quantile_cont(greatest(0, max_gap_min), 0.5) AS DOUBLE) AS median_gap,
       max(greatest(0, max_gap_min)) AS max_gap
FROM mission_gaps WHERE max_gap_min IS NOT NULL AND max_gap_min < 30 GROUP BY direction""",
        "drift_missions": f"""WITH {_HISTORY}, {_drift('history')}
SELECT mission, direction, first_at, last_at, first_gap, last_gap, minutes, round(drift, 9) AS drift FROM drifts""",
        "drift_first_last": f"""WITH {_HISTORY}, {_drift('history')}
SELECT direction, count(*) AS n_missions, round(avg(drift), 9) AS mean_drift FROM drifts GROUP BY direction""",
        "drift_strict_join": f"""WITH {_OBS}, {_drift('obs')}
SELECT direction, count(*) AS n_pairs, round(avg(drift), 9) AS mean_drift FROM drifts GROUP BY direction""",
        "reference_build": f"""
WITH runs AS (
  SELECT p_type AS mission_type, {_direction('p_type')} AS direction, p_brand AS origin,
         split_part(p_name, ' ', -1) AS destination, p_size AS n_stops,
         max(p_size) OVER (PARTITION BY p_type) AS most
  FROM part)
SELECT DISTINCT mission_type, direction, origin, destination, n_stops FROM runs WHERE n_stops = most""",
        "reference_latest": f"""
WITH {_p('day')},
trips AS (
  SELECT mission, mission_type, direction, observed_at, arg_min(stop_key, (planned_t, stop_key)) AS origin,
         arg_max(stop_key, (planned_t, stop_key)) AS destination,
         CAST(count(DISTINCT stop_key) AS INTEGER) AS n_stops
  FROM p GROUP BY ALL),
runs AS (
  SELECT *, max(n_stops) OVER (PARTITION BY mission_type) AS most, max(observed_at) OVER () AS newest FROM trips)
SELECT DISTINCT mission_type, direction, origin, destination, n_stops
FROM runs WHERE n_stops = most AND observed_at = newest""",
        "reference_reconcile": f"""
WITH cur AS ({_ref_rows(0, "split_part(p_name, ' ', -1)", True)}),
inc AS ({_ref_rows(10, "split_part(p_name, ' ', 1)", False)}),
merged AS (
  SELECT coalesce(cur.mission_type, inc.mission_type) AS mission_type,
         coalesce(cur.direction, inc.direction) AS direction,
         coalesce(cur.origin, inc.origin) AS origin,
         coalesce(cur.destination, inc.destination) AS destination,
         coalesce(cur.n_stops, inc.n_stops) AS n_stops
  FROM cur FULL OUTER JOIN inc ON cur.mission_type = inc.mission_type)
SELECT DISTINCT mission_type, direction, origin,
       CASE substr(mission_type, 1, 1) WHEN 'P' THEN 'Promotion terminus' WHEN 'S' THEN 'South terminus'
            ELSE destination END AS destination, n_stops
FROM merged""",
        "destination_rules": """
SELECT o_orderkey, substr(o_orderpriority, 3, 20) AS mission_type,
       CASE substr(o_orderpriority, 3, 1) WHEN 'U' THEN 'Urgent' WHEN 'L' THEN 'Low' WHEN 'H' THEN 'High'
            ELSE o_orderstatus END AS destination
FROM orders""",
        "clean_prefix": "SELECT p_partkey, p_name FROM part WHERE p_name IS NULL OR p_name NOT LIKE 'red%'",
        "clean_finished": f"""{_ORDER_TRIPS}
SELECT * FROM trips WHERE ends_at IS NULL OR ends_at >= TIMESTAMP '1998-09-02'""",
        "clean_counters": f"""{_ORDER_TRIPS}
SELECT count(*) AS n_read, count(*) FILTER (WHERE dup) AS n_prefixed,
       count(*) FILTER (WHERE NOT dup AND done) AS n_finished,
       count(*) FILTER (WHERE NOT dup AND NOT done) AS n_kept
FROM (SELECT coalesce(o_orderpriority LIKE '1-%', false) AS dup,
             coalesce(ends_at < TIMESTAMP '1998-09-02', false) AS done FROM trips)""",
        "ledger_anti_join": """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
        "latest_file": f"""{_FILES}
SELECT user_id, arg_max(file_name, (modified, file_name)) AS file_name, max(modified) AS modified,
       CASE WHEN file_name LIKE 'horaires_reels%' THEN 'horaires_reels' ELSE 'horaires_theoriques' END AS prefix
FROM files WHERE regexp_matches(file_name, '^horaires_(reels|theoriques)_[0-9]{{8}}_[0-9]{{6}}\\.csv$')
GROUP BY user_id, prefix""",
        "files_to_load": f"{_FILES} SELECT file_name FROM files WHERE file_name NOT LIKE 'horaires_theoriques%'",
        "latest_rows_per_user": f"""WITH {_p('day')}
SELECT mission_type, mission, stop_key, observed_at
FROM (SELECT *, max(observed_at) OVER (PARTITION BY mission_type) AS newest FROM p) WHERE observed_at = newest""",
        "trip_summary": """
SELECT l_orderkey, arg_min(l_partkey, (l_shipdate, l_linenumber, l_partkey)) AS origin,
       CAST(count(l_shipdate) AS INTEGER) AS n_served, max(l_shipdate) AS ends_at
FROM lineitem GROUP BY l_orderkey""",
        "calls_pivot_wide": f"""WITH {_WIDE_CALLS}
SELECT *, CAST(NULL AS TIMESTAMP) AS stop_8,
       greatest({', '.join(f'stop_{i}' for i in range(1, 8))}) AS last_t FROM wide""",
        "calls_unpivot": f"""WITH {_WIDE_CALLS}
SELECT l_orderkey, stop_key, t FROM wide UNPIVOT (t FOR stop_key IN ({', '.join(f'stop_{i}' for i in range(1, 8))}))""",
        "siri_parse": f"""
WITH j AS (
  SELECT substr(o_orderpriority, 3, 4) || l_orderkey AS mission, o_orderstatus AS destination, l_linenumber AS n,
         CAST(o_orderdate AS DATE) AS service_date,
         epoch_us(l_shipdate + INTERVAL 1 DAY) AS planned_us,
         epoch_us(l_shipdate + INTERVAL 1 DAY + CAST(l_quantity AS INTEGER) * INTERVAL 1 MINUTE) AS real_us
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
calls AS (
  SELECT j.*, 'planned' AS kind, n AS stop_id, planned_us AS t_us,
         CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_linenumber = n + 1) THEN 2 ELSE 1 END AS n_served FROM j
  UNION ALL
  SELECT j.*, 'planned', n + 1, planned_us, 2 FROM j
  WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_linenumber = n + 1)
  UNION ALL
  SELECT j.*, 'real', n, real_us, 1 FROM j)
SELECT mission, substr(mission, 1, 4) AS mission_type, {_direction('mission')} AS direction, destination, kind,
       stop_id, 'stop_' || stop_id AS stop_key, stop_id AS stop_seq, t_us, 'Stop ' || n AS origin,
       n_served, t_us AS ends_us, service_date
FROM calls""",
        "json_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
        "csv_rows": f"""{_LINES}
SELECT file_name, mission, destination,
       CASE WHEN event_type <> 'signup' THEN iso END AS date_observation,
       'Saint-Rémy' AS column_1, 'saint_remy' AS key_1, iso AS value_1,
       'Antony' AS column_2, 'antony' AS key_2, CAST(NULL AS VARCHAR) AS value_2
FROM lines WHERE event_type <> 'error'""",
        "csv_rejects": f"""{_LINES}
SELECT file_name, mission || ',"a, ""b""' || chr(10) || '",' || iso || ',NA,' || iso || ','
         || CASE WHEN event_id % 1000 = 0 THEN repeat('"q",', 5000) ELSE 'x' END AS line
FROM lines WHERE event_type = 'error'""",
        "csv_roundtrip": f"""
WITH {_p('day')}
SELECT mission, stop_key, epoch_us(max(planned_t)) AS t_us,
       CAST(count(*) OVER (PARTITION BY mission) AS INTEGER) AS n_served
FROM p GROUP BY mission, stop_key""",
        "normalize_key": f"""
SELECT origin, id, {_KEY} AS "key"
FROM (SELECT 'part' AS origin, p_partkey AS id, p_name AS name FROM part
      UNION ALL SELECT 'document', doc_id, text FROM documents)""",
        "try_parse_times": """
SELECT event_id, CASE event_type WHEN 'error' THEN NULL
         WHEN 'view' THEN epoch_us(ts) - 7200000000 ELSE epoch_us(ts) END AS us
FROM events""",
        "latest_two": f"{_DAILY} SELECT * FROM served ORDER BY date_observation DESC, direction LIMIT 2",
        "latest_per_direction": f"""{_DAILY}
SELECT * FROM served QUALIFY row_number() OVER (PARTITION BY direction ORDER BY date_observation DESC) = 1""",
        "last_update": f"{_DAILY} SELECT max(date_observation) AS updated_at FROM served",
        "kpi_cards": f"""{_LAST_CALL_SCORES},
wide AS (SELECT direction, {_WIDE} FROM scores GROUP BY direction)
SELECT direction, label, coalesce(CAST(score AS VARCHAR), '—') AS "value",
       CASE WHEN score IS NULL THEN 'grey' WHEN score >= 85 THEN 'green' WHEN score >= 70 THEN 'orange'
            ELSE 'red' END AS band
FROM ({_CARD_ROWS})""",
        "gap_cards": f"""{_DAILY}
SELECT direction || ' ' || strftime(date_observation, '%Y-%m-%d') AS direction,
       printf('%.1f min', ecart_moyen) AS mean_text, printf('%.1f min', ecart_median) AS median_text,
       printf('%.0f min', ecart_max) AS max_text
FROM served""",
        "drift_cards": f"""WITH {_HISTORY}, {_drift('history')}
SELECT direction || ' ' || mission AS direction,
       '+ ' || greatest(0, CAST(round_even(round(drift, 9) * 1000 * 100, 0) AS INTEGER)) || '%' AS "value"
FROM drifts""",
        "quality_checks": f"""{_SCORES},
wide AS (SELECT direction, {_WIDE} FROM scores GROUP BY direction),
{_DAILY.strip().removeprefix('WITH')}
SELECT 'direction' AS "check", count(*) AS n_rows, count(*) FILTER (WHERE direction NOT IN ('Nord', 'Sud')) AS n_bad
FROM wide
""" + "".join(f"""UNION ALL SELECT 'score_{s}', count(*), count(*) FILTER (WHERE score_{s} NOT BETWEEN 0 AND 100) FROM wide
""" for s in STOPS) + """
UNION ALL SELECT 'direction', count(*), count(*) FILTER (WHERE direction NOT IN ('Nord', 'Sud')) FROM daily
UNION ALL SELECT 'max_below_mean', count(*), count(*) FILTER (WHERE max_gap < mean_gap) FROM daily""",
        "history_roundtrip": f"""{_DAILY}
SELECT * FROM served WHERE CAST(date_observation AS DATE) > (SELECT CAST(min(date_observation) AS DATE) FROM served)""",
        "update_cycle": f"""
WITH {_p('day')}, {_REAL_CALLS}, {_PLANNED_CALLS}, {_PAIRS},
scores AS (SELECT direction, stop_key, {_SCORE} FROM pairs WHERE {_DUE} GROUP BY direction, stop_key),
wide AS (SELECT direction, {_WIDE} FROM scores GROUP BY direction),
trips AS (SELECT mission, mission_type, direction, observed_at, count(DISTINCT stop_key) AS n_served
          FROM p GROUP BY ALL),
ref AS (SELECT mission_type, max(n_served) AS n_stops FROM trips GROUP BY ALL),
newest AS (
  SELECT p.*, CAST(round((epoch_us(max(real_t) OVER w) - epoch_us(max(planned_t) OVER w)) / 6e7) AS INTEGER) AS gap
  FROM p JOIN trips USING (mission, observed_at) JOIN ref ON ref.mission_type = p.mission_type
  WHERE observed_at = (SELECT max(observed_at) FROM p) AND n_served < n_stops
  WINDOW w AS (PARTITION BY p.mission, p.stop_key)),
mission_gaps AS (SELECT mission, direction, max(gap) AS max_gap_min FROM newest GROUP BY ALL),
stats AS (
  SELECT direction, round(avg(greatest(0, max_gap_min)), 9) AS ecart_moyen,
         CAST(quantile_cont(greatest(0, max_gap_min), 0.5) AS DOUBLE) AS ecart_median,
         max(greatest(0, max_gap_min)) AS ecart_max
  FROM mission_gaps WHERE max_gap_min < 30 GROUP BY direction)
-- a first cycle has no change yet
SELECT *, 0.0::DOUBLE AS moyenne_allongement FROM wide JOIN stats USING (direction)""",
        "replay_cycles": f"{_CYCLES} SELECT * FROM scores",
        "stream_update_cycles": f"""{_CYCLES},
wide AS (SELECT as_of_us, direction, {_WIDE} FROM scores GROUP BY ALL)
SELECT * FROM wide FULL JOIN stats USING (as_of_us, direction) FULL JOIN drifts USING (as_of_us, direction)""",
        "load_new_files": """
WITH rows AS (
  SELECT prefix || '_2024010' || (CASE WHEN day(ts) > 15 THEN 2 ELSE 1 END) || '_000000.csv' AS file_name, event_type, day(ts) > 15 AS late,
         CASE WHEN prefix = 'horaires_reels' THEN ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) ELSE ts END AS t
  FROM events, (VALUES ('horaires_theoriques'), ('horaires_reels')) p(prefix)),
kept AS (SELECT late, count(*) AS n FROM rows WHERE event_type NOT IN ('error', 'signup') AND t >= TIMESTAMP '2024-01-11' GROUP BY late)
SELECT file_name, count(*) FILTER (event_type = 'error') AS n_bad, count(*) FILTER (event_type = 'signup') AS n_prefixed,
       count(*) FILTER (event_type NOT IN ('error', 'signup') AND t < TIMESTAMP '2024-01-11') AS n_finished,
       count(*) FILTER (event_type NOT IN ('error', 'signup') AND t >= TIMESTAMP '2024-01-11') AS n_loaded,
       coalesce(any_value(n), 0) AS n_passages
FROM rows LEFT JOIN kept USING (late) GROUP BY file_name""",
        "archive_day": f"""{_DAILY},
d AS (SELECT *, CAST(date_observation AS DATE) = (SELECT min(CAST(date_observation AS DATE)) FROM served) AS closed FROM served),
places AS (
  SELECT 'hist_moyenne_ecarts' AS name, 'table' AS place, direction FROM d
  UNION ALL SELECT 'passages', 'table', direction FROM d WHERE NOT closed
  UNION ALL SELECT 'passages', 'archive', direction FROM d WHERE closed
  UNION ALL SELECT 'passages', 'archive', direction FROM d WHERE closed AND direction = 'Nord'
  UNION ALL SELECT 'hist_moyenne_ecarts', 'archive', direction FROM d, (VALUES (1), (2)) WHERE closed)
SELECT name, place, direction, count(*) AS n FROM places GROUP BY ALL""",
        "mon_p95": _quantile_sql(),
        "mon_rate": f"""WITH w AS ({_panes('event_type,', 'count(*) AS n')})
SELECT window_start, event_type, n / 300.0::DOUBLE AS per_second FROM w""",
        "mon_error_pct": f"""
WITH w AS ({_panes('', "count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS n_errors")})
SELECT window_start, n, 100.0::DOUBLE * n_errors / n AS error_pct FROM w""",
        "mon_counter_rate": f"""
WITH samples AS (
  SELECT event_type, ts, max(CAST(round(value * 100) AS BIGINT)) AS c FROM events GROUP BY ALL),
steps AS (SELECT *, lag(c) OVER (PARTITION BY event_type ORDER BY ts) AS prev FROM samples),
increases AS (
  SELECT event_type, ts, CASE WHEN prev IS NULL THEN 0 WHEN c >= prev THEN c - prev ELSE c END AS inc FROM steps),
w AS ({_panes('event_type,', 'CAST(sum(inc) AS BIGINT) AS increase', 'increases', 2)})
SELECT window_start, event_type, increase, increase / 120.0::DOUBLE AS per_second FROM w""",
        "mon_gauge": "SELECT event_id, value, value / 1048576.0::DOUBLE AS mb FROM events",
        "stream_tumbling": """
SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*) AS n
FROM events GROUP BY ALL""",
        "stream_first_planned": f"WITH {_STREAM_FIRST} SELECT * FROM firsts",
        "stream_last_real": f"""WITH {_p()}
SELECT mission, direction, stop_key, CAST(date_trunc('day', observed_at) AS TIMESTAMP) AS service_day,
       max(real_t) AS last_t
FROM p GROUP BY ALL""",
        "stream_foreach_scores": f"""
WITH {_STREAM_FIRST}, {_REAL_CALLS},
planned_calls AS (
  SELECT mission, direction, stop_key, first_t AS t
  FROM firsts QUALIFY first_observed_at = min(first_observed_at) OVER (PARTITION BY mission)),
{_PAIRS}
SELECT direction, stop_key, {_SCORE} FROM pairs WHERE {_DUE} GROUP BY direction, stop_key""",
    }
