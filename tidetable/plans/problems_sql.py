"""DuckDB oracles of the general training-data problems."""

COPIES = "city, trip_uid, stop_id, stop_sequence, arr_pred_ts_utc, dep_pred_ts_utc, arr_delay_sec, dep_delay_sec, schedule_relationship, stu_schedule_relationship"

_RANKED = f"SELECT *, row_number() OVER (PARTITION BY {COPIES} ORDER BY fetched_at NULLS LAST, row_no) AS rn FROM stop_time_predictions"

_VALID = """fct_stop_events e LEFT JOIN dim_route r ON e.city_key = r.city_key AND e.route_id = r.route_id
AND r.valid_from <= e.service_date AND (r.valid_to IS NULL OR e.service_date < r.valid_to)"""

_HISTORY = """
WITH v AS (SELECT city, gtfs_version_id, CAST(strptime(split_part(gtfs_version_id, '-', 2), '%Y%m%d') AS DATE) AS d,
                  row_number() OVER (PARTITION BY city ORDER BY split_part(gtfs_version_id, '-', 2), gtfs_version_id) AS k
           FROM (SELECT DISTINCT city, gtfs_version_id FROM gtfs_static_routes)),
r AS (SELECT DISTINCT city, gtfs_version_id, route_id, coalesce(agency_id, '') AS agency_id, coalesce(route_short_name, '') AS route_short_name,
             coalesce(route_long_name, '') AS route_long_name, coalesce(route_type, -1) AS route_type, coalesce(route_color, '') AS route_color FROM gtfs_static_routes),
-- every version of the city for every route, absent ones with nulls
grid AS (SELECT v.city, i.route_id, v.k, v.d, v.gtfs_version_id, r.agency_id IS NOT NULL AS here,
                hash(r.agency_id, r.route_short_name, r.route_long_name, r.route_type, r.route_color) AS h
         FROM v JOIN (SELECT DISTINCT city, route_id FROM r) i ON i.city = v.city LEFT JOIN r ON r.city = v.city AND r.gtfs_version_id = v.gtfs_version_id AND r.route_id = i.route_id),
steps AS (SELECT *, lag(here) OVER w AS was, lag(h) OVER w AS hw FROM grid WINDOW w AS (PARTITION BY city, route_id ORDER BY k)),
edges AS (SELECT * FROM steps WHERE here IS DISTINCT FROM coalesce(was, false) OR (here AND h <> hw)),
periods AS (SELECT *, lead(d) OVER (PARTITION BY city, route_id ORDER BY k) AS until FROM edges)
"""

ORACLES = {
    "p2_found": f"SELECT row_no FROM ({_RANKED}) WHERE rn > 1",
    "p2_kept": f"""SELECT city, schedule_relationship, count(*) AS messages, CAST(sum(copies) AS BIGINT) AS deliveries, max(copies) AS most_copies FROM (
SELECT city, schedule_relationship, count(*) AS copies FROM stop_time_predictions GROUP BY {COPIES}) GROUP BY 1, 2""",
    "p3_found": f"SELECT e.event_no, coalesce(r.route_key, '') AS route_key FROM {_VALID} WHERE e.route_id IS NOT NULL AND e.route_key IS DISTINCT FROM r.route_key",
    "p3_attributes": f"""SELECT e.city_key, r.mode, r.route_type, count(*) AS visits, count(r.route_key) AS with_route, CAST(sum(delay_arr_sec) AS BIGINT) AS delay_sum,
count(r.route_color) AS with_color FROM {_VALID} GROUP BY 1, 2, 3""",
    "p6_found": f"""{_HISTORY} SELECT city AS city_key, route_id, strftime(d, '%Y-%m-%d') AS valid_from, coalesce(strftime(until, '%Y-%m-%d'), '') AS valid_to, gtfs_version_id
FROM periods WHERE here""",
}

# Every reading of every text: (id, feed_ts, micros, k), k being 0 written order, 2 day first, 4 month first, and 1 more for the later of two
# instants. ``texts`` holds id, txt, tz and feed_ts.
_READ = r"""
t AS (SELECT id, tz, feed_ts, upper(trim(translate(regexp_replace(translate(txt, '０１２３４５６７８９：', '0123456789:'), '^\s+|\s+$', '', 'g'), '年月日時分', '-- :'))) AS t FROM texts WHERE txt IS NOT NULL),
days AS (
SELECT id, tz, feed_ts, 0 AS k, regexp_extract(t, '^(\d{4})[-/]?(\d{1,2})[-/]?(\d{1,2})[T ]+(.*)$', ['y', 'm', 'd', 'rest']) AS p FROM t WHERE regexp_matches(t, '^(\d{4}[-/]\d{1,2}[-/]\d{1,2}|\d{8})[T ]')
UNION ALL SELECT id, tz, feed_ts, 2, regexp_extract(t, '^(\d{1,2})[./](\d{1,2})[./](\d{4}) (.*)$', ['d', 'm', 'y', 'rest']) FROM t WHERE regexp_matches(t, '^\d{1,2}[./]\d{1,2}[./]\d{4} ')
UNION ALL SELECT id, tz, feed_ts, 4, regexp_extract(t, '^(\d{1,2})/(\d{1,2})/(\d{4}) (.*)$', ['m', 'd', 'y', 'rest']) FROM t WHERE regexp_matches(t, '^\d{1,2}/\d{1,2}/\d{4} ')
UNION ALL SELECT id, tz, feed_ts, 0, struct_pack(d := p.d, m := CAST((instr('JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC', p.mon) + 2) // 3 AS VARCHAR), y := p.y, rest := p.rest) FROM
  (SELECT id, tz, feed_ts, regexp_extract(t, '^[A-Z]{3}, (\d{1,2}) ([A-Z]{3}) (\d{4}) (.*)$', ['d', 'mon', 'y', 'rest']) AS p FROM t WHERE regexp_matches(t, '^[A-Z]{3}, '))),
clocks AS (SELECT id, tz, feed_ts, k, p.y AS y, p.m AS m, p.d AS d, regexp_extract(p.rest, '^(\d{1,2}):?(\d{2})(?::?(\d{2}))?(?:\.(\d+))?\s*([AP]M)?\s*(Z|[+-]\d{2}:?\d{2}|[A-Z]{3,4})?(?:\[.*\])?$', ['h', 'mi', 's', 'f', 'half', 'zone']) AS c FROM days
WHERE regexp_matches(p.rest, '^(\d{1,2}):?(\d{2})(?::?(\d{2}))?(?:\.(\d+))?\s*([AP]M)?\s*(Z|[+-]\d{2}:?\d{2}|[A-Z]{3,4})?(?:\[.*\])?$')),
locals AS (SELECT id, tz, feed_ts, k, nullif(c.zone, '') AS zone, epoch_us(TRY_CAST(y || '-' || lpad(m, 2, '0') || '-' || lpad(d, 2, '0') || ' ' || lpad(CAST(CASE c.half WHEN 'PM' THEN CAST(c.h AS INT) % 12 + 12 WHEN 'AM' THEN CAST(c.h AS INT) % 12 ELSE CAST(c.h AS INT) END AS VARCHAR), 2, '0')
|| ':' || c.mi || ':' || CASE c.s WHEN '' THEN '00' ELSE c.s END AS TIMESTAMP)) + CAST(rpad(c.f, 6, '0')[:6] AS BIGINT) AS l FROM clocks),
offsets AS (SELECT *, CASE WHEN zone IN ('Z', 'GMT') THEN 0 WHEN zone LIKE '+%' OR zone LIKE '-%' THEN (CASE WHEN zone LIKE '-%' THEN -1 ELSE 1 END) * (CAST(zone[2:3] AS INT) * 3600 + CAST(zone[-2:] AS INT) * 60)
ELSE map {'PST': -28800, 'PDT': -25200, 'EST': -18000, 'EDT': -14400, 'NST': -12600, 'NDT': -9000, 'IST': 19800, 'JST': 32400, 'LHST': 37800, 'LHDT': 39600, 'EET': 7200, 'EEST': 10800, 'CET': 3600, 'CEST': 7200}[zone] END AS o FROM locals WHERE l IS NOT NULL),
pairs AS (SELECT *, 2 * l - 86400000000 - epoch_us(timezone(tz, make_timestamptz(l - 86400000000))) AS one, 2 * l + 86400000000 - epoch_us(timezone(tz, make_timestamptz(l + 86400000000))) AS two FROM offsets WHERE o IS NULL),
valid AS (SELECT *, epoch_us(timezone(tz, make_timestamptz(one))) = l AS one_ok, epoch_us(timezone(tz, make_timestamptz(two))) = l AS two_ok FROM pairs),
readings AS (SELECT id, feed_ts, micros, min(k) AS k FROM (SELECT id, feed_ts, l - CAST(o AS BIGINT) * 1000000 AS micros, k FROM offsets WHERE o IS NOT NULL
UNION ALL SELECT id, feed_ts, one, k + CASE WHEN one_ok AND two_ok AND one > two THEN 1 ELSE 0 END FROM valid WHERE one_ok OR NOT two_ok UNION ALL SELECT id, feed_ts, two, k + CASE WHEN one_ok AND two > one THEN 1 ELSE 0 END FROM valid WHERE two_ok
UNION ALL SELECT id, feed_ts, CAST(t AS BIGINT) * 1000, 0 FROM t WHERE regexp_matches(t, '^\d{13}$') UNION ALL SELECT id, feed_ts, CAST(split_part(t, '.', 1) AS BIGINT) * 1000000 + CAST(rpad(split_part(t, '.', 2), 6, '0')[:6] AS BIGINT), 0 FROM t WHERE regexp_matches(t, '^\d{10}(\.\d+)?$')) GROUP BY 1, 2, 3),
instants AS (SELECT id, arg_min(micros, (coalesce(abs(micros - feed_ts * 1000000), 0), micros)) AS micros FROM readings GROUP BY id)"""

_TEXTS = r"""texts AS (SELECT envelope_id AS id, fetched_at AS txt, iana_tz AS tz, feed_ts FROM envelope LEFT JOIN dim_city ON city_key = city
UNION ALL SELECT -timetable_id, dc_date, 'Asia/Tokyo', NULL FROM tokyo_odpt_train_timetable)"""

_CALLS = """
calls AS (SELECT timetable_id, unnest(odpt_train_timetable_object) AS x, generate_subscripts(odpt_train_timetable_object, 1) AS i FROM tokyo_odpt_train_timetable),
marks AS (SELECT timetable_id, i, regexp_replace(translate(x.departure_time, '０１２３４５６７８９：時分', '0123456789::'), ':$', '') AS t FROM calls WHERE x.departure_time IS NOT NULL),
secs AS (SELECT timetable_id, i, CASE WHEN t LIKE '%:%' THEN CAST(split_part(t, ':', 1) AS INT) * 3600 + CAST(split_part(t, ':', 2) AS INT) * 60 + coalesce(TRY_CAST(split_part(t, ':', 3) AS INT), 0) ELSE CAST(t[:-3] AS INT) * 3600 + CAST(t[-2:] AS INT) * 60 END AS c FROM marks),
steps AS (SELECT *, CASE WHEN c < lag(c) OVER (PARTITION BY timetable_id ORDER BY i) THEN 1 ELSE 0 END AS back FROM secs),
runs AS (SELECT timetable_id, i, c + 86400 * sum(back) OVER (PARTITION BY timetable_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS s FROM steps)"""

_ARRIVED = """
sent AS (SELECT endpoint, feed_ts, micros, unnest(payload) AS x FROM envelope JOIN instants ON id = envelope_id),
firsts AS (SELECT endpoint, x.vehicle_id AS v, coalesce(x.timestamp, feed_ts) AS e, min(micros) AS a FROM sent WHERE coalesce(x.timestamp, feed_ts) IS NOT NULL GROUP BY ALL),
arrived AS (SELECT endpoint, CAST(floor(e / 3600.0) * 3600 AS BIGINT) AS h, greatest(0, CAST(ceil((a - (floor(e / 3600.0) + 1) * 3600000000) / 600000000.0) AS BIGINT)) AS k FROM firsts),
cells AS (SELECT endpoint, h, k, count(*) AS n FROM arrived WHERE k <= 12 GROUP BY 1, 2, 3)"""

_KIND = "CASE {0} WHEN 0 THEN 'plain' WHEN 1 THEN 'plain_later' WHEN 2 THEN 'day_first' WHEN 3 THEN 'day_first_later' WHEN 4 THEN 'month_first' WHEN 5 THEN 'month_first_later' END"
# Of the undecided dates in two orders, the order that most dates of the same spelling prove, and how often it is the one nearest the feed's time.
_ORDERS = r"""
proof AS (SELECT txt LIKE '%M' AS half, CAST(regexp_extract(txt, '^(\d{1,2})/(\d{1,2})/', 1) AS INT) > 12 AS day_first FROM envelope_texts WHERE regexp_matches(txt, '^(1[3-9]|[23]\d)/\d{1,2}/|^\d{1,2}/(1[3-9]|[23]\d)/')),
learned AS (SELECT half, CASE WHEN count(*) FILTER (WHERE day_first) * 2 > count(*) THEN 2 ELSE 4 END AS base FROM proof GROUP BY 1),
open_ids AS (SELECT id FROM readings WHERE k >= 2 GROUP BY 1 HAVING count(DISTINCT micros) > 1 AND count(DISTINCT k // 2) > 1)"""

ORACLES |= {
    "p7_status": f"""WITH {_TEXTS}, {_READ}, picked AS (SELECT r.id, any_value(r.k) FILTER (WHERE r.micros = i.micros) AS k, count(*) AS several FROM readings r JOIN instants i ON i.id = r.id GROUP BY 1)
SELECT CASE WHEN several IS NULL THEN 'unreadable' WHEN several > 1 THEN 'by evidence' ELSE 'certain' END AS status, {_KIND.format("k")} AS reading, count(*) AS n FROM envelope LEFT JOIN picked ON id = envelope_id GROUP BY 1, 2""",
    "p7_by_mixture": f"""WITH {_TEXTS}, {_READ}, envelope_texts AS (SELECT upper(trim(txt)) AS txt FROM texts WHERE id > 0), {_ORDERS}
SELECT city, {_KIND.format("coalesce(base, 2)")} AS reading, CASE WHEN base IS NULL OR (coalesce(base, 2) = 2 AND d_twice) OR (base = 4 AND m_twice) THEN 'ambiguous' ELSE 'by mixture' END AS status, count(*) AS n, count(*) FILTER (WHERE first = i.micros) AS as_by_evidence FROM envelope e JOIN open_ids o ON o.id = envelope_id LEFT JOIN learned ON half = (upper(trim(fetched_at)) LIKE '%M')
JOIN (SELECT id, min(micros) FILTER (WHERE k = 2) AS d, min(micros) FILTER (WHERE k = 4) AS m, bool_or(k = 3) AS d_twice, bool_or(k = 5) AS m_twice FROM readings GROUP BY 1) r ON r.id = envelope_id JOIN instants i ON i.id = envelope_id, LATERAL (SELECT CASE WHEN coalesce(base, 2) = 2 THEN d ELSE m END AS first) GROUP BY 1, 2, 3""",
    "p6_history": f"""{_HISTORY} SELECT md5(concat_ws('|', p.city, p.route_id, strftime(d, '%Y-%m-%d'))) AS route_key, p.city AS city_key, p.route_id, s.agency_id, s.route_short_name, s.route_long_name, s.route_type, s.route_color, d AS valid_from, until AS valid_to,
until IS NULL AS is_current, p.gtfs_version_id FROM periods p JOIN (SELECT DISTINCT * FROM gtfs_static_routes) s ON s.city = p.city AND s.route_id = p.route_id AND s.gtfs_version_id = p.gtfs_version_id WHERE here""",
    "p4_cells": f"WITH {_TEXTS}, {_READ}, {_ARRIVED} SELECT endpoint, h AS period_start, k AS arrival_period, n AS arrived FROM cells",
    "p4_found": f"WITH {_TEXTS}, {_READ}, {_ARRIVED} SELECT DISTINCT endpoint, h AS hour_start FROM cells WHERE k > 1",
    "p4_revisions": f"""WITH {_TEXTS}, {_READ}, {_ARRIVED} SELECT endpoint, h AS period_start, k AS arrival_period, n AS arrived, CAST(sum(n) OVER (PARTITION BY endpoint, h ORDER BY k ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total,
CAST(row_number() OVER (PARTITION BY endpoint, h ORDER BY k) AS INT) AS revision, k = max(k) OVER (PARTITION BY endpoint, h) AS is_final FROM cells""",
    "p7_found": rf"""WITH {_TEXTS}, {_READ}, {_CALLS} SELECT 'envelope' AS src, id AS record_id, CAST(0 AS INT) AS item_no, micros AS utc_micros FROM instants JOIN envelope ON envelope_id = id WHERE NOT regexp_full_match(fetched_at, '\d{{4}}-\d\d-\d\dT\d\d:\d\d:\d\dZ')
UNION ALL SELECT 'timetable', -id, 0, micros FROM instants WHERE id < 0
UNION ALL SELECT 'timetable', timetable_id, CAST(i AS INT), CAST(((micros + 32400000000) // 86400000000) * 86400000000 - 32400000000 + s * 1000000 AS BIGINT) FROM runs JOIN instants ON id = -timetable_id""",
}
