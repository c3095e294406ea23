"""The same answers in plain SQL, for checking."""

from clicksieve.plans.catalogue import CLOSED_BEFORE, DENSER, ONE_DAY

LOG = """log AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS event_id, '0' AS invited,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '+00:00' AS time_stamp,
         CASE event_type WHEN 'view' THEN '0' WHEN 'click' THEN '1' ELSE event_type END AS interested,
         date_trunc('second', ts) AS "timeStamp_flag"
  FROM events)"""

KINDS = """shows AS (SELECT * FROM log WHERE interested = '0'),
clicks AS (SELECT * FROM log WHERE interested = '1')"""

FEATURES = """features AS (
  SELECT CAST(c_custkey AS VARCHAR) AS key, c_mktsegment AS segment, n_name AS nation,
         CASE WHEN c_acctbal > 0 THEN 'yes' END AS in_credit, CAST(NULL AS VARCHAR) AS field8
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

RECORD = 'user_id, event_id, invited, time_stamp, interested, "timeStamp_flag"'
TEXTS = "user_id, event_id, invited, time_stamp, interested"
FEATURE_NAMES = "segment, nation, in_credit, field8"
DAY = """strftime("timeStamp_flag", '%Y%m%d')"""
JSON = """'{' || CASE WHEN {user} THEN '"user_id":"' || user_id || '",' ELSE '' END
  || '"event_id":"' || event_id || '","invited":"' || invited || '","time_stamp":"' || time_stamp
  || '","interested":"' || interested || '"}'"""


def window_of(width, column='"timeStamp_flag"'):
    return f"time_bucket(INTERVAL '{width}', {column}, TIMESTAMP '1970-01-01 00:00:00')"


def chain(name, source, ttl):
    """The first row per user, then repeatedly the first one a ttl or more later."""
    return f"""{name}_times AS (
  SELECT user_id, min("timeStamp_flag") AS t FROM {source} GROUP BY user_id
  UNION ALL
  SELECT c.user_id, min(s."timeStamp_flag") FROM {name}_times c JOIN {source} s
    ON s.user_id = c.user_id AND s."timeStamp_flag" >= c.t + INTERVAL '{ttl}'
  GROUP BY c.user_id, c.t),
{name} AS (
  SELECT {RECORD} FROM (
    SELECT s.*, row_number() OVER (PARTITION BY s.user_id, s."timeStamp_flag" ORDER BY s.event_id) AS place
    FROM {source} s JOIN {name}_times c ON s.user_id = c.user_id AND s."timeStamp_flag" = c.t)
  WHERE place = 1)"""


def window_negatives(width):
    return f"""SELECT {RECORD}, {window_of(width)} AS window_start, 0 AS label FROM shows s
WHERE NOT EXISTS (SELECT 1 FROM clicks c WHERE c.user_id = s.user_id
  AND {window_of(width, 'c."timeStamp_flag"')} = {window_of(width, 's."timeStamp_flag"')})"""


def interval_negatives(shown, clicked, ttl):
    return f"""SELECT {RECORD}, 0 AS label FROM {shown} s
WHERE NOT EXISTS (SELECT 1 FROM {clicked} c WHERE c.user_id = s.user_id
  AND c."timeStamp_flag" BETWEEN s."timeStamp_flag" AND s."timeStamp_flag" + INTERVAL '{ttl}')"""


def from_log(select, *more):
    return f"WITH {', '.join([LOG, *more])}\n{select}"


def chained(select, *more):
    return f"WITH RECURSIVE {', '.join([LOG, KINDS, *more])}\n{select}"


def samples(columns):
    return from_log(
        f"SELECT {columns} FROM ({window_negatives('1 day')}) n LEFT JOIN features f ON n.user_id = f.key",
        KINDS,
        FEATURES,
    )


SAMPLES = f"{RECORD}, label, {FEATURE_NAMES}, {DAY} AS pt_d"
STORED_SAMPLES = f"{TEXTS}, {FEATURE_NAMES}, {DAY} AS pt_d"
LINE = f"concat_ws(chr(1), {TEXTS})"
EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"
PART = "TRY_CAST(regexp_extract(text, '^ *(\\d{4})-(\\d+)-(\\d+) (\\d+):(\\d+):(\\d+)', %d) AS BIGINT)"
PARSED = (
    f"coalesce(make_date({PART % 1}, 1, 1) + to_months(CAST({PART % 2} - 1 AS INTEGER)) + to_days(CAST({PART % 3} - 1 AS INTEGER)) "
    f"+ to_hours({PART % 4}) + to_minutes({PART % 5}) + to_seconds({PART % 6}), {EPOCH})"
)
DENSE = f"""dense AS (
  SELECT user_id, event_id, invited, time_stamp, interested, TIMESTAMP '2024-01-01'
    + to_seconds(CAST(floor((epoch("timeStamp_flag") - epoch(TIMESTAMP '2024-01-01')) / {DENSER}) AS BIGINT)) AS "timeStamp_flag"
  FROM log)"""
DENSE_KINDS = """shows AS (SELECT * FROM dense WHERE interested = '0'),
clicks AS (SELECT * FROM dense WHERE interested = '1')"""


def dense(select, *more):
    return f"WITH RECURSIVE {', '.join([LOG, DENSE, DENSE_KINDS, *more])}\n{select}"


DISTINCT_ROWS = from_log(f"SELECT {RECORD}, {window_of('10 seconds')} AS window_start FROM log")
FIRST_6H = chained(f"SELECT {RECORD} FROM kept", chain("kept", "clicks", "6 hours"))
TWO_STREAM_6H = chained(
    interval_negatives("first_shows", "first_clicks", "6 hours"),
    chain("first_shows", "shows", "6 hours"),
    chain("first_clicks", "clicks", "6 hours"),
)
LOOKED_UP = f"SELECT {{columns}}, {FEATURE_NAMES} FROM log LEFT JOIN features ON user_id = key"

ORACLE = {
    "labelled_samples": samples(SAMPLES),
    "labelled_samples_to_table": samples(STORED_SAMPLES),
    "decode_wire": from_log(f"SELECT {RECORD} FROM log"),
    "quarantine_counts": """SELECT CASE event_type WHEN 'signup' THEN 'fields' WHEN 'error' THEN 'json' ELSE 'time' END AS reason,
  count(*) AS line_count FROM events WHERE event_type IN ('signup', 'error', 'purchase') GROUP BY 1""",
    "quarantine_rest": from_log(
        f"""SELECT user_id, event_id, invited, interested,
  CASE interested WHEN 'purchase' THEN 'soon' ELSE time_stamp END AS time_stamp,
  CASE interested WHEN 'purchase' THEN {EPOCH} ELSE "timeStamp_flag" END AS "timeStamp_flag"
FROM log WHERE interested NOT IN ('signup', 'error')"""
    ),
    "parse_time_lenient": from_log(
        f"SELECT event_id, form, {PARSED} AS parsed FROM forms",
        """forms AS (
  SELECT event_id, 'fraction and offset' AS form, time_stamp AS text FROM log
  UNION ALL SELECT event_id, 'offset', split_part(time_stamp, '.', 1) || '+00:00' FROM log
  UNION ALL SELECT event_id, 'plain', split_part(time_stamp, '.', 1) FROM log
  UNION ALL SELECT event_id, 'minutes only', substr(time_stamp, 1, 16) FROM log
  UNION ALL SELECT event_id, 'prefixed', 'at ' || time_stamp FROM log
  UNION ALL SELECT event_id, 'blank', '  ' || time_stamp FROM log
  UNION ALL SELECT event_id, 'month 13', substr(time_stamp, 1, 5) || '13' || substr(split_part(time_stamp, '.', 1), 8) FROM log
  UNION ALL SELECT event_id, 'hour 24', substr(time_stamp, 1, 11) || '24:00:00' FROM log
  UNION ALL SELECT event_id, '30 February', substr(time_stamp, 1, 5) || '02-30 10:00:00' FROM log
  UNION ALL SELECT event_id, 'empty', '' FROM log
  UNION ALL SELECT event_id, 'missing', NULL FROM log)""",
    ),
    "null_fill": from_log(
        """SELECT CASE WHEN interested = 'signup' THEN '' ELSE user_id END AS user_id, event_id,
  CASE WHEN interested = '1' THEN invited ELSE '' END AS invited, time_stamp, interested, "timeStamp_flag" FROM log"""
    ),
    "json_export": from_log(f"SELECT {JSON.replace('{user}', 'interested <> ' + chr(39) + 'signup' + chr(39))} AS value FROM log"),
    "wire_export": from_log(
        f"SELECT {JSON.replace('{user}', 'true')} || chr(1) || 'abcd' || chr(1) || 'abcd' AS value FROM log"
    ),
    "record_lines": from_log(f"SELECT {LINE} AS value FROM log"),
    "decode_files": from_log(f"SELECT {RECORD} FROM log"),
    "distinct_rows_in_window": DISTINCT_ROWS,
    "distinct_in_window": from_log(
        f"SELECT DISTINCT user_id, interested, {window_of('1 day')} AS window_start FROM log"
    ),
    "window_arrays": from_log(
        f"SELECT {window_of('1 day')} AS window_start, user_id, count(*) AS row_count FROM log GROUP BY 1, 2"
    ),
    "window_rows": from_log(f"SELECT {RECORD} FROM log"),
    "first_per_user_30s": chained(f"SELECT {RECORD} FROM kept", chain("kept", "clicks", "30 seconds")),
    "first_per_user_ttl": FIRST_6H,
    "first_per_user_segmented": FIRST_6H,
    "first_per_user_30s_dense": dense(f"SELECT {RECORD} FROM kept", chain("kept", "clicks", "30 seconds")),
    "negatives_window_10s_dense": dense(window_negatives("10 seconds")),
    "negatives_interval_30s_dense": dense(interval_negatives("shows", "clicks", "30 seconds")),
    "negatives_two_stream_30s_dense": dense(
        interval_negatives("first_shows", "first_clicks", "30 seconds"),
        chain("first_shows", "shows", "30 seconds"),
        chain("first_clicks", "clicks", "30 seconds"),
    ),
    "connected_counts": """SELECT CAST(user_id AS VARCHAR) AS user_id,
  CASE event_type WHEN 'view' THEN 'show' ELSE 'click' END AS side, count(*) AS row_count
FROM events WHERE event_type IN ('view', 'click') GROUP BY 1, 2""",
    "negatives_window_10s": from_log(window_negatives("10 seconds"), KINDS),
    "negatives_window_1h": from_log(window_negatives("1 hour"), KINDS),
    "negatives_window_1d": from_log(window_negatives("1 day"), KINDS),
    "negatives_window_distinct_1d": from_log(window_negatives("1 day"), KINDS),
    "negatives_interval_30s": from_log(interval_negatives("shows", "clicks", "30 seconds"), KINDS),
    "negatives_interval_6h": from_log(interval_negatives("shows", "clicks", "6 hours"), KINDS),
    "negatives_interval_1d": from_log(interval_negatives("shows", "clicks", "1 day"), KINDS),
    "negatives_two_stream": TWO_STREAM_6H,
    "negatives_two_stream_1d": chained(
        interval_negatives("first_shows", "first_clicks", "1 day"),
        chain("first_shows", "shows", "1 day"),
        chain("first_clicks", "clicks", "1 day"),
    ),
    "negatives_two_stream_all_clicks": chained(
        interval_negatives("first_shows", "clicks", "6 hours"), chain("first_shows", "shows", "6 hours")
    ),
    "multi_window_negatives": chained(
        interval_negatives("first_shows", "first_clicks", "6 hours"),
        f"unclicked AS ({window_negatives('1 hour')})",
        chain("first_shows", "unclicked", "6 hours"),
        chain("first_clicks", "clicks", "6 hours"),
    ),
    "lookup_features": from_log(LOOKED_UP.format(columns="event_id, user_id"), FEATURES),
    "lookup_features_missing": from_log(
        f"""SELECT event_id, CASE interested WHEN 'error' THEN 'unknown ' ELSE '' END || user_id AS user_id, {FEATURE_NAMES}
FROM log LEFT JOIN features ON interested <> 'error' AND user_id = key""",
        FEATURES,
    ),
    "feature_map_to_columns": f"WITH {FEATURES}\nSELECT key AS user_id, {FEATURE_NAMES} FROM features",
    "sql_map_projection": from_log(LOOKED_UP.format(columns=RECORD), FEATURES),
    "struct_expanded": from_log(f"SELECT {RECORD} FROM log"),
    "day_buckets": from_log(f"SELECT event_id, {DAY} AS pt_d, {DAY} AS day_of_millis FROM log"),
    "day_buckets_zone": from_log(
        """SELECT event_id, strftime("timeStamp_flag" + INTERVAL '8 hours', '%Y%m%d') AS pt_d,
  strftime("timeStamp_flag" + INTERVAL '8 hours', '%Y-%m-%d--%H') AS hour FROM log"""
    ),
    "partition_scan": from_log(f"SELECT {RECORD} FROM log WHERE {DAY} = '{ONE_DAY}'"),
    "evolve_append": from_log(
        f"""SELECT {TEXTS}, NULL AS segment, NULL AS nation, {DAY} AS pt_d FROM shows
UNION ALL SELECT {TEXTS}, segment, nation, {DAY} FROM clicks LEFT JOIN features ON user_id = key""",
        KINDS,
        FEATURES,
    ),
    "repeated_load": from_log(
        f"""SELECT {TEXTS}, {DAY} AS pt_d, CASE interested WHEN '0' THEN '1' ELSE '2' END AS load_id
FROM log WHERE interested IN ('0', '1')"""
    ),
    "published_days": from_log(
        f"""SELECT {TEXTS}, {DAY} AS pt_d FROM log
WHERE date_trunc('day', "timeStamp_flag") + INTERVAL '1 day' <= TIMESTAMP '{CLOSED_BEFORE}'"""
    ),
    "bucketed_text": from_log(f"SELECT {LINE} AS value, {DAY} AS pt_d FROM log"),
    "hour_bucketed_text": from_log(f"SELECT {LINE} AS value FROM log"),
    "orc_roundtrip": from_log(f"SELECT {RECORD}, {DAY} AS pt_d FROM log"),
    "stream_distinct": DISTINCT_ROWS,
    "stream_negatives_window": from_log(window_negatives("1 day"), KINDS),
    "stream_negatives_interval": from_log(interval_negatives("shows", "clicks", "6 hours"), KINDS),
    "stream_first_per_user_ttl": FIRST_6H,
    "stream_two_stream": TWO_STREAM_6H,
    "stream_samples_to_table": samples(STORED_SAMPLES),
    "two_streams_to_table": from_log(f"SELECT {TEXTS}, {DAY} AS pt_d FROM log WHERE interested IN ('0', '1')"),
    "stream_text": from_log(f"SELECT {LINE} AS value FROM log"),
    "compacted_loads": from_log(f"SELECT {TEXTS}, {DAY} AS pt_d FROM log"),
    "rolled_by_bytes": from_log(f"SELECT {LINE} AS value, {DAY} AS pt_d FROM log"),
    "lines_to_table_quarantine": from_log(
        f"""SELECT 'samples' AS kind, pt_d AS name, count(*) AS row_count FROM (
  SELECT {DAY} AS pt_d FROM ({window_negatives('1 day')}) n) GROUP BY pt_d
UNION ALL SELECT 'damaged', CASE interested WHEN 'signup' THEN 'fields' WHEN 'error' THEN 'json' ELSE 'time' END, count(*)
FROM log WHERE interested IN ('signup', 'error', 'purchase') GROUP BY interested""",
        KINDS,
    ),
    "lines_to_table_zone": samples(
        f"""{TEXTS}, {FEATURE_NAMES}, strftime("timeStamp_flag" + INTERVAL '8 hours', '%Y%m%d') AS pt_d"""
    ),
    "stream_published_days": from_log(
        f"""SELECT {TEXTS}, {DAY} AS pt_d FROM log
WHERE date_trunc('day', "timeStamp_flag") + INTERVAL '1 day' <= (SELECT max("timeStamp_flag") FROM log) - INTERVAL '2 seconds'"""
    ),
    "stream_quarantine": """SELECT CASE event_type WHEN 'signup' THEN 'fields' WHEN 'error' THEN 'json' WHEN 'purchase' THEN 'time'
  ELSE 'none' END AS reason, count(*) AS line_count FROM events GROUP BY 1""",
    "stream_late_rows": from_log(
        f"""SELECT {RECORD} FROM log WHERE interested = 'signup' AND "timeStamp_flag" <=
  (SELECT max("timeStamp_flag") FROM log WHERE interested <> 'signup') - INTERVAL '2 seconds'"""
    ),
}
