"""Every operator as a query over the given tables."""

import os

from pyspark.sql import functions as F

from clicksieve.functions import day, day_of_millis, lenient_timestamp, register_map_function
from clicksieve.operators import (
    clicks,
    connect_by_key,
    decode,
    distinct_in_window,
    expand_struct,
    first_per_key_ttl,
    flatten,
    good_records,
    json_lines,
    lookup_features,
    map_to_columns,
    negatives_across_windows,
    negatives_in_window,
    negatives_two_stream,
    negatives_within,
    null_fill,
    quarantine_counts,
    record_lines,
    shows,
    window_arrays,
    wire_lines,
)
from clicksieve.operators.decode import REASON
from clicksieve.operators.distinct import ELEMENTS, WINDOW_START
from clicksieve.plans.samples import (
    lines_to_table,
    samples_from_lines,
    stream_lines_to_records,
    stream_lines_to_table,
    table_to_records,
)
from clicksieve.record import EVENT_TIME, LOAD_COLUMN, MAP_COLUMN, MAP_FUNCTION, PARTITION_COLUMN, RECORD_FIELDS, STRUCT_COLUMN
from clicksieve.session import fresh_path, use_utc
from clicksieve.sinks import (
    bucketed,
    compact_loads,
    create_sample_table,
    current_rows,
    drop_merged_loads,
    evolve_and_append,
    folder_days,
    hour_bucketed,
    publish_closed_days,
    write_orc_buckets,
    write_text_buckets,
    write_text_rolled,
)
from clicksieve.sinks.files import ROLL
from clicksieve.sources import customer_features, events_log, read_lines, register_view, stream_lines
from clicksieve.streaming import (
    date_in_order,
    distinct_stream,
    end_record,
    first_per_key_ttl_stream,
    in_time_order,
    late_rows_stream,
    negatives_in_window_stream,
    negatives_two_stream_stream,
    negatives_within_stream,
    replay,
    stream_to_table,
    stream_to_text_buckets,
)
from clicksieve.streaming.times import END_USER

FEATURES = ["segment", "nation", "in_credit", "field8"]
RECORD = [*RECORD_FIELDS, EVENT_TIME]
ONE_DAY = "20240115"
CLOSED_BEFORE = "2024-01-20 12:00:00"
DENSER = 2000  # times of the dense log are so many times nearer to one another
ROWS_PER_FILE = 50_000  # about, and at least per micro-batch of a replayed log
BATCHES = 16  # of a longer log, about, until
ROWS_PER_BATCH = 1_000_000  # are in each
ROW_GROUP_BYTES = 4 << 20  # so that several tasks read one file of a micro-batch
BYTES_PER_FILE = 65_536


def comparable(df):
    """Times without a zone, so that any engine reads the same values."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def new_table(spark, name, **options):
    path = fresh_path(spark, name)
    table = os.path.basename(path).replace("-", "_")
    create_sample_table(spark, table, path=path, **options)
    return table


def twice(df):
    """A log delivered twice."""
    return df.unionByName(df)


# Lines and records


def decode_wire(spark, sf):
    return good_records(decode(wire_lines(events_log(spark, sf), RECORD_FIELDS)))


def damaged_lines(spark, sf):
    """The log's lines, damaged by event type: a field short, half a JSON text, no time."""
    log = events_log(spark, sf)
    whole = wire_lines(log.withColumn("kind", F.col("interested")), [*RECORD_FIELDS, "kind"])
    line, kind = F.col("value"), F.get_json_object(F.substring_index("value", "\u0001", 1), "$.kind")
    damaged = (
        F.when(kind == "signup", F.substring_index(line, "\u0001", 2))
        .when(kind == "error", F.regexp_replace(line, '"event_id.*?\u0001', "\u0001"))
        .when(kind == "purchase", F.regexp_replace(line, '"time_stamp":"[^"]*"', '"time_stamp":"soon"'))
        .otherwise(line)
    )
    return whole.select(damaged.alias("value"))


def quarantined(spark, sf):
    return quarantine_counts(decode(damaged_lines(spark, sf)))


def quarantine_rest(spark, sf):
    """The records of the damaged lines that could be read."""
    return good_records(decode(damaged_lines(spark, sf)))


def parse_time_lenient(spark, sf):
    text = F.col("time_stamp")
    second = F.substring_index(text, ".", 1)
    forms = {
        "fraction and offset": text,
        "offset": F.concat(second, F.lit("+00:00")),
        "plain": second,
        "minutes only": F.substring(text, 1, 16),
        "prefixed": F.concat(F.lit("at "), text),
        "blank": F.concat(F.lit("  "), text),
        "month 13": F.concat(F.substring(text, 1, 5), F.lit("13"), F.substring(second, 8, 100)),
        "hour 24": F.concat(F.substring(text, 1, 11), F.lit("24:00:00")),
        "30 February": F.concat(F.substring(text, 1, 5), F.lit("02-30 10:00:00")),
        "empty": F.lit(""),
        "missing": F.lit(None).cast("string"),
    }
    variants = F.array(*[F.struct(F.lit(name).alias("form"), t.alias("text")) for name, t in forms.items()])
    rows = events_log(spark, sf).select("event_id", F.explode(variants).alias("variant"))
    return rows.select("event_id", "variant.form", lenient_timestamp(F.col("variant.text")).alias("parsed"))


def null_filled(spark, sf):
    log = events_log(spark, sf)
    holes = log.withColumns(
        {
            "user_id": F.when(F.col("interested") != "signup", F.col("user_id")),
            "invited": F.when(F.col("interested") == "1", F.col("invited")),
        }
    )
    return null_fill(holes)


def json_export(spark, sf):
    """Users stay out of the rows of signups, and so of their JSON."""
    log = events_log(spark, sf)
    user = F.when(F.col("interested") != "signup", F.col("user_id"))
    return json_lines(log.withColumn("user_id", user), RECORD_FIELDS)


def wire_export(spark, sf):
    return wire_lines(events_log(spark, sf), RECORD_FIELDS)


def record_text(spark, sf):
    return record_lines(events_log(spark, sf))


def decode_files(spark, sf):
    """The log written as text files and read from them."""
    path = fresh_path(spark, "lines")
    wire_lines(events_log(spark, sf), RECORD_FIELDS).write.text(path)
    return good_records(decode(read_lines(spark, path)))


def dense_log(spark, sf):
    """Shows and clicks with times so near that windows of seconds hold several of one user."""
    log = events_log(spark, sf, labelled_only=True)
    start = F.unix_seconds(F.lit("2024-01-01").cast("timestamp"))
    seconds = F.floor((F.unix_seconds(EVENT_TIME) - start) / DENSER) + start
    return log.withColumn(EVENT_TIME, F.timestamp_seconds(seconds))


# Distinct rows and first rows


def distinct_rows(spark, sf):
    return distinct_in_window(twice(events_log(spark, sf)))


def distinct_types(spark, sf):
    return distinct_in_window(twice(events_log(spark, sf)), "1 day", columns=["user_id", "interested"])


def window_array_sizes(spark, sf):
    arrays = window_arrays(twice(events_log(spark, sf)), rows_per_array=10_000, width="1 day")
    sizes = arrays.groupBy("window_start", "user_id")
    return sizes.agg(F.sum(F.size(ELEMENTS)).cast("bigint").alias("row_count"))


def window_rows(spark, sf):
    """Rows gathered per window and user in small arrays, then flattened again."""
    arrays = window_arrays(twice(events_log(spark, sf)), width="1 day", rows_per_array=4)
    return flatten(arrays.select(ELEMENTS), ELEMENTS)


def first_per_user(ttl):
    return lambda spark, sf: first_per_key_ttl(clicks(events_log(spark, sf, labelled_only=True)), ttl=ttl)


def first_per_user_segmented(spark, sf):
    """As first_per_user_ttl, cut into so many ranges that users span several."""
    return first_per_key_ttl(clicks(events_log(spark, sf, labelled_only=True)), ttl="6 hours", partitions=100)


def first_per_user_dense(spark, sf):
    return first_per_key_ttl(clicks(dense_log(spark, sf)), ttl="30 seconds")


def window_negatives_dense(spark, sf):
    return negatives_in_window(dense_log(spark, sf), width="10 seconds")


def interval_negatives_dense(spark, sf):
    log = dense_log(spark, sf)
    return negatives_within(shows(log), clicks(log), ttl="30 seconds")


def two_stream_negatives_dense(spark, sf):
    return negatives_two_stream(dense_log(spark, sf), ttl="30 seconds")


def connected_counts(spark, sf):
    log = events_log(spark, sf, labelled_only=True)
    both = connect_by_key(shows(log), clicks(log), names=("show", "click"))
    return both.groupBy("user_id", "side").agg(F.count("*").alias("row_count"))


# Negative samples


def window_negatives(width, distinct=False):
    def run(spark, sf):
        log = events_log(spark, sf, labelled_only=True)
        return negatives_in_window(twice(log) if distinct else log, width=width, distinct=distinct)

    return run


def interval_negatives(ttl):
    def run(spark, sf):
        log = events_log(spark, sf, labelled_only=True)
        return negatives_within(shows(log), clicks(log), ttl=ttl)

    return run


def two_stream_negatives(ttl, dedup_clicks=True):
    def run(spark, sf):
        return negatives_two_stream(events_log(spark, sf, labelled_only=True), ttl=ttl, dedup_clicks=dedup_clicks)

    return run


def multi_window_negatives(spark, sf):
    return negatives_across_windows(events_log(spark, sf, labelled_only=True), width="1 hour", ttl="6 hours")


# Features


def looked_up(spark, sf):
    enriched = lookup_features(events_log(spark, sf), customer_features(spark, sf), FEATURES)
    return map_to_columns(enriched.select("event_id", "user_id", MAP_COLUMN), FEATURES)


def looked_up_with_misses(spark, sf):
    """Users of errors have no features, and stay."""
    log = events_log(spark, sf)
    unknown = F.when(F.col("interested") == "error", F.concat(F.lit("unknown "), "user_id")).otherwise(F.col("user_id"))
    enriched = lookup_features(log.withColumn("user_id", unknown), customer_features(spark, sf), FEATURES)
    return map_to_columns(enriched.select("event_id", "user_id", MAP_COLUMN), FEATURES)


def features_of_users(spark, sf):
    """Features of every customer, event or not, as a map and back."""
    customers = spark.read.parquet(os.path.join(sf, "customer.parquet"))
    keys = customers.select(F.col("c_custkey").cast("string").alias("user_id"))
    return map_to_columns(lookup_features(keys, customer_features(spark, sf), FEATURES), FEATURES)


def sql_map_projection(spark, sf):
    """The registered struct-and-map view, read in SQL with the map function."""
    enriched = lookup_features(events_log(spark, sf), customer_features(spark, sf), FEATURES)
    nested = enriched.select(F.struct(*RECORD).alias(STRUCT_COLUMN), MAP_COLUMN)
    register_map_function(spark)
    register_view(nested, "union_table")
    picked = ", ".join(f"{MAP_FUNCTION}({MAP_COLUMN}, '{name}') AS {name}" for name in FEATURES)
    return spark.sql(f"SELECT {STRUCT_COLUMN}.*, {picked} FROM union_table")


def struct_expanded(spark, sf):
    nested = events_log(spark, sf).select(F.struct(*RECORD).alias(STRUCT_COLUMN))
    return expand_struct(nested, STRUCT_COLUMN)


# Days, tables and files


def day_buckets(spark, sf):
    millis = F.unix_millis(F.col(EVENT_TIME))
    return bucketed(events_log(spark, sf)).select(
        "event_id", PARTITION_COLUMN, day_of_millis(millis).alias("day_of_millis")
    )


def day_buckets_zone(spark, sf):
    hour = day(F.col(EVENT_TIME), "yyyy-MM-dd--HH", "Asia/Shanghai")
    rows = bucketed(events_log(spark, sf), tz="Asia/Shanghai")
    return rows.select("event_id", PARTITION_COLUMN, hour.alias("hour"))


def partition_scanned(spark, sf):
    table = new_table(spark, "scan")
    evolve_and_append(events_log(spark, sf), table)
    return table_to_records(spark, table, ONE_DAY)


def evolve_append(spark, sf):
    """Shows, then clicks with two feature columns more, in one table."""
    log = events_log(spark, sf, labelled_only=True)
    table = new_table(spark, "evolve")
    evolve_and_append(shows(log), table)
    enriched = lookup_features(clicks(log), customer_features(spark, sf), FEATURES[:2])
    evolve_and_append(map_to_columns(enriched, FEATURES[:2]), table)
    return spark.table(table)


def repeated_load(spark, sf):
    """A load that ran twice and counts once."""
    log = events_log(spark, sf, labelled_only=True)
    table = new_table(spark, "repeat", batch_column="load_id")
    for batch, batch_id in ((shows(log), 1), (clicks(log), 2), (clicks(log), 2)):
        evolve_and_append(batch, table, batch_column="load_id", batch_id=batch_id)
    return spark.table(table)


def published_days(spark, sf):
    """Files are written for all days, but a day is visible only once the watermark has passed it."""
    table = new_table(spark, "publish")
    path = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
    rows = bucketed(events_log(spark, sf)).drop(EVENT_TIME)
    rows.hint("rebalance", PARTITION_COLUMN).write.mode("append").partitionBy(PARTITION_COLUMN).parquet(path)
    publish_closed_days(spark, table, folder_days(spark, path), CLOSED_BEFORE)
    return spark.table(table)


def compacted_loads(spark, sf):
    """Five loads of every day merged, the replaced ones dropped, one of them written again, which changes nothing."""
    log = events_log(spark, sf)
    table = new_table(spark, "compact", batch_column=LOAD_COLUMN)
    loads = [log.where(F.pmod(F.col("event_id").cast("long"), F.lit(5)) == n) for n in range(5)]
    for number, rows in enumerate(loads):
        evolve_and_append(rows, table, batch_column=LOAD_COLUMN, batch_id=f"log-{number}")
    compact_loads(spark, table)
    drop_merged_loads(spark, table, keep=None)
    evolve_and_append(loads[1], table, batch_column=LOAD_COLUMN, batch_id="log-1")
    return current_rows(spark, table).drop(LOAD_COLUMN)


def rolled_by_bytes(spark, sf):
    """Record lines per day in files of so many bytes."""
    path = fresh_path(spark, "rolled")
    write_text_rolled(record_lines(bucketed(events_log(spark, sf)), keep=[PARTITION_COLUMN]), path, BYTES_PER_FILE)
    return spark.read.schema(f"value string, {PARTITION_COLUMN} string, {ROLL} int").text(path).drop(ROLL)


def bucketed_text(spark, sf):
    path = fresh_path(spark, "text")
    write_text_buckets(record_lines(bucketed(events_log(spark, sf)), keep=[PARTITION_COLUMN]), path, max_records=1_000_000)
    schema = f"value string, {PARTITION_COLUMN} string"
    return spark.read.schema(schema).text(path)


def hour_bucketed_text(spark, sf):
    path = fresh_path(spark, "hours")
    write_text_buckets(hour_bucketed(record_lines(events_log(spark, sf))), path, column="bucket")
    return spark.read.schema("value string, bucket string").text(path).select("value")


def orc_roundtrip(spark, sf):
    path = fresh_path(spark, "orc")
    rows = bucketed(events_log(spark, sf))
    write_orc_buckets(rows, path)
    return spark.read.schema(rows.schema).orc(path)


# The whole way


def labelled(spark, sf):
    """Wire lines to labelled, enriched, dated samples, in windows of a day."""
    lines = wire_lines(events_log(spark, sf), RECORD_FIELDS)
    return samples_from_lines(lines, customer_features(spark, sf), FEATURES, "1 day")


def labelled_to_table(spark, sf):
    table = new_table(spark, "samples")
    lines = wire_lines(events_log(spark, sf), RECORD_FIELDS)
    lines_to_table(lines, customer_features(spark, sf), table, FEATURES, "1 day")
    return spark.table(table)


def labelled_with_quarantine(spark, sf):
    """Damaged lines to samples per day and quarantined lines per reason, from one decoding; loaded twice under one name."""
    samples = new_table(spark, "samples", batch_column=LOAD_COLUMN)
    damaged = new_table(spark, "damaged", columns=["value", REASON], batch_column=LOAD_COLUMN)
    features = customer_features(spark, sf)
    for _ in range(2):
        lines_to_table(damaged_lines(spark, sf), features, samples, FEATURES, "1 day", damaged=damaged, load="log")
    count = F.count("*").alias("row_count")
    days = spark.table(samples).groupBy(F.lit("samples").alias("kind"), F.col(PARTITION_COLUMN).alias("name")).agg(count)
    return days.unionByName(spark.table(damaged).groupBy(F.lit("damaged").alias("kind"), F.col(REASON).alias("name")).agg(count))


def labelled_in_zone(spark, sf):
    """The whole way with the days of another zone."""
    table = new_table(spark, "zone")
    lines = wire_lines(events_log(spark, sf), RECORD_FIELDS)
    lines_to_table(lines, customer_features(spark, sf), table, FEATURES, "1 day", tz="Asia/Shanghai")
    return spark.table(table)


# Streams


def batch_rows(count):
    """About how many rows of a log of ``count`` rows a micro-batch takes.

    Each micro-batch starts jobs and commits all state partitions whatever it
    holds, so their number must not grow with the log, until they are as large
    as a micro-batch should be.
    """
    return min(ROWS_PER_BATCH, max(ROWS_PER_FILE, -(-count // BATCHES)))


def files_in_order(spark, rows, path, make=lambda ordered: ordered, count=None):
    """Writes a log, or a part of one that has ``count`` rows, as the files that a stream reads one by one in the order of time."""
    here = rows.count()
    size = batch_rows(count or here)
    made = make(in_time_order(rows, size, count=here))
    # Ranges are sampled: only those with far more rows, of one instant, are cut.
    writer = made.write.mode("append").option("maxRecordsPerFile", 2 * size).option("parquet.block.size", ROW_GROUP_BYTES)
    writer.text(path) if made.columns == ["value"] else writer.parquet(path)


def log_stream(spark, log, end=None):
    """A log as a stream of bounded files, and last the record after which every window has closed."""
    path = fresh_path(spark, "stream")
    files_in_order(spark, log, path)
    date_in_order(spark, path)
    (end or end_record(spark)).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(path)


def replayed(spark, log, name, operator):
    """A log through a stream operator, in one run of many micro-batches; without what the end record itself makes."""
    return replay(operator(log_stream(spark, log)), name).where(~F.col("user_id").eqNullSafe(END_USER))


def stream_distinct(spark, sf):
    return replayed(spark, twice(events_log(spark, sf)), "distinct", distinct_stream)


def stream_negatives_window(spark, sf):
    return replayed(spark, events_log(spark, sf), "window", lambda s: negatives_in_window_stream(s, width="1 day"))


def stream_negatives_interval(spark, sf):
    return replayed(spark, events_log(spark, sf), "interval", lambda s: negatives_within_stream(s, ttl="6 hours"))


def stream_first_per_user(spark, sf):
    log = clicks(events_log(spark, sf, labelled_only=True))
    return replayed(spark, log, "first", lambda s: first_per_key_ttl_stream(s, ttl="6 hours"))


def stream_two_stream(spark, sf):
    return replayed(spark, events_log(spark, sf), "two", lambda s: negatives_two_stream_stream(s, ttl="6 hours"))


def stream_to_samples(spark, sf):
    """The whole way on a stream of lines, into a table."""
    path = fresh_path(spark, "lines")
    files_in_order(spark, events_log(spark, sf), path, lambda rows: wire_lines(rows, RECORD_FIELDS))
    date_in_order(spark, path)
    end = end_record(spark).withColumn("time_stamp", F.lit("2200-01-01 00:00:00"))
    wire_lines(end, RECORD_FIELDS).coalesce(1).write.mode("append").text(path)
    table = new_table(spark, "samples", batch_column=LOAD_COLUMN)
    stream_lines_to_table(
        stream_lines(spark, path, 1), customer_features(spark, sf), table, f"{path}-progress", FEATURES, "1 day", interval=None
    ).awaitTermination()
    return spark.table(table).drop(LOAD_COLUMN)


def stream_published(spark, sf):
    """Distinct rows into a table that shows a day once the stream's watermark has passed it: here all but the last one."""
    rows = distinct_stream(log_stream(spark, twice(events_log(spark, sf)))).drop(WINDOW_START)
    table = new_table(spark, "published", batch_column=LOAD_COLUMN)
    progress = fresh_path(spark, "progress")
    stream_to_table(rows, table, progress, interval=None, publish=True).awaitTermination()
    return spark.table(table).drop(LOAD_COLUMN)


def stream_quarantine(spark, sf):
    """Damaged lines as a stream: how many lines ended as records, and how many in quarantine for which reason."""
    path = fresh_path(spark, "lines")
    damaged_lines(spark, sf).write.option("maxRecordsPerFile", ROWS_PER_FILE).text(path)
    at_once = batch_rows(events_log(spark, sf).count()) // ROWS_PER_FILE
    records = new_table(spark, "records", batch_column=LOAD_COLUMN)
    damaged = new_table(spark, "damaged", columns=["value", REASON], batch_column=LOAD_COLUMN)
    stream_lines_to_records(stream_lines(spark, path, at_once), records, damaged, f"{path}-progress", interval=None).awaitTermination()
    counts = spark.table(records).agg(F.lit("none").alias(REASON), F.count("*").alias("line_count"))
    return counts.unionByName(spark.table(damaged).groupBy(REASON).agg(F.count("*").alias("line_count")))


def late_rows(spark, sf):
    """Signups arrive after all other rows: those that the watermark has passed by then."""
    log, root = events_log(spark, sf), fresh_path(spark, "late")
    on_time, late, count = f"{root}/a", f"{root}/b", log.count()
    files_in_order(spark, log.where("interested <> 'signup'"), on_time, count=count)
    files_in_order(spark, log.where("interested = 'signup'"), late, count=count)
    date_in_order(spark, on_time, late)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/*")
    return replay(late_rows_stream(stream), "late").drop("watermark")


def two_streams_to_table(spark, sf):
    """Shows and clicks as two streams into one table, each with its own checkpoint; the second one is started again."""
    log = events_log(spark, sf, labelled_only=True)
    table = new_table(spark, "shared", batch_column=LOAD_COLUMN)
    paths = [fresh_path(spark, name) for name in ("shows", "clicks")]
    for rows, path in zip((shows(log), clicks(log)), paths):
        rows.write.parquet(path)
    for path in (*paths, paths[1]):
        stream = spark.readStream.schema(log.schema).parquet(path)
        stream_to_table(stream, table, f"{path}-progress", interval=None).awaitTermination()
    return spark.table(table).drop(LOAD_COLUMN)


def stream_text(spark, sf):
    path = fresh_path(spark, "lines")
    record_lines(events_log(spark, sf)).write.text(path)
    out = fresh_path(spark, "rolled")
    stream_to_text_buckets(stream_lines(spark, path), out, f"{out}-progress", None, 1_000_000).awaitTermination()
    return spark.read.schema("value string, bucket string").text(out).select("value")


def _in_utc(query):
    return lambda spark, sf: comparable(query(use_utc(spark), sf))


QUERIES = {
    name: _in_utc(query)
    for name, query in {
        "labelled_samples": labelled,
        "labelled_samples_to_table": labelled_to_table,
        "decode_wire": decode_wire,
        "quarantine_counts": quarantined,
        "quarantine_rest": quarantine_rest,
        "parse_time_lenient": parse_time_lenient,
        "null_fill": null_filled,
        "json_export": json_export,
        "wire_export": wire_export,
        "record_lines": record_text,
        "decode_files": decode_files,
        "distinct_rows_in_window": distinct_rows,
        "distinct_in_window": distinct_types,
        "window_arrays": window_array_sizes,
        "window_rows": window_rows,
        "first_per_user_30s": first_per_user("30 seconds"),
        "first_per_user_ttl": first_per_user("6 hours"),
        "first_per_user_segmented": first_per_user_segmented,
        "first_per_user_30s_dense": first_per_user_dense,
        "negatives_window_10s_dense": window_negatives_dense,
        "negatives_interval_30s_dense": interval_negatives_dense,
        "negatives_two_stream_30s_dense": two_stream_negatives_dense,
        "connected_counts": connected_counts,
        "negatives_window_10s": window_negatives("10 seconds"),
        "negatives_window_1h": window_negatives("1 hour"),
        "negatives_window_1d": window_negatives("1 day"),
        "negatives_window_distinct_1d": window_negatives("1 day", distinct=True),
        "negatives_interval_30s": interval_negatives("30 seconds"),
        "negatives_interval_6h": interval_negatives("6 hours"),
        "negatives_interval_1d": interval_negatives("1 day"),
        "negatives_two_stream": two_stream_negatives("6 hours"),
        "negatives_two_stream_1d": two_stream_negatives("1 day"),
        "negatives_two_stream_all_clicks": two_stream_negatives("6 hours", dedup_clicks=False),
        "multi_window_negatives": multi_window_negatives,
        "lookup_features": looked_up,
        "lookup_features_missing": looked_up_with_misses,
        "feature_map_to_columns": features_of_users,
        "sql_map_projection": sql_map_projection,
        "struct_expanded": struct_expanded,
        "day_buckets": day_buckets,
        "day_buckets_zone": day_buckets_zone,
        "partition_scan": partition_scanned,
        "evolve_append": evolve_append,
        "repeated_load": repeated_load,
        "published_days": published_days,
        "compacted_loads": compacted_loads,
        "rolled_by_bytes": rolled_by_bytes,
        "lines_to_table_quarantine": labelled_with_quarantine,
        "lines_to_table_zone": labelled_in_zone,
        "bucketed_text": bucketed_text,
        "hour_bucketed_text": hour_bucketed_text,
        "orc_roundtrip": orc_roundtrip,
        "stream_distinct": stream_distinct,
        "stream_negatives_window": stream_negatives_window,
        "stream_negatives_interval": stream_negatives_interval,
        "stream_first_per_user_ttl": stream_first_per_user,
        "stream_two_stream": stream_two_stream,
        "stream_samples_to_table": stream_to_samples,
        "two_streams_to_table": two_streams_to_table,
        "stream_text": stream_text,
        "stream_published_days": stream_published,
        "stream_quarantine": stream_quarantine,
        "stream_late_rows": late_rows,
    }.items()
}
