"""The whole way from log lines to a day-partitioned sample table."""

from pyspark import StorageLevel
from pyspark.sql import functions as F

from clicksieve.functions import day
from clicksieve.operators import (
    decode,
    good_records,
    lookup_features,
    map_to_columns,
    negatives_in_window,
    quarantine,
    record_from_row,
    without_label,
)
from clicksieve.operators.decode import REASON
from clicksieve.operators.distinct import WINDOW_START
from clicksieve.record import (
    DEDUP_WINDOW,
    EVENT_TIME,
    FEATURE_FIELDS,
    LOAD_COLUMN,
    PARTITION_COLUMN,
    RECORD_FIELDS,
    TRIGGER_INTERVAL,
    WATERMARK_DELAY,
)
from clicksieve.session import fresh_path
from clicksieve.sinks import bucketed, evolve_and_append
from clicksieve.sources import partition_scan
from clicksieve.streaming.jobs import stream_id, stream_to_table, trigger
from clicksieve.streaming.labels import negatives_in_window_stream


def labelled_samples(records, features, fields=FEATURE_FIELDS, width=DEDUP_WINDOW, ts=EVENT_TIME, tz="UTC"):
    """Distinct unclicked shows per window, with their user's features as columns and their day."""
    negatives = negatives_in_window(records, width=width, ts=ts, distinct=True).drop(WINDOW_START)
    enriched = map_to_columns(lookup_features(negatives, features, fields), fields)
    return bucketed(enriched, ts, tz=tz)


def samples_from_lines(lines, features, fields=FEATURE_FIELDS, width=DEDUP_WINDOW, source_tz="UTC", tz="UTC"):
    """The same from wire lines, whose times are in ``source_tz``; days are those of the zone ``tz``."""
    return labelled_samples(good_records(decode(lines, source_tz=source_tz)), features, fields, width, tz=tz)


def lines_to_table(lines, features, table, fields=FEATURE_FIELDS, width=DEDUP_WINDOW, source_tz="UTC", tz="UTC", damaged=None, load=None):
    """Wire lines labelled, enriched and appended to a table that gains the feature columns it lacks.

    With ``damaged``, a table, the lines that cannot be read go there whole, with
    their reason and the day of ``load``'s run, from the same decoding: decoded
    lines are written once to the shared folder and both results read them.
    ``load`` names the run, and both tables are then partitioned by load first:
    a run that is repeated replaces what its first attempt wrote to either.
    """
    decoded = decode(lines, source_tz=source_tz)
    if damaged is not None:
        spark = lines.sparkSession
        path = fresh_path(spark, "decoded")
        decoded.write.parquet(path)
        decoded = spark.read.schema(decoded.schema).parquet(path)
    named = {"batch_column": LOAD_COLUMN, "batch_id": load} if load else {}
    samples = labelled_samples(good_records(decoded), features, fields, width, tz=tz)
    evolve_and_append(without_label(samples), table, **named)
    if damaged is not None:
        evolve_and_append(_dated_quarantine(decoded, tz), damaged, **named)


def _dated_quarantine(decoded, tz="UTC"):
    """Suspect lines by the day they are found, as their own times are what cannot be read."""
    return quarantine(decoded).withColumn(PARTITION_COLUMN, day(F.current_timestamp(), tz=tz))


def stream_lines_to_table(
    lines,
    features,
    table,
    checkpoint,
    fields=FEATURE_FIELDS,
    width=DEDUP_WINDOW,
    delay=WATERMARK_DELAY,
    source_tz="UTC",
    **options,
):
    """The same, continuously: a stream of lines joined to the features as they are at each micro-batch.

    ``options`` are those of :func:`stream_to_table`, such as ``tz`` and
    ``publish``. Damaged lines are left out; :func:`stream_lines_to_records`
    keeps them, and :func:`stream_records_to_table` goes on from its records.
    """
    records = good_records(decode(lines, source_tz=source_tz))
    return stream_records_to_table(records, features, table, checkpoint, fields, width, delay, **options)


def stream_records_to_table(
    records, features, table, checkpoint, fields=FEATURE_FIELDS, width=DEDUP_WINDOW, delay=WATERMARK_DELAY, **options
):
    """A stream of records labelled, enriched and appended to a table."""
    negatives = negatives_in_window_stream(records, width=width, delay=delay).drop(WINDOW_START)
    enriched = map_to_columns(lookup_features(negatives, features, fields), fields)
    return stream_to_table(without_label(enriched), table, checkpoint, **options)


def stream_lines_to_records(lines, records, damaged, checkpoint, interval=TRIGGER_INTERVAL, source_tz="UTC", tz="UTC"):
    """A stream of wire lines split into two tables: records, and damaged lines with their reason.

    Each micro-batch is decoded once, and what was decoded feeds both tables.
    Both name the load by stream and micro-batch, so a batch that is repeated
    after a failure, at whatever point, replaces its first attempt in both. A
    line is in exactly one of them: records without a readable time, which
    :func:`good_records` dates 1970, count as damaged here.
    """
    spark = lines.sparkSession

    def split(batch, batch_id):
        load = f"{stream_id(batch)}-{batch_id}"
        decoded = decode(batch, source_tz=source_tz).persist(StorageLevel.DISK_ONLY)
        try:
            good = decoded.where(F.col(REASON).isNull()).select(*RECORD_FIELDS, EVENT_TIME)
            for rows, table in ((good, records), (_dated_quarantine(decoded, tz), damaged)):
                evolve_and_append(rows, table, batch_column=LOAD_COLUMN, batch_id=load, tz=tz)
                spark.catalog.refreshTable(table)
        finally:
            decoded.unpersist()

    return trigger(lines.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint), interval).start()


def table_to_records(spark, table, value):
    """One day of a table as typed records."""
    return record_from_row(partition_scan(spark, table, value))
