"""Running streams: checkpoints, triggers, sinks."""

import time

from pyspark.sql import functions as F

from clicksieve.record import EVENT_TIME, LOAD_COLUMN, PARTITION_COLUMN, TRIGGER_INTERVAL
from clicksieve.session import fresh_path
from clicksieve.sinks.files import hour_bucketed
from clicksieve.sinks.folders import date_file, files
from clicksieve.sinks.publish import Publisher
from clicksieve.sinks.tables import evolve_and_append, write_load


def stream_id(batch):
    """The id of the stream a micro-batch is of: kept in its checkpoint, and the same after a restart."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def trigger(writer, interval):
    """Micro-batches at an interval, or all present input once and stop for None."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def stream_to_text_buckets(lines, path, checkpoint, interval=TRIGGER_INTERVAL, max_records=None, column="bucket"):
    """A ``value`` stream into UTF-8 files per hour of processing; files roll with each trigger."""
    writer = hour_bucketed(lines, column).writeStream.format("text").partitionBy(column)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return trigger(writer, interval).start()


def stream_to_table(
    df,
    table,
    checkpoint,
    interval=TRIGGER_INTERVAL,
    ts=EVENT_TIME,
    partition=PARTITION_COLUMN,
    batch_column=LOAD_COLUMN,
    tz="UTC",
    publish=False,
):
    """A stream appended to a table partitioned by day (in the zone ``tz``), which gains new columns batch by batch.

    A batch cut short by a failure runs again. ``batch_column``, by which the
    table is partitioned first, names the load: the stream, by the id that its
    checkpoint keeps, and the batch. So a repeat replaces its own first attempt
    and nothing else, whatever other streams or checkpoints feed the table.
    With ``None`` a repeat may leave duplicates.

    With ``publish`` a day appears in the table only once the stream's own
    watermark has passed its end; see :class:`Publisher`.
    """
    spark = df.sparkSession
    if publish:
        if not batch_column:
            raise ValueError("days are published load by load: name the batch_column")
        publisher = Publisher(spark, table, batch_column, partition, tz)

    def append(batch, batch_id):
        stream = stream_id(batch)
        load = f"{stream}-{batch_id}"
        if publish:
            days = write_load(batch, table, load, ts, partition, load_column=batch_column, tz=tz)
            publisher.publish([(load, day) for day in days], watermark_of(spark, stream))
        else:
            evolve_and_append(batch, table, ts, partition, batch_column=batch_column, batch_id=load, tz=tz)
        # Readers of the session that started the stream see the files as they are now.
        spark.catalog.refreshTable(table)

    writer = df.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).outputMode("append")
    return trigger(writer, interval).start()


def watermark_of(spark, stream):
    """The watermark of a running stream's last finished micro-batch as ISO text, ``None`` before there is one."""
    query = spark.streams.get(stream)
    progress = query.lastProgress if query else None
    return dict(progress["eventTime"]).get("watermark") if progress else None


def in_time_order(df, rows_per_file, ts=EVENT_TIME, count=None):
    """Rows dealt by time to partitions of about ``rows_per_file``, and in order in each; rows without a time first.

    ``count`` is the number of rows, where it is known.

    To be written with ``maxRecordsPerFile``, which also cuts an instant of very
    many rows, and then dated with :func:`date_in_order`.
    """
    parts = -(-(df.count() if count is None else count) // rows_per_file)
    order = F.col(ts).asc_nulls_first()
    return df.repartitionByRange(max(1, parts), order).sortWithinPartitions(order)


def date_in_order(spark, *paths):
    """Gives the files of some folders modification times in the order of the folders and of their names.

    A file stream reads files in the order of these times.
    """
    names = [name for path in paths for name in files(spark, path)]
    last = int(time.time() * 1000)
    for number, name in enumerate(names):
        date_file(spark, name, last - len(names) + number)


def replay(df, name, arrivals=(lambda: None,)):
    """A stream run once after each of ``arrivals``, which add to its input; the rows it emitted, as a batch.

    Each run takes what is there as micro-batches of its own and goes on from
    the state and the watermark of the run before.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-progress")
    for arrive in arrivals:
        arrive()
        trigger(writer.outputMode("append"), None).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(path)
