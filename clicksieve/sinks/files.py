"""Files in one folder per time bucket.

Row files roll once per trigger of a stream and at ``max_records`` rows, or at a
size in bytes with :func:`write_text_rolled`. Rolling after an idle second has
no equivalent here.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from clicksieve.functions import day
from clicksieve.record import DAY_PATTERN, EVENT_TIME, HOUR_BUCKET_PATTERN, PARTITION_COLUMN
from clicksieve.session import fresh_path

ROLL = "roll"
CHUNK = "_chunk"
BYTES = "_bytes"
BEFORE = "_before"
NO_BUCKET = "__HIVE_DEFAULT_PARTITION__"


def bucketed(df, ts=EVENT_TIME, column=PARTITION_COLUMN, pattern=DAY_PATTERN, tz="UTC"):
    """Rows with the bucket of their event time, in a pattern and zone of choice."""
    return df.withColumn(column, day(F.col(ts), pattern, tz))


def hour_bucketed(df, column="bucket", pattern=HOUR_BUCKET_PATTERN):
    """Rows with the bucket of the time they are processed."""
    return df.withColumn(column, F.date_format(F.current_timestamp(), pattern))


def _writer(df, column, max_records, rebalance):
    if rebalance:
        df = df.hint("rebalance", column)
    writer = df.write.mode("append").partitionBy(column)
    return writer.option("maxRecordsPerFile", max_records) if max_records else writer


def write_text_buckets(df, path, column=PARTITION_COLUMN, max_records=None, rebalance=True):
    """A line column and a bucket column as UTF-8 text files."""
    _writer(df, column, max_records, rebalance).text(path)


def write_orc_buckets(df, path, column=PARTITION_COLUMN, max_records=None, rebalance=True):
    _writer(df, column, max_records, rebalance).orc(path)


def rolled(lines, max_bytes, column=PARTITION_COLUMN, roll=ROLL):
    """Lines and their bucket with the number of the file they go to, counted from 0 in each bucket.

    A file takes the lines that begin, counted in encoded bytes with their line
    ends, within the same ``max_bytes`` of their bucket; so it is longer than
    that by less than one line. The running sum needs no order of the whole
    bucket: each task's share of the input is a chunk, lines are summed within
    chunks, and chunks are put one after the other by their totals. Lines and
    chunks are written to the shared folder first, so that both read the same.
    """
    spark = lines.sparkSession
    path = fresh_path(spark, "chunks")
    # A text file has one byte for a line's end, and nothing else for a missing line.
    size = F.coalesce(F.octet_length("value"), F.lit(0)).cast("long") + 1
    bucket = F.coalesce(F.col(column).cast("string"), F.lit(NO_BUCKET)).alias(column)
    lines.select("value", bucket, F.spark_partition_id().alias(CHUNK), size.alias(BYTES)).write.parquet(path)
    chunked = spark.read.parquet(path)
    upto_here = Window.partitionBy(column, CHUNK).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    chunks_before = Window.partitionBy(column).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    totals = chunked.groupBy(column, CHUNK).agg(F.sum(BYTES).alias(BYTES))
    offsets = totals.select(column, CHUNK, F.coalesce(F.sum(BYTES).over(chunks_before), F.lit(0)).alias(BEFORE))
    within = chunked.withColumn(BYTES, F.coalesce(F.sum(BYTES).over(upto_here), F.lit(0)))
    number = F.floor((F.col(BEFORE) + F.col(BYTES)) / F.lit(max_bytes)).cast("int")
    return within.join(offsets, [column, CHUNK]).select("value", column, number.alias(roll))


def write_text_rolled(lines, path, max_bytes, column=PARTITION_COLUMN, roll=ROLL):
    """A line column and a bucket column as UTF-8 text, in files of about ``max_bytes``: ``bucket/roll/one file``.

    See :func:`rolled`. A repeat of the job replaces what is at ``path``.
    """
    rows = rolled(lines, max_bytes, column, roll)
    # All rows of a file meet in one task, and a task writes a file for each folder.
    rows.repartition(column, roll).write.mode("overwrite").partitionBy(column, roll).text(path)
