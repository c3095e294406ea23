"""Distinct rows on a stream."""

from pyspark.sql import functions as F

from clicksieve.functions import window_start
from clicksieve.operators.distinct import WINDOW_START
from clicksieve.record import DEDUP_WINDOW, EVENT_TIME, WATERMARK_DELAY


def distinct_stream(df, width=DEDUP_WINDOW, ts=EVENT_TIME, delay=WATERMARK_DELAY):
    """The streaming form of ``distinct_in_window``; sets the watermark itself.

    Equal rows share their time and so their window. They fold before they are
    shuffled, so copies of one row do not meet in one task, and leave once the
    watermark has passed them.
    """
    rows = df.withWatermark(ts, delay).groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    return rows.select(*df.columns).withColumn(WINDOW_START, window_start(F.col(ts), width))
