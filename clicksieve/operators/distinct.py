"""Distinct rows of a tumbling window."""

from pyspark.sql import functions as F

from clicksieve.functions import window_start
from clicksieve.operators.records import null_fill
from clicksieve.operators.skew import splittable
from clicksieve.record import DEDUP_WINDOW, EVENT_TIME

WINDOW_START = "window_start"
ELEMENTS = "elements"


def distinct_in_window(df, width=DEDUP_WINDOW, ts=EVENT_TIME, columns=None):
    """The distinct rows (or distinct ``columns``) of each window, with the window's start.

    Copies fold before the shuffle, which hashes the whole row: neither a
    frequent user nor a frequent row loads one task.
    """
    rows = df.withColumn(WINDOW_START, window_start(F.col(ts), width))
    if columns is not None:
        rows = rows.select(*columns, WINDOW_START)
    return rows.distinct()


def window_arrays(df, rows_per_array, key="user_id", width=DEDUP_WINDOW, ts=EVENT_TIME):
    """The distinct rows of each ``(window, key)`` as arrays of about ``rows_per_array`` at most.

    A group larger than that is dealt out to several arrays, numbered
    ``part``; together they hold every row once. NULL keys are filled, so
    that rows and group sizes share the shuffle of the distinct rows.
    """
    rows = distinct_in_window(null_fill(df, [key]), width, ts)
    group = [WINDOW_START, key]
    sizes = rows.groupBy(*group).agg(
        F.ceil(F.count("*") / F.lit(rows_per_array)).cast("int").alias("_parts")
    )
    rows, sizes, on = splittable(rows, sizes.where(F.col("_parts") > 1), group)
    part = F.pmod(F.xxhash64(*df.columns), F.coalesce("_parts", F.lit(1))).cast("int")
    dealt = rows.join(sizes, on, "left").withColumn("part", part)
    return dealt.groupBy(*group, "part").agg(F.collect_list(F.struct(*df.columns)).alias(ELEMENTS))
