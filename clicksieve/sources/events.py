"""The ``events`` table as an ad log: views are shows, clicks are clicks."""

import os

from pyspark.sql import functions as F

from clicksieve.record import CLICK, EVENT_TIME, SHOW

LABELLED_TYPES = ["view", "click"]


def events_parquet(spark, sf_dir):
    return spark.read.parquet(os.path.join(sf_dir, "events.parquet"))


def events_log(spark, sf_dir, labelled_only=False):
    """Records from ``events``; ``labelled_only`` leaves other types to the scan's own filter."""
    events = events_parquet(spark, sf_dir)
    if labelled_only:
        events = events.where(F.col("event_type").isin(LABELLED_TYPES))
    return as_log(events)


def as_log(events):
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_id").cast("string").alias("event_id"),
        F.lit("0").alias("invited"),
        F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("time_stamp"),
        F.when(kind == "view", SHOW).when(kind == "click", CLICK).otherwise(kind).alias("interested"),
        # The log's event time has whole seconds.
        F.date_trunc("second", ts).alias(EVENT_TIME),
    )
