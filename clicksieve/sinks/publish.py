"""Days become visible in a table once they are complete."""

from datetime import datetime, timedelta, timezone
from urllib.parse import unquote
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from clicksieve.record import LOAD_COLUMN, PARTITION_COLUMN
from clicksieve.sinks.folders import folders, table_location
from clicksieve.sinks.tables import add_partitions

NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def closed_days(df, watermark, column=PARTITION_COLUMN, tz="UTC"):
    """The distinct days of ``df`` that end at or before ``watermark`` (a UTC timestamp column or text)."""
    end = F.to_utc_timestamp(F.date_add(F.to_date(column, "yyyyMMdd"), 1).cast("timestamp"), tz)
    # Reading a folder may have made the day a number.
    return df.select(F.col(column).cast("string")).distinct().where(end <= F.lit(watermark).cast("timestamp"))


def publish_closed_days(spark, table, written, watermark, column=PARTITION_COLUMN, tz="UTC"):
    """Register the closed days of ``written``, which has a row per day or more.

    Only day names reach the driver. Returns the days. :func:`folder_days`
    gives the days of files that are already there, without opening them.
    """
    days = [row[0] for row in closed_days(written, watermark, column, tz).collect()]
    if days:
        partitions = " ".join(f"PARTITION (`{column}` = '{value}')" for value in sorted(days))
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {partitions}")
    return sorted(days)


def folder_days(spark, path, column=PARTITION_COLUMN):
    """The days that have a folder ``column=day`` under ``path``, by listing it."""
    days = [name.split("=", 1)[1] for name in folders(spark, path) if name.startswith(f"{column}=")]
    return spark.createDataFrame([(day,) for day in days], f"{column} string")


def day_end(day, tz="UTC"):
    """The instant a day (``yyyyMMdd``) of the zone ends."""
    start = datetime.strptime(day, "%Y%m%d")
    return (start + timedelta(days=1)).replace(tzinfo=ZoneInfo(tz)).astimezone(timezone.utc)


class Publisher:
    """Shows the days of a stream's loads once its watermark has passed them.

    Files are written into their folders first and become partitions of the table
    when the watermark of the micro-batch before this one is at or past the end
    of their day, so a day appears a micro-batch late at most and never early.
    Files of a day that has been passed before (by rows within the delay) appear
    at once, and so do rows without a day, which no watermark passes. What waits
    is known from the folders that are no partitions yet, so a stream that
    starts again goes on where it was.
    """

    def __init__(self, spark, table, load_column=LOAD_COLUMN, partition=PARTITION_COLUMN, tz="UTC"):
        self.spark, self.table, self.tz = spark, table, tz
        self.load_column, self.partition = load_column, partition
        self.waiting = None

    def written(self):
        """The ``(load, day)`` pairs that have a folder but are no partition."""
        location, _ = table_location(self.spark, self.table)
        shown = {row[0] for row in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()}
        found = set()
        for load in folders(self.spark, location):
            if load.startswith(f"{self.load_column}="):
                days = [d for d in folders(self.spark, f"{location}/{load}") if d.startswith(f"{self.partition}=")]
                found |= {(load, d) for d in days if f"{load}/{d}" not in shown}
        return {tuple(unquote(name.split("=", 1)[1]) for name in pair) for pair in found}

    def publish(self, pairs, watermark):
        """Adds ``(load, day)`` pairs to what waits, and shows what ``watermark`` (ISO text or ``None``) has passed."""
        if self.waiting is None:
            self.waiting = self.written()
        self.waiting |= set(pairs)
        passed = datetime.fromisoformat(watermark.replace("Z", "+00:00")) if watermark else datetime.min.replace(tzinfo=timezone.utc)
        closed = sorted(p for p in self.waiting if p[1] == NO_DAY or day_end(p[1], self.tz) <= passed)
        add_partitions(self.spark, self.table, closed, self.load_column, self.partition)
        self.waiting -= set(closed)
        return closed
