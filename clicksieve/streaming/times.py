"""Event time on streams.

Rows later than the watermark are dropped by every stateful operator here.
The last windows of a stream close only when a later row moves the watermark
past them; a bounded replay ends with :func:`end_record`.
"""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from clicksieve.record import RECORD_SCHEMA

END_USER = "__end"


def end_record(spark):
    """A record from the far future, neither show nor click, after which all windows and timers have fired."""
    far = datetime(2200, 1, 1, tzinfo=timezone.utc)
    return spark.createDataFrame([(END_USER, "", "", "", "", far)], RECORD_SCHEMA)


def of_kind(df, at, *kinds):
    """Rows of the given kinds, chosen after the watermark has seen all rows.

    Catalyst moves a plain filter below the watermark, which then would not
    advance with the other rows. A condition on the event time ``at`` stays.
    """
    any_time = F.col(at) > F.to_timestamp(F.lit("0001-01-01 00:00:00"))
    return df.where(F.when(any_time, F.col("interested").isin(*kinds)))
