"""Negative samples on streams, from built-in stateful operators.

Streams have no anti-join: an outer join finds the shows without a click
once the watermark has passed their window. Its click side is folded first,
so that no pairs of shows and clicks are formed and a show meets one row at
most. Streams do not adapt to skew either: ``salts`` spreads each key's shows
over so many state partitions, against as many copies of its one click row.
"""

from pyspark.sql import functions as F

from clicksieve.functions import duration_micros
from clicksieve.operators.negatives import FIRST_CLICK, LAST_CLICK, has_click_within
from clicksieve.operators.records import with_label
from clicksieve.record import CLICK, EVENT_TIME, LABEL_WINDOW, SHOW, TTL, WATERMARK_DELAY
from clicksieve.streaming.times import of_kind

SALT = "_salt"
SALTS = 8
REACH = "_reach"
MICROS = "_micros"


def _salted(shown, clicked, salts, spread_by):
    shown = shown.withColumn(SALT, F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    return shown, clicked.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def _left_outer(left, right, on, payload=()):
    """Outer join on equal columns; the right side's keys come back as ``_r`` columns."""
    right = right.select(*[F.col(c).alias(f"_r{c}") for c in on], *payload)
    condition = F.lit(True)
    for column in on:
        condition = condition & (F.col(column) == F.col(f"_r{column}"))
    return left.join(right, condition, "left_outer")


def negatives_in_window_stream(
    df, key="user_id", width=LABEL_WINDOW, ts=EVENT_TIME, delay=WATERMARK_DELAY, distinct=True, salts=SALTS
):
    """The streaming form of ``negatives_in_window``; sets the watermark itself.

    ``distinct`` folds equal rows, as they are in the same window.
    """
    columns = df.columns
    rows = df.withWatermark(ts, delay)
    if distinct:
        # As aggregates, copies fold before they are shuffled.
        rows = of_kind(rows, ts, SHOW, CLICK).groupBy(*columns).agg(F.count("*").alias("_copies")).select(*columns)
    shown, clicked = of_kind(rows, ts, SHOW), of_kind(rows, ts, CLICK)
    window = F.window(ts, width).alias("_window")
    clicked = clicked.groupBy(key, window).agg(F.count("*").alias("_clicks")).select(key, "_window")
    # A join side may have one event-time column: the window. The row's own time goes along as a number.
    others = [c for c in columns if c != ts]
    shown = shown.select(*others, F.unix_micros(F.col(ts)).alias(MICROS), window)
    shown, clicked = _salted(shown, clicked, salts, ["event_id", MICROS])
    joined = _left_outer(shown, clicked, [key, "_window", SALT]).where(F.col(f"_r{key}").isNull())
    joined = joined.withColumn(ts, F.timestamp_micros(MICROS))
    return with_label(joined.select(*columns, F.col("_window.start").alias("window_start")))


def negatives_within_stream(df, key="user_id", ttl=TTL, ts=EVENT_TIME, delay=WATERMARK_DELAY, salts=SALTS):
    """The streaming form of ``negatives_within``; sets the watermark itself.

    As in batch, the last click of a show's bucket and the first of the next
    decide. Both are filed under the window of the later bucket, where the
    show's interval ends, so that no click is late for an earlier window.
    """
    columns = df.columns
    micros = duration_micros(ttl)
    at = F.unix_micros(F.col(ts))
    end = F.timestamp_micros(at + micros)
    # A time shifted by the ttl is delayed by that much more for the same watermark.
    shifted_delay = f"{micros + duration_micros(delay)} microseconds"
    none = F.lit(None).cast("long")
    sides = F.array(
        F.struct(end.alias(REACH), at.alias(LAST_CLICK), none.alias(FIRST_CLICK)),
        F.struct(F.col(ts).alias(REACH), none.alias(LAST_CLICK), at.alias(FIRST_CLICK)),
    )
    reach = df.select(key, "interested", F.explode(sides).alias("_side")).select(key, "interested", "_side.*")
    reach = (
        of_kind(reach.withWatermark(REACH, shifted_delay), REACH, CLICK)
        .groupBy(key, F.window(REACH, f"{micros} microseconds").alias("_window"))
        .agg(F.max(LAST_CLICK).alias(LAST_CLICK), F.min(FIRST_CLICK).alias(FIRST_CLICK))
    )
    shown = df.withColumn(REACH, end).withWatermark(REACH, shifted_delay)
    shown = (
        of_kind(shown, REACH, SHOW)
        .withColumn("_window", F.window(REACH, f"{micros} microseconds"))
        .drop(REACH)
    )
    shown, reach = _salted(shown, reach, salts, ["event_id", ts])
    joined = _left_outer(shown, reach, [key, "_window", SALT], [LAST_CLICK, FIRST_CLICK])
    clicked = F.coalesce(has_click_within(at, ttl), F.lit(False))
    return with_label(joined.where(~clicked).select(*columns))
