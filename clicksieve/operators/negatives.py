"""Negative samples: shows that got no click."""

from pyspark.sql import functions as F

from clicksieve.functions import bucket_start, duration_micros, window_start
from clicksieve.operators.distinct import WINDOW_START
from clicksieve.operators.records import clicks, null_fill, shows, with_label
from clicksieve.operators.skew import splittable
from clicksieve.operators.ttl import first_per_key_ttl
from clicksieve.record import CLICK, EVENT_TIME, LABEL_WINDOW, SHOW, TTL

BUCKET = "_bucket"
LAST_CLICK = "_last_click"
FIRST_CLICK = "_first_click"
CLICKED = "_clicked"


def labelled_rows(df):
    """Shows and clicks; rows of any other kind take no part in labelling."""
    return df.where(F.col("interested").isin(SHOW, CLICK))


def negatives_in_window(df, key="user_id", width=LABEL_WINDOW, ts=EVENT_TIME, distinct=False):
    """Shows whose key has no click in the same tumbling window, labelled and with the window's start.

    NULL keys are filled, and are one key. ``distinct`` first folds equal rows.
    Shows and clicks then read one shuffle of one decoded input: the flag is aggregated and the
    join keys are never NULL, so that no filter of either sinks below the fold.
    """
    rows = null_fill(labelled_rows(df).withColumn(WINDOW_START, window_start(F.col(ts), width)), [key])
    if distinct:
        folded = rows.groupBy(*rows.columns).agg(F.max(F.col("interested") == CLICK).alias(CLICKED))
        shown = folded.where(~F.col(CLICKED)).drop(CLICKED)
        clicked = folded.where(CLICKED)
    else:
        shown, clicked = shows(rows), clicks(rows)
    clicked = clicked.select(key, WINDOW_START).distinct()
    columns = shown.columns
    shown, clicked, on = splittable(shown, clicked, [key, WINDOW_START])
    return with_label(shown.join(clicked, on, "left_anti").select(*columns))


def click_reach(clicked, key, ttl, ts):
    """Per key and ``ttl`` bucket, the clicks that can matter to a show in it.

    A show's interval is the rest of its own bucket and the head of the next
    one. It holds a click exactly if the last click of its bucket is not
    before the show, or the first click of the next is not after its end. So
    two numbers per bucket replace all clicks.
    """
    micros = F.unix_micros(F.col(ts))
    bucket = bucket_start(F.col(ts), ttl)
    none = F.lit(None).cast("long")
    sides = F.array(
        F.struct(bucket.alias(BUCKET), micros.alias(LAST_CLICK), none.alias(FIRST_CLICK)),
        F.struct((bucket - duration_micros(ttl)).alias(BUCKET), none.alias(LAST_CLICK), micros.alias(FIRST_CLICK)),
    )
    return (
        clicked.select(key, F.explode(sides).alias("_side"))
        .select(key, "_side.*")
        .groupBy(key, BUCKET)
        .agg(F.max(LAST_CLICK).alias(LAST_CLICK), F.min(FIRST_CLICK).alias(FIRST_CLICK))
    )


def has_click_within(micros, ttl):
    """Whether the joined :func:`click_reach` row holds a click in a show's closed interval."""
    return (F.col(LAST_CLICK) >= micros) | (F.col(FIRST_CLICK) <= micros + duration_micros(ttl))


def negatives_within(shown, clicked, key="user_id", ttl=TTL, ts=EVENT_TIME):
    """Shows with no click of their key from the show's time to ``ttl`` later, both included.

    NULL keys are filled, and are one key.
    """
    columns = shown.columns
    shown, clicked = null_fill(shown, [key]), null_fill(clicked, [key])
    reach = click_reach(clicked, key, ttl, ts)
    left, right, on = splittable(shown.withColumn(BUCKET, bucket_start(F.col(ts), ttl)), reach, [key, BUCKET])
    right = right.select(*[F.col(c).alias(f"_r_{c}") for c in on], LAST_CLICK, FIRST_CLICK)
    matches = has_click_within(F.unix_micros(F.col(ts)), ttl)
    for c in on:
        matches = (F.col(c) == F.col(f"_r_{c}")) & matches
    return with_label(left.join(right, matches, "left_anti").select(*columns))


def connect_by_key(left, right, side="side", names=("left", "right")):
    """Two inputs of the same columns as one, tagged, for work that groups both by a key."""
    return left.withColumn(side, F.lit(names[0])).unionByName(right.withColumn(side, F.lit(names[1])))


def negatives_two_stream(df, key="user_id", ttl=TTL, ts=EVENT_TIME, tie="event_id", dedup_clicks=True, partitions=None):
    """Shows and clicks each thinned to the first per key and ``ttl``, then :func:`negatives_within`.

    Thinning hides clicks too, so a show may stay negative although a later,
    hidden click followed it; ``dedup_clicks=False`` counts every click. NULL
    keys are filled, and are one key; rows without a time are left out. Both
    steps spread a key of very many rows over tasks.
    """
    rows = null_fill(labelled_rows(df), [key]).where(F.col(ts).isNotNull())
    thinned = first_per_key_ttl(rows if dedup_clicks else shows(rows), [key, "interested"], ttl, ts, tie, partitions)
    return negatives_within(shows(thinned), clicks(thinned if dedup_clicks else rows), key, ttl, ts)


def negatives_across_windows(df, key="user_id", width=LABEL_WINDOW, ttl=TTL, ts=EVENT_TIME, tie="event_id", partitions=None):
    """Clicked shows removed within a window, the rest thinned across windows, then clicked ones removed again."""
    df = null_fill(df, [key])
    unclicked = negatives_in_window(df, key, width, ts, distinct=True).select(*df.columns)
    thinned = first_per_key_ttl(unclicked, key, ttl, ts, tie, partitions)
    first_clicks = first_per_key_ttl(clicks(df), key, ttl, ts, tie, partitions)
    return negatives_within(thinned, first_clicks, key, ttl, ts)
