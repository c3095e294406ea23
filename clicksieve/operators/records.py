"""Row-wise steps on records."""

from pyspark.sql import functions as F

from clicksieve.functions import lenient_timestamp
from clicksieve.record import CLICK, EVENT_TIME, LABEL, NEGATIVE_LABEL, RECORD_FIELDS, SHOW


def null_fill(df, columns=RECORD_FIELDS):
    """NULL strings become empty, so that later equality never meets NULL."""
    return df.na.fill("", subset=list(columns))


def shows(df):
    return df.where(F.col("interested") == SHOW)


def clicks(df):
    return df.where(F.col("interested") == CLICK)


def expand_struct(df, column):
    """A struct column's fields in its place, the other columns after them."""
    return df.select(f"{column}.*", *[c for c in df.columns if c != column])


def flatten(df, column):
    """One row per element of an array of structs; the other columns come along."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(column).alias(column)).select(f"{column}.*", *others)


def with_label(df, label=NEGATIVE_LABEL):
    return df.withColumn(LABEL, F.lit(label))


def without_label(df):
    return df.drop(LABEL)


def record_from_row(df, source_tz="UTC"):
    """The first five columns, whatever their names, as records; the time is parsed again."""
    columns = [F.col(f"`{name}`").cast("string").alias(field) for field, name in zip(RECORD_FIELDS, df.columns)]
    return null_fill(df.select(*columns)).withColumn(EVENT_TIME, lenient_timestamp(F.col("time_stamp"), source_tz))
