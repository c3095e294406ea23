"""Wire lines to records, with a quarantine for what cannot be read."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicksieve.functions import first_field, has_fields
from clicksieve.functions.times import readable_time
from clicksieve.operators.records import null_fill
from clicksieve.record import EVENT_TIME, JSON_SCHEMA, RECORD_FIELDS

REASON = "reason"
BAD_FIELDS = "fields"
BAD_JSON = "json"
BAD_TIME = "time"

_CORRUPT = "_corrupt"
_SCHEMA = T.StructType(JSON_SCHEMA.fields + [T.StructField(_CORRUPT, T.StringType())])


def decode(lines, value="value", source_tz="UTC"):
    """Every line with its record's columns and the reason it is suspect, NULL if none.

    One pass over the lines; :func:`good_records` and :func:`quarantine` select from it.
    """
    line = F.col(value)
    texts = lines.select(line.alias("value"), F.when(has_fields(line), first_field(line)).alias("_text"))
    parsed = F.from_json("_text", _SCHEMA, {"columnNameOfCorruptRecord": _CORRUPT})
    # Generated, the parsed row stays one value: later filters and columns do not parse again.
    rows = texts.select("value", "_text", F.explode(F.array(parsed)).alias("_json"))
    rows = rows.select("value", "_text", "_json", readable_time(F.col("_json.time_stamp"), source_tz).alias("_time"))
    reason = (
        F.when(F.col("_text").isNull(), BAD_FIELDS)
        .when(F.col("_json").isNull() | F.col(f"_json.{_CORRUPT}").isNotNull(), BAD_JSON)
        .when(F.col("_time").isNull(), BAD_TIME)
    )
    rows = rows.select(
        *[F.col(f"_json.{name}").alias(name) for name in RECORD_FIELDS],
        F.coalesce("_time", F.timestamp_seconds(F.lit(0))).alias(EVENT_TIME),
        reason.alias(REASON),
        "value",
    )
    return null_fill(rows)


def good_records(decoded):
    """The records that could be read; those without a readable time are dated 1970."""
    kept = F.col(REASON).isNull() | (F.col(REASON) == BAD_TIME)
    return decoded.where(kept).select(*RECORD_FIELDS, EVENT_TIME)


def quarantine(decoded):
    """The suspect lines, whole, with their reason."""
    return decoded.where(F.col(REASON).isNotNull()).select("value", REASON)


def quarantine_counts(decoded):
    return quarantine(decoded).groupBy(REASON).agg(F.count("*").alias("line_count"))
