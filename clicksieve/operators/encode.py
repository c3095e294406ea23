"""Records to lines."""

from pyspark.sql import functions as F

from clicksieve.functions import delimited
from clicksieve.record import DELIMITER, RECORD_FIELDS, WIRE_FIELD_COUNT, WIRE_TAIL


def json_lines(df, columns=None):
    """Each row as a JSON text in ``value``; NULL columns are left out."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("value"))


def wire_lines(df, columns=None, tail=WIRE_TAIL):
    """The JSON texts followed by the wire form's further fields, ready for a text or Kafka sink."""
    rest = (DELIMITER + tail) * (WIRE_FIELD_COUNT - 1)
    return json_lines(df, columns).select(F.concat("value", F.lit(rest)).alias("value"))


def record_lines(df, keep=()):
    """Each record's text fields as one delimited line; columns named in ``keep`` come along."""
    return df.select(delimited(*RECORD_FIELDS).alias("value"), *keep)
