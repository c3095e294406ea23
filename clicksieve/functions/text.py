"""Delimited text lines."""

from pyspark.sql import functions as F

from clicksieve.record import DELIMITER, WIRE_FIELD_COUNT


def has_fields(line, count=WIRE_FIELD_COUNT, delimiter=DELIMITER):
    """Whether a line holds exactly ``count`` fields, empty fields at its end not counted."""
    code = f"\\x{{{ord(delimiter):x}}}"
    field, last = f"[^{code}]*", f"[^{code}]+"
    return line.rlike(rf"\A(?:{field}{code}){{{count - 1}}}{last}{code}*\z")


def first_field(line, delimiter=DELIMITER):
    return F.substring_index(line, delimiter, 1)


def delimited(*columns, delimiter=DELIMITER):
    """Columns joined into one line; NULL counts as an empty field."""
    return F.concat_ws(delimiter, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
