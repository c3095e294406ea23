"""Feature lookup per record."""

from pyspark.sql import functions as F

from clicksieve.functions import map_value
from clicksieve.operators.skew import splittable
from clicksieve.record import FEATURE_FIELDS, MAP_COLUMN


def feature_columns(features, fields=FEATURE_FIELDS, version=None):
    """A long ``(key, field, value)`` table as one row per key with a column per field.

    Only the given fields are read. Of several values for one field the one
    with the greatest ``version`` counts, or the greatest value where there
    is no version column.
    """
    value = F.col("value")

    def pick(field):
        mine = F.col("field") == field
        if version is None:
            return F.max(F.when(mine, value)).alias(field)
        return F.max_by(value, F.when(mine, F.struct(F.col(version), value))).alias(field)

    return features.where(F.col("field").isin(*fields)).groupBy("key").agg(*[pick(field) for field in fields])


def lookup_features(df, features, fields=FEATURE_FIELDS, key="user_id", column=MAP_COLUMN, version=None):
    """Every row with a map of its key's features, NULL for those it lacks.

    ``features`` is a long ``(key, field, value)`` table, or the saved result
    of :func:`feature_columns`: one row per ``key``, a column per field. The
    latter spares large or repeated lookups, such as those of a stream, from
    gathering the features each time.

    Spark broadcasts the features where their measured size allows and
    shuffles both sides otherwise.
    """
    columns = df.columns
    is_long = {"field", "value"} <= set(features.columns)
    wide = feature_columns(features, fields, version) if is_long else features
    present = set(wide.columns)
    picked = [F.col(f) if f in present else F.lit(None).cast("string") for f in fields]
    named = wide.select(F.col("key").alias(key), *[c.alias(f"_f_{f}") for c, f in zip(picked, fields)])
    left, right, on = splittable(df, named, [key])
    joined = left.join(right, on, "left")
    pairs = [part for field in fields for part in (F.lit(field), F.col(f"_f_{field}"))]
    return joined.select(*columns, F.create_map(*pairs).alias(column))


def map_to_columns(df, fields=FEATURE_FIELDS, column=MAP_COLUMN):
    """A map's values as columns, in the order given."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, *[map_value(F.col(column), field).alias(field) for field in fields])


def map_partitions(df, open_client, enrich, schema, close_client=None):
    """Row batches through ``enrich(client, batch)`` with one client per partition.

    For outside services only; features that are a table belong in
    :func:`lookup_features`.
    """

    def run(batches):
        client = open_client()
        try:
            for batch in batches:
                yield enrich(client, batch)
        finally:
            if close_client is not None:
                close_client(client)

    return df.mapInPandas(run, schema)
