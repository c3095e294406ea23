"""String maps."""

from clicksieve.record import MAP_FUNCTION


def map_value(column, key):
    """A map's value, NULL when the key is missing."""
    return column[key]


def register_map_function(spark, name=MAP_FUNCTION):
    """Offer the map lookup to SQL as ``name(map, key)``; Catalyst inlines its body."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(m MAP<STRING, STRING>, k STRING) "
        "RETURNS STRING RETURN m[k]"
    )
