"""Frequent keys.

One key may hold a large share of all rows. Joins leave it to adaptive
execution, which splits an oversized partition of the preserved side by map
output, so that even identical rows spread. It does that only where both
join inputs are plain shuffles; :func:`splittable` makes them so. Operators
that need a key's rows in order deal rows by ranges of key and time.
"""

from pyspark.sql import functions as F

SHARD = "_shard"
SHARDS = 1024  # a power of two


def splittable(left, right, keys):
    """Both sides with one more join key, computed from ``keys`` alike on each.

    It changes no match. An aggregated right side is hashed by ``keys`` only,
    so the join shuffles it once more, and that plain shuffle is what the
    skew rule looks for. The right side is the aggregated, small one.
    """
    shard = F.xxhash64(*keys).bitwiseAND(F.lit(SHARDS - 1))
    return left.withColumn(SHARD, shard), right.withColumn(SHARD, shard), [*keys, SHARD]


def range_partitions(spark):
    """How many ranges rows in order are cut into: as many as a shuffle starts with, since ranges are not merged later."""
    start = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(start or spark.conf.get("spark.sql.shuffle.partitions"))
