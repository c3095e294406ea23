"""Per-key features as a long table ``(key, field, value)``."""

import os

from pyspark.sql import functions as F


def long_features(df, key, fields):
    """A wide table's columns as ``(key, field, value)``; absent values have no row."""
    pairs = F.array(
        *[F.struct(F.lit(name).alias("field"), F.col(source).cast("string").alias("value")) for name, source in fields.items()]
    )
    return (
        df.select(F.col(key).cast("string").alias("key"), F.explode(pairs).alias("pair"))
        .select("key", "pair.field", "pair.value")
        .where(F.col("value").isNotNull())
    )


def customer_features(spark, sf_dir):
    """Market segment and nation of every customer, and a mark for those with a positive balance only."""
    customer = spark.read.parquet(os.path.join(sf_dir, "customer.parquet"))
    nation = spark.read.parquet(os.path.join(sf_dir, "nation.parquet"))
    wide = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").withColumn(
        "in_credit", F.when(F.col("c_acctbal") > 0, "yes")
    )
    return long_features(wide, "c_custkey", {"segment": "c_mktsegment", "nation": "n_name", "in_credit": "in_credit"})
