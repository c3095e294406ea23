"""Catalog tables and views."""

from pyspark.sql import functions as F

from clicksieve.record import PARTITION_COLUMN


def partition_scan(spark, table, value, column=PARTITION_COLUMN):
    """One partition of a table; the filter prunes the files that are listed and read."""
    return spark.table(table).where(F.col(column) == value)


def register_view(df, name):
    df.createOrReplaceTempView(name)
    return df


def use_database(spark, name):
    spark.catalog.setCurrentDatabase(name)


def column_names(spark, table):
    """A table's columns from the catalog, without a job."""
    return spark.table(table).columns
