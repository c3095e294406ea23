"""Kafka topics as one ``value`` column; needs Spark's Kafka connector on the class path."""

from pyspark.sql import functions as F


def kafka_source_options(servers, topic, group_id=None, starting_offsets="earliest", max_offsets_per_trigger=None):
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_lines(df):
    return df.select(F.col("value").cast("string").alias("value"))


def stream_kafka_lines(spark, servers, topic, **options):
    source = kafka_source_options(servers, topic, **options)
    return kafka_lines(spark.readStream.format("kafka").options(**source).load())


def read_kafka_lines(spark, servers, topic, **options):
    source = kafka_source_options(servers, topic, **options)
    return kafka_lines(spark.read.format("kafka").options(**source).load())
