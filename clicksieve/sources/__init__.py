from clicksieve.sources.events import as_log, events_log, events_parquet
from clicksieve.sources.features import customer_features, long_features
from clicksieve.sources.kafka import kafka_source_options, read_kafka_lines, stream_kafka_lines
from clicksieve.sources.lines import read_lines, stream_lines
from clicksieve.sources.tables import column_names, partition_scan, register_view, use_database

__all__ = [
    "as_log",
    "column_names",
    "customer_features",
    "events_log",
    "events_parquet",
    "kafka_source_options",
    "long_features",
    "partition_scan",
    "read_kafka_lines",
    "read_lines",
    "register_view",
    "stream_kafka_lines",
    "stream_lines",
    "use_database",
]
