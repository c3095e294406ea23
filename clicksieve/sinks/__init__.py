from clicksieve.sinks.compaction import compact_loads, current_rows, drop_merged_loads
from clicksieve.sinks.files import bucketed, hour_bucketed, rolled, write_orc_buckets, write_text_buckets, write_text_rolled
from clicksieve.sinks.kafka import kafka_sink_options, write_kafka
from clicksieve.sinks.publish import closed_days, folder_days, publish_closed_days
from clicksieve.sinks.tables import create_sample_table, evolve_and_append, evolve_columns

__all__ = [
    "bucketed",
    "closed_days",
    "compact_loads",
    "create_sample_table",
    "current_rows",
    "drop_merged_loads",
    "evolve_and_append",
    "evolve_columns",
    "folder_days",
    "hour_bucketed",
    "kafka_sink_options",
    "publish_closed_days",
    "rolled",
    "write_kafka",
    "write_orc_buckets",
    "write_text_buckets",
    "write_text_rolled",
]
