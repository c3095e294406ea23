from clicksieve.streaming.distinct import distinct_stream
from clicksieve.streaming.jobs import date_in_order, in_time_order, replay, stream_to_table, stream_to_text_buckets
from clicksieve.streaming.labels import negatives_in_window_stream, negatives_within_stream
from clicksieve.streaming.late import late_rows_stream
from clicksieve.streaming.ordered import first_per_key_ttl_stream, negatives_two_stream_stream
from clicksieve.streaming.times import end_record

__all__ = [
    "date_in_order",
    "distinct_stream",
    "end_record",
    "first_per_key_ttl_stream",
    "in_time_order",
    "late_rows_stream",
    "negatives_in_window_stream",
    "negatives_two_stream_stream",
    "negatives_within_stream",
    "replay",
    "stream_to_table",
    "stream_to_text_buckets",
]
