from clicksieve.operators.decode import decode, good_records, quarantine, quarantine_counts
from clicksieve.operators.distinct import distinct_in_window, window_arrays
from clicksieve.operators.encode import json_lines, record_lines, wire_lines
from clicksieve.operators.lookup import (
    feature_columns,
    lookup_features,
    map_partitions,
    map_to_columns,
)
from clicksieve.operators.negatives import (
    connect_by_key,
    negatives_across_windows,
    negatives_in_window,
    negatives_two_stream,
    negatives_within,
)
from clicksieve.operators.records import (
    clicks,
    expand_struct,
    flatten,
    null_fill,
    record_from_row,
    shows,
    with_label,
    without_label,
)
from clicksieve.operators.ttl import first_per_key_ttl

__all__ = [
    "clicks",
    "connect_by_key",
    "decode",
    "distinct_in_window",
    "expand_struct",
    "feature_columns",
    "first_per_key_ttl",
    "flatten",
    "good_records",
    "json_lines",
    "lookup_features",
    "map_partitions",
    "map_to_columns",
    "negatives_across_windows",
    "negatives_in_window",
    "negatives_two_stream",
    "negatives_within",
    "null_fill",
    "quarantine",
    "quarantine_counts",
    "record_from_row",
    "record_lines",
    "shows",
    "window_arrays",
    "wire_lines",
    "with_label",
    "without_label",
]
