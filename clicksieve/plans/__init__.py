from clicksieve.plans.samples import (
    labelled_samples,
    lines_to_table,
    samples_from_lines,
    stream_lines_to_records,
    stream_lines_to_table,
    stream_records_to_table,
    table_to_records,
)

__all__ = [
    "labelled_samples",
    "lines_to_table",
    "samples_from_lines",
    "stream_lines_to_records",
    "stream_lines_to_table",
    "stream_records_to_table",
    "table_to_records",
]
