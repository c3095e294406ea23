from clicksieve.functions.maps import map_value, register_map_function
from clicksieve.functions.text import delimited, first_field, has_fields
from clicksieve.functions.times import (
    bucket_start,
    day,
    day_of_millis,
    duration_micros,
    lenient_timestamp,
    window_start,
)

__all__ = [
    "bucket_start",
    "day",
    "day_of_millis",
    "delimited",
    "duration_micros",
    "first_field",
    "has_fields",
    "lenient_timestamp",
    "map_value",
    "register_map_function",
    "window_start",
]
