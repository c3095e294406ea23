"""The log record and the fixed values of its wire form."""

from pyspark.sql import types as T

# They must equal those of existing logs, tables and consumers.
RECORD_FIELDS = ["user_id", "event_id", "invited", "time_stamp", "interested"]
EVENT_TIME = "timeStamp_flag"
SHOW = "0"
CLICK = "1"
NEGATIVE_LABEL = 0
DELIMITER = "\u0001"
WIRE_FIELD_COUNT = 3
WIRE_TAIL = "abcd"
PARTITION_COLUMN = "pt_d"
LOAD_COLUMN = "load_id"
DAY_PATTERN = "yyyyMMdd"
HOUR_BUCKET_PATTERN = "yyyy-MM-dd--HH"
FEATURE_FIELDS = ["field1", "field2", "field3", "field4", "field5", "field6", "field7", "field8"]
MAP_COLUMN = "mymap"
STRUCT_COLUMN = "record"
MAP_FUNCTION = "getValFromMap"
DEDUP_WINDOW = "10 seconds"
LABEL_WINDOW = "10 seconds"
TTL = "30 seconds"
WATERMARK_DELAY = "2 seconds"
TRIGGER_INTERVAL = "5 seconds"

LABEL = "label"

JSON_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RECORD_FIELDS])

RECORD_SCHEMA = T.StructType(JSON_SCHEMA.fields + [T.StructField(EVENT_TIME, T.TimestampType())])

FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
