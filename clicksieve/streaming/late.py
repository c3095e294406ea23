"""Rows that came too late, kept instead of lost."""

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from clicksieve.record import EVENT_TIME, WATERMARK_DELAY
from clicksieve.session import use_rocksdb_state
from clicksieve.streaming.ordered import MICROS, named_rows, plain_rows

SHARD = "late_shard"
SHARDS = 64
PASSED = "watermark"


class LateRows(StatefulProcessor):
    """Passes on the rows at or before their micro-batch's watermark; keeps no state."""

    def __init__(self, names):
        self.names, self.at = names, names.index(MICROS)

    def init(self, handle):
        pass

    def handleInputRows(self, key, rows, timerValues):
        millis = timerValues.getCurrentWatermarkInMs()
        late = [(*row, millis * 1000) for row in plain_rows(rows, self.names) if row[self.at] <= millis * 1000]
        yield from named_rows(late, [*self.names, PASSED])

    def close(self):
        pass


def late_rows_stream(df, ts=EVENT_TIME, delay=WATERMARK_DELAY, shards=SHARDS, watermark=PASSED):
    """The rows that the watermark of their micro-batch has passed, with that watermark; sets it itself.

    These are the rows that ``first_per_key_ttl_stream`` and
    ``negatives_two_stream_stream`` leave out where they read the same input with
    the same delay and trigger. Rows without a time are never late. Rows are
    dealt over ``shards`` by a hash of all they hold that can be hashed, so no key
    gathers in one task; only the late ones are passed on.
    """
    use_rocksdb_state(df.sparkSession)
    rows = df.withWatermark(ts, delay)
    rows = rows.select(*[c for c in df.columns if c != ts], F.unix_micros(F.col(ts)).alias(MICROS))
    schema = T.StructType([*rows.schema.fields, T.StructField(PASSED, T.LongType())])
    hashed = [f.name for f in rows.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    late = (
        rows.where(F.col(MICROS).isNotNull())
        .withColumn(SHARD, F.pmod(F.xxhash64(*hashed), F.lit(shards)).cast("int"))
        .groupBy(SHARD)
        .transformWithState(statefulProcessor=LateRows(rows.columns), outputStructType=schema, outputMode="append", timeMode="EventTime")
    )
    times = {ts: F.timestamp_micros(MICROS), watermark: F.timestamp_micros(PASSED)}
    return late.withColumns(times).select(*df.columns, watermark)
