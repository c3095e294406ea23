"""What processors read of their state, ties across micro-batches, late rows, and lifetimes in wall-clock time."""

import random
import time
import uuid

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from clicksieve.operators import first_per_key_ttl, negatives_two_stream
from clicksieve.plans import catalogue
from clicksieve.record import EVENT_TIME, RECORD_SCHEMA
from clicksieve.sinks.folders import files as folder_files
from clicksieve.streaming import date_in_order, end_record, first_per_key_ttl_stream, in_time_order, late_rows_stream, negatives_two_stream_stream, replay
from clicksieve.streaming.ordered import MICROS, SHARD_KEY, ByShard, FirstPerTtl, FirstSeen, UnclickedShows, chunk_of
from helpers import log

SECOND = 1_000_000


class Store:
    """State of one key in memory, which counts what is read of it."""

    def __init__(self):
        self.now, self.reads, self.rows_read, self.timers, self.states = 0, 0, 0, set(), {}

    def getMapState(self, name, key, value):
        return self.states.setdefault(name, MapState(self))

    def getValueState(self, name, schema, ttl=None):
        return self.states.setdefault(name, ValueState(self))

    def registerTimer(self, millis):
        assert millis > self.now, "a timer in the past never fires"
        self.timers.add(millis)

    def getCurrentWatermarkInMs(self):
        return self.now


class MapState:
    def __init__(self, store):
        self.store, self.values = store, {}

    def getValue(self, key):
        self.store.reads += 1
        found = self.values.get(key)
        self.store.rows_read += len(found[0]) if found else 0
        return found

    def updateValue(self, key, value):
        self.values[key] = value

    def removeKey(self, key):
        del self.values[key]

    def exists(self):
        return bool(self.values)


class ValueState:
    def __init__(self, store):
        self.store, self.value = store, None

    def get(self):
        self.store.reads += 1
        return self.value

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


def run_to(processor, store, millis):
    """Moves the watermark and fires the timers it has passed, in order."""
    store.now, out = millis, []
    for at in sorted(t for t in store.timers if t <= millis):
        store.timers.discard(at)
        info = type("Info", (), {"getExpiryTimeInMs": lambda self, at=at: at})()
        out += processor.handleExpiredTimer(("u",), store, info)
    return out


@pytest.fixture
def schema(spark):
    rows = log(spark, []).withColumn(MICROS, F.unix_micros(EVENT_TIME)).drop(EVENT_TIME)
    return rows.schema


def rows_at(schema, times, kind="0", event=lambda n: f"{n:06d}"):
    make = Row(*schema.fieldNames())
    return [make("u", event(n), "0", str(t), kind, t) for n, t in enumerate(times)]


@pytest.mark.parametrize("kind", [FirstPerTtl, UnclickedShows])
def test_a_timer_reads_only_what_is_due(schema, kind):
    """A user with 100 000 waiting rows: each timer reads its own slice, and all of them once."""
    options = (True,) if kind is UnclickedShows else ()
    processor, store = kind(schema, ["event_id"], 30 * SECOND, SECOND, *options), Store()
    processor.init(store)
    times = [n * 100_000 + 1 for n in range(100_000)]
    list(processor.handleInputRows(("u",), iter(rows_at(schema, times)), store))
    assert store.rows_read == 0 and len(store.timers) == 10_000
    before = store.reads
    out = run_to(processor, store, 1_000)
    assert store.rows_read == 10 and store.reads == before + 2
    out += run_to(processor, store, 40_000)
    assert store.rows_read == 400
    out += run_to(processor, store, 10**9)
    assert store.rows_read == 100_000 and not store.timers
    kept = [r[MICROS] for r in out]
    expected = [1 + 30 * SECOND * n for n in range(len(kept))]
    assert kept == expected and len(kept) == 334
    assert not store.states["waiting"].values and store.states["opens"].value is None


def test_equal_instants_fold_in_their_slice(schema):
    processor, store = FirstPerTtl(schema, ["event_id"], 30 * SECOND, SECOND), Store()
    processor.init(store)
    for _ in range(5):
        rows = rows_at(schema, [5 * SECOND] * 200, event=lambda n: f"{(n * 7) % 200:06d}")
        list(processor.handleInputRows(("u",), iter(rows), store))
    assert store.rows_read == 4
    assert [r["event_id"] for r in run_to(processor, store, 10**6)] == ["000000"]


def test_first_seen_opens_again_when_its_state_has_expired(schema):
    processor, store = FirstSeen(schema, ["event_id"], 30 * SECOND), Store()
    processor.init(store)
    assert processor.ttl_millis == 30_000
    take = lambda times: [r["time_stamp"] for r in processor.handleInputRows(("u",), iter(rows_at(schema, times)), store)]
    assert take([9, 3, 5]) == ["3"]
    assert take([1]) == []
    store.states["seen"].clear()
    assert take([2]) == ["2"]


def test_a_lifetime_in_wall_clock_time(spark, tmp_path):
    """Rows of one event time: the second is hidden, the third comes after the state's lifetime."""
    path = str(tmp_path / "in")
    log(spark, []).write.parquet(path)
    stream = first_per_key_ttl_stream(spark.readStream.schema(RECORD_SCHEMA).parquet(path), ttl="15 seconds", clock="processing")
    seen = []
    writer = stream.writeStream.foreachBatch(lambda batch, n: seen.extend(str(r.user_id) for r in batch.collect()))
    query = writer.option("checkpointLocation", str(tmp_path / "progress")).trigger(processingTime="1 second").start()

    def bring(users, expected):
        log(spark, [(user, 0, "0") for user in users]).coalesce(1).write.mode("append").parquet(path)
        until = time.time() + 60
        while sorted(seen) != sorted(expected) and time.time() < until:
            time.sleep(0.5)
        assert sorted(seen) == sorted(expected)

    try:
        bring(["a", "a", "b"], ["a", "b"])
        bring(["a", None], ["a", "b", "None"])
        time.sleep(20)
        bring(["a", "a"], ["a", "a", "b", "None"])
    finally:
        query.stop()


def test_clocks(spark, tmp_path):
    with pytest.raises(ValueError):
        first_per_key_ttl_stream(log(spark, []), clock="sundial")


def micro_batches(spark, folder, *batches):
    path = str(folder / uuid.uuid4().hex)
    for number, rows in enumerate(batches):
        rows.coalesce(1).write.parquet(f"{path}/{number}")
    end_record(spark).write.parquet(f"{path}/end")
    date_in_order(spark, *[f"{path}/{number}" for number in range(len(batches))], f"{path}/end")
    return spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_null_and_equal_ties_in_two_micro_batches(spark, tmp_path, order):
    """Rows of one user and instant, some without a tie, in whatever order they arrive: as in batch."""
    rows = log(spark, [("a", 0, "0"), ("a", 0, "0"), ("a", 0, "1"), ("a", 1, "0"), (None, 1, "0"), ("b", 1, "0"), ("b", 1, "0")])
    # The first of "a" has no tie and so comes first; the rows of "b" have equal ties and differ elsewhere.
    rows = rows.withColumn("invited", F.col("event_id")).withColumn(
        "event_id", F.when(F.col("event_id") == "000001", None).when(F.col("user_id") == "b", F.lit("same")).otherwise(F.col("event_id"))
    )
    parts = [rows.where("invited in ('000000', '000002', '000006', '000004')"), rows.where("invited in ('000001', '000003', '000005')")]
    batches = [parts[n] for n in order]
    first = replay(first_per_key_ttl_stream(micro_batches(spark, tmp_path, *batches)), "first").where(~F.col("user_id").eqNullSafe("__end"))
    expected = first_per_key_ttl(rows)
    assert sorted(map(str, first.collect())) == sorted(map(str, expected.collect()))
    assert {r.invited for r in expected.collect()} == {"000001", "000004", "000005"}
    two = replay(negatives_two_stream_stream(micro_batches(spark, tmp_path, *batches), ttl="10 seconds"), "two")
    wanted = negatives_two_stream(rows, ttl="10 seconds")
    plain = lambda df: sorted(str((r.user_id or "", r.invited, r.event_id)) for r in df.collect())
    assert plain(two) == plain(wanted)


def test_late_rows(spark, tmp_path):
    """A row at the watermark is late, one after it is not; rows without a time never are."""
    rows = [[("a", 100, "0")], [("b", 98, "0"), ("c", 99, "1"), ("d", 10, "0"), ("d", 10, "0"), (None, 5, "x")], [("e", 99, "0")]]
    batches = [log(spark, r) for r in rows]
    batches[1] = batches[1].unionByName(batches[0].withColumn(EVENT_TIME, F.lit(None).cast("timestamp")))
    out = replay(late_rows_stream(micro_batches(spark, tmp_path, *batches)), "late")
    found = sorted((str(r.user_id), r.time_stamp, r.watermark.second) for r in out.collect())
    assert found == [("None", "5", 38), ("b", "98", 38), ("d", "10", 38), ("d", "10", 38)]


def test_files_in_time_order(spark, tmp_path):
    rows = log(spark, [("a", (n * 37) % 1000, "0") for n in range(1000)])
    rows = rows.unionByName(rows.limit(3).withColumn(EVENT_TIME, F.lit(None).cast("timestamp")))
    path = str(tmp_path / "ordered")
    in_time_order(rows, 100).write.parquet(path)
    date_in_order(spark, path)
    query = spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    seen = []
    stream = query.writeStream.foreachBatch(lambda batch, n: seen.append([r[EVENT_TIME] for r in batch.collect()]))
    stream.option("checkpointLocation", str(tmp_path / "p")).trigger(availableNow=True).start().awaitTermination()
    times = [t for batch in seen for t in batch]
    assert times[:3] == [None] * 3 and times[3:] == sorted(times[3:]) and len(times) == 1003
    assert 8 <= len(seen) <= 13 and max(map(len, seen)) <= 250


@pytest.mark.parametrize("seconds, files", [(120_000, (2, 4)), (2_400_000, (12, 24))])
def test_micro_batches_of_a_replayed_log_do_not_grow_with_it(spark, tmp_path, seconds, files):
    """A log of many rows is cut into larger files, not into more of them, and none of its rows is lost."""
    path = str(tmp_path / "log")
    rows = spark.range(seconds).select("id", F.timestamp_seconds("id").alias(EVENT_TIME))
    catalogue.files_in_order(spark, rows, path)
    assert files[0] <= len(folder_files(spark, path)) <= files[1]
    assert spark.read.parquet(path).agg(F.count("*"), F.sum("id")).first() == (seconds, seconds * (seconds - 1) // 2)


def test_micro_batches_have_a_largest_size():
    assert [catalogue.batch_rows(n) for n in (0, 100_000, 6_000_000, 36_000_000, 10**9)] == [50_000, 50_000, 375_000, 10**6, 10**6]


@pytest.mark.parametrize("kind", [FirstPerTtl, UnclickedShows])
def test_a_shard_walks_each_key_as_it_would_be_alone(schema, kind):
    """Rows of 50 keys in disorder, watermarks in small and large steps: as key by key, with far fewer reads than rows."""
    options = (True,) if kind is UnclickedShows else ()
    draw = random.Random(11)
    make, keyed = Row(*schema.fieldNames()), Row(*schema.fieldNames(), SHARD_KEY)
    arrivals = []
    for n in range(3000):
        at = n * 400_000 + draw.randrange(90 * SECOND) // SECOND * SECOND + 1
        arrivals.append((f"u{draw.randrange(50)}", f"{n:06d}", "0", str(at), draw.choice("001"), at))
    steps, start = [], 0
    while start < len(arrivals):
        size = draw.choice([1, 30, 700])
        steps.append(arrivals[start : start + size])
        start += size
    shard, whole = ByShard(kind(schema, ["event_id"], 30 * SECOND, SECOND, *options)), Store()
    shard.init(whole)
    alone = {}
    got, expected, watermark = [], [], 0
    for rows in [*steps, []]:
        list(shard.handleInputRows((0,), iter([keyed(*r, r[0]) for r in rows]), whole))
        for user in {r[0] for r in rows}:
            if user not in alone:
                alone[user] = (kind(schema, ["event_id"], 30 * SECOND, SECOND, *options), Store())
                alone[user][0].init(alone[user][1])
                alone[user][1].now = watermark
            processor, store = alone[user]
            list(processor.handleInputRows((user,), iter([make(*r) for r in rows if r[0] == user]), store))
        watermark = max([watermark, *[r[-1] // 1000 - 60_000 for r in rows]]) if rows else 10**9
        got += run_to(shard, whole, watermark)
        for processor, store in alone.values():
            expected += run_to(processor, store, watermark)
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected)) and len(got) > 100
    assert not whole.timers and not whole.states["waiting"].values
    assert whole.states["opens"].value is None and whole.states["places"].value is None
    assert whole.reads < sum(store.reads for _, store in alone.values()) / 2


def test_chunks_double_in_length():
    assert [chunk_of(n, 100) for n in (100, 101, 102, 103, 104, 111, 112, 127, 128, 255, 256)] == [100, 101, 102, 102, 104, 104, 112, 112, 128, 128, 256]


@pytest.mark.parametrize("shards", [0, 1])
def test_keys_with_and_without_shards(spark, tmp_path, shards):
    rows = log(spark, [(user, n, kind) for n, kind in enumerate("0100101") for user in ("a", "b", None, "null")])
    batches = [rows.where(f"event_id % 2 = {n}") for n in (1, 0)]
    out = replay(first_per_key_ttl_stream(micro_batches(spark, tmp_path, *batches), ttl="3 seconds", shards=shards, delay="1 minute"), "first")
    expected = first_per_key_ttl(rows, ttl="3 seconds")
    assert sorted(map(str, out.where(~F.col("user_id").eqNullSafe("__end")).collect())) == sorted(map(str, expected.collect()))
