"""Sequential operators on streams: each key's rows in time order.

Rows wait in state until the watermark has passed them and are then walked in
order, so the result does not depend on how rows fall into micro-batches and
equals the batch result for all rows that are not late.

State is cut into short slices of event time. A row is filed under its slice,
whose end is a timer; when it fires, that slice is read, walked and removed, and
no other waiting row is touched. Of rows of one key and instant only the first
can matter, by the order that batch operators use too; others are left out of
the slice, and within an Arrow batch before the shuffle.

Each call to the state is a round trip to the JVM, several for a row that has a
slice to itself. So keys are by default dealt over shards, and a shard keeps the
rows of all its keys together: see :class:`ByShard`.
"""

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from clicksieve.functions import duration_micros
from clicksieve.operators.records import with_label
from clicksieve.operators.ttl import tie_order
from clicksieve.record import CLICK, EVENT_TIME, SHOW, TTL, WATERMARK_DELAY
from clicksieve.session import use_rocksdb_state
from clicksieve.streaming.times import of_kind

# Not "_micros": rows reach a processor as named tuples, whose names cannot start so.
MICROS = "event_micros"
SLICE = "1 second"
SHARD, SHARD_KEY = "order_shard", "order_key"
SHARDS = 1024
EVENT_CLOCK, PROCESSING_CLOCK = "event", "processing"


def plain_rows(rows, names):
    """Rows as tuples of plain values in the order of ``names``."""
    for row in rows:
        yield tuple([row[name] for name in names])


def named_rows(rows, names):
    """Tuples as Spark takes them from a processor."""
    make = Row(*names)
    return [make(*row) for row in rows]


class InTimeOrder(StatefulProcessor):
    """Holds a key's rows back until the watermark passes the slice of time they are in.

    ``order`` names the columns that rank rows of one instant, NULLs first.
    """

    def __init__(self, schema, order, ttl_micros, slice_micros):
        self.schema = schema
        self.names = schema.fieldNames()
        self.at = self.names.index(MICROS)
        self.order = [self.names.index(name) for name in order]
        self.ttl = ttl_micros
        self.width = slice_micros

    def init(self, handle):
        self.handle = handle
        rows = T.StructType([T.StructField("held", T.ArrayType(self.schema))])
        self.waiting = handle.getMapState("waiting", T.StructType([T.StructField("slice", T.LongType())]), rows)

    def handleInputRows(self, key, rows, timerValues):
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        slices = {}
        for row in plain_rows(rows, self.names):
            if row[self.at] > passed:
                slices.setdefault(row[self.at] // self.width, []).append(row)
        for number, fresh in slices.items():
            held = self._held(number)
            self.waiting.updateValue((number,), (self.firsts(held + fresh),))
            if not held:
                self._wake_after(number * self.width)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # Timers come in the order of time, so all before this end has been walked.
        end = expiredTimerInfo.getExpiryTimeInMs() * 1000
        number = end // self.width - 1
        due = self._held(number)
        if due:
            self.waiting.removeKey((number,))
        # A key that has nothing waiting is as far as the watermark; else its next slice goes on from here.
        more = self.waiting.exists()
        emitted, until = self.walk(due, end if more else timerValues.getCurrentWatermarkInMs() * 1000)
        if until is not None and not more:
            self._wake_after(until)
        yield from named_rows(emitted, self.names)

    def _wake_after(self, micros):
        """A timer at the end of the slice that holds a time."""
        self.handle.registerTimer((micros // self.width + 1) * self.width // 1000)

    def _held(self, number):
        held = self.waiting.getValue((number,))
        return [tuple(row) for row in held[0]] if held else []

    def firsts(self, rows):
        """The first row of each instant (and kind), in the order of time."""
        kept = {}
        for row in sorted(rows, key=self.rank):
            kept.setdefault(self.place(row), row)
        return list(kept.values())

    def place(self, row):
        """What only the first row of counts."""
        return row[self.at]

    def rank(self, row):
        return self.place(row), [(row[i] is not None, row[i]) for i in self.order]

    def walk(self, rows, end):
        """Takes a slice's rows, and the time before which there are no others; gives rows to emit, and the last time that is still awaited."""
        raise NotImplementedError

    def close(self):
        pass


class FirstPerTtl(InTimeOrder):
    """The first row of the key, and again the first ``ttl`` or more after each kept one."""

    def init(self, handle):
        super().init(handle)
        self.opens = handle.getValueState("opens", self.open_type())

    def open_type(self):
        return T.StructType([T.StructField("open_from", T.LongType())])

    def walk(self, rows, end):
        stored = self.opens.get()
        open_from = stored[0] if stored else None
        kept = []
        for row in rows:
            if open_from is None or row[self.at] >= open_from:
                kept.append(row)
                open_from = row[self.at] + self.ttl
        if open_from is None or open_from <= end:
            if stored:
                self.opens.clear()
            return kept, None
        if kept:
            self.opens.update((open_from,))
        return kept, open_from


class UnclickedShows(InTimeOrder):
    """Shows and clicks thinned to the first per ``ttl``; a kept show leaves unless a kept click follows in time."""

    def __init__(self, schema, order, ttl_micros, slice_micros, dedup_clicks):
        super().__init__(schema, order, ttl_micros, slice_micros)
        self.kind = self.names.index("interested")
        self.dedup_clicks = dedup_clicks

    def init(self, handle):
        super().init(handle)
        self.opens = handle.getValueState("opens", self.open_type())

    def open_type(self):
        times = [T.StructField(name, T.LongType()) for name in ("show_from", "click_from")]
        # A show is pending only while it still hides others, so one value holds all: each call to the state is a round trip.
        return T.StructType([*times, T.StructField("pending", T.ArrayType(self.schema))])

    def place(self, row):
        # A click at a show's own instant counts as after it.
        return row[self.at], row[self.kind] == CLICK

    def walk(self, rows, end):
        stored = self.opens.get()
        if not rows and not stored:
            return [], None
        show_from, click_from, held = stored or (None, None, ())
        pending, negatives = [tuple(row) for row in held], []

        def release(before):
            negatives.extend(row for row in pending if row[self.at] + self.ttl < before)
            pending[:] = [row for row in pending if row[self.at] + self.ttl >= before]

        for row in rows:
            now = row[self.at]
            release(now)
            if row[self.kind] == SHOW:
                if show_from is None or now >= show_from:
                    pending.append(row)
                    show_from = now + self.ttl
            elif not self.dedup_clicks or click_from is None or now >= click_from:
                pending.clear()
                click_from = now + self.ttl
        release(end)

        show_from, click_from = [t if t is not None and t > end else None for t in (show_from, click_from)]
        if show_from is not None or click_from is not None or pending:
            self.opens.update((show_from, click_from, pending))
        elif stored:
            self.opens.clear()
        awaited = [t for t in (show_from, click_from) if t is not None] + [row[self.at] + self.ttl for row in pending]
        return negatives, max(awaited, default=None)


def plain(value):
    """A value of a state, with tuples for rows: the state takes no rows inside others."""
    if isinstance(value, tuple):
        return tuple([plain(v) for v in value])
    return [plain(v) for v in value] if isinstance(value, list) else value


class Slot:
    """What one key of a shard has open, with the calls of a value state."""

    def __init__(self, values, key):
        self.values, self.key = values, key

    def get(self):
        return self.values.get(self.key)

    def update(self, value):
        self.values[self.key] = value

    def clear(self):
        self.values.pop(self.key, None)


class ByShard(StatefulProcessor):
    """Walks the keys of a shard, each as ``walker`` does, with few calls to the state.

    Waiting rows are filed in chunks of whole slices. Seen from the watermark
    these double in length, so a row is read again only when the watermark has
    come half the way to it: a chunk is read once its first slice has passed, and
    what of it is not due is filed anew. What the keys have open is one value.
    Rows end with the name of their key.
    """

    def __init__(self, walker):
        self.walker, self.at, self.width = walker, walker.at, walker.width
        self.names = [*walker.names, SHARD_KEY]

    def init(self, handle):
        self.handle, self.walked = handle, None
        key, long = T.StructField(SHARD_KEY, T.StringType()), T.LongType()
        place = T.StructType([T.StructField("start", long), T.StructField("filed", long)])
        rows = T.StructType([*self.walker.schema.fields, key])
        opened = T.StructType([key, T.StructField("until", long), *self.walker.open_type().fields])
        self.waiting = handle.getMapState("waiting", place, T.StructType([T.StructField("held", T.ArrayType(rows))]))
        self.places = handle.getValueState("places", T.StructType([T.StructField("places", T.ArrayType(place))]))
        self.opens = handle.getValueState("opens", T.StructType([T.StructField("opens", T.ArrayType(opened))]))

    def handleInputRows(self, key, rows, timerValues):
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        fresh = [row for row in plain_rows(rows, self.names) if row[self.at] > passed]
        if fresh:
            places = self._places()
            self._file(fresh, passed // self.width, places)
            self.places.update((sorted(places),))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        millis = timerValues.getCurrentWatermarkInMs()
        # The first timer of a micro-batch takes all that is due.
        if self.walked == (key, millis):
            return
        self.walked = (key, millis)
        now = millis * 1000 // self.width
        end = now * self.width
        places, found = self._places(), []
        reached = {place for place in places if place[0] < now}
        for place in sorted(reached):
            found += self._held(place)
            self.waiting.removeKey(place)
        if reached:
            places -= reached
            self._file([row for row in found if row[self.at] >= end], now, places)
            if places:
                self.places.update((sorted(places),))
            else:
                self.places.clear()

        due = {}
        for row in found:
            if row[self.at] < end:
                due.setdefault(row[-1], []).append(row[:-1])
        stored = self.opens.get()
        untils = {row[0]: row[1] for row in stored[0]} if stored else {}
        values = {row[0]: plain(row)[2:] for row in stored[0]} if stored else {}
        for name in [*due, *[n for n, until in untils.items() if until < end and n not in due]]:
            self.walker.opens = Slot(values, name)
            emitted, untils[name] = self.walker.walk(self.walker.firsts(due.get(name, [])), end)
            yield from named_rows(emitted, self.walker.names)
        if values:
            self.opens.update(([(name, untils[name], *value) for name, value in values.items()],))
            self._wake(min(untils[name] for name in values) // self.width)
        elif stored:
            self.opens.clear()

    def _places(self):
        stored = self.places.get()
        return {tuple(place) for place in stored[0]} if stored else set()

    def _held(self, place):
        return plain(self.waiting.getValue(place)[0])

    def _file(self, rows, now, places):
        chunks = {}
        for row in rows:
            chunks.setdefault(chunk_of(row[self.at] // self.width, now), []).append(row)
        for start, fresh in chunks.items():
            place = (start, now)
            if place in places:
                fresh = self._held(place) + fresh
            else:
                places.add(place)
                self._wake(start)
            self.waiting.updateValue(place, (self._firsts(fresh),))

    def _firsts(self, rows):
        kept = {}
        for row in rows:
            kept.setdefault(row[-1], []).append(row)
        return [row for some in kept.values() for row in self.walker.firsts(some)]

    def _wake(self, number):
        """A timer at the end of a slice."""
        self.handle.registerTimer(-(-(number + 1) * self.width // 1000))

    def close(self):
        pass


def chunk_of(number, now):
    """The first slice of the chunk that a slice is in: the longest aligned one, of a power of two, that begins after ``now``."""
    if number <= now:
        return number
    low = (number ^ now).bit_length() - 1
    return number >> low << low


class FirstSeen(StatefulProcessor):
    """A key's first row to arrive, and again the first to arrive when its state has expired."""

    def __init__(self, schema, order, ttl_micros):
        self.names = schema.fieldNames()
        self.order = [self.names.index(name) for name in (MICROS, *order)]
        self.ttl_millis = max(1, ttl_micros // 1000)

    def init(self, handle):
        self.seen = handle.getValueState("seen", "seen BOOLEAN", self.ttl_millis)

    def handleInputRows(self, key, rows, timerValues):
        if self.seen.exists():
            return
        self.seen.update((True,))
        first = min(plain_rows(rows, self.names), key=lambda row: [(row[i] is not None, row[i]) for i in self.order])
        yield from named_rows([first], self.names)

    def close(self):
        pass


def _sorted(frame, order):
    return frame.sort_values(order, kind="stable", na_position="first")


def _first_of_instant(keys, order):
    def fold(frames):
        for frame in frames:
            yield _sorted(frame, order).drop_duplicates([*keys, MICROS])

    return fold


def _in_micros(df, ts):
    """Rows with their time as a number, and without those that have none."""
    rows = df.select(*[c for c in df.columns if c != ts], F.unix_micros(F.col(ts)).alias(MICROS))
    return rows.where(F.col(MICROS).isNotNull())


def _key_name(df, keys):
    """A text that differs between keys."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def text(name):
        if isinstance(kinds[name], (T.ArrayType, T.StructType)):
            return F.to_json(F.struct(name))
        return F.hex(name) if isinstance(kinds[name], T.BinaryType) else F.col(name).cast("string")

    return F.to_json(F.array(*[text(name) for name in keys]))


def _ordered(df, keys, fold_keys, processor, tie, ts, shards):
    """A watermarked stream through one of the processors above."""
    columns = df.columns
    use_rocksdb_state(df.sparkSession)
    rows = _in_micros(df, ts)
    schema = T.StructType(rows.schema.fields)
    order = tie_order(rows, fold_keys, MICROS, tie)
    folded = rows.mapInPandas(_first_of_instant(fold_keys, order), schema)
    walker = processor(schema, order)
    if shards:
        folded = folded.withColumn(SHARD_KEY, _key_name(folded, keys))
        folded = folded.withColumn(SHARD, F.pmod(F.xxhash64(SHARD_KEY), F.lit(shards)).cast("int"))
    walked = folded.groupBy(*([SHARD] if shards else keys)).transformWithState(
        statefulProcessor=ByShard(walker) if shards else walker,
        outputStructType=schema,
        outputMode="append",
        timeMode="EventTime",
    )
    return walked.withColumn(ts, F.timestamp_micros(MICROS)).select(*columns)


def first_per_key_ttl_stream(
    df, keys="user_id", ttl=TTL, ts=EVENT_TIME, tie="event_id", delay=WATERMARK_DELAY, clock=EVENT_CLOCK, slice_width=SLICE, shards=SHARDS
):
    """The streaming form of ``first_per_key_ttl``; sets the watermark itself.

    ``slice_width`` is the length of the slices that rows wait in; a row leaves
    when the watermark has passed its slice. Keys are dealt over ``shards``,
    which stay as they are for a checkpoint: take so many that a task can hold
    what is waiting and open in one. With 0 each key has state of its own, which
    is slower where keys are many. With the clock ``"processing"`` a
    key is hidden for ``ttl`` of wall-clock time from the micro-batch in which a
    row of it left, whatever the rows' own times are; rows leave at once, none is
    late, and the result depends on when rows arrive.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    micros = duration_micros(ttl)
    if clock == PROCESSING_CLOCK:
        use_rocksdb_state(df.sparkSession)
        rows = df.withColumn(MICROS, F.unix_micros(F.col(ts))).drop(ts)
        schema = T.StructType(rows.schema.fields)
        walked = rows.groupBy(*keys).transformWithState(
            statefulProcessor=FirstSeen(schema, tie_order(rows, keys, MICROS, tie), micros),
            outputStructType=schema,
            outputMode="append",
            timeMode="ProcessingTime",
        )
        return walked.withColumn(ts, F.timestamp_micros(MICROS)).select(*df.columns)
    if clock != EVENT_CLOCK:
        raise ValueError(f"no such clock: {clock!r}")
    width = duration_micros(slice_width)
    rows = df.withWatermark(ts, delay)
    return _ordered(rows, keys, keys, lambda schema, order: FirstPerTtl(schema, order, micros, width), tie, ts, shards)


def negatives_two_stream_stream(
    df, key="user_id", ttl=TTL, ts=EVENT_TIME, tie="event_id", delay=WATERMARK_DELAY, dedup_clicks=True, slice_width=SLICE, shards=SHARDS
):
    """The streaming form of ``negatives_two_stream``: one shuffle, one stateful operator for both sides.

    ``slice_width`` and ``shards`` are those of :func:`first_per_key_ttl_stream`.
    """
    micros, width = duration_micros(ttl), duration_micros(slice_width)

    def processor(schema, order):
        return UnclickedShows(schema, order, micros, width, dedup_clicks)

    rows = of_kind(df.withWatermark(ts, delay), ts, SHOW, CLICK)
    return with_label(_ordered(rows, [key], [key, "interested"], processor, tie, ts, shards))
