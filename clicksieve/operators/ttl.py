"""First row per key within a time-to-live.

A kept row hides the key's rows of the next ``ttl``; the first row at or after
that time is kept in turn. Each decision depends on the one before, so a key's
rows are walked in time order. All keys go the same way, however many rows they
have:

1. equal rows fold to one before they are shuffled;
2. rows are dealt by ranges of key and time and sorted, so that a partition
   holds many keys, or a piece of a large one, and nothing else decides its size;
3. each partition computes, for the key it begins with and for every time from
   which that key might be entered, the time from which it is open again at the
   partition's end (a short step function), and the same for the key it ends with;
4. the step functions, a few rows per partition, are chained in order, which
   gives each partition the true entry time of its first key;
5. the partitions are walked from those entry times.

Steps 3 and 5 read one shuffle, so the input is read once.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicksieve.functions import duration_micros
from clicksieve.operators.skew import range_partitions
from clicksieve.record import EVENT_TIME, TTL

PART = "_part"
STARTS_AT = "_starts_at"
OPEN_FROM = "_open_from"
UP_TO = "_up_to"

ALWAYS = -(2**63)
EVER = 2**63 - 1
UNORDERED = ("map", "variant")


def first_per_key_ttl(df, keys="user_id", ttl=TTL, ts=EVENT_TIME, tie="event_id", partitions=None):
    """The first row per key, and again the first row ``ttl`` or more after each kept one.

    Among rows of the same instant the smallest ``tie`` comes first, and of
    equal ties the row that is smallest in all its columns. NULL keys are one
    key. Rows without a time have no place in the order and are left out.
    ``partitions`` is the number of ranges that keys and times are cut into.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    micros = duration_micros(ttl)
    order = tie_order(df, keys, ts, tie)
    count = partitions or range_partitions(df.sparkSession)
    # Different rows of one instant may be dealt to different partitions: the first of them hides the others there too.
    by = [*keys, ts, *order]
    rows = _folded(df.where(F.col(ts).isNotNull()), keys, ts, order)
    ranged = rows.repartitionByRange(count, *by).sortWithinPartitions(*by).withColumn(PART, F.spark_partition_id())
    # One row per partition at most, so its size is bounded by their number.
    entries = F.broadcast(_entry_times(ranged, keys, micros, ts))
    entered = ranged.join(entries, PART, "left").select(*df.columns, STARTS_AT, OPEN_FROM)
    return entered.mapInArrow(_keep_first(keys, ts, micros), df.schema)


def tie_order(df, keys, ts, tie):
    """The columns that order rows of one key and instant: the tie, then all others that have an order."""
    others = [f.name for f in df.schema.fields if f.dataType.typeName() not in UNORDERED]
    return [tie, *[c for c in others if c not in (*keys, ts, tie)]]


def _folded(df, keys, ts, order):
    """Equal rows once; where some column cannot be compared, the first row of each key and instant."""
    if not any(f.dataType.typeName() in UNORDERED for f in df.schema.fields):
        return df.distinct()
    others = [c for c in df.columns if c not in (*keys, ts)]
    # A struct is never NULL, even where all its fields are, so no row is lost.
    firsts = df.groupBy(*keys, ts).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_row"))
    return firsts.select(*keys, ts, "_row.*").select(*df.columns)


def _entry_times(ranged, keys, micros, ts):
    """For each partition the time of its first row, and that from which the key it begins with counts."""
    key_fields = [ranged.schema[k] for k in keys]
    longs = [T.StructField(name, T.LongType()) for name in (STARTS_AT, UP_TO, OPEN_FROM)]
    part = T.StructField(PART, T.IntegerType())
    steps = ranged.mapInArrow(_exit_steps(keys, ts, micros), T.StructType([*key_fields, part, *longs]))
    ordered = steps.repartition(*keys).sortWithinPartitions(*keys, PART, UP_TO)
    return ordered.mapInArrow(_chain_steps(keys), T.StructType([part, longs[0], longs[2]]))


def starts_run(batch, keys, previous):
    """Which rows of a sorted batch begin a new key, given the batch before."""
    starts = np.zeros(batch.num_rows, dtype=bool)
    for key in keys:
        values = batch.column(key)
        if previous is None or previous.column(key)[0].as_py() != values[0].as_py():
            starts[0] = True
        if values.null_count == len(values):
            continue
        changed = pc.not_equal(values.slice(1), values.slice(0, len(values) - 1))
        # NULL next to a value compares as NULL: a change, unless both are NULL.
        nulls = pc.is_null(values).to_numpy(zero_copy_only=False)
        changed = pc.fill_null(changed, True).to_numpy(zero_copy_only=False)
        starts[1:] |= changed & ~(nulls[1:] & nulls[:-1])
    return starts


def _times(batch, ts):
    return batch.column(ts).cast(pa.int64()).to_numpy(zero_copy_only=False)


def _keep_first(keys, ts, micros):
    def keep(batches):
        previous, open_from = None, ALWAYS
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = starts_run(batch, keys, previous).tolist()
            times = _times(batch, ts).tolist()
            kept = []
            if previous is None:
                starts[0] = False
                entry = batch.column(OPEN_FROM)[0].as_py()
                open_from = ALWAYS if entry is None else entry
                if batch.column(STARTS_AT)[0].as_py() != times[0]:
                    raise RuntimeError("the ranges of rows were dealt twice, and not alike: spark.sql.exchange.reuse must be on")
            for row, (start, time) in enumerate(zip(starts, times)):
                if start:
                    open_from = ALWAYS
                if time >= open_from:
                    kept.append(row)
                    open_from = time + micros
            previous = batch.slice(batch.num_rows - 1)
            yield batch.take(pa.array(kept, type=pa.int64())).drop_columns([STARTS_AT, OPEN_FROM])

    return keep


def _exit_steps(keys, ts, micros):
    """The step functions of a partition's first and last key: entered no later than ``up_to``, one opens again at ``open_from``.

    Only a key that fills its partition passes an entry time on. Else the first
    one ends here and the last one begins here.
    """
    names = [*keys, PART, STARTS_AT, UP_TO, OPEN_FROM]

    def rows(key, part, starts_at, up_to, open_from):
        many = len(up_to)
        columns = [pa.concat_arrays([k] * many) for k in key]
        columns += [pa.array([value] * many, kind) for value, kind in ((part, pa.int32()), (starts_at, pa.int64()))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(up_to, pa.int64()), pa.array(open_from, pa.int64())], names=names)

    def steps(batches):
        previous, runs, head, key, run = None, 0, None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            key_at = lambda row: [batch.column(k).slice(row, 1) for k in keys]  # noqa: B023, E731
            times = _times(batch, ts)
            starts = np.flatnonzero(starts_run(batch, keys, previous))
            if previous is None:
                part, starts_at, head = batch.column(PART)[0].as_py(), int(times[0]), key_at(0)
            previous = batch.slice(batch.num_rows - 1)
            if len(starts):
                key, run = key_at(int(starts[-1])), []
                runs += len(starts)
                times = times[starts[-1] :]
            run.append(times)
        if previous is None:
            return
        up_to, open_from = _steps(np.concatenate(run), micros)
        if runs == 1:
            yield rows(key, part, starts_at, up_to, open_from)
        else:
            yield rows(head, part, starts_at, [EVER], [ALWAYS])
            yield rows(key, part, None, [EVER], open_from[:1])

    return steps


def _steps(times, micros):
    """Entry times up to which, and the time from which a key is open again after its sorted ``times``."""
    times = np.unique(times)
    end = len(times)
    following = np.append(np.searchsorted(times, times + micros), end)
    # Entered from an earlier partition, the first kept row is at most the first one a ttl after the start.
    firsts = np.arange(min(end, int(following[0]) + 1))
    place, chain = firsts, firsts
    while (following[place] < end).any():
        place = np.where(following[place] < end, following[place], place)
        # Chains that meet go on as one.
        place, met = np.unique(place, return_inverse=True)
        chain = met[chain]
    exits = times[place][chain] + micros
    last = np.flatnonzero(np.append(exits[1:] != exits[:-1], True))
    return times[firsts][last].tolist(), exits[last].tolist()


def _chain_steps(keys):
    def chain(batches):
        previous, entered, leaves = None, ALWAYS, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key_starts = starts_run(batch, keys, previous)
            part_starts = key_starts | starts_run(batch, [PART], previous)
            found = []
            columns = [batch.column(name).to_pylist() for name in (PART, STARTS_AT, UP_TO, OPEN_FROM)]
            for key_start, part_start, part, starts_at, up_to, open_from in zip(key_starts.tolist(), part_starts.tolist(), *columns):
                if part_start:
                    entered = ALWAYS if key_start else entered if leaves is None else leaves
                    leaves = None
                    if starts_at is not None:
                        found.append((part, starts_at, entered))
                if leaves is None and up_to >= entered:
                    leaves = open_from
            previous = batch.slice(batch.num_rows - 1)
            arrays = [pa.array([row[i] for row in found], kind) for i, kind in enumerate([pa.int32(), pa.int64(), pa.int64()])]
            yield pa.RecordBatch.from_arrays(arrays, names=[PART, STARTS_AT, OPEN_FROM])

    return chain
