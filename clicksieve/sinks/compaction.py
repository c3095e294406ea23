"""Many small loads of a table merged into few large ones.

A stream adds a partition per micro-batch and day (``load_id``, ``pt_d``).
:func:`compact_loads` copies the finished loads of each day into one load of
well-sized files and commits the merge by renaming one folder, ``_merges/<n>``
in the table's location, which lists the loads that the new one replaces.
:func:`current_rows` reads the table by that record, so its readers see all of a
merge or none of it, and a replaced load that is written once more stays
hidden. :func:`drop_merged_loads` removes what no reader can still need.

The file system must rename folders in one step, as HDFS and local ones do.
Other readers of the table see it right once replaced loads are dropped.
"""

import hashlib
import json
import time
import uuid
from urllib.parse import unquote

from pyspark.sql import functions as F

from clicksieve.functions import duration_micros
from clicksieve.record import LOAD_COLUMN, PARTITION_COLUMN
from clicksieve.sinks.folders import changed_at, drop_folder, folders, move_folder, table_location
from clicksieve.sinks.tables import add_partitions, alter_partitions

MERGES = "_merges"
MERGED = "merged-"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def partitions(spark, table):
    """``{(load, day): folder name}`` of the partitions the catalog knows."""
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        load, day = [unquote(part.split("=", 1)[1]) for part in row[0].split("/")]
        found[load, day] = row[0]
    return found


def merges(spark, table):
    """The committed merges in order: ``(number, target, replaced)``, the last a set of ``(load, day)``."""
    root = f"{table_location(spark, table)[0]}/{MERGES}"
    numbers = [int(name) for name in folders(spark, root) if name.isdigit()]
    if not numbers:
        return []
    rows = spark.read.schema("number long, target string, load string, day string").json([f"{root}/{n:09d}" for n in numbers]).collect()
    found = {}
    for row in rows:
        found.setdefault((row["number"], row["target"]), set()).add((row["load"], row["day"]))
    return [(number, target, replaced) for (number, target), replaced in sorted(found.items())]


def _stream_and_batch(load):
    stream, _, batch = load.rpartition("-")
    return (stream, int(batch)) if stream and batch.isdigit() else (load, None)


def finished_loads(loads):
    """Those of ``(load, day)`` that no stream can write again: not of the latest micro-batch of its stream.

    Loads are named by stream and micro-batch. A load of another name is as
    finished as its caller says.
    """
    latest = {}
    for load, _ in loads:
        stream, batch = _stream_and_batch(load)
        if batch is not None:
            latest[stream] = max(batch, latest.get(stream, -1))
    return {(load, day) for load, day in loads if latest.get(_stream_and_batch(load)[0]) != _stream_and_batch(load)[1] or load.startswith(MERGED)}


def current_loads(spark, table):
    """``(loads, number)``: the ``(load, day)`` pairs that count, and the number of the last merge."""
    # Partitions first: a merge committed after they were listed hides its loads and is not hidden itself.
    present = set(partitions(spark, table))
    done = merges(spark, table)
    replaced = set().union(*[r for _, _, r in done])
    targets = {target for _, target, _ in done}
    loads = {(load, day) for load, day in present - replaced if load in targets or not load.startswith(MERGED)}
    return loads, done[-1][0] if done else 0


def compact_loads(spark, table, days=None, least=2, finished=finished_loads, load_column=LOAD_COLUMN, partition=PARTITION_COLUMN):
    """Merges the finished loads of each day that has ``least`` of them; returns the new load's name, or ``None``.

    ``days`` limits the work to some days, and ``finished`` says which loads are
    ready. Rows without a day stay in their loads. A run that is lost before its
    commit changes nothing that readers see, and the next one writes over what it
    left. Of two runs at a time the second to commit gives up, with an error.
    """
    loads, number = current_loads(spark, table)
    ready = [(load, day) for load, day in finished(loads) if day != NO_DAY and (days is None or day in days)]
    per_day = {}
    for _, day in ready:
        per_day[day] = per_day.get(day, 0) + 1
    chosen = sorted((load, day) for load, day in ready if per_day[day] >= least)
    if not chosen:
        return None
    target = MERGED + hashlib.sha256(json.dumps(chosen).encode()).hexdigest()[:20]
    location, provider = table_location(spark, table)
    merged_days = sorted({day for _, day in chosen})
    spark.catalog.refreshTable(table)
    picked = spark.createDataFrame(chosen, f"`{load_column}` string, `{partition}` string")
    rows = spark.table(table).where(F.col(partition).isin(merged_days)).join(picked, [load_column, partition], "left_semi")
    rows = rows.drop(load_column).hint("rebalance", partition)
    rows.write.format(provider).mode("overwrite").partitionBy(partition).save(f"{location}/{load_column}={target}")
    add_partitions(spark, table, [(target, day) for day in merged_days], load_column, partition)
    record = f"{location}/{MERGES}/{number + 1:09d}"
    attempt = f"{location}/{MERGES}/.{uuid.uuid4().hex}"
    listed = picked.select(F.lit(number + 1).alias("number"), F.lit(target).alias("target"), F.col(load_column).alias("load"), F.col(partition).alias("day"))
    listed.coalesce(1).write.json(attempt)
    if not move_folder(spark, attempt, record):
        drop_folder(spark, attempt)
        raise RuntimeError(f"another merge of {table} was committed meanwhile; run this one again")
    spark.catalog.refreshTable(table)
    return target


def current_rows(spark, table, load_column=LOAD_COLUMN, partition=PARTITION_COLUMN):
    """The rows of a table, each load once: merged loads in place of those they replaced.

    Only partition columns are compared, so hidden loads are not read.
    """
    present = set(partitions(spark, table))
    done = merges(spark, table)
    hidden = sorted(f"{load}/{day}" for load, day in present & set().union(*[r for _, _, r in done]))
    targets = [target for _, target, _ in done]
    spark.catalog.refreshTable(table)
    rows = spark.table(table).where(~F.col(load_column).startswith(MERGED) | F.col(load_column).isin(targets))
    if not hidden:
        return rows
    return rows.where(~F.concat_ws("/", load_column, F.coalesce(partition, F.lit(NO_DAY))).isin(hidden))


def drop_merged_loads(spark, table, keep="1 hour", load_column=LOAD_COLUMN, partition=PARTITION_COLUMN):
    """Drops the partitions and files of loads whose merge was committed ``keep`` ago or earlier; returns how many.

    ``keep`` is the time that readers who planned before the commit may take;
    ``None`` waits for nobody. The records of merges stay, as a stream may still
    repeat a load of theirs.
    """
    location, _ = table_location(spark, table)
    present, old = partitions(spark, table), set()
    for number, _, replaced in merges(spark, table):
        age = time.time() - changed_at(spark, f"{location}/{MERGES}/{number:09d}") / 1000
        if keep is None or age >= duration_micros(keep) / 1e6:
            old |= replaced
    gone = sorted(old & set(present))
    alter_partitions(spark, table, "DROP IF EXISTS", gone, load_column, partition, ", ")
    for pair in gone:
        drop_folder(spark, f"{location}/{present[pair]}")
    spark.catalog.refreshTable(table)
    return len(gone)

