"""Streams give the batch answers, whatever the micro-batches."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from clicksieve.operators import (
    clicks,
    decode,
    distinct_in_window,
    first_per_key_ttl,
    negatives_in_window,
    negatives_two_stream,
    negatives_within,
    quarantine,
    shows,
)
from clicksieve.record import RECORD_SCHEMA
from clicksieve.sources import stream_lines
from clicksieve.streaming import (
    distinct_stream,
    end_record,
    first_per_key_ttl_stream,
    negatives_in_window_stream,
    negatives_two_stream_stream,
    negatives_within_stream,
    replay,
)
from helpers import log, users_seconds


@pytest.fixture(scope="module")
def rows():
    random.seed(7)
    kinds = ["0", "0", "1", "other"]
    drawn = [
        ("hot" if n % 3 == 0 else f"u{random.randrange(6)}", random.randrange(600), random.choice(kinds))
        for n in range(400)
    ]
    return sorted(drawn, key=lambda r: r[1])


@pytest.fixture(scope="module")
def batch(spark, rows):
    return log(spark, rows).cache()


def stream_of(spark, folder, df, files, disorder=0):
    """The log as a file stream in time order, one file per trigger, ending with the end record.

    ``disorder`` delays rows by up to so many seconds, across files.
    """
    path = str(folder / uuid.uuid4().hex)
    width = 600 / files
    arrival = F.col("time_stamp").cast("double") + F.pmod(F.hash("event_id"), F.lit(1000)) / 1000 * disorder
    part = F.least(F.floor(F.greatest(arrival, F.lit(0)) / width), F.lit(files - 1))
    numbered = df.withColumn("part", part)
    for number in range(files):
        numbered.where(F.col("part") == number).drop("part").coalesce(1).write.mode("append").parquet(path)
    end_record(spark).coalesce(1).write.mode("append").parquet(path)
    return (
        spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(path)
    )


@pytest.mark.parametrize("files", [1, 4])
def test_distinct(spark, tmp_path, batch, files):
    doubled = batch.union(batch)
    out = replay(distinct_stream(stream_of(spark, tmp_path, doubled, files)), "distinct")
    expected = distinct_in_window(batch)
    assert out.columns == expected.columns
    got = out.where(F.col("user_id") != "__end")
    assert sorted(got.collect()) == sorted(expected.collect())


@pytest.mark.parametrize("files", [1, 4])
@pytest.mark.parametrize("width", ["10 seconds", "1 minute"])
def test_window_negatives(spark, tmp_path, batch, files, width):
    source = stream_of(spark, tmp_path, batch.union(batch), files)
    out = replay(negatives_in_window_stream(source, width=width, salts=3), "window")
    expected = negatives_in_window(batch, width=width)
    assert sorted(out.select(*expected.columns).collect()) == sorted(expected.collect())
    assert expected.count() > 20


def test_window_negatives_of_raw_rows(spark, tmp_path, batch):
    source = stream_of(spark, tmp_path, batch.union(batch), 2)
    out = replay(negatives_in_window_stream(source, width="1 minute", distinct=False, salts=1), "raw")
    expected = negatives_in_window(batch.union(batch), width="1 minute")
    assert sorted(out.select(*expected.columns).collect()) == sorted(expected.collect())


def test_quarantine_of_a_stream(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([("short",), ("{bad\u0001x\u0001y",)], "value string").write.text(path)
    out = replay(quarantine(decode(stream_lines(spark, path))), "quarantine")
    assert sorted((r.value, r.reason) for r in out.collect()) == [("short", "fields"), ("{bad\u0001x\u0001y", "json")]


@pytest.mark.parametrize("files", [1, 4])
@pytest.mark.parametrize("ttl", ["5 seconds", "30 seconds"])
def test_interval_negatives(spark, tmp_path, batch, files, ttl):
    source = stream_of(spark, tmp_path, batch, files)
    out = replay(negatives_within_stream(source, ttl=ttl, salts=3), "interval")
    expected = negatives_within(shows(batch), clicks(batch), ttl=ttl)
    assert sorted(out.collect()) == sorted(expected.collect())
    assert expected.count() > 10


@pytest.mark.parametrize("files, disorder", [(1, 0), (6, 1.9)])
def test_first_per_key_ttl(spark, tmp_path, batch, files, disorder):
    source = stream_of(spark, tmp_path, batch, files, disorder)
    out = replay(first_per_key_ttl_stream(source), "first")
    expected = first_per_key_ttl(batch)
    got = out.where(F.col("user_id") != "__end")
    assert sorted(got.collect()) == sorted(expected.collect())


@pytest.mark.parametrize("files, disorder", [(1, 0), (6, 1.9)])
@pytest.mark.parametrize("dedup_clicks", [True, False])
def test_two_stream(spark, tmp_path, batch, files, disorder, dedup_clicks):
    source = stream_of(spark, tmp_path, batch, files, disorder)
    out = replay(negatives_two_stream_stream(source, ttl="10 seconds", dedup_clicks=dedup_clicks), "two")
    expected = negatives_two_stream(batch, ttl="10 seconds", dedup_clicks=dedup_clicks)
    assert sorted(out.collect()) == sorted(expected.collect())
    assert expected.count() > 10


def test_null_users_and_users_of_any_name_stay(spark, tmp_path):
    rows = log(spark, [(None, 0, "0"), ("__end", 1, "0"), ("a", 2, "0")])
    out = replay(distinct_stream(stream_of(spark, tmp_path, rows, 1)), "distinct")
    assert {r.event_id for r in out.collect()} == {"000000", "000001", "000002"}


LATE = {
    "distinct": distinct_stream,
    "window": lambda s: negatives_in_window_stream(s, width="10 seconds"),
    "interval": negatives_within_stream,
    "first": first_per_key_ttl_stream,
    "two": negatives_two_stream_stream,
}


@pytest.mark.parametrize("name", LATE)
def test_late_rows_are_dropped(spark, tmp_path, name):
    """Of three users' rows of one time, one comes in order, one within the delay, and one after the watermark."""
    path = str(tmp_path / "late")
    batches = [[("a", 100, "0")], [("x", 101, "0"), ("b", 100, "0")], [("x", 400, "0")], [("c", 100, "0"), ("y", 401, "0")]]
    log(spark, []).write.parquet(path)
    source = spark.readStream.schema(RECORD_SCHEMA).parquet(path)

    def bring(rows):
        return lambda: (end_record(spark) if rows is None else log(spark, rows)).write.mode("append").parquet(path)

    out = replay(LATE[name](source), name, [bring(rows) for rows in (*batches, None)])
    assert {r.user_id for r in out.collect()} - {"__end"} == {"a", "b", "x", "y"}


@pytest.mark.parametrize("operator", [distinct_stream, negatives_in_window_stream, negatives_within_stream])
def test_rows_fold_before_they_are_shuffled(spark, tmp_path, batch, operator):
    """A third of the rows are one user's and a third are copies of one line; both are aggregated below the exchange."""
    source = operator(stream_of(spark, tmp_path, batch.union(batch), 1))
    query = source.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start()
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    lines = plan.splitlines()
    below = [after for line, after in zip(lines, lines[1:]) if "Exchange hashpartitioning" in line]
    assert any("HashAggregate" in line for line in below)
    assert "Deduplicate" not in plan
