import glob
import uuid

import pytest
from pyspark.sql import functions as F

from clicksieve.functions import day, day_of_millis
from clicksieve.operators import lookup_features, map_to_columns, record_lines
from clicksieve.plans import lines_to_table, stream_lines_to_table, table_to_records
from clicksieve.record import FEATURE_SCHEMA, RECORD_FIELDS
from clicksieve.session import fresh_path, shared_dir
from clicksieve.sinks import (
    bucketed,
    closed_days,
    create_sample_table,
    evolve_and_append,
    evolve_columns,
    hour_bucketed,
    publish_closed_days,
    write_orc_buckets,
    write_text_buckets,
)
from clicksieve.sources import column_names, partition_scan, read_lines, stream_lines, use_database
from clicksieve.streaming import stream_to_table, stream_to_text_buckets
from clicksieve.streaming.jobs import stream_id
from helpers import log
from test_wire import CLICKED, SHOWN, record


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_evolution(spark, table):
    create_sample_table(spark, table, ["user_id", "f1"])
    first = spark.createDataFrame([("a", "x", "20190307")], "user_id string, f1 string, pt_d string")
    evolve_and_append(first, table)
    assert evolve_columns(spark, table, ["F1", "user_id"]) == []
    assert evolve_columns(spark, table, ["f2", "f3", "user_id"]) == ["f2", "f3"]
    second = spark.createDataFrame([("20190308", "z", "b")], "pt_d string, f3 string, user_id string")
    evolve_and_append(second, table)
    assert column_names(spark, table) == ["user_id", "f1", "f2", "f3", "pt_d"]
    assert sorted(tuple(r) for r in spark.table(table).collect()) == [
        ("a", "x", None, None, "20190307"),
        ("b", None, None, "z", "20190308"),
    ]


def test_day_comes_from_the_event_time(spark, table):
    create_sample_table(spark, table)
    evolve_and_append(log(spark, [("a", 0, "0"), ("b", 86_400, "1")]), table)
    assert column_names(spark, table) == [*RECORD_FIELDS, "pt_d"]
    assert {r.pt_d for r in spark.table(table).collect()} == {"20190307", "20190308"}
    scanned = partition_scan(spark, table, "20190308")
    assert [r.user_id for r in scanned.collect()] == ["b"]
    assert "PartitionFilters: [isnotnull(pt_d" in scanned._jdf.queryExecution().executedPlan().toString()
    assert [r.user_id for r in table_to_records(spark, table, "20190307").collect()] == ["a"]


def test_a_repeated_batch_counts_once(spark, table):
    create_sample_table(spark, table, batch_column="load_id")
    for batch_id, rows in ((1, [("a", 0, "0")]), (2, [("b", 0, "0")]), (2, [("b", 0, "0")])):
        evolve_and_append(log(spark, rows), table, batch_column="load_id", batch_id=batch_id)
    assert sorted(r.user_id for r in spark.table(table).collect()) == ["a", "b"]


def test_closed_days(spark, table, tmp_path):
    path = str(tmp_path / "days")
    create_sample_table(spark, table, path=path)
    rows = bucketed(log(spark, [("a", 0, "0"), ("b", 86_400, "0"), ("c", 172_800, "0")])).drop("timeStamp_flag")
    rows.write.mode("append").partitionBy("pt_d").parquet(path)
    written = spark.read.parquet(path)
    assert spark.table(table).count() == 0
    assert closed_days(written, "2019-03-08 00:00:00").count() == 1
    assert publish_closed_days(spark, table, written, "2019-03-09 00:00:00") == ["20190307", "20190308"]
    assert sorted(r.user_id for r in spark.table(table).collect()) == ["a", "b"]
    assert publish_closed_days(spark, table, written, "2019-03-14 00:00:00")[-1] == "20190309"
    assert spark.table(table).count() == 3


def test_text_and_orc_buckets(spark, tmp_path):
    df = log(spark, [("a", n * 3_600, "0") for n in range(48)])
    lines = record_lines(bucketed(df), keep=["pt_d"])
    write_text_buckets(lines, str(tmp_path / "text"), max_records=5)
    assert len(glob.glob(str(tmp_path / "text" / "pt_d=20190308" / "*.txt"))) >= 5
    assert spark.read.text(str(tmp_path / "text")).count() == 48
    write_orc_buckets(bucketed(df), str(tmp_path / "orc"))
    assert spark.read.orc(str(tmp_path / "orc")).drop("pt_d").count() == 48
    assert len(glob.glob(str(tmp_path / "orc" / "pt_d=*"))) == 3


def test_day_formats(spark):
    df = spark.sql("SELECT timestamp '2019-03-07 17:53:05' AS ts")
    row = df.select(
        day(F.col("ts")).alias("utc"),
        day(F.col("ts"), tz="Asia/Shanghai").alias("shanghai"),
        day_of_millis(F.lit(1_551_981_185_000), "yyyy-MM-dd--HH").alias("hour"),
    ).first()
    assert tuple(row) == ("20190307", "20190308", "2019-03-07--17")
    now = hour_bucketed(df).first().bucket
    assert len(now) == len("2019-03-07--17")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS other")
    use_database(spark, "other")
    assert spark.catalog.currentDatabase() == "other"
    use_database(spark, "default")


FEATURES = [("7100", "field1", "10"), ("7101", "field2", "20")]


def lines(spark, folder, extra=()):
    shown = [record(str(7100 + n), SHOWN, "0") for n in range(3)]
    clicked = [record("7102", SHOWN, "1")]
    path = str(folder / uuid.uuid4().hex)
    texts = [*shown, *shown, *clicked, *extra]
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(path)
    return path


def test_lines_to_table(spark, table, tmp_path):
    create_sample_table(spark, table)
    features = spark.createDataFrame(FEATURES, FEATURE_SCHEMA)
    lines_to_table(read_lines(spark, lines(spark, tmp_path)), features, table, ["field1", "field2"])
    assert column_names(spark, table) == [*RECORD_FIELDS, "field1", "field2", "pt_d"]
    rows = spark.table(table).select("user_id", "field1", "field2", "pt_d").collect()
    assert sorted(tuple(r) for r in rows) == [
        ("7100", "10", None, "20190307"),
        ("7101", None, "20", "20190307"),
    ]


def test_line_stream_to_table(spark, table, tmp_path):
    create_sample_table(spark, table, batch_column="load_id")
    features = spark.createDataFrame(FEATURES, FEATURE_SCHEMA)
    source = stream_lines(spark, lines(spark, tmp_path, [record("__end", "2200-01-01 00:00:00", "")]))
    query = stream_lines_to_table(source, features, table, str(tmp_path / "progress"), ["field1", "field2"], interval=None)
    query.awaitTermination()
    rows = spark.table(table).select("user_id", "field1", "field2", "pt_d").collect()
    assert sorted(tuple(r) for r in rows) == [
        ("7100", "10", None, "20190307"),
        ("7101", None, "20", "20190307"),
    ]


def test_streams_of_one_table_do_not_replace_each_other(spark, table, tmp_path):
    """Two streams, one of them started again from its checkpoint, and a third run of the same input with a new one."""
    create_sample_table(spark, table, batch_column="load_id")
    paths = {name: str(tmp_path / name) for name in ("one", "two")}
    for name, path in paths.items():
        log(spark, [(name, n, "0") for n in range(3)]).write.parquet(path)
    for name, progress in (("one", "p1"), ("two", "p2"), ("two", "p2"), ("two", "p3")):
        stream = spark.readStream.schema(log(spark, []).schema).parquet(paths[name])
        stream_to_table(stream, table, str(tmp_path / progress), interval=None).awaitTermination()
    counts = spark.table(table).groupBy("load_id", "user_id").count().collect()
    assert sorted((r["user_id"], r["count"]) for r in counts) == [("one", 3), ("two", 3), ("two", 3)]


def test_repeated_batch_counts_once(spark, table, tmp_path):
    """A batch that fails after its insert runs again from the checkpoint."""
    create_sample_table(spark, table, batch_column="load_id")
    path, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    log(spark, [("a", 0, "0"), ("b", 90_000, "0")]).write.parquet(path)
    stream = spark.readStream.schema(log(spark, []).schema).parquet(path)

    def broken(batch, number):
        evolve_and_append(batch, table, batch_column="load_id", batch_id=f"{stream_id(batch)}-{number}")
        raise RuntimeError("lost after the insert")

    query = stream.writeStream.foreachBatch(broken).option("checkpointLocation", progress).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="lost after the insert"):
        query.awaitTermination()
    assert spark.read.table(table).count() == 2
    stream_to_table(stream, table, progress, interval=None).awaitTermination()
    assert sorted(r.user_id for r in spark.table(table).collect()) == ["a", "b"]


def test_stream_gains_columns_and_rolls_files(spark, table, tmp_path):
    create_sample_table(spark, table, batch_column="load_id")
    path = str(tmp_path / "in")
    log(spark, [("a", 0, "0")]).write.parquet(path)
    stream = spark.readStream.schema(log(spark, [("a", 0, "0")]).schema).parquet(path)
    features = spark.createDataFrame([("a", "field1", "10")], FEATURE_SCHEMA)
    enriched = map_to_columns(lookup_features(stream, features, ["field1"]), ["field1"])
    stream_to_table(enriched, table, str(tmp_path / "p1"), interval=None).awaitTermination()
    assert [(r.user_id, r.field1) for r in spark.table(table).collect()] == [("a", "10")]
    out = str(tmp_path / "text")
    stream_to_text_buckets(record_lines(stream), out, str(tmp_path / "p2"), None, 1).awaitTermination()
    assert glob.glob(out + "/bucket=*/*.txt")
    assert spark.read.text(out).first().value.startswith("a\u0001")
