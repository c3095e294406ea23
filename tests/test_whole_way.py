"""Quarantine beside samples, days of a zone, days published by a stream, files rolled by bytes."""

import glob
import os
import uuid
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from clicksieve.plans import lines_to_table, samples, stream_lines_to_records, stream_lines_to_table, stream_records_to_table
from clicksieve.operators.records import record_from_row
from clicksieve.record import FEATURE_SCHEMA, RECORD_SCHEMA
from clicksieve.sinks import create_sample_table, evolve_and_append, rolled, write_text_rolled
from clicksieve.sinks.publish import Publisher, day_end
from clicksieve.sources import read_lines, stream_lines
from clicksieve.streaming import date_in_order, distinct_stream, stream_to_table
from helpers import log
from test_wire import SHOWN, record

FEATURES = [("7100", "field1", "10"), ("7101", "field2", "20")]
DAY = 86_400
GOOD = [record(str(7100 + n), SHOWN, "0") for n in range(3)] + [record("7102", SHOWN, "1")]
BAD = ["", "one field", "{half\u0001abcd\u0001abcd", record("7105", "soon", "0")]


@pytest.fixture
def table(spark):
    names = []

    def make(**options):
        names.append(f"t_{uuid.uuid4().hex}")
        create_sample_table(spark, names[-1], **{"batch_column": "load_id", **options})
        return names[-1]

    yield make
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_lines(spark, path, lines):
    spark.createDataFrame([(t,) for t in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_samples_and_quarantine_from_one_decoding(spark, table, tmp_path, monkeypatch):
    path = str(tmp_path / "lines")
    write_lines(spark, path, GOOD + BAD)
    out, damaged = table(), table(columns=["value", "reason"])
    features = spark.createDataFrame(FEATURES, FEATURE_SCHEMA)
    decoded = []
    decode = samples.decode
    monkeypatch.setattr(samples, "decode", lambda *a, **k: decoded.append(1) or decode(*a, **k))
    for _ in range(2):
        lines_to_table(read_lines(spark, path), features, out, ["field1", "field2"], damaged=damaged, load="run 1")
    assert len(decoded) == 2
    assert sorted(r.user_id for r in spark.table(out).collect()) == ["7100", "7101", "7105"]
    found = sorted((r.value, r.reason) for r in spark.table(damaged).collect())
    assert found == sorted(zip(BAD, ["fields", "fields", "json", "time"]))


def test_every_line_of_a_stream_ends_in_one_of_two_tables(spark, table, tmp_path, monkeypatch):
    """Three micro-batches; the second is lost between the two tables and runs again."""
    path, progress = str(tmp_path / "lines"), str(tmp_path / "progress")
    records, damaged = table(), table(columns=["value", "reason"])
    for part in (GOOD[:2] + BAD[:1], GOOD[2:] + BAD[1:], BAD):
        write_lines(spark, path, part)
    write, calls = samples.evolve_and_append, []

    def lost(df, name, **options):
        calls.append(name)
        if len(calls) == 4:
            raise OSError("lost")
        write(df, name, **options)

    start = lambda: stream_lines_to_records(stream_lines(spark, path, 1), records, damaged, progress, interval=None)
    with monkeypatch.context() as patch:
        patch.setattr(samples, "evolve_and_append", lost)
        with pytest.raises(Exception, match="lost"):
            start().awaitTermination()
    start().awaitTermination()
    assert sorted(r.user_id for r in spark.table(records).collect()) == ["7100", "7101", "7102", "7102"]
    assert sorted(r.value for r in spark.table(damaged).collect()) == sorted(BAD + BAD)
    # The records go on as a stream of their own.
    write_lines(spark, path, [record("__end", "2200-01-01 00:00:00", "")])
    start().awaitTermination()
    out, features = table(), spark.createDataFrame(FEATURES, FEATURE_SCHEMA)
    stream_records_to_table(
        record_from_row(spark.readStream.table(records)), features, out, str(tmp_path / "p2"), ["field1"], interval=None
    ).awaitTermination()
    assert sorted(r.user_id for r in spark.table(out).collect()) == ["7100", "7101"]


def test_days_of_a_zone(spark, table, tmp_path):
    """17:53 in UTC is the next day in Shanghai, in batch and on a stream."""
    path = str(tmp_path / "lines")
    write_lines(spark, path, [record("7100", "2019-03-07 17:53:05", "0"), record("__end", "2200-01-01 00:00:00", "")])
    features = spark.createDataFrame(FEATURES, FEATURE_SCHEMA)
    batch, stream = table(), table()
    lines_to_table(read_lines(spark, path), features, batch, ["field1"], tz="Asia/Shanghai", load="one")
    stream_lines_to_table(
        stream_lines(spark, path), features, stream, str(tmp_path / "progress"), ["field1"], tz="Asia/Shanghai", interval=None
    ).awaitTermination()
    for name in (batch, stream):
        assert [r.pt_d for r in spark.table(name).where("user_id = '7100'").collect()] == ["20190308"]


def test_a_stream_publishes_days_that_its_watermark_has_passed(spark, table, tmp_path):
    """Six micro-batches, a stop, and one more: a day is hidden until passed, and then stays."""
    name, path, progress = table(), str(tmp_path / "in"), str(tmp_path / "progress")
    days = [[("a", 10, "0")], [("b", 20, "0"), ("c", DAY + 5, "0")], [("d", DAY + 9, "0")], [("e", 2 * DAY, "0")], [("f", 2 * DAY + 9, "0")], [("g", 3 * DAY, "0")]]
    for number, rows in enumerate(days):
        log(spark, rows).coalesce(1).write.parquet(f"{path}/{number}")
    date_in_order(spark, *[f"{path}/{n}" for n in range(len(days))])
    source = spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")
    shown = []
    publish = Publisher.publish

    def noted(self, pairs, watermark):
        closed = publish(self, pairs, watermark)
        shown.append((watermark, sorted({d for _, d in closed})))
        return closed

    Publisher.publish = noted
    try:
        run = lambda: stream_to_table(distinct_stream(source).drop("window_start"), name, progress, interval=None, publish=True).awaitTermination()
        run()
        first = {r.pt_d for r in spark.table(name).collect()}
        log(spark, [("h", 9 * DAY, "0")]).coalesce(1).write.parquet(f"{path}/7")
        log(spark, [("i", 20 * DAY, "0")]).coalesce(1).write.parquet(f"{path}/8")
        date_in_order(spark, f"{path}/7", f"{path}/8")
        run()
    finally:
        Publisher.publish = publish
    assert first == {"20190307", "20190308"}
    for watermark, closed in shown:
        passed = datetime.fromisoformat(watermark.replace("Z", "+00:00")) if watermark else None
        assert all(passed and day_end(d) <= passed for d in closed)
    assert sorted(r.user_id for r in spark.table(name).collect()) == list("abcdefg")


def test_day_ends():
    assert day_end("20190307") == datetime(2019, 3, 8, tzinfo=timezone.utc)
    assert day_end("20190307", "Asia/Shanghai") == datetime(2019, 3, 7, 16, tzinfo=timezone.utc)


def test_files_rolled_by_bytes(spark, tmp_path):
    """A third of the rows are one line, texts are not ASCII, one line is longer than a file, some have no day."""
    rows = [("same é line", "20190307")] * 400 + [(f"{n} " + "ü" * (n % 50), f"2019030{n % 2 + 7}") for n in range(800)]
    rows += [("x" * 5000, "20190307"), ("", "20190308"), (None, "20190308"), ("no day", None)]
    df = spark.createDataFrame(rows, "value string, pt_d string").repartition(7)
    path, limit = str(tmp_path / "rolled"), 2000
    write_text_rolled(df, path, limit)
    back = spark.read.schema("value string, pt_d string, roll int").text(path)
    expected = sorted((v or "", d or "") for v, d in rows)
    assert sorted((r.value, r.pt_d or "") for r in back.collect()) == expected
    for folder in glob.glob(f"{path}/pt_d=*"):
        files = glob.glob(f"{folder}/roll=*/*.txt")
        assert len(files) == len(glob.glob(f"{folder}/roll=*"))
        sizes = {int(f.split("roll=")[1].split("/")[0]): os.path.getsize(f) for f in files}
        longest = 5001 if folder.endswith("07") else 110
        assert max(sizes.values()) < limit + longest
        # Where the long line is not in the way, only the last file is short.
        if not folder.endswith("07"):
            assert all(size > limit - 110 for roll, size in sizes.items() if roll < max(sizes))
    assert rolled(df.limit(0), limit).count() == 0


def test_streams_write_one_table_at_a_time_of_their_own(spark, table):
    """Loads of two writers into one table at the same time do not touch each other's unfinished files."""
    import threading

    name, errors = table(), []

    def write(writer):
        try:
            for n in range(4):
                evolve_and_append(log(spark, [(writer, n * DAY, "0")]), name, batch_column="load_id", batch_id=f"{writer}-{n}")
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=write, args=(w,)) for w in "abc"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert spark.table(name).groupBy("user_id").agg(F.count("*").alias("n")).where("n = 4").count() == 3


