import json

import pytest
from pyspark.sql import functions as F

from clicksieve.functions import delimited, first_field, has_fields, lenient_timestamp
from clicksieve.operators import (
    clicks,
    decode,
    good_records,
    json_lines,
    negatives_in_window,
    negatives_two_stream,
    negatives_within,
    quarantine,
    quarantine_counts,
    record_from_row,
    record_lines,
    shows,
    wire_lines,
)
from clicksieve.record import RECORD_FIELDS, RECORD_SCHEMA
from clicksieve.sinks import bucketed, kafka_sink_options
from clicksieve.sources import kafka_source_options, read_lines, stream_lines
from clicksieve.sources.kafka import kafka_lines

SHOWN, CLICKED = "2019-03-07 11:26:42.318000+00:00", "2019-03-07 12:26:5{}.318000+00:00"


def wire(**fields):
    return json.dumps(fields) + "\u0001x\u0001y"


def record(user, time, interested):
    return wire(user_id=user, event_id=f"e{user}", invited="0", time_stamp=time, interested=interested)


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    """Six shows of one instant, and clicks of three of those users an hour later."""
    lines = [record(str(7100 + n), SHOWN, "0") for n in range(6)]
    lines += [record(str(7100 + n), CLICKED.format(d), "1") for n, d in enumerate((4, 6, 7))]
    path = tmp_path_factory.mktemp("wire") / "log.txt"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def lines_of(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_sample(spark, sample):
    records = good_records(decode(read_lines(spark, sample)))
    assert [(f.name, f.dataType) for f in records.schema] == [(f.name, f.dataType) for f in RECORD_SCHEMA]
    assert (records.count(), shows(records).count(), clicks(records).count()) == (9, 6, 3)
    negatives = bucketed(negatives_in_window(records, distinct=True)).collect()
    assert len(negatives) == 6
    assert {str(r.window_start) for r in negatives} == {"2019-03-07 11:26:40"}
    assert {r.pt_d for r in negatives} == {"20190307"}
    assert negatives_within(shows(records), clicks(records)).count() == 6
    assert negatives_two_stream(records).count() == 6


FIELD_COUNTS = [
    ("a\u0001b\u0001c", True),
    ("a\u0001b\u0001", False),
    ("a\u0001b\u0001c\u0001", True),
    ("a\u0001b\u0001c\u0001\u0001\u0001", True),
    ("\u0001b\u0001c", True),
    ("a\u0001\u0001c", True),
    ("a\u0001b\u0001c\u0001d", False),
    ("a\u0001b\u0001\u0001d", False),
    ("", False),
    ("\u0001\u0001", False),
    ("a", False),
]


def test_field_guard(spark):
    df = lines_of(spark, *[v for v, _ in FIELD_COUNTS])
    got = {r.value: r.ok for r in df.select("value", has_fields(F.col("value")).alias("ok")).collect()}
    assert got == dict(FIELD_COUNTS)
    first = df.select(first_field(F.col("value")).alias("f")).collect()
    assert [r.f for r in first] == [v.split("\u0001")[0] for v, _ in FIELD_COUNTS]


def test_json_forms(spark):
    tail = "\u0001a\u0001b"
    df = lines_of(
        spark,
        '{"user_id":88,"invited":{"a":1},"time_stamp":"2019-03-07 11:26:42"}' + tail,
        "{bad" + tail,
        tail,
        "null" + tail,
        "[1]" + tail,
        "{}" + tail,
        "short",
    )
    decoded = decode(df)
    good = {r.user_id: r for r in good_records(decoded).collect()}
    assert set(good) == {"88", ""}
    assert (good["88"].event_id, good["88"].invited, good["88"].interested) == ("", '{"a":1}', "")
    assert str(good[""].timeStamp_flag) == "1970-01-01 00:00:00"
    counts = {r.reason: r.line_count for r in quarantine_counts(decoded).collect()}
    assert counts == {"json": 4, "time": 1, "fields": 1}
    assert {r.value for r in quarantine(decoded).collect()} == {r.value for r in df.collect()[1:]}


TIMES = [
    ("2019-03-07 11:26:42.318000+00:00", "2019-03-07 11:26:42"),
    ("2019-03-07 11:26:42+00:00", "2019-03-07 11:26:42"),
    ("2012-1-2 3:4:5", "2012-01-02 03:04:05"),
    ("", "1970-01-01 00:00:00"),
    (None, "1970-01-01 00:00:00"),
    ("junk", "1970-01-01 00:00:00"),
    ("2012-13-02 00:00:00", "2013-01-02 00:00:00"),
    ("2019-03-07", "1970-01-01 00:00:00"),
]


@pytest.mark.parametrize("text, expected", TIMES)
def test_lenient_time(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert str(df.select(lenient_timestamp(F.col("t"))).first()[0]) == expected


def test_time_in_another_zone(spark):
    df = spark.createDataFrame([("2019-03-07 11:26:42",)], "t string")
    assert str(df.select(lenient_timestamp(F.col("t"), "Asia/Shanghai")).first()[0]) == "2019-03-07 03:26:42"


def test_one_parse_per_line(spark, sample):
    records = good_records(decode(read_lines(spark, sample))).where("interested = '0'")
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_lines_out(spark, sample):
    records = good_records(decode(read_lines(spark, sample)))
    lines = wire_lines(records, RECORD_FIELDS)
    assert {v.value.split("\u0001")[1] for v in lines.collect()} == {"abcd"}
    again = good_records(decode(lines))
    assert sorted(again.collect()) == sorted(records.collect())
    with_null = records.withColumn("invited", F.lit(None).cast("string"))
    assert "invited" not in json_lines(with_null, RECORD_FIELDS).first().value
    text = record_lines(with_null).first().value
    assert text.split("\u0001")[2] == "" and len(text.split("\u0001")) == 5
    assert records.select(delimited("user_id", "interested", delimiter="|").alias("v")).first().v == "7100|0"


def test_positional_record(spark):
    df = spark.createDataFrame([("u", "e", None, SHOWN, "0", "x")], "a string, b string, c string, d string, e string, f string")
    row = record_from_row(df).first()
    assert (row.user_id, row.invited, str(row.timeStamp_flag)) == ("u", "", "2019-03-07 11:26:42")


def test_kafka_options_and_decode(spark, sample):
    options = kafka_source_options("host:1", "log", group_id="g")
    assert options == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "log",
        "startingOffsets": "earliest",
        "kafka.group.id": "g",
    }
    assert kafka_sink_options("host:1", "log") == {"kafka.bootstrap.servers": "host:1", "topic": "log"}
    binary = read_lines(spark, sample).select(F.col("value").cast("binary").alias("value"))
    assert good_records(decode(kafka_lines(binary))).count() == 9


def test_line_stream(spark, sample):
    stream = stream_lines(spark, sample.rsplit("/", 1)[0], max_files_per_trigger=1)
    assert stream.isStreaming and stream.columns == ["value"]
