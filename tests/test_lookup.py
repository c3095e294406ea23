import pandas as pd
from pyspark.sql import functions as F

from clicksieve.functions import register_map_function
from clicksieve.operators import (
    distinct_in_window,
    expand_struct,
    feature_columns,
    flatten,
    lookup_features,
    map_partitions,
    map_to_columns,
    null_fill,
    window_arrays,
    with_label,
    without_label,
)
from clicksieve.operators.distinct import ELEMENTS
from clicksieve.record import FEATURE_FIELDS, FEATURE_SCHEMA
from clicksieve.sources import customer_features, long_features
from helpers import log

FEATURES = [("reader7", "field1", "10"), ("reader7", "field2", "20"), ("other", "unknown", "1")]


def features(spark, rows=FEATURES):
    return spark.createDataFrame(rows, FEATURE_SCHEMA)


def test_lookup_keeps_every_row(spark):
    df = log(spark, [("reader7", 0, "0"), ("reader7", 1, "0"), ("other", 2, "0"), ("nobody", 3, "0"), ("", 4, "0")])
    enriched = lookup_features(df, features(spark), ["field1", "field3"])
    maps = {r.user_id: r.mymap for r in enriched.collect()}
    assert maps["reader7"] == {"field1": "10", "field3": None}
    assert maps["other"] == maps["nobody"] == maps[""] == {"field1": None, "field3": None}
    columns = map_to_columns(enriched, ["field3", "field1"])
    assert columns.columns == [*df.columns, "field3", "field1"]
    assert sorted((r.user_id, r.field1) for r in columns.collect()) == [
        ("", None), ("nobody", None), ("other", None), ("reader7", "10"), ("reader7", "10"),
    ]


def test_all_configured_fields(spark):
    df = log(spark, [("reader7", 0, "0")])
    row = map_to_columns(lookup_features(df, features(spark))).first()
    assert [row[f] for f in FEATURE_FIELDS] == ["10", "20", None, None, None, None, None, None]


def test_saved_features(spark):
    df = log(spark, [("reader7", 0, "0"), ("nobody", 1, "0")])
    saved = feature_columns(features(spark), ["field1", "field2"])
    wanted = ["field2", "field8"]
    assert sorted(map(str, lookup_features(df, saved, wanted).collect())) == sorted(
        map(str, lookup_features(df, features(spark), wanted).collect())
    )


def test_repeated_fields_keep_one_value(spark):
    df = log(spark, [("reader7", 0, "0")])
    assert lookup_features(df, features(spark, FEATURES + [("reader7", "field1", "9")]), ["field1"]).first().mymap == {"field1": "9"}
    versions = spark.createDataFrame(
        [("reader7", "field1", "9", 1), ("reader7", "field1", "10", 2)], "key string, field string, value string, v int"
    )
    assert lookup_features(df, versions, ["field1"], version="v").first().mymap == {"field1": "10"}


def test_map_is_not_built_for_columns(spark):
    df = map_to_columns(lookup_features(log(spark, [("a", 0, "0")]), features(spark)))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "map(" not in plan


def test_a_hot_key_is_split_in_the_lookup(spark, data):
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = [("1" if n % 3 == 0 else str(n % 500), n, "0") for n in range(5_000)]
        df = log(spark, rows).repartition(16)
        out = lookup_features(df, customer_features(spark, data("0.001")), ["segment"])
        assert out.count() == 5_000
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_sql_map_function(spark):
    register_map_function(spark)
    spark.sql("SELECT map('a', '1') AS m").createOrReplaceTempView("maps")
    row = spark.sql("SELECT getValFromMap(m, 'a') AS a, getValFromMap(m, 'b') AS b FROM maps").first()
    assert (row.a, row.b) == ("1", None)


def test_client_per_partition(spark):
    def open_client():
        return {"rows": 0}

    def enrich(client, batch):
        client["rows"] += len(batch)
        return pd.DataFrame({"user_id": batch["user_id"], "seen": client["rows"]})

    df = log(spark, [("a", n, "0") for n in range(10)]).coalesce(1)
    out = map_partitions(df, open_client, enrich, "user_id string, seen int", lambda client: client.clear())
    assert {r.seen for r in out.collect()} == {10}


def test_long_features(spark):
    wide = spark.createDataFrame([(1, "x", None), (2, None, 5)], "id int, a string, b int")
    rows = {tuple(r) for r in long_features(wide, "id", {"first": "a", "second": "b"}).collect()}
    assert rows == {("1", "first", "x"), ("2", "second", "5")}


def test_window_arrays_hold_every_row_once(spark):
    rows = [("hot" if n % 2 else f"u{n % 7}", n % 40, "0") for n in range(300)]
    df = log(spark, rows)
    arrays = window_arrays(df.union(df), width="1 minute", rows_per_array=10)
    assert arrays.where("user_id = 'hot'").count() > 5
    assert sorted(flatten(arrays.select(ELEMENTS), ELEMENTS).collect()) == sorted(df.collect())


def test_row_steps(spark):
    df = log(spark, [("a", 0, "0")])
    assert without_label(with_label(df)).columns == df.columns
    assert with_label(df).first().label == 0
    nested = df.select(F.struct("user_id", "event_id").alias("s"), "invited")
    assert expand_struct(nested, "s").columns == ["user_id", "event_id", "invited"]
    holes = df.withColumn("user_id", F.lit(None).cast("string"))
    assert null_fill(holes).first().user_id == ""
    assert distinct_in_window(df.union(df)).count() == 1
