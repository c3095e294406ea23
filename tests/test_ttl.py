import random

import pytest
from pyspark.sql import functions as F

from clicksieve.operators import clicks, first_per_key_ttl
from clicksieve.operators.negatives import labelled_rows
from clicksieve.record import EVENT_TIME
from clicksieve.sources import events_log, events_parquet
from helpers import chain, log, users_seconds

CHAINS = {
    30: [([0], [0]), ([0, 29], [0]), ([0, 30], [0, 30]), ([0, 0, 0], [0])],
    10: [([5, 12, 16], [5, 16])],
}


@pytest.mark.parametrize("ttl", CHAINS)
@pytest.mark.parametrize("partitions", [1, 7])
def test_chain_cases(spark, ttl, partitions):
    cases = {f"case {n}": case for n, case in enumerate(CHAINS[ttl])}
    df = log(spark, [(user, t, "0") for user, (times, _) in cases.items() for t in times])
    out = first_per_key_ttl(df, ttl=f"{ttl} seconds", partitions=partitions)
    assert out.columns == df.columns
    assert users_seconds(out) == [(user, float(t)) for user, (_, kept) in cases.items() for t in kept]


def brute(rows, ttl):
    times = {}
    for user, second, _ in rows:
        times.setdefault(user, []).append(second)
    return sorted((user, float(t)) for user, ts in times.items() for t in chain(ts, ttl))


@pytest.mark.parametrize("partitions", [1, 6, 150])
@pytest.mark.parametrize("span, ttl", [(2_000, 30), (600, 1), (900, 400)])
def test_against_brute_force(spark, partitions, span, ttl):
    """A third of all rows belongs to one user; ranges hold many users, or pieces of one."""
    random.seed(span + ttl)
    rows = [("hot" if n % 3 == 0 else f"u{random.randrange(15)}", random.randrange(-span, span), "0") for n in range(1_500)]
    out = first_per_key_ttl(log(spark, rows), ttl=f"{ttl} seconds", partitions=partitions)
    assert users_seconds(out) == brute(rows, ttl)


def test_even_spacing_never_merges_chains(spark):
    rows = [("a", t, "0") for t in range(0, 3_000)]
    out = first_per_key_ttl(log(spark, rows), ttl="30 seconds", partitions=20)
    assert users_seconds(out) == [("a", float(t)) for t in range(0, 3_000, 30)]


def test_quiet_segments_pass_the_entry_time_on(spark):
    # 480 s segments: the row at 470 hides 485 although 485 opens its own segment.
    base = 1_000_000 - (1_000_000 % 480)
    rows = [("a", t, "0") for t in (0, 470, 485, 501, 5_000)]
    from datetime import datetime, timedelta, timezone

    start = datetime.fromtimestamp(base, timezone.utc)
    for partitions in (1, 4):
        out = first_per_key_ttl(log(spark, rows, start), ttl="30 seconds", partitions=partitions)
        assert users_seconds(out) == [("a", 0.0), ("a", 470.0), ("a", 501.0), ("a", 5_000.0)]


def test_ties_keep_the_smallest_event_id(spark):
    df = log(spark, [("a", 0, "0")] * 5).withColumn("event_id", F.concat(F.lit("e"), 9 - F.col("event_id").cast("int")))
    for partitions in (1, 4):
        assert [r.event_id for r in first_per_key_ttl(df, partitions=partitions).collect()] == ["e5"]


def test_several_keys(spark):
    df = log(spark, [("a", 0, "0"), ("a", 1, "1"), ("a", 2, "0"), ("b", 2, "0")])
    for partitions in (1, 4):
        out = first_per_key_ttl(df, ["user_id", "interested"], partitions=partitions)
        assert users_seconds(out) == [("a", 0.0), ("a", 1.0), ("b", 2.0)]


def test_a_hot_instant_spreads(spark):
    """Most rows are of one user and instant, many of them equal; the first of each chain is the smallest."""
    df = log(spark, [("a", 0, "0")] * 900 + [("a", 30, "0")] * 300 + [("b", 0, "1")])
    df = df.unionByName(df)
    out = first_per_key_ttl(df, partitions=8)
    assert sorted((r.user_id, r.event_id) for r in out.collect()) == [("a", "000000"), ("a", "000900"), ("b", "001200")]


def test_columns_without_an_order(spark):
    df = log(spark, [("a", t, "0") for t in (0, 0, 10, 40)]).withColumn("tags", F.create_map(F.lit("n"), "event_id"))
    out = first_per_key_ttl(df, partitions=3)
    assert sorted((r.event_id, r.tags["n"]) for r in out.collect()) == [("000000", "000000"), ("000003", "000003")]


def test_ranges_dealt_twice_are_noticed(spark):
    df = log(spark, [("a", t, "0") for t in range(2_000)])
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        rows = users_seconds(first_per_key_ttl(df, partitions=5))
    except Exception as error:  # noqa: BLE001
        assert "dealt twice" in str(error)
    else:
        assert rows == [("a", float(t)) for t in range(0, 2_000, 30)]
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


@pytest.mark.parametrize("partitions", [None, 60])
def test_known_counts_on_events(spark, data, partitions):
    log_rows = events_log(spark, data("0.001"))
    exact = events_parquet(spark, data("0.001")).select(
        F.col("event_id").cast("string").alias("event_id"), F.col("ts").cast("timestamp").alias("at")
    )
    exact = log_rows.join(exact, "event_id")
    out = first_per_key_ttl(clicks(exact), ttl="6 hours", ts="at", partitions=partitions)
    row = out.agg(F.count("*").alias("n"), F.sum(F.col("event_id").cast("long")).alias("s")).first()
    assert (row.n, row.s) == (190, 97755)


def test_one_scan_and_one_shuffle_in_order(spark, data):
    df = first_per_key_ttl(labelled_rows(events_log(spark, data("0.001"))), ttl="6 hours")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1
    assert plan.count("+- Exchange rangepartitioning") == 1 and "ReusedExchange" in plan


@pytest.mark.parametrize("partitions", [None, 1, 5])
def test_nulls_and_equal_ties_do_not_depend_on_size(spark, partitions):
    df = log(spark, [("a", 0, "0"), ("a", 0, "1"), ("a", 40, "0"), (None, 0, "0"), (None, 1, "0"), (None, 50, "1"), ("b", 0, "0"), ("b", 1, "0")])
    df = df.withColumn("event_id", F.when(F.col("user_id") == "a", F.lit(None)).otherwise(F.lit("same")))
    df = df.withColumn(EVENT_TIME, F.when((F.col("user_id") == "b") & (F.col("time_stamp") == "0"), None).otherwise(F.col(EVENT_TIME)))
    out = first_per_key_ttl(df, partitions=partitions)
    kept = sorted((str(r.user_id), r.time_stamp, r.interested, r.event_id) for r in out.collect())
    assert kept == [("None", "0", "0", "same"), ("None", "50", "1", "same"), ("a", "0", "0", None), ("a", "40", "0", None), ("b", "1", "0", "same")]
