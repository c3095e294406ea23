"""Loads merged into few files: the same rows before, during and after, whatever is repeated or lost."""

import glob
import threading
import uuid

import pytest

from clicksieve.sinks import compact_loads, compaction, create_sample_table, current_rows, drop_merged_loads, evolve_and_append, evolve_columns
from clicksieve.sources import column_names
from helpers import log


@pytest.fixture
def table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    create_sample_table(spark, name, path=str(tmp_path / "table"), batch_column="load_id")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


DAY = 86_400


def load(spark, table, name, users, seconds=0):
    rows = log(spark, [(u, seconds + n, "0") for n, u in enumerate(users)])
    evolve_and_append(rows, table, batch_column="load_id", batch_id=name)


def users(spark, table):
    return sorted(r.user_id for r in current_rows(spark, table).collect())


def five_loads(spark, table):
    for n in range(5):
        load(spark, table, f"s-{n}", [f"u{n}a", f"u{n}b"])
    return sorted(f"u{n}{x}" for n in range(5) for x in "ab")


def test_a_merge_keeps_the_rows(spark, table, tmp_path):
    expected = five_loads(spark, table)
    load(spark, table, "s-2", ["other day"], DAY)
    expected = sorted([u for u in expected if not u.startswith("u2")] + ["other day"])
    target = compact_loads(spark, table)
    assert users(spark, table) == expected
    # The latest micro-batch may still be repeated, and a single load of a day has nothing to merge with.
    assert compaction.current_loads(spark, table)[0] == {(target, "20190307"), ("s-4", "20190307"), ("s-2", "20190308")}
    assert compact_loads(spark, table) is None
    assert drop_merged_loads(spark, table) == 0
    assert drop_merged_loads(spark, table, keep=None) == 3
    assert users(spark, table) == expected == sorted(r.user_id for r in spark.table(table).collect())
    assert not glob.glob(str(tmp_path / "table" / "load_id=s-0" / "pt_d=*" / "*"))
    assert len(glob.glob(str(tmp_path / "table" / f"load_id={target}" / "pt_d=20190307" / "*.parquet"))) == 1


def test_a_merged_load_that_is_written_again_counts_once(spark, table):
    expected = five_loads(spark, table)
    compact_loads(spark, table)
    load(spark, table, "s-1", ["u1a", "u1b"])
    assert users(spark, table) == expected
    drop_merged_loads(spark, table, keep=None)
    load(spark, table, "s-1", ["u1a", "u1b"])
    assert users(spark, table) == expected
    assert compact_loads(spark, table) is None


def test_merges_of_merges(spark, table):
    expected = five_loads(spark, table)
    first = compact_loads(spark, table)
    for n in range(5, 9):
        load(spark, table, f"s-{n}", [f"u{n}"])
    second = compact_loads(spark, table)
    assert first != second
    assert users(spark, table) == sorted(expected + [f"u{n}" for n in range(5, 9)])
    assert drop_merged_loads(spark, table, keep=None) == 9
    assert users(spark, table) == sorted(expected + [f"u{n}" for n in range(5, 9)])
    assert len(compaction.partitions(spark, table)) == 2


def test_a_merge_lost_before_its_commit_changes_nothing(spark, table, monkeypatch):
    expected = five_loads(spark, table)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(compaction, "move_folder", lost)
        with pytest.raises(OSError):
            compact_loads(spark, table)
    assert users(spark, table) == expected
    assert compact_loads(spark, table)
    assert users(spark, table) == expected


def test_the_second_of_two_merges_gives_up(spark, table, monkeypatch):
    expected = five_loads(spark, table)
    move, within = compaction.move_folder, []

    def beaten(spark_, source, target):
        if not within:
            within.append(1)
            load(spark, table, "t-0", ["late"])
            load(spark, table, "t-1", ["later"])
            assert compact_loads(spark, table)
        return move(spark_, source, target)

    monkeypatch.setattr(compaction, "move_folder", beaten)
    with pytest.raises(RuntimeError, match="meanwhile"):
        compact_loads(spark, table)
    assert users(spark, table) == sorted([*expected, "late", "later"])


def test_readers_prune_hidden_loads(spark, table):
    five_loads(spark, table)
    compact_loads(spark, table)
    plan = current_rows(spark, table)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "load_id" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_other_columns_and_days(spark, table):
    load(spark, table, "s-0", ["a"])
    df = spark.createDataFrame([("b", "x", "20190307"), ("c", "y", None)], "user_id string, f1 string, pt_d string")
    evolve_and_append(df, table, batch_column="load_id", batch_id="s-1")
    load(spark, table, "s-2", ["d"], DAY)
    load(spark, table, "s-3", ["e"], DAY)
    load(spark, table, "s-4", ["f"], DAY)
    before = sorted(map(str, current_rows(spark, table).drop("load_id").collect()))
    assert compact_loads(spark, table, days=["20190307"])
    assert sorted(map(str, current_rows(spark, table).drop("load_id").collect())) == before
    assert compact_loads(spark, table, days=["20190307"]) is None
    assert compact_loads(spark, table)
    assert sorted(map(str, current_rows(spark, table).drop("load_id").collect())) == before


def test_writers_add_columns_at_a_time(spark, table):
    """Four threads add the same column and one of their own, over and over."""
    errors = []

    def add(number):
        try:
            for step in range(4):
                evolve_columns(spark, table, [f"shared{step}", f"own{number}"])
                row = spark.createDataFrame([(f"u{number}", "v", "20190307")], f"user_id string, own{number} string, pt_d string")
                evolve_and_append(row, table, batch_column="load_id", batch_id=f"w{number}-{step}")
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=add, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    names = column_names(spark, table)
    assert {f"shared{n}" for n in range(4)} | {f"own{n}" for n in range(4)} <= set(names)
    assert len(names) == len(set(names))
    assert spark.table(table).count() == 16
    assert {r[0] for r in spark.table(table).select("own2").distinct().collect()} == {None, "v"}
