import itertools

import pytest
from cases import clashing, documents, empty, prose, rows_of, words

from clicksieve.llm import mixing
from clicksieve.llm.common import table


def test_targets_share_the_excess_again():
    found = mixing.targets({"a": 100, "b": 1000, None: 900})
    assert found["a"] == 200 and sum(found.values()) == pytest.approx(3000)
    assert found["b"] == 1866.6666666666665 or found["b"] == pytest.approx(2800 * 2 / 3)
    assert all(found[s] <= 2 * n for s, n in {"a": 100, "b": 1000, None: 900}.items())
    assert mixing.targets({"a": 0}) == {"a": 0}
    assert mixing.targets({}) == {}


def test_flow_is_cheapest_by_brute_force():
    patterns = {("a",): 3, ("a", "b"): 4, ("b",): 2}
    quotas = {"a": 5, "b": 6}
    found = mixing.route(patterns, quotas)
    cost = lambda flow: sum(max(0, f - patterns[p]) for p, f in flow.items())

    def feasible(flow):
        shared = flow[("a", "b")]
        return any(flow[("a",)] + x <= 5 and flow[("b",)] + shared - x <= 6 for x in range(shared + 1))

    every = [dict(zip(patterns, f)) for f in itertools.product(*[range(2 * n + 1) for n in patterns.values()])]
    every = [f for f in every if feasible(f)]
    most = max(sum(f.values()) for f in every)
    assert sum(found.values()) == most == 11
    assert cost(found) == min(cost(f) for f in every if sum(f.values()) == most)


def test_sources_come_near_their_targets(spark, data):
    docs = table(spark, data("0.01"), "documents")
    rows = mixing.mix(docs).withColumn("source", mixing.F.col("pattern")[0]).collect()
    sizes = {r["doc_id"]: r["size"] for r in rows}
    assert sizes == {r["doc_id"]: len(words(r["text"])) for r in docs.collect()}
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert sum(r["taken"] for r in own) == pytest.approx(own[0]["target"], rel=0.05)
        assert own[0]["target"] == pytest.approx(mixing.targets({s: sum(r["size"] for r in rows if r["source"] == s) for s in {r["source"] for r in rows}})[source])
    assert all(r["taken"] <= 2 * r["size"] for r in rows)


def test_overlapping_sources(spark):
    rows = [(i, prose(i, 50), [["a"], ["b"], ["a", "b"], ["b", "a"]][i % 4]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    found = mixing.mix(docs).groupBy("pattern").sum("taken", "size").collect()
    assert {tuple(r["pattern"]) for r in found} == {("a",), ("b",), ("a", "b")}
    assert sum(r["sum(taken)"] for r in found) == pytest.approx(1.5 * 20_000, rel=0.02)


def test_awkward_rows_and_reruns(spark):
    found = rows_of(mixing.mix(documents(spark)))
    assert found == rows_of(mixing.mix(documents(spark).repartition(7)))
    assert found == rows_of(mixing.mix(clashing(spark)))
    assert len(found) == documents(spark).count()
    assert mixing.mix(empty(spark)).count() == 0
    taken = mixing.mixed_documents(clashing(spark))
    assert taken.columns == clashing(spark).columns
    assert taken.count() == mixing.mix(documents(spark)).agg({"copies": "sum"}).first()[0]


def in_order(units, wanted):
    """What is taken of ``(draw, size)``: in the order of draws without sign each that fits, then the smallest if it comes nearer."""
    order = sorted(units, key=lambda u: u[0] % 2**64)
    taken, gap = set(), wanted
    for draw, size in order:
        if 0 < size <= gap:
            taken.add(draw)
            gap -= size
    left = [(size, draw) for draw, size in order if size and draw not in taken and size < 2 * gap]
    return taken | ({min(left)[1]} if left else set())


@pytest.mark.parametrize("ahead", [256, 3])
def test_a_unit_that_does_not_fit_is_passed_over(spark, monkeypatch, ahead):
    """Sources of small texts and a text of a third of all words, which stands before, at and behind the boundary."""
    import random

    monkeypatch.setattr(mixing, "AHEAD", ahead, raising=False)
    draw = random.Random(3)
    plan, rows = {}, []
    for number, (share, long_at) in enumerate([(0.5, 0.3), (0.25, 0.1), (0.8, 0.75), (0.02, 0.0), (0.97, 0.99)]):
        sizes = [draw.randint(1, 100) for _ in range(1500)]
        units = [(draw.getrandbits(64) - 2**63, size) for size in sizes]
        units.append((int(long_at * 2**64) - (2**64 if long_at >= 0.5 else 0), sum(sizes) // 2))
        words = sum(size for _, size in units)
        plan[(f"s{number}",)] = (words, int(share * words))
        rows += [([f"s{number}"], size, d) for d, size in units]
    sized = spark.createDataFrame(rows, "pattern array<string>, size long, draw long")
    found = mixing.choose_copies(sized, plan)(sized).collect()
    for pattern, (words, wanted) in plan.items():
        own = [r for r in found if tuple(r["pattern"]) == pattern]
        assert len(own) == 1501
        if pattern not in (("s2",), ("s4",)):  # there the small texts alone are less than what is wanted
            assert {r["draw"] for r in own if r["copies"]} == in_order([(r["draw"], r["size"]) for r in own], wanted)
        assert abs(sum(r["size"] * r["copies"] for r in own) - wanted) <= 0.001 * wanted


def test_several_long_texts_that_small_ones_cannot_stand_in_for(spark):
    rows = [(["a"], 10, (i * 2654435761 % 2**32) << 31) for i in range(1000)] + [(["a"], 5000, 2**62 + i) for i in range(2)]
    sized = spark.createDataFrame(rows, "pattern array<string>, size long, draw long")
    found = mixing.choose_copies(sized, {("a",): (20_000, 18_000)})(sized).collect()
    assert sum(r["size"] * r["copies"] for r in found) == 18_000


def test_a_long_text_does_not_keep_a_source_from_its_target(spark):
    rows = [(i, prose(i, 50), "a") for i in range(400)] + [(400 + i, prose(9000 + i, 10_000), f"b{i}") for i in range(6)]
    rows += [(1000 + 100 * i + j, prose(20_000 + 100 * i + j, 100), f"b{i}") for i in range(6) for j in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(docs).groupBy("pattern").agg({"taken": "sum", "target": "max"}).collect()
    assert all(r["sum(taken)"] == pytest.approx(r["max(target)"], abs=51) for r in found)


def test_sources_that_share_nothing_are_routed_apart():
    patterns = {("a",): 3, ("a", "b"): 4, ("b",): 2, ("c", "d"): 5, ("e",): 6, (None,): 3}
    quotas = {"a": 5, "b": 6, "c": 4, "d": 3, "e": 7, None: 20}
    found = mixing.route(patterns, quotas)
    assert list(found) == list(patterns)
    assert found[("a",)] + found[("a", "b")] + found[("b",)] == 11
    assert (found[("c", "d")], found[("e",)], found[(None,)]) == (7, 7, 6)
    import time

    began = time.monotonic()
    many = {(f"s{i}",): 1000 + i for i in range(20_000)}
    assert sum(mixing.route(many, {s: 1500 for (s,) in many}).values()) == 20_000 * 1500
    assert time.monotonic() - began < 30


def test_what_the_driver_worked_out_needs_no_python_worker(spark):
    rows = [(["a", None], mixing.LEAST), (["b"], mixing.MOST)]
    frame = mixing._plan_frame(spark, rows, "start")
    assert frame.dtypes == [("pattern", "array<string>"), ("start", "bigint")]
    assert sorted(map(tuple, frame.collect()), key=lambda r: r[1]) == rows
    assert "LocalRelation" in frame._jdf.queryExecution().optimizedPlan().toString()
    nothing = mixing._plan_frame(spark, [], "start")
    assert nothing.dtypes == frame.dtypes and nothing.count() == 0
