import random

from cases import clashing, documents, empty, rows_of, words

from clicksieve.llm import quality


def plain_measures(text):
    own = words(text)
    runs = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    covered = {i + j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (
        len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
    )


def test_measures_are_the_plain_ones():
    draw = random.Random(1)
    for _ in range(1500):
        text = "".join(draw.choice(["a", "b", "é", " ", "\n", "\x0b", " ", "#", "a b c d e ", "\n\n"]) for _ in range(draw.randint(0, 40)))
        assert quality.measures_of(text) == plain_measures(text), text
    assert quality.measures_of(None) == (0, 0, 0, 0, 0)


def test_awkward_rows(spark):
    found = quality.judge(documents(spark))
    assert found.count() == documents(spark).count()
    assert rows_of(found) == rows_of(quality.judge(clashing(spark)))
    assert quality.judge(empty(spark)).count() == 0
    kept = quality.filter_quality(documents(spark))
    assert kept.columns == documents(spark).columns
    assert kept.count() == found.where("kept").count()


def test_thresholds_follow_each_group(spark):
    """Bars between all words are odd in prose, and ordinary in a source of tables."""
    from cases import prose

    rows = [(i, prose(i, 100), "en", "prose", 0) for i in range(300)]
    rows += [(1000 + i, prose(i, 100 + i % 40).replace(" ", " | "), "en", "tables", 0) for i in range(300)]
    rows += [(5000, prose(7, 100).replace(" ", " | "), "en", "prose", 0)]
    found = {r["doc_id"]: r["kept"] for r in quality.judge(documents(spark, rows)).collect()}
    assert not found[5000]
    assert all(kept for doc_id, kept in found.items() if doc_id < 5000)


def test_sketches_merge_by_addition(spark):
    from cases import prose

    docs = documents(spark, [(i, prose(i, 20 + i), "en", f"s{i % 3}", 0) for i in range(60)])
    rows = docs.select("doc_id", "lang", "source", quality.measured(docs["text"]).alias("m")).select("doc_id", "lang", "source", "m.*").cache()
    whole = {(r["measure"], r["bucket"]): r["rows"] for r in quality.sketches(rows).groupBy("measure", "bucket").agg({"rows": "sum"}).withColumnRenamed("sum(rows)", "rows").collect()}
    parts = {}
    for source in ("s0", "s1", "s2"):
        for r in quality.sketches(rows.where(rows["source"] == source)).collect():
            parts[r["measure"], r["bucket"]] = parts.get((r["measure"], r["bucket"]), 0) + r["rows"]
    assert whole == parts
