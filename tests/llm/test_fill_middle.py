import hashlib
import re
import time

import pytest
from cases import clashing, documents, empty, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clicksieve.llm import fill_middle

LINE = re.compile(r"[^\n]*\n|[^\n]+")


def draws_of(doc_id):
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def plain(text, draws):
    lines = LINE.findall(text)
    n = len(lines)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or draws[2] % 100 >= 100:
        return n, "plain", None, None, text
    a, b = sorted(d % (n + 1) for d in draws[:2])
    p, m, s = ["".join(part) for part in (lines[:a], lines[a:b], lines[b:])]
    if draws[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a\n<PSM>é\U0001f600\r ", max_size=60), st.lists(st.integers(0, 2**32 - 1), min_size=4, max_size=4), st.integers(1, 9))
def test_cuts_against_lines(text, draws, block):
    assert fill_middle.arrange(text, draws, block=block) == plain(text, draws)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=40))
def test_fenwick(counts):
    tree = fill_middle.Fenwick(counts)
    owners = [block for block, n in enumerate(counts) for _ in range(n)]
    assert [tree.before(i) for i in range(len(counts) + 1)] == [sum(counts[:i]) for i in range(len(counts) + 1)]
    for rank, block in enumerate(owners, 1):
        assert tree.descend(rank) == (block, rank - sum(counts[:block]))


def test_documents(spark, data):
    rows = spark.read.parquet(data("0.01") + "/documents.parquet")
    expected = set()
    for r in rows.collect():
        n, form, p, m, output = plain(r["text"], draws_of(r["doc_id"]))
        expected.add((r["doc_id"], n, form, p, m, sha(output), sha(r["text"])))
    assert {tuple(r) for r in fill_middle.digests(rows).collect()} == expected


MARKED = ["<P>", "a\n<S>\nb", "x<M>", "<<P\n>S>\nM>", "<\n<\n<", ">\n>S>\nP>\n", "\n", "\n\n\n", "one\r\ntwo\rthree\n", "a\x00b\nc"]


def test_awkward_rows(spark):
    rows = [(i, text, None, None, 0) for i, text in enumerate(MARKED * 3)] + [(None, "no id\nat all\n", None, None, 0)] * 2
    for docs in (documents(spark), documents(spark, rows)):
        found = fill_middle.digests(docs)
        expected = []
        for r in docs.collect():
            text = r["text"] or ""
            n, form, p, m, output = plain(text, draws_of(r["doc_id"]))
            expected.append(tuple(map(repr, (r["doc_id"], n, form, p, m, sha(output), sha(text)))))
        assert rows_of(found) == sorted(expected)
    assert rows_of(fill_middle.digests(clashing(spark))) == rows_of(fill_middle.digests(documents(spark)))
    assert fill_middle.digests(empty(spark)).count() == 0
    kept = fill_middle.transform(clashing(spark))
    assert kept.columns == [*clashing(spark).columns, "fim"] and rows_of(kept.drop("fim")) == rows_of(clashing(spark))


@pytest.mark.parametrize("rate, spm, forms", [(0, 50, {"plain"}), (100, 0, {"psm"}), (100, 100, {"spm"})])
def test_shares(spark, rate, spm, forms):
    docs = documents(spark, [(i, f"a{i}\nb\nc", None, None, 0) for i in range(50)])
    rows = fill_middle.transform(docs, rate, spm).select("text", "fim.*")
    assert {r["form"] for r in rows.collect()} == forms
    back = rows.select("text", fill_middle.restored(F.col("form"), F.col("output")).alias("back"))
    assert all(r["text"] == r["back"] for r in back.collect())


def test_a_long_text_takes_linear_time():
    text = "é\n" * 5_000_000
    start = time.perf_counter()
    n, form, p, m, output = fill_middle.arrange(text, [4_000_000, 1_000_001, 0, 0])
    assert (n, form, p, m) == (5_000_000, "spm", 2_000_002, 5_999_998) and len(output) == len(text) + 9
    assert time.perf_counter() - start < 20
