import hashlib
import random
import re

import pytest
from cases import clashing, documents, empty, rows_of

from clicksieve.llm import personal_data

KINDS = ["email", "ip", "card", "phone"]
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": True,
        "ip": kind != "ip" or all(int(p) <= 255 for p in value.split(".")),
        "card": 14 <= len(digits) <= 19 and luhn(digits),
        "phone": 10 <= len(digits) <= 15,
    }[kind]


def plain_base(text):
    found = [(m.start(), KINDS.index(k), m.end(), k) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if passes(k, m[0])]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def odd_texts():
    draw = random.Random(8)
    parts = [
        "a", "b.c", "@", "..", ".", "-", "_", "+", " ", "é", "\U0001f600", "x@y.z", "mail@host.example.com", "1", "12", "255", "256", "10.0.0.1",
        "1.2.3.4.5.6.7.8", "4539 1488 0343 6467", "4539148803436467", "4539-1488-0343-6468", "+1 (212) 555-0143", "(", ")", "\n", "0",
    ]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(1500)]
    return [*texts, None, "", "a@b" + ".c" * 20_000, "1." * 20_000, "x" * 50_000 + "@y.z", "7 " * 20_000, "+1" + "-" * 20_000]


def test_base_spans_are_those_of_the_plain_patterns(spark):
    texts = odd_texts()
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in personal_data.find_personal_data(rows).collect()}
    for number, text in enumerate(texts):
        expected = plain_base(text)
        assert found[number]["base_sha256"] == hashlib.sha256(expected.encode()).hexdigest(), (text or "")[:200]
        assert set(filter(None, expected.split(","))) <= set(found[number]["spans"].split(","))
        for kind in KINDS:
            assert found[number][f"n_{kind}"] == sum(s.startswith(kind) for s in expected.split(","))


def test_only_dataframe_functions(spark):
    plan = personal_data.mask_personal_data(documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_candidates_with_cues_are_added_and_quantities_are_not(spark):
    rows = [(i, f"call me at +1 (212) 555-{1000 + i} or write to p{i}@mail.example.com today") for i in range(200)]
    rows += [(1000 + i, f"my phone: (212) 555-{2000 + i}, ask for me") for i in range(50)]
    rows += [(2000 + i, f"order 2024-03-{10 + i % 20} page 1234567 of version 1 2 3 4 5 6 7 km") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["n_added"] for r in personal_data.find_personal_data(docs).collect()}
    assert all(found[1000 + i] == 1 for i in range(50))
    assert not any(found[2000 + i] for i in range(50))


def test_reliable_labelers_gain_weight():
    counts = {"+++0+": 500, "++00+": 300, "-0-0-": 900, "0-0-0": 400, "+-000": 3}
    likely = personal_data.expectation_maximisation(counts)
    assert likely["+++0+"] > 0.99 and likely["-0-0-"] < 0.01


def test_masks(spark):
    rows = [(1, "to a@b.co now", 13), (2, None, None), (3, "", 0), (4, "\U0001f600 10.0.0.1 and 10.0.0.2", 23)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in personal_data.mask_personal_data(docs).collect()}
    assert found == {1: ("to <email> now", 14), 2: (None, None), 3: ("", 0), 4: ("\U0001f600 <ip> and <ip>", 15)}


@pytest.mark.parametrize("find", [personal_data.find_personal_data, personal_data.mask_personal_data])
def test_awkward_rows(spark, find):
    assert find(documents(spark)).count() == documents(spark).count()
    assert find(empty(spark)).count() == 0
    shared = [c for c in find(documents(spark)).columns]
    assert rows_of(find(documents(spark))) == rows_of(find(clashing(spark)).select(*shared))
