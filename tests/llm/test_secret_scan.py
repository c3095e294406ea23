import random
import re
import time

from cases import clashing, documents, empty, rows_of

from clicksieve.llm import secret_scan
from clicksieve.llm.common import table

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def plain_base(text):
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    return found + [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 16]


def test_base_spans_are_those_of_the_plain_patterns():
    draw = random.Random(3)
    parts = ["password", "TOKEN", "api_key", "apiKEY", "=", ":", " ", '"', "'", "AKIA", "AKIA0123456789ABCD", "deadbeef", "0123456789abcdef", "x.y-z", "ſecret", "é"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))
        assert secret_scan.base_spans(text) == plain_base(text), text


def test_awkward_rows(spark):
    found = secret_scan.scan_secrets(documents(spark))
    assert found.count() == documents(spark).count()
    assert rows_of(found) == rows_of(secret_scan.scan_secrets(clashing(spark)))
    assert secret_scan.scan_secrets(empty(spark)).count() == 0


def test_random_strings_are_told_from_words(spark, data):
    docs = table(spark, data("0.001"), "documents")
    ratio, threshold = model = secret_scan.train(docs)
    # Of the kinds that the base patterns do not find anyway.
    secrets = [s for s in secret_scan.random_strings(500, seed=99) if not secret_scan.base_spans(s)]
    assert (secret_scan.ratio_scores(secrets, ratio) > threshold).mean() > 0.6
    clear = max(secrets, key=lambda s: secret_scan.ratio_scores([s], ratio)[0])
    rows = [(1, f"key {clear} end"), (2, "internationalization_of_everything here"), (3, None)]
    found = {r["doc_id"]: r["spans"] for r in secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert found == {1: f"random:4:{4 + len(clear)}", 2: "", 3: ""}


def test_runs_beside_spans_by_comparing_all():
    draw = random.Random(5)
    for _ in range(300):
        text = " ".join("x" * draw.randrange(1, 30) for _ in range(20))
        found = [("hex", a, a + draw.randrange(1, 40)) for a in (draw.randrange(len(text)) for _ in range(draw.randrange(6)))]
        every = [(m.start(), m.end()) for m in secret_scan.RUN.finditer(text)]
        expected = [r for r in every if not any(a < r[1] and r[0] < b for _, a, b in found)]
        assert secret_scan.runs_beside(text, found) == expected


def test_a_long_text_of_many_spans_takes_linear_time():
    text = "".join(f"token = {n:016x}{n:016x} and some_identifier_{n}_of_many\n" for n in range(20_000))
    start = time.perf_counter()
    found = secret_scan.base_spans(text)
    assert len(found) == 40_000 and len(secret_scan.runs_beside(text, found)) == 20_000
    assert time.perf_counter() - start < 10


def test_the_model_counts_every_document(spark):
    """More documents than a sample would hold: pair counts and threshold are those of all runs, taken one by one."""
    draw = random.Random(9)
    texts = [f"token={n:016x} {''.join(draw.choice('ghijklm_') for _ in range(draw.randint(16, 300)))}" for n in range(9000)]
    docs = spark.createDataFrame([*enumerate(texts), (9000, None), (9001, "")], "doc_id long, text string").repartition(7)
    ratio, threshold = secret_scan.train(docs, random_samples=90)
    secret, ordinary = (sum(some, []) for some in zip(*map(secret_scan.labelled_runs, texts)))
    assert len(secret) == 18_000 and len(ordinary) == 9000
    drawn = secret_scan.count_pairs(secret_scan.random_strings(90)) * (9001 / 90)
    plain = secret_scan.log_table(secret_scan.count_pairs(secret) + drawn) - secret_scan.log_table(secret_scan.count_pairs(ordinary))
    assert abs(ratio - plain).max() < 1e-9
    scores = secret_scan.ratio_scores(ordinary, ratio)
    assert threshold == 0.0 or (scores > threshold).sum() == 0 and scores.max() > threshold - 1 / secret_scan.SCORE_STEPS
