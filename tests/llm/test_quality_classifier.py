import math
import re
import zlib

import numpy as np
from cases import clashing, documents, empty, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from clicksieve.llm import quality_classifier as qc
from clicksieve.llm.common import table

MASK = 2**64 - 1
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+")
LABELS = "doc_id long, quality int, toxic int"


def mix(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> shift)) * factor) & MASK
    return x ^ (x >> 31)


def plain_features(text, bits=qc.BITS):
    """Features word by word, as a dictionary."""
    words = []
    for token in TOKEN.findall((text or "").encode("utf-8", "surrogatepass")):
        words.append(mix((sum(mix((b * qc.GOLDEN + i) & MASK) for i, b in enumerate(token)) + len(token)) & MASK))
    grams = list(words)
    for a, b in zip(words, words[1:]):
        grams.append(mix((a * qc.GOLDEN + b) & MASK))
        if a == b:
            grams.append(qc.REPEAT + 2)
    counts = {}
    for g in grams:
        number = mix(g) >> (64 - bits)
        counts[number] = counts.get(number, 0) + 1
    made = {n: math.sqrt(c / len(grams)) for n, c in counts.items()}
    made[1 << bits] = 1.0
    return made


def plain_weights(state):
    shrink = lambda z: math.copysign(max(0.0, abs(z) - qc.L1), z)
    return {k: -shrink(z) / ((qc.BETA + math.sqrt(n)) / qc.ALPHA + qc.L2) for k, (z, n) in state.items()}


def plain_fit(sample, epochs, seed):
    state, draw = {}, np.random.default_rng(seed)
    for _ in range(epochs):
        for at in draw.permutation(len(sample)):
            made, label = sample[at]
            own = plain_weights({k: state.get(k, (0.0, 0.0)) for k in made})
            error = 1 / (1 + math.exp(-sum(own[k] * x for k, x in made.items()))) - label
            for k, x in made.items():
                z, n = state.get(k, (0.0, 0.0))
                g = error * x
                state[k] = (z + g - (math.sqrt(n + g * g) - math.sqrt(n)) / qc.ALPHA * own[k], n + g * g)
    return plain_weights(state)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é\n#!\x00\x7f\U0001f600", max_size=80))
def test_features_against_plain_ones(text):
    numbers, values = qc.features(text)
    assert dict(zip(numbers.tolist(), values.tolist())) == {k: v for k, v in plain_features(text).items()}


def test_pieces_of_a_long_text_do_not_matter(monkeypatch):
    text = "one two two  three,, four " * 50 + "x" * 400 + " end end"
    whole = np.sort(qc.terms(text))
    for size in (1, 7, 64):
        monkeypatch.setattr(qc, "PIECE", size)
        assert np.array_equal(np.sort(qc.terms(text)), whole)


def test_training_against_plain_updates():
    texts = [("good words here and there", 1), ("bad### junk### here", 0), ("more good words", 1), ("junk junk junk", 0), ("", 1)]
    weights = qc.fit([(*qc.features(t), y) for t, y in texts], epochs=3, seed=5)
    expected = plain_fit([(plain_features(t), y) for t, y in texts], 3, 5)
    assert all(abs(weights[k] - w) < 1e-9 for k, w in expected.items())
    assert np.count_nonzero(weights) == sum(w != 0 for w in expected.values())
    for text in ("good junk", "", "words ### ###", None):
        dot = sum(expected.get(k, 0.0) * x for k, x in plain_features(text).items())
        assert abs(qc.score(weights, text) - 1 / (1 + math.exp(-dot))) < 1e-6


def test_held_out_accuracy(spark, data):
    docs, labels = table(spark, data("0.1"), "documents"), table(spark, data("0.1"), "labels")
    found = qc.classify(docs, labels)
    assert found.count() == docs.count()
    rows = found.join(labels, "doc_id").where("held_out").collect()
    good, bad = [[r["score"] for r in rows if r["quality"] == q] for q in (1, 0)]
    # The share of pairs that are in the right order.
    assert np.mean([np.mean((np.array(good) > b) + 0.5 * (np.array(good) == b)) for b in bad]) >= 0.98
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_nothing_is_learned_from_what_is_held_out(spark):
    rows = [(i, f"text number {i} word{i}", None, None, 0) for i in range(200)]
    labels = [(i, i % 2, 0) for i in range(200)]
    docs, votes = documents(spark, rows), spark.createDataFrame(labels, LABELS)
    sample = qc.sample_features(docs, votes)
    held = {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {r["doc_id"] for r in qc.classify(docs, votes).where("held_out").collect()} == held
    assert len(sample) == 200 - len(held)
    flipped = spark.createDataFrame([(i, 1 - q if i in held else q, 0) for i, q, _ in labels], LABELS)
    assert rows_of(qc.classify(docs, votes)) == rows_of(qc.classify(docs, flipped))


def test_bounds_of_the_sample(spark):
    docs = documents(spark, [(i, "word " * (i + 1), None, None, 0) for i in range(400)])
    votes = spark.createDataFrame([(i, i % 2, 0) for i in range(400)], LABELS)
    assert 20 < len(qc.sample_features(docs, votes, train_docs=50)) < 100
    assert len(qc.sample_features(docs, votes, train_features=200)) < 150


def test_awkward_rows(spark):
    labels = [(5, 1, 0), (5, 1, 0), (6, 0, 0), (7, None, 0), (None, 1, 0), (8, 3, 0), (9, 1, 0), (9, 0, 0), (4, 1, 0), (13, 0, 1), (999, 1, 1)]
    votes = spark.createDataFrame(labels, LABELS)
    docs = documents(spark)
    found = qc.classify(docs, votes)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    assert found.count() == docs.count()
    assert rows_of(found) == rows_of(qc.classify(clashing(spark), votes))
    blank = {r["score"] for r in found.where("doc_id in (0, 1, 2)").collect()}
    assert len(blank) == 1 and 0 < blank.pop() < 1
    assert qc.classify(empty(spark), votes).count() == 0
    none = spark.createDataFrame([], LABELS)
    assert {(r["score"], r["predicted"]) for r in qc.classify(docs, none).collect()} == {(0.5, 0)}
    kept = qc.filter_quality(clashing(spark), votes, least=0.0)
    assert kept.columns == clashing(spark).columns and kept.count() == docs.count()
