"""A quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Words are runs of letters and digits, and runs of other signs. Their n-grams
are hashed into a fixed number of features; a document is a sparse vector of
unit length, the square roots of its features' shares. An n-gram that repeats
one word is also hashed as such, whatever the word. Training walks a bounded
sample of labelled documents; a score is a sparse dot product with the weights.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from clicksieve.llm.common import saved, unused

BITS = 18
GRAMS = (1, 2)
BIAS = 1 << BITS
PIECE = 1 << 20  # bytes of a text that are hashed at once; a word is never cut

# Training: bounds of the sample, and its settings.
TRAIN_DOCS = 8000
TRAIN_FEATURES = 1 << 24
EPOCHS = 8
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1e-4, 1e-3
SEED = 13
GOOD = 0.7

# Classes of bytes: blanks, letters and digits (all of what is not ASCII too), other signs.
CLASSES = np.full(256, 2, dtype=np.int8)
CLASSES[:0x21] = 0
CLASSES[0x30:0x3A] = CLASSES[0x41:0x5B] = CLASSES[0x61:0x7B] = 1
CLASSES[0x7F] = 0
CLASSES[0x80:] = 1

GOLDEN = 0x9E3779B97F4A7C15
REPEAT = 0xD6E8FEB86659FD93


def mixed(x):
    """Each 64-bit number with its bits spread over all 64."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def pieces(data):
    """A text's bytes in pieces that end at a blank, of about ``PIECE`` bytes where there are blanks."""
    start = 0
    while start < len(data):
        end = start + PIECE
        while end < len(data) and CLASSES[data[end]]:
            end += 1
        yield data[start:end]
        start = end


def words_hashed(data):
    """A hash per word: the sum of what its bytes and their places in it are mixed to."""
    byte = np.frombuffer(data, dtype=np.uint8)
    kind = CLASSES[byte]
    edges = np.flatnonzero(np.diff(kind, prepend=0, append=0))
    starts, ends = edges[:-1], edges[1:]
    words = kind[starts] > 0
    starts, ends = starts[words], ends[words]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    place = np.arange(len(byte), dtype=np.uint64)
    place[starts[0] :] -= np.repeat(starts, np.diff(starts, append=len(byte))).astype(np.uint64)
    signs = mixed(byte.astype(np.uint64) * np.uint64(GOLDEN) + place)
    signs[kind == 0] = 0
    return mixed(np.add.reduceat(signs, starts) + (ends - starts).astype(np.uint64))


def terms(text, bits=BITS):
    """The numbers of a text's n-grams, each as often as it occurs."""
    found, last = [], np.zeros(0, dtype=np.uint64)
    for piece in pieces((text or "").encode("utf-8", "surrogatepass")):
        words = np.concatenate([last, words_hashed(piece)])
        fresh = words[len(last) :]
        grams = [fresh]
        # What begins in the piece before ends in this one.
        for n in GRAMS[1:]:
            runs = np.lib.stride_tricks.sliding_window_view(words[max(0, len(last) - n + 1) :], n) if len(words) >= n else words[:0].reshape(0, n)
            hashed = runs[:, 0]
            for j in range(1, n):
                hashed = mixed(hashed * np.uint64(GOLDEN) + runs[:, j])
            repeats = (runs == runs[:, :1]).all(axis=1).sum()
            grams += [hashed, np.full(repeats, REPEAT + n, dtype=np.uint64)]
        last = words[len(words) - min(len(words), max(GRAMS) - 1) :]
        found += [(mixed(g) >> np.uint64(64 - bits)).astype(np.int64) for g in grams]
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def features(text, bits=BITS):
    """``(numbers, values)`` of a text: its distinct features, as a vector of unit length, and the bias."""
    numbers, counts = np.unique(terms(text, bits), return_counts=True)
    values = np.sqrt(counts / max(1, counts.sum()))
    return np.append(numbers, 1 << bits), np.append(values, 1.0)


class Ftrl:
    """Weights by follow-the-regularised-leader (proximal): per feature a sum of corrected slopes, and one of their squares."""

    def __init__(self, bits=BITS, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
        self.slopes, self.squares = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, numbers=slice(None)):
        slopes = self.slopes[numbers]
        shrunk = np.sign(slopes) * np.maximum(np.abs(slopes) - self.l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(self.squares[numbers])) / self.alpha + self.l2)

    def update(self, numbers, values, label):
        """One document; its features are distinct."""
        weights = self.weights(numbers)
        slope = (sigmoid(weights @ values) - label) * values
        before = self.squares[numbers]
        after = before + slope * slope
        self.slopes[numbers] += slope - (np.sqrt(after) - np.sqrt(before)) / self.alpha * weights
        self.squares[numbers] = after


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


def fit(sample, bits=BITS, epochs=EPOCHS, seed=SEED):
    """Weights from ``(numbers, values, label)`` of documents, in a drawn order each time; ``None`` without any."""
    if not sample:
        return None
    model, draw = Ftrl(bits), np.random.default_rng(seed)
    for _ in range(epochs):
        for at in draw.permutation(len(sample)):
            model.update(*sample[at])
    return model.weights()


def score(weights, text):
    """The chance that a text is labelled good, from 0 to 1; one half where nothing was learned."""
    if weights is None:
        return 0.5
    numbers, values = features(text, (len(weights) - 1).bit_length() - 1)
    return round(float(sigmoid(weights[numbers] @ values)), 6)


def held_out():
    """Whether a document is kept from training: the remainder of its id's checksum (null id: not held out)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _share(*key):
    """A number from 0 to 1 that a row's key decides."""
    return F.pmod(F.xxhash64(F.lit("quality"), *key), F.lit(1_000_000)) / F.lit(1_000_000.0)


def sample_features(docs, labels, train_docs=TRAIN_DOCS, train_features=TRAIN_FEATURES, name="quality"):
    """``(numbers, values, label)`` of about ``train_docs`` labelled documents that are not held out.

    An id's label is what most of its rows in ``labels`` say (none if they are
    even); of a repeated id the smallest text counts. Documents are chosen by a
    hash of the id, and thinned by it again if together they had more than
    ``train_features`` distinct features each.
    """
    spark = docs.sparkSession
    votes = labels.where(F.col("doc_id").isNotNull() & F.col(name).isin(0, 1)).where(~held_out())
    votes = votes.groupBy("doc_id").agg(F.avg(F.col(name).cast("double")).alias("vote")).where("vote <> 0.5")
    total = votes.count()
    chosen = votes.where(_share("doc_id") < min(1.0, train_docs / max(1, total)))
    chosen = chosen.select("doc_id", (F.col("vote") > 0.5).cast("int").alias("label"))
    # About train_docs rows, whatever the tables' size.
    texts = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(frames):
        for frame in frames:
            rows = [features(text) for text in frame["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "label": frame["label"],
                    "size": [len(n) for n, _ in rows],
                    "numbers": [n.astype(np.int32).tobytes() for n, _ in rows],
                    "parts": [v.tobytes() for _, v in rows],
                }
            )

    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    made = texts.mapInPandas(run, f"doc_id {id_type}, label int, size long, numbers binary, parts binary")
    made = saved(made, "quality-sample")
    size = made.agg(F.sum("size")).first()[0] or 0
    rows = made.where(_share(F.lit("thin"), "doc_id") < min(1.0, train_features / max(1, size))).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return [(np.frombuffer(r["numbers"], dtype=np.int32), np.frombuffer(r["parts"]), r["label"]) for r in rows]


def train(docs, labels, train_docs=TRAIN_DOCS, train_features=TRAIN_FEATURES):
    """Weights fitted on a bounded sample, or ``None`` if no document has a label."""
    return fit(sample_features(docs, labels, train_docs, train_features))


def scores(spark, text, weights):
    """The score of a text column."""
    shipped = spark.sparkContext.broadcast(weights)

    def run(texts):
        return pd.Series([score(shipped.value, text) for text in texts], dtype="float64")

    return F.pandas_udf(lambda texts: run(texts), "double")(text)


def classify(docs, labels=None, weights=None, good=GOOD):
    """One row per document: ``doc_id, held_out, score, predicted``.

    Without weights they are trained on ``labels`` (``doc_id, quality``) of
    documents that are not held out; labels other than 0 and 1, and labels of
    no document, teach nothing, and without any every score is one half.
    ``predicted`` is 1 from a score of ``good``. Null and empty texts are scored
    by the bias alone. Scores read the text only, so repeated rows agree; an
    empty table gives an empty one. Other columns are not read.
    """
    weights = train(docs, labels) if weights is None else weights
    made = docs.select("doc_id", held_out().alias("held_out"), scores(docs.sparkSession, F.col("text"), weights).alias("score"))
    return made.withColumn("predicted", (F.col("score") >= good).cast("int"))


def filter_quality(docs, labels=None, weights=None, least=GOOD):
    """The documents, with their columns, that score ``least`` or more."""
    weights = train(docs, labels) if weights is None else weights
    name = unused("quality_score", docs.columns)
    rows = docs.withColumn(name, scores(docs.sparkSession, docs["text"], weights))
    return rows.where(F.col(name) >= least).drop(name)
