"""Language identification by a convolutional network over bytes.

Filters of several widths slide over windows of fixed length; each filter's
greatest response in the window feeds a softmax over the languages. The network
is trained here, with numpy, on labelled windows. Over single bytes a filter of
width w is a sum of w table look-ups, so applying it is a few gathers per byte.
A document's windows are all scored, and its prediction is their mean.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from clicksieve.llm.common import free_worker, unused

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
STRIDE = WINDOW - max(WIDTHS) + 1  # every run of bytes a filter can see lies in some window
WINDOWS_AT_ONCE = 256
PAD = 0x20
UNKNOWN = "und"

# Training: bounds of the sample, and its settings.
DOCS_PER_LANGUAGE = 400
WINDOWS_PER_DOC = 2
MOST_LANGUAGES = 400
EPOCHS = 12
BATCH = 64
RATE = 0.02
SEED = 11


def windows_of(text):
    """All windows of a text, the last one filled up with blanks."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    count = max(1, -(-(len(data) - WINDOW) // STRIDE) + 1)
    padded = np.full((count - 1) * STRIDE + WINDOW, PAD, dtype=np.uint8)
    padded[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]


class Network:
    """Tables of the filters by width, and the softmax layer on their greatest responses."""

    def __init__(self, languages, seed=SEED):
        draw = np.random.default_rng(seed)
        self.languages = languages
        self.filters = [draw.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros((len(WIDTHS), FILTERS), dtype=np.float32)
        self.out = draw.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.shift = np.zeros(len(languages), dtype=np.float32)

    def responses(self, windows, table):
        """Each filter's response at each place."""
        width = len(table)
        places = windows.shape[1] - width + 1
        total = np.take(table[0], windows[:, :places], axis=0)
        for j in range(1, width):
            total += np.take(table[j], windows[:, j : j + places], axis=0)
        return total

    def pooled(self, windows):
        return np.concatenate(
            [np.maximum(self.responses(windows, t).max(axis=1) + b, 0) for t, b in zip(self.filters, self.bias)], axis=1
        )

    def probabilities(self, windows):
        """One row per window; windows are scored in batches of bounded size."""
        parts = []
        for start in range(0, len(windows), WINDOWS_AT_ONCE):
            scores = self.pooled(windows[start : start + WINDOWS_AT_ONCE]) @ self.out + self.shift
            scores = np.exp((scores - scores.max(axis=1, keepdims=True)).astype(np.float64))
            parts.append(scores / scores.sum(axis=1, keepdims=True))
        return np.concatenate(parts)

    def train(self, windows, labels, epochs=EPOCHS, seed=SEED):
        """Stochastic gradient descent with Adam; only the place of a filter's greatest response has a gradient."""
        draw = np.random.default_rng(seed)
        moments, step = {}, 0

        def move(name, value, slope):
            first, second = moments.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
            first *= 0.9
            first += 0.1 * slope
            second *= 0.999
            second += 0.001 * slope * slope
            value -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)

        for _ in range(epochs):
            order = draw.permutation(len(windows))
            for start in range(0, len(order), BATCH):
                step += 1
                some, wanted = windows[order[start : start + BATCH]], labels[order[start : start + BATCH]]
                tops, places = [], []
                for table, bias in zip(self.filters, self.bias):
                    response = self.responses(some, table)
                    place = response.argmax(axis=1)
                    places.append(place)
                    tops.append(np.take_along_axis(response, place[:, None, :], axis=1)[:, 0] + bias)
                pooled = np.maximum(np.concatenate(tops, axis=1), 0)
                scores = pooled @ self.out + self.shift
                error = np.exp(scores - scores.max(axis=1, keepdims=True))
                error /= error.sum(axis=1, keepdims=True)
                error[np.arange(len(some)), wanted] -= 1
                error /= len(some)
                back = (error @ self.out.T) * (pooled > 0)
                move("out", self.out, pooled.T @ error)
                move("shift", self.shift, error.sum(axis=0))
                for number, (table, place) in enumerate(zip(self.filters, places)):
                    own = back[:, number * FILTERS : (number + 1) * FILTERS]
                    slope = np.zeros_like(table)
                    for j in range(len(table)):
                        seen = np.take_along_axis(some, place + j, axis=1)
                        np.add.at(slope[j], (seen, np.arange(FILTERS)[None, :]), own)
                    move(("filter", number), table, slope)
                    move(("bias", number), self.bias[number], own.sum(axis=0))
        return self


def sample_windows(docs, docs_per_language=DOCS_PER_LANGUAGE):
    """``(windows, labels, languages)`` of about ``docs_per_language`` documents a language, at most twice as many.

    Documents are chosen by a hash of their id and text, and of each its first
    window and one in the middle.
    """
    labelled = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    if not counts:
        return np.zeros((0, WINDOW), dtype=np.uint8), np.zeros(0, dtype=np.int64), []
    parts = 1_000_000
    shares = [F.lit(x) for r in counts for x in (r["lang"], min(parts, int(parts * docs_per_language / r["count"]) + 1))]
    chosen = F.pmod(F.xxhash64(F.lit("language"), "doc_id", "text"), F.lit(parts)) < F.create_map(*shares)[F.col("lang")]

    def cut(frames):
        for frame in frames:
            rows = []
            for text, lang in zip(frame["text"], frame["lang"]):
                every = windows_of(text)
                places = sorted({0, len(every) // 2})[:WINDOWS_PER_DOC]
                rows += [(lang, every[place].tobytes()) for place in places]
            yield pd.DataFrame(rows, columns=["lang", "window"])

    rows = labelled.where(chosen).select("text", "lang").mapInPandas(cut, "lang string, window binary")
    rows = rows.limit(2 * WINDOWS_PER_DOC * docs_per_language * len(counts)).collect()
    rows = sorted((r["lang"], bytes(r["window"])) for r in rows)
    languages = sorted({lang for lang, _ in rows})
    number = {lang: i for i, lang in enumerate(languages)}
    windows = np.array([np.frombuffer(w, dtype=np.uint8) for _, w in rows]).reshape(-1, WINDOW)
    return windows, np.array([number[lang] for lang, _ in rows], dtype=np.int64), languages


def train(docs, docs_per_language=DOCS_PER_LANGUAGE):
    """A network fitted on a bounded sample of the labelled documents, or ``None`` if no document has a label."""
    windows, labels, languages = sample_windows(docs, docs_per_language)
    return Network(languages).train(windows, labels) if languages else None


def predict(network, text):
    """``(language, score)`` of a text: the greatest mean probability over its windows."""
    if network is None or not text or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    mean = network.probabilities(windows_of(text)).mean(axis=0)
    best = int(mean.argmax())
    return network.languages[best], round(float(min(1.0, mean[best])), 6)


def prediction(spark, text, network):
    """A struct ``lang_pred, score`` for a text column."""
    shipped = spark.sparkContext.broadcast(network)

    def run(texts):
        free_worker()
        return pd.DataFrame([predict(shipped.value, t) for t in texts], columns=["lang_pred", "score"])

    return F.pandas_udf(lambda texts: run(texts), "lang_pred string, score double").asNondeterministic()(text)


def held_out():
    """Whether a document is kept from training: the remainder of its id's checksum (null id: not held out)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs, network=None):
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    Without a network one is trained on the documents that have an id, a text
    and a language and are not held out. Null texts and texts without a letter
    are ``und`` with score 0, and so is everything if nothing is labelled; ties
    go to the language first in order. Predictions read the text alone, so
    repeated rows agree. An empty table gives an empty one. Other columns are
    not read.
    """
    network = network or train(docs.where("doc_id IS NOT NULL").where(~held_out()))
    made = prediction(docs.sparkSession, F.col("text"), network).alias("made")
    return docs.select("doc_id", held_out().alias("held_out"), made).select("doc_id", "held_out", "made.*")


def filter_language(docs, network=None, languages=None, least=0.5):
    """The documents, with their columns, in one of ``languages`` (any known one if ``None``) with a score of ``least``."""
    network = network or train(docs.where("doc_id IS NOT NULL").where(~held_out()))
    name = unused("language_made", docs.columns)
    rows = docs.withColumn(name, prediction(docs.sparkSession, docs["text"], network))
    good = (F.col(name)["lang_pred"] != UNKNOWN) & (F.col(name)["score"] >= least)
    if languages is not None:
        good = good & F.col(name)["lang_pred"].isin(list(languages))
    return rows.where(good).drop(name)
