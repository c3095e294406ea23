"""Secret scans: fixed patterns, and strings that read as random rather than as identifiers.

Two first-order Markov models over characters, one of random strings and one of
ordinary identifiers, are fitted on all documents. A long run of identifier
characters is a secret if its log-likelihood ratio per character exceeds a
threshold that hardly any ordinary run of them exceeds.
"""

import hashlib
import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from clicksieve.llm.common import join_spans

# The base patterns, their least lengths and their order.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
LEAST_ASSIGN = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
LEAST_RUN = 16
EDGE = len(ALPHABET)
CODE = np.full(256, EDGE, dtype=np.int64)
CODE[np.frombuffer(ALPHABET.encode(), dtype=np.uint8)] = np.arange(EDGE)
# Alphabets of the random strings that are labelled samples beside the secrets of the corpus.
RANDOM_ALPHABETS = [ALPHABET[:62], ALPHABET[26:62], ALPHABET[:26] + ALPHABET[52:62], ALPHABET[:64], "0123456789abcdef"]

RANDOM_SAMPLES = 4000
SMOOTHING = 0.5
ORDINARY_ABOVE = 1e-4
SCORE_STEPS = 4096


def base_spans(text):
    """``(kind, start, end)`` of the base patterns; a match that fails its test is dropped, not tried again."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def runs_beside(text, found):
    """Long identifier runs that touch none of the spans."""
    spans, at, free = sorted((a, b) for _, a, b in found), 0, []
    reach = 0  # the end of what the spans before ``at`` cover
    for m in RUN.finditer(text):
        # Both lists are in order, so each is walked once.
        while at < len(spans) and spans[at][0] < m.end():
            reach = max(reach, spans[at][1])
            at += 1
        if reach <= m.start():
            free.append((m.start(), m.end()))
    return free


def pair_codes(strings):
    """Codes of neighbouring characters with an edge before each string, and where each string starts."""
    data = CODE[np.frombuffer("\n".join(strings).encode(), dtype=np.uint8)]
    before = np.concatenate([[EDGE], data[:-1]])
    starts = np.concatenate([[0], np.cumsum([len(s) + 1 for s in strings])[:-1]]).astype(np.int64)
    return before * (EDGE + 1) + data, starts


def count_pairs(strings):
    """How often each character follows each other one."""
    if not strings:
        return np.zeros((EDGE + 1) ** 2)
    codes, _ = pair_codes(strings)
    return np.bincount(codes, minlength=(EDGE + 1) ** 2).astype(float)


def log_table(counts):
    """Log probability of each character after each other one, smoothed."""
    table = counts.reshape(EDGE + 1, EDGE + 1).copy()
    table[:, EDGE] = 0
    table[:, :EDGE] += SMOOTHING
    table /= table.sum(axis=1, keepdims=True)
    table[:, EDGE] = 1
    return np.log(table).ravel()


def ratio_scores(strings, ratio):
    """Mean log-likelihood ratio per character of each string."""
    codes, starts = pair_codes(strings)
    sums = np.add.reduceat(ratio[codes], starts)
    return sums / np.array([len(s) for s in strings])


def random_strings(count, seed=7):
    """Labelled samples of random strings."""
    draw = random.Random(seed)
    return [
        "".join(draw.choice(RANDOM_ALPHABETS[i % len(RANDOM_ALPHABETS)]) for _ in range(draw.randint(LEAST_RUN, 48)))
        for i in range(count)
    ]


def labelled_runs(text):
    """Secrets by the base patterns, and the ordinary runs beside them, of one text."""
    found = base_spans(text)
    secret = [text[a:b].rpartition("=")[2] for _, a, b in found]
    return [s for s in secret if s], [text[a:b] for a, b in runs_beside(text, found)]


def pair_totals(texts):
    """Pair counts of all secrets and of all ordinary runs, and the number of texts: summed on Spark, one number a pair."""

    def count(frames):
        totals, rows = [np.zeros((EDGE + 1) ** 2), np.zeros((EDGE + 1) ** 2)], 0
        for frame in frames:
            labelled = [labelled_runs(text) for text in frame["text"]]
            rows += len(labelled)
            for total, runs in zip(totals, zip(*labelled)):
                total += count_pairs([run for some in runs for run in some])
        for kind, total in enumerate(totals):
            codes = np.flatnonzero(total)
            yield pd.DataFrame({"kind": kind, "code": codes, "n": total[codes].astype(np.int64)})
        yield pd.DataFrame({"kind": [2], "code": [0], "n": [rows]})

    counts = texts.mapInPandas(count, "kind int, code int, n long").groupBy("kind", "code").agg(F.sum("n"))
    secret, ordinary, rows = np.zeros((EDGE + 1) ** 2), np.zeros((EDGE + 1) ** 2), 0
    for kind, code, n in counts.collect():
        if kind == 2:
            rows = n
        else:
            (secret, ordinary)[kind][code] = n
    return secret, ordinary, rows


def ordinary_limit(texts, ratio):
    """The least multiple of ``1 / SCORE_STEPS`` that at most ``ORDINARY_ABOVE`` of all ordinary runs exceed."""

    def tally(frames):
        for frame in frames:
            runs = [run for text in frame["text"] for run in labelled_runs(text)[1]]
            scores = ratio_scores(runs, ratio) if runs else np.zeros(0)
            steps, n = np.unique(np.ceil(scores * SCORE_STEPS).astype(np.int64), return_counts=True)
            yield pd.DataFrame({"step": steps, "n": n})

    # Scores are differences of logarithms, so steps are few however many runs there are.
    tallied = texts.mapInPandas(tally, "step long, n long").groupBy("step").agg(F.sum("n")).collect()
    above, allowed = 0, ORDINARY_ABOVE * sum(n for _, n in tallied)
    for step, n in sorted(tallied, reverse=True):
        if above + n > allowed:
            return step / SCORE_STEPS
        above += n
    return float("inf")


def train(docs, random_samples=RANDOM_SAMPLES):
    """``(ratio table, threshold)`` from all documents and ``random_samples`` random strings.

    Secrets are what the base patterns find, with the random strings, which
    weigh as much as one a document; ordinary is what the patterns leave. Two
    passes over the documents, of which pair counts and a tally of scores reach
    the driver. Without any ordinary run the threshold is infinite: nothing is
    added to the base spans.
    """
    texts = docs.where(F.col("text").isNotNull()).select("text")
    secret, ordinary, rows = pair_totals(texts)
    drawn = count_pairs(random_strings(random_samples)) * max(1.0, rows / max(1, random_samples))
    ratio = log_table(secret + drawn) - log_table(ordinary)
    return ratio, max(0.0, ordinary_limit(texts, ratio))


def secret_column(text, model):
    """A struct of counts, digest and spans for a text column; null text counts as empty."""
    ratio, threshold = model

    def scan(texts):
        found, runs, owners = [], [], []
        for place, text in enumerate(texts):
            text = text or ""
            spans = base_spans(text)
            found.append(spans)
            for a, b in runs_beside(text, spans):
                runs.append((a, b, text[a:b]))
                owners.append(place)
        added = [[] for _ in found]
        if runs:
            for (a, b, _), owner, score in zip(runs, owners, ratio_scores([r[2] for r in runs], ratio)):
                if score > threshold:
                    added[owner].append(("random", a, b))
        rows = []
        for base, more in zip(found, added):
            kinds = [kind for kind, _, _ in base]
            rows.append(
                (
                    kinds.count("assign"),
                    kinds.count("access"),
                    kinds.count("hex"),
                    len(more),
                    hashlib.sha256(join_spans(base, KINDS).encode()).hexdigest(),
                    join_spans(base + more, KINDS),
                )
            )
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])

    fields = "n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    return F.pandas_udf(lambda texts: scan(texts), fields).asNondeterministic()(text)


def scan_secrets(docs, model=None):
    """One row per document: counts per kind, the digest of the base spans, and all spans.

    ``docs`` has ``doc_id`` and ``text``; other columns, whatever their names,
    are not read. Null and empty texts have no spans. Repeated rows give
    repeated results, an empty table gives an empty one. Equal starts are
    ordered by kind. Offsets count code points.
    """
    model = model or train(docs)
    return docs.select("doc_id", secret_column(F.col("text"), model).alias("found")).select("doc_id", "found.*")
