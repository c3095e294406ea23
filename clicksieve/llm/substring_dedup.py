"""Removal of passages that an earlier document has: seed and extend.

Seeds are winnowed anchors: of any ``window`` consecutive words, the run of
``ANCHOR`` words with the least hash. Equal windows have the same anchor at the
same place, so only anchors that two documents share can be part of a repeat.
Each shared anchor is extended both ways as far as it is the anchor of the
windows around it. Equal extensions are repeats as a whole; where extensions of
one anchor differ, their windows are compared one by one. All windows that an
earlier document has too are merged to maximal repeats.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from clicksieve.llm.common import saved, words_of
from clicksieve.llm.hashing import run_hashes, sequence_hashes, word_hashes

WINDOW = 50
ANCHOR = 8


def anchor_places(words, window, anchor):
    """For each window of a document, the place of its anchor; and the hash of the anchor at each place."""
    grams = sequence_hashes(words, anchor)
    if len(words) < window:
        return np.zeros(0, dtype=np.int64), grams
    views = np.lib.stride_tricks.sliding_window_view(grams, window - anchor + 1)
    return np.arange(len(views)) + views.argmin(axis=1), grams


def text_key(text):
    """A name for one text, to tell rows that share a doc_id apart."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def digest_of(words):
    return hashlib.sha256(" ".join(words).encode("utf-8", "surrogatepass")).hexdigest()


def seeds(window, anchor):
    """Rows of ``doc_id, text``: per document its size, its digest as it is, and its distinct anchors."""

    def run(frames):
        for frame in frames:
            rows = []
            for text in frame["text"]:
                words = words_of(text)
                places, grams = anchor_places(word_hashes(text), window, anchor)
                anchors = np.unique(grams[np.unique(places)]).view(np.int64)
                rows.append((text_key(text or ""), len(words), digest_of(words), anchors))
            out = pd.DataFrame(rows, columns=["key", "n_words", "kept_sha256", "anchors"])
            yield pd.concat([frame[["doc_id"]].reset_index(drop=True), out], axis=1)

    return run


def extensions(words, window, anchor):
    """Of each anchor in turn: its hash, the hash of all its windows' words, and its first and last window."""
    places, grams = anchor_places(words, window, anchor)
    first = np.flatnonzero(np.diff(places, prepend=-1))
    last = np.append(first[1:], len(places)) - 1
    # A run of windows is told by all of them, each at its place.
    runs = run_hashes(sequence_hashes(words, window), first)
    return grams[places[first]].view(np.int64), runs.view(np.int64), first, last


def extended(window, anchor):
    """Rows of ``doc_id, key, text, shared``: the extension of each shared anchor."""

    def run(frames):
        for frame in frames:
            parts = []
            for doc_id, key, text, shared in frame[["doc_id", "key", "text", "shared"]].itertuples(index=False):
                anchors, runs, first, last = extensions(word_hashes(text), window, anchor)
                at = np.isin(anchors, np.asarray(shared, dtype=np.int64))
                if at.any():
                    columns = {"anchor": anchors[at], "run": runs[at], "doc_id": doc_id, "key": key}
                    parts.append(pd.DataFrame({**columns, "first": first[at], "last": last[at]}))
            if parts:
                yield pd.concat(parts, ignore_index=True)

    return run


def windows_of(window, anchor):
    """Rows of ``doc_id, key, text, ranges``: every window that starts in one of the ranges."""

    def run(frames):
        for frame in frames:
            parts = []
            for doc_id, key, text, ranges in frame[["doc_id", "key", "text", "ranges"]].itertuples(index=False):
                words = word_hashes(text)
                places, grams = anchor_places(words, window, anchor)
                at = np.unique(np.concatenate([np.arange(r["first"], r["last"] + 1) for r in ranges]))
                columns = {"anchor": grams[places[at]].view(np.int64), "run": sequence_hashes(words, window)[at].view(np.int64)}
                parts.append(pd.DataFrame({**columns, "doc_id": doc_id, "key": key, "first": at, "last": at}))
            if parts:
                yield pd.concat(parts, ignore_index=True)

    return run


def cut(window, columns):
    """Rows of ``doc_id, text, ranges``: the text without the words that the windows in ``ranges`` cover."""

    def run(frames):
        for frame in frames:
            rows = []
            for text, ranges in zip(frame["text"], frame["ranges"]):
                words = words_of(text)
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                for r in ranges:
                    edge[r["first"]] += 1
                    edge[r["last"] + window] -= 1
                covered = np.cumsum(edge)[:-1] > 0
                kept = [w for w, gone in zip(words, covered) if not gone]
                turns = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
                rows.append((len(words), int(covered.sum()), " ".join(kept), digest_of(kept), turns.tolist()))
            out = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_text", "kept_sha256", "repeats"])
            yield pd.concat([frame[["doc_id"]].reset_index(drop=True), out], axis=1)[columns]

    return run


def earliest(rows, name):
    """``anchor, run, least``: the first document with each run, written so that a join with it can be split."""
    return saved(rows.groupBy("anchor", "run").agg(F.min("doc_id").alias("least")), name)


def ranges_of(rows):
    return rows.groupBy("doc_id", "key").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))


def find_repeats(docs, window=WINDOW, anchor=ANCHOR):
    """``(all documents, documents with repeats)``.

    The first has ``doc_id, key, n_words, kept_sha256, copy`` of all rows;
    ``copy`` marks those whose words are, one for one, those of a document with
    a smaller doc_id. The second has ``doc_id, key, text, ranges`` of the other
    rows with windows that start in such a document too: ``ranges`` are those
    windows, by their first words. Copies stand behind their first document
    and are not searched themselves.
    """
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, key long, n_words long, kept_sha256 string, anchors array<long>"
    plain = saved(docs.mapInPandas(seeds(window, anchor), fields), "substring-seeds")
    # A row without an id is neither smaller nor greater than another.
    longer = plain.where(f"doc_id IS NOT NULL AND n_words >= {window}")
    least = saved(longer.groupBy("kept_sha256").agg(F.min("doc_id").alias("least")), "substring-copies")
    plain = plain.join(least, "kept_sha256", "left").withColumn(
        "copy", F.coalesce((F.col("n_words") >= window) & (F.col("least") < F.col("doc_id")), F.lit(False))
    )
    plain = saved(plain.drop("least"), "substring-marked")
    anchors = plain.where("doc_id IS NOT NULL AND NOT copy").select("doc_id", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shared = saved(shared.where("least < most").select("anchor"), "substring-shared")
    hits = anchors.join(shared, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("shared"))
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").join(hits, "doc_id")
    texts = saved(texts.withColumn("key", key_column(F.col("text"))), "substring-texts")
    fields = f"anchor long, run long, doc_id {kind}, key long, first int, last int"
    runs = saved(texts.mapInPandas(extended(window, anchor), fields), "substring-runs")
    whole = earliest(runs, "substring-first-runs")
    # An anchor with one extension only has no other windows to compare.
    several = saved(whole.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "substring-several")
    placed = runs.join(whole, ["anchor", "run"])
    open_ = placed.where("doc_id = least").drop("least").join(several, "anchor")
    parts = texts.drop("shared").join(ranges_of(open_), ["doc_id", "key"])
    parts = saved(parts.mapInPandas(windows_of(window, anchor), fields), "substring-windows")
    single = parts.join(earliest(parts, "substring-first-windows"), ["anchor", "run"])
    repeated = placed.where("least < doc_id").unionByName(single.where("least < doc_id"))
    return plain.drop("anchors"), texts.drop("shared").join(ranges_of(repeated), ["doc_id", "key"])


def key_column(text):
    def run(texts):
        return pd.Series([text_key(t or "") for t in texts], dtype="int64")

    return F.pandas_udf(lambda texts: run(texts), "long").asNondeterministic()(text)


def remove_repeats(docs, window=WINDOW, anchor=ANCHOR):
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``.

    Each word covered by a window of ``window`` words whose sequence also starts
    in a document with a smaller doc_id counts as removed. Windows are judged
    on the input. Null and empty texts have no words; texts shorter than a
    window keep all. A row without doc_id keeps all and removes nothing
    elsewhere. Rows that share a doc_id are judged each by its own text and
    never against one another. Other columns are not read; an empty table gives
    an empty one.
    """
    plain, changed = find_repeats(docs, window, anchor)
    changed = saved(changed, "substring-changed")
    kind = plain.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    fields = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string"
    cuts = changed.select("doc_id", "text", "ranges").mapInPandas(cut(window, columns), fields)
    touched = changed.select("doc_id", "key").distinct()
    untouched = plain.join(touched, ["doc_id", "key"], "left_anti")
    untouched = untouched.select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(0).alias("n_removed"),
        F.when(F.col("copy"), digest_of([])).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
    return untouched.unionByName(cuts)


def without_repeats(docs, window=WINDOW, anchor=ANCHOR):
    """The documents that lose words: ``doc_id``, the text that is left, and the maximal repeats as word offsets.

    Offsets are start, end, start, end, ... Of copies of a whole document nothing is left.
    """
    plain, changed = find_repeats(docs, window, anchor)
    kind = changed.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "kept_text", "repeats"]
    fields = f"doc_id {kind}, kept_text string, repeats array<long>"
    whole = F.array(F.lit(0).cast("long"), F.col("n_words")).alias("repeats")
    copies = plain.where("copy").select("doc_id", F.lit("").alias("kept_text"), whole)
    return changed.select("doc_id", "text", "ranges").mapInPandas(cut(window, columns), fields).unionByName(copies)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []::VARCHAR[]) AS w FROM documents
), win AS (
  SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM d WHERE len(w) >= 50
), seq AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS s FROM win
), least AS (
  SELECT s, min(doc_id) AS m FROM seq GROUP BY s
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps
  FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM seq JOIN least USING (s) WHERE m < doc_id)
  GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN w
    ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""
