"""Near duplicates by word shingles: a set similarity join with PartEnum signatures.

Two sets are similar if their Jaccard similarity is 0.75 or more; then they
differ in at most a seventh of their added sizes. Sizes are cut into bands, so
narrow that similar sets lie in one band or in two that touch. For each band
the features are partitioned by hash into more parts than two sets of the band
may differ in. Similar sets agree on a part that is not empty, and the hash of
what a set has in a part is a signature. A set that fills too few parts for
this to be certain has signatures of finer partitions too.

Before that, documents that cannot be similar to any other are put aside: too
many of their shingles are found nowhere else. Signatures that very many sets
have say least, and a set with more parts than needed can do without as many of
them. Sets with equal signatures are compared in full: first with the leader of
each signature, which joins most groups; where a signature's sets are then in
different components, all of these, in blocks of bounded size.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clicksieve.llm.common import free_worker, saved
from clicksieve.llm.components import connected_components
from clicksieve.llm.hashing import mixed, sequence_hashes, word_hashes

# Five words, 75 of 100.
SHINGLE = 5
SHARE, OF = 75, 100

SAMPLED = 0.35  # part of the feature domain that is looked at to put documents aside; above 1 - SHARE / OF
SPREAD = 1.3  # parts per difference: with some more parts than needed, few sets need finer partitions
BLOCK = 1024  # sets that are compared with as many others in one task
ROWS_AT_ONCE = 200_000  # signatures that leave a task together
MARK = -1


def shingles(text):
    """The distinct shingles of a text as hashes, in order; with fewer words, the whole sequence as one."""
    words = word_hashes(text, lower=True)
    if not len(words):
        return words
    found = sequence_hashes(words, min(SHINGLE, len(words)))
    found.sort()
    new = np.ones(len(found), dtype=bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    return found[new]


def band_starts(most=1 << 40):
    """The least size of each band: sets two bands apart cannot be similar."""
    starts = [1]
    while starts[-1] < most:
        starts.append(max(starts[-1] + 1, OF * (starts[-1] - 1) // SHARE + 1))
    return np.array(starts)


def signatures(features, starts, spread=SPREAD):
    """``(signatures, bands, own)`` of a set; ``own`` is the finest partition's spare parts, or ``MARK`` for coarser ones.

    A set of band b belongs to the joins of bands b and b + 1. ``bands`` holds
    each signature's join and the level of the set's finest partition in it.
    """
    size = len(features)
    band = int(np.searchsorted(starts, size, side="right")) - 1
    found, names, spare = [], [], []
    for join in (band, band + 1):
        # The most by which two sets of this join differ: |r| + |s| - 2 |r and s| <= (1 - t) / (1 + t) * (|r| + |s|).
        differ = 2 * (int(starts[join + 1]) - 1) * (OF - SHARE) // (OF + SHARE)
        parts, level, runs = max(1, int(spread * (differ + 1))), 0, []
        while True:
            place = (mixed(features ^ np.uint64(0x5DEECE66D)) % np.uint64(parts << level)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            first = np.flatnonzero(np.diff(place[order], prepend=-1))
            sums = np.add.reduceat(mixed(features[order]), first)
            salt = mixed(np.array([join, level, 1], dtype=np.uint64)).sum(dtype=np.uint64)
            runs.append(mixed(mixed(sums + salt) + mixed(place[order][first].astype(np.uint64))))
            if len(first) > differ:
                break
            level += 1
        found += runs
        names.append(np.full(sum(map(len, runs)), 64 * join + level))
        spare += [np.full(len(r), MARK) for r in runs[:-1]] + [np.full(len(runs[-1]), len(runs[-1]) - differ - 1)]
    return np.concatenate(found).view(np.int64), np.concatenate(names), np.concatenate(spare)


def outline(frames):
    """Rows of ``doc_id, text``: the size and the identity of each set, the sampled shingles and how many of them others must share."""
    free_worker()
    edge = np.uint64(int(SAMPLED * 2**64))
    for frame in frames:
        rows, held, at = [], 0, 0
        for text in frame["text"]:
            own = shingles(text)
            size = len(own)
            again = mixed(own)
            some = again[again < edge].view(np.int64)
            need = len(some) - size * (OF - SHARE) // OF
            key, other = int(own.sum(dtype=np.uint64).view(np.int64)), int(again.sum(dtype=np.uint64).view(np.int64))
            rows.append((size, key, other, need, some))
            held += len(some)
            if held >= ROWS_AT_ONCE:
                yield outlined(frame, at, rows)
                rows, held, at = [], 0, at + len(rows)
        yield outlined(frame, at, rows)


def outlined(frame, at, rows):
    """The rows of ``outline`` for the documents from place ``at`` on."""
    out = pd.DataFrame(rows, columns=["n_shingles", "key", "again", "need", "sample"])
    return pd.concat([frame[["doc_id"]].iloc[at : at + len(rows)].reset_index(drop=True), out], axis=1)


def sampled(bits):
    """Batches of ``doc_id, sample``: the sampled shingles, cut to ``bits`` bits, as ``shingle, doc_id, credit``.

    Shingles that two documents of a batch share count for these at once: the
    documents' sums are rows with a credit, and one marked row tells the rest.
    """
    mask = np.int64((1 << bits) - 1)

    def run(batches):
        for batch in batches:
            samples = batch.column("sample")
            docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
            values = samples.flatten().to_numpy(zero_copy_only=False) & mask
            owner = np.repeat(np.arange(len(docs)), np.diff(samples.offsets.to_numpy()))
            order = np.argsort(values)
            ordered = values[order]
            again, goes_on, shared = (np.zeros(len(values), dtype=bool) for _ in range(3))
            again[1:] = ordered[1:] == ordered[:-1]
            goes_on[:-1] = again[1:]
            marks = ordered[goes_on & ~again]
            shared[order] = again | goes_on
            credit = np.bincount(owner[shared], minlength=len(docs))
            some = np.flatnonzero(credit)
            alone = ~shared
            columns = (
                np.concatenate([values[alone], marks, docs[some] * 7919 & mask]),
                np.concatenate([docs[owner[alone]], np.zeros(len(marks), dtype=docs.dtype), docs[some]]),
                np.concatenate([np.zeros(alone.sum()), np.full(len(marks), MARK), credit[some]]).astype(np.int32),
            )
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shingle", "doc_id", "credit"])

    return run


def credited(frames):
    """Rows of ``shingle, doc_id, credit`` in order of shingles: ``doc_id, credit`` for what documents share."""
    held = None  # the last row of the batch before: its shingle, and its document if that still has no credit
    for frame in frames:
        given = frame[frame["credit"] > 0][["doc_id", "credit"]]
        rows = frame[frame["credit"] <= 0]
        if len(rows):
            values, docs = rows["shingle"].to_numpy(), rows["doc_id"].to_numpy()
            marked = rows["credit"].to_numpy() == MARK
            goes_on = held is not None and values[0] == held[0]
            equal = values[1:] == values[:-1]
            twice = np.concatenate([[goes_on], equal]) | np.concatenate([equal, [False]])
            credit = docs[twice & ~marked]
            if goes_on and held[1] is not None:
                credit = np.append(credit, held[1])
            held = values[-1], None if marked[-1] or twice[-1] else docs[-1]
            more = pd.DataFrame({"doc_id": credit})
            more["credit"] = np.int32(1)
            given = pd.concat([given, more], ignore_index=True)
        if len(given):
            given = given.groupby("doc_id", as_index=False)["credit"].sum()
            yield given.astype({"credit": "int64"})


def set_rows(frames):
    """Rows of ``doc_id, text``: the sets."""
    for frame in frames:
        sets = [shingles(t).view(np.int64) for t in frame["text"]]
        yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "size": [len(s) for s in sets], "features": sets})


def signature_rows(frames):
    """Rows of ``doc_id, size, features``: one row per signature."""
    starts = band_starts()

    def rows(parts):
        doc, found, names, spare, size = (np.concatenate(p) for p in zip(*parts))
        return pd.DataFrame({"signature": found, "doc_id": doc, "size": size, "name": names, "spare": spare})

    for frame in frames:
        parts, held = [], 0
        for doc_id, features in zip(frame["doc_id"], frame["features"]):
            found, names, spare = signatures(np.asarray(features).view(np.uint64), starts)
            size = np.full(len(found), len(features), dtype=np.int32)
            parts.append((np.full(len(found), doc_id), found, names.astype(np.int32), spare.astype(np.int32), size))
            held += len(found)
            if held >= ROWS_AT_ONCE:
                yield rows(parts)
                parts, held = [], 0
        if parts:
            yield rows(parts)


def similar_sizes(a, b):
    return OF * F.least(a, b) >= SHARE * F.greatest(a, b)


def linked(pairs, sets):
    """Of pairs ``u, v``, those whose sets are similar, compared in full."""
    of = lambda name: sets.select(F.col("doc_id").alias(name), F.col("features").alias(f"of_{name}"))
    both = pairs.join(of("v"), "v").join(of("u"), "u")
    common = F.size(F.array_intersect("of_u", "of_v"))
    union = F.size("of_u") + F.size("of_v") - common
    return both.where(OF * common >= SHARE * union).select("u", "v")


def possible(outlines):
    """Ids of documents that may have a similar one: enough of their sampled shingles are found elsewhere too."""
    total = outlines.agg(F.sum("n_shingles")).first()[0] or 1
    bits = min(60, 8 + math.ceil(math.log2(total + 1)))
    rows = outlines.where("doc_id IS NOT NULL AND n_shingles > 0").select("doc_id", "sample")
    rows = rows.mapInArrow(sampled(bits), "shingle long, doc_id long, credit int")
    rows = rows.repartition("shingle").sortWithinPartitions("shingle")
    credits = rows.mapInPandas(credited, "doc_id long, credit long").groupBy("doc_id").agg(F.sum("credit").alias("credit"))
    # Rows that share an id are one document: the least demand of them counts.
    demands = outlines.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id").agg(F.min("need").alias("need"))
    return demands.join(credits, "doc_id", "left").where(F.coalesce("credit", F.lit(0)) >= F.col("need")).select("doc_id")


def needed(members):
    """``members`` of the signatures that some set cannot do without, with each signature's ``leader``.

    Two similar sets agree on more of a set's finest parts than the ``spare``
    ones, so that many may be left out, and those are its most frequent ones.
    Of two sets the one with the coarser finest partition decides. The leader
    is the set that shares most of its signatures, so that a group of near
    copies has few leaders.
    """
    own = W.partitionBy("doc_id", "name")
    rank = F.row_number().over(own.orderBy(F.col("n").desc(), "signature"))
    rows = members.withColumns(
        {"active": (F.col("spare") != MARK) & (rank > F.col("spare")), "shares": F.count("*").over(own)}
    )
    rows = saved(rows.drop("n", "spare"), "shingle-ranked")
    asked = rows.groupBy("signature").agg(
        F.max("active").alias("asked"), F.min(F.struct(-F.col("shares"), "doc_id", "size")).alias("least")
    )
    asked = asked.where("asked").select(
        "signature", F.col("least.doc_id").alias("leader"), F.col("least.size").alias("leader_size")
    )
    rows = rows.select("signature", "doc_id", "size").join(saved(asked, "shingle-asked"), "signature")
    return saved(rows, "shingle-needed")


def first_pairs(members):
    """Each signature's leader with the others."""
    rows = members.where((F.col("doc_id") != F.col("leader")) & similar_sizes(F.col("size"), F.col("leader_size")))
    return rows.select(F.least("leader", "doc_id").alias("u"), F.greatest("leader", "doc_id").alias("v")).distinct()


def compare_block(low, high, frame):
    """Links between the sets of two parts of a group (or within one), from ``doc_id, component, part, features``."""
    sets = [np.asarray(f) for f in frame["features"]]
    columns = (frame[c].to_numpy() for c in ("doc_id", "component", "part"))
    u, v = block_links(low, high, *columns, np.concatenate(sets), np.array([len(s) for s in sets]))
    return pd.DataFrame({"u": u, "v": v})


def compare_table(key, table):
    """``compare_block`` of an Arrow table: most groups are small, so frames would take longer than what is compared."""
    features = table.column("features").combine_chunks()
    columns = (table.column(c).to_numpy() for c in ("doc_id", "component", "part"))
    sizes = np.diff(features.offsets.to_numpy())
    u, v = block_links(key[1].as_py(), key[2].as_py(), *columns, features.flatten().to_numpy(), sizes)
    return pa.table({"u": u, "v": v})


def block_links(low, high, docs, of_component, part, features, sizes):
    """``compare_block`` of arrays; the sets stand one after another in ``features``."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(features)
    new = np.diff(features[order], prepend=features[order[:1]]) != 0
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.cumsum(new)
    times = np.bincount(place)
    # What two sets have in common is found in at least two sets, so a set with too few such features has no link here.
    held = np.flatnonzero(times[place] > 1)
    able = OF * np.bincount(owner[held], minlength=len(sizes)) >= SHARE * sizes
    links = [np.zeros((0, 2), dtype=np.int64)]
    able &= sizes > 0
    if np.count_nonzero(able) > 1:
        held = held[able[owner[held]]]
        place, owner = place[held], owner[held]
        starts = np.searchsorted(owner, np.arange(len(sizes) + 1))
        order = np.argsort(place, kind="stable")
        holders, first = owner[order], np.searchsorted(place[order], np.arange(len(times) + 1))
        for one in np.flatnonzero((part == low) & able):
            own = place[starts[one] : starts[one + 1]]
            common = np.bincount(np.concatenate([holders[first[p] : first[p + 1]] for p in own]), minlength=len(sizes))
            union = sizes[one] + sizes - common
            similar = (OF * common >= SHARE * union) & (of_component != of_component[one]) & (part == high)
            found = docs[similar]
            links.append(np.stack([np.full(len(found), docs[one]), found], axis=1))
    return np.concatenate(links).T.astype(np.int64)


def remaining_links(members, sets, components):
    """Links between sets with one signature that are in different components.

    All sets of the signatures with one leader are a group. A group is dealt
    into parts of about ``BLOCK`` sets, and each two parts meet in a task of
    their own, so neither a task's memory nor a row depends on a group's size.
    """
    part_of = components.select(F.col("node").alias("doc_id"), "component")
    rows = members.select("signature", "leader", "doc_id").join(part_of, "doc_id", "left")
    rows = saved(rows.withColumn("component", F.coalesce("component", "doc_id")), "shingle-parted")
    mixed_ones = rows.groupBy("signature").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
    rows = rows.join(saved(mixed_ones.select("signature"), "shingle-mixed"), "signature")
    rows = saved(rows.select("leader", "doc_id", "component").distinct(), "shingle-groups")
    sizes = rows.groupBy("leader").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("parts"))
    rows = rows.join(saved(sizes, "shingle-sizes"), "leader")
    rows = rows.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.join(sets.select("doc_id", "features"), "doc_id").withColumn("other", other)
    rows = rows.select(
        "leader", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "doc_id", "component", "features"
    )
    return rows.groupBy("leader", "low", "high").applyInArrow(compare_table, "u long, v long")


def similar_links(sets):
    """``u, v``: links that connect all similar sets of ``doc_id, size, features`` (not all links within a component)."""
    fields = "signature long, doc_id long, size int, name int, spare int"
    rows = sets.mapInPandas(signature_rows, fields)
    shared = rows.groupBy("signature").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n")
    )
    shared = shared.where("least < most").select("signature", "n")
    members = needed(rows.join(saved(shared, "shingle-shared"), "signature"))
    first = saved(linked(saved(first_pairs(members), "shingle-pairs"), sets), "shingle-links")
    return first.unionByName(remaining_links(members, sets, connected_components(first)))


def near_duplicates(docs):
    """One row per document: ``doc_id, n_shingles, component_id``.

    ``n_shingles`` is the number of distinct five-word shingles of the text,
    with A-Z as a-z; a text of fewer words has one, null texts and texts
    without words have none and link with nothing. ``component_id`` is the
    smallest doc_id reachable by links, the document's own included. Documents
    with equal sets stand behind the one with the smallest id and follow it.
    Rows that share a doc_id are one document in the links. A row without an id
    links nothing; its component is that of an equal set, or null. Similarity
    of exactly 0.75 links. An empty table gives an empty one. Other columns are
    not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fields = "doc_id long, n_shingles long, key long, again long, need long, sample array<long>"
    outlines = saved(docs.mapInPandas(outline, fields), "shingle-outlines")
    maybe = possible(outlines)
    keys = ["n_shingles", "key", "again"]
    whole = outlines.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = saved(whole.groupBy(*keys).agg(F.min("doc_id").alias("first")), "shingle-classes")
    firsts = classes.select(F.col("first").alias("doc_id")).distinct()
    sets = docs.where("text IS NOT NULL").join(saved(maybe.join(firsts, "doc_id"), "shingle-possible"), "doc_id")
    sets = saved(sets.mapInPandas(set_rows, "doc_id long, size int, features array<long>").where("size > 0"), "shingle-sets")
    parts = connected_components(similar_links(sets))
    parts = parts.select(F.col("node").alias("first"), "component")
    # Several sets of one id are one node, so the class and its component are looked up by the class's first document.
    found = classes.join(parts, "first", "left").select(*keys, F.coalesce("component", "first").alias("of_class"))
    rows = outlines.drop("sample").join(saved(found, "shingle-components"), keys, "left")
    return rows.select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("of_class")).otherwise(F.col("doc_id")).alias("component_id")
    )


def without_near_duplicates(docs):
    """The documents, with their columns, of which each group of near duplicates keeps the one with the smallest id.

    Rows without an id are kept unless an equal set has one. Of rows with one id that are kept, all are.
    """
    found = near_duplicates(docs).where("component_id IS NOT NULL AND doc_id IS NOT NULL AND component_id <> doc_id")
    gone = found.select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []::VARCHAR[]) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT u, v FROM common JOIN n a ON u = a.doc_id JOIN n b ON v = b.doc_id WHERE 100 * c >= 75 * (a.n + b.n - c)
), reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, link.v FROM reach JOIN link ON reach.r = link.u
)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r) AS component_id
FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""
