import random

import numpy as np
import pandas as pd
import pyarrow as pa
from cases import awkward_rows, clashing, documents, empty, rows_of, words

from clicksieve.llm import components, shingle_join
from clicksieve.llm.hashing import mixed


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_sets(text):
    own = words(lower(text))
    if not own:
        return set()
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))}


def plain_components(rows):
    """By brute force over all pairs."""
    sets = {}
    for doc_id, text, *_ in rows:
        sets.setdefault(doc_id, []).append(plain_sets(text))
    names = list(sets)
    parent = {n: n for n in names}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(names):
        for b in names[:i]:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {n: root(n) for n in names}


def near_copies(seed, groups, size):
    draw = random.Random(seed)
    rows, doc_id = [], 0
    for group in range(groups):
        length = draw.choice([3, 5, 6, 9, 14, 25, 60, 200])
        base = [f"w{draw.randrange(40 if length < 10 else 10_000)}" for _ in range(length)]
        for _ in range(draw.randint(1, size)):
            own = list(base)
            for _ in range(draw.randint(0, max(1, length // 15))):
                own[draw.randrange(len(own))] = f"w{draw.randrange(10_000)}"
            if draw.random() < 0.3:
                own = own[: draw.randint(max(1, int(len(own) * 0.7)), len(own))]
            rows.append((doc_id, " ".join(own), None, None, 0))
            doc_id += 1
    draw.shuffle(rows)
    return rows


def test_bands_hold_all_similar_sizes():
    starts = shingle_join.band_starts(100_000)
    for n in range(1, 3000):
        most = n * 100 // 75
        assert np.searchsorted(starts, most, side="right") - np.searchsorted(starts, n, side="right") <= 1


def test_similar_sets_share_a_signature():
    draw = random.Random(4)
    starts = shingle_join.band_starts()
    for _ in range(400):
        size = draw.choice([1, 2, 3, 4, 5, 7, 9, 20, 50, 300])
        one = {draw.getrandbits(63) for _ in range(size)}
        two = set(one)
        while True:
            more = set(two)
            if draw.random() < 0.5 and more:
                more.discard(draw.choice(sorted(more)))
            else:
                more.add(draw.getrandbits(63))
            if not more or 100 * len(one & more) < 75 * len(one | more):
                break
            two = more
        found = [set(shingle_join.signatures(np.array(sorted(s), dtype=np.uint64), starts)[0].tolist()) for s in (one, two)]
        assert found[0] & found[1], (len(one), len(two))


def test_components_are_those_of_all_pairs(spark):
    for seed, groups, size in ((1, 40, 6), (2, 12, 30)):
        rows = near_copies(seed, groups, size)
        found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in shingle_join.near_duplicates(documents(spark, rows)).collect()}
        expected = plain_components(rows)
        assert found == {d: (len(plain_sets(t)), expected[d]) for d, t, *_ in rows}


def test_groups_are_compared_in_blocks(spark, monkeypatch):
    """Documents that share a passage but are not similar, and some that are: the result is that of all pairs."""
    monkeypatch.setattr(shingle_join, "BLOCK", 5)
    passage = [f"p{i}" for i in range(40)]
    draw = random.Random(9)
    rows = [(i, " ".join(passage + [f"x{draw.randrange(10**6)}" for _ in range(draw.choice([2, 8, 14, 40]))]), None, None, 0) for i in range(40)]
    found = {r["doc_id"]: r["component_id"] for r in shingle_join.near_duplicates(documents(spark, rows)).collect()}
    assert found == plain_components(rows)


def test_blocks_find_all_links_between_components():
    draw = np.random.default_rng(3)
    base = np.arange(100)
    sets = [np.unique(np.where(draw.random(100) < draw.choice([0.05, 0.2]), draw.integers(1000, 2000, 100), base)) for _ in range(30)]
    frame = pd.DataFrame({"doc_id": range(30), "component": [i % 7 for i in range(30)], "part": [i % 2 for i in range(30)], "features": sets})
    found = {frozenset(x) for x in shingle_join.compare_block(0, 1, frame).itertuples(index=False, name=None)}
    for part in (0, 1):
        own = frame[frame["part"] == part]
        found |= {frozenset(x) for x in shingle_join.compare_block(part, part, own).itertuples(index=False, name=None)}
    expected = set()
    for a in range(30):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if a % 7 != b % 7 and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                expected.add(frozenset((a, b)))
    assert found == expected and expected


def test_awkward_rows(spark):
    found = shingle_join.near_duplicates(documents(spark))
    assert rows_of(found) == rows_of(shingle_join.near_duplicates(clashing(spark)))
    assert shingle_join.near_duplicates(empty(spark)).count() == 0
    whole = [r for r in awkward_rows() if r[0] is not None]
    expected = plain_components(whole)
    assert {r["doc_id"]: r["component_id"] for r in found.where("doc_id IS NOT NULL").collect()} == expected
    nulls = {(r["n_shingles"], r["component_id"]) for r in found.where("doc_id IS NULL").collect()}
    assert nulls == {(0, None), (76, 5)}
    kept = shingle_join.without_near_duplicates(clashing(spark))
    assert kept.columns == clashing(spark).columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, c in expected.items() if d == c} | {None}


def test_long_chains_are_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 400), (400, 450)], "u long, v long")
    found = {r["node"]: r["component"] for r in components.connected_components(links).collect()}
    assert found == {**{i: 0 for i in range(1, 301)}, 450: 400, 500: 400}
    assert mixed(np.arange(3, dtype=np.uint64)).tolist() == mixed(np.arange(3, dtype=np.uint64)).tolist()


def test_long_words_are_told_apart(spark):
    """Two words that a polynomial modulo 2**64 does not tell apart."""
    rows = []
    for size in (1024, 4096):
        ones = [bin(i).count("1") % 2 for i in range(size)]
        for pair in ("ab", "ba"):
            rows.append((len(rows), "p q r s " + "".join(pair[i] for i in ones), None, None, 0))
    found = {r["doc_id"]: r["component_id"] for r in shingle_join.near_duplicates(documents(spark, rows)).collect()}
    assert found == {i: i for i in range(4)}


def test_blocks_link_what_is_similar_and_nothing_else():
    draw = np.random.default_rng(5)
    passage = draw.integers(0, 1 << 60, 30)
    sets = []
    for _ in range(12):
        own = np.unique(np.concatenate([passage, draw.integers(0, 1 << 60, int(draw.integers(1, 60)))]))
        sets += [own, own[: max(1, int(len(own) * draw.uniform(0.6, 1)))]]
    sets += [np.array([1, 2, 3, 4]), np.array([1, 2, 3]), np.array([9]), np.array([9])]
    part = draw.integers(0, 2, len(sets))
    component = draw.integers(0, 5, len(sets))
    frame = pd.DataFrame({"doc_id": range(len(sets)), "component": component, "part": part, "features": sets})
    for low, high in ((0, 1), (0, 0), (1, 1)):
        some = frame if low != high else frame[frame["part"] == low].reset_index(drop=True)
        found = {tuple(r) for r in shingle_join.compare_block(low, high, some).itertuples(index=False)}
        expected = set()
        for u in range(len(sets)):
            for v in range(len(sets)):
                common, union = len(set(sets[u]) & set(sets[v])), len(set(sets[u]) | set(sets[v]))
                if part[u] == low and part[v] == high and component[u] != component[v] and 100 * common >= 75 * union:
                    expected.add((u, v))
        assert found == expected


def test_each_text_is_hashed_once_before_sets_are_made(spark, monkeypatch):
    """The sampled shingles come from the first pass over the texts; what is shared within a batch counts at once."""
    frame = pd.DataFrame({"doc_id": [1, 2, 3], "text": ["a b c d e f g h i j", "A b c d e f g h i j", None]})
    monkeypatch.setattr(shingle_join, "ROWS_AT_ONCE", 1)
    rows = pd.concat(shingle_join.outline(iter([frame])), ignore_index=True)
    assert rows["doc_id"].tolist() == [1, 2, 3] and rows["n_shingles"].tolist() == [6, 6, 0]
    whole = np.sort(mixed(shingle_join.shingles("a b c d e f g h i j")))
    sample = whole[whole < np.uint64(int(shingle_join.SAMPLED * 2**64))].view(np.int64)
    assert [sorted(s) for s in rows["sample"]] == [sorted(sample.tolist())] * 2 + [[]]
    batch = pa.RecordBatch.from_pandas(rows[["doc_id", "sample"]], schema=pa.schema([("doc_id", pa.int64()), ("sample", pa.list_(pa.int64()))]))
    (found,) = shingle_join.sampled(40)(iter([batch]))
    found = found.to_pandas()
    assert sorted(found[found["credit"] > 0][["doc_id", "credit"]].itertuples(index=False, name=None)) == [(d, len(sample)) for d in (1, 2) if len(sample)]
    assert (found["credit"] == shingle_join.MARK).sum() == len(sample)


def test_tables_are_compared_as_frames_are():
    sets = [[1, 2, 3, 4], [1, 2, 3], [9], [9], [], [1, 2, 3, 5]]
    columns = {"doc_id": range(6), "component": [0, 1, 2, 3, 4, 5], "part": [0, 1, 0, 1, 0, 1], "features": sets}
    table = pa.table({n: pa.array(list(c), pa.list_(pa.int64()) if n == "features" else pa.int64()) for n, c in columns.items()})
    chunks = pa.concat_tables([table.slice(0, 2), table.slice(2)])
    found = shingle_join.compare_table((pa.scalar(0), pa.scalar(0), pa.scalar(1)), chunks).to_pydict()
    assert found == {"u": [0, 2], "v": [1, 3]}
