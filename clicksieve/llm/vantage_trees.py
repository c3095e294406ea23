"""Nearest neighbours by cosine with vantage-point trees.

Rows are dealt over shards by a hash of their id; each shard builds a tree over
its unit vectors, where Euclidean distance is a metric and falls as the cosine
rises. A query leaves out a subtree if the triangle inequality, relaxed by
``factor``, says that it holds nothing nearer than the worst of its best so
far. Factor one is exact search; smaller factors prune more.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clicksieve.llm.common import shards

LEAF = 64
LEAST_SIDE = 1 / 16  # a split with less of the rows on one side is not made: it prunes nothing, and chains of such nodes are deep
EPS = np.finfo(np.float64).eps
LEAST_ROWS, MOST_ROWS = 2048, 65_536  # of a shard
QUERIES_AT_ONCE = 16_384
OFFERED_AT_ONCE = 2048  # queries that meet a leaf together
PAIRS_AT_ONCE = 16_384  # of a query and a row, whose exact cosines are summed together
NO_ID = np.iinfo(np.int64).max


class Tree:
    """A vantage-point tree over the rows of ``units`` (distinct unit vectors).

    ``rows`` (default: ``units``) are the vectors that exact cosines are taken
    of. ``lead`` and ``next_lead`` are the two smallest ids of each row, with
    the row's number and no second one as default; ``NO_ID`` where there is none.
    """

    def __init__(self, units, seed=5, rows=None, lead=None, next_lead=None):
        self.units, self.draw = units, np.random.default_rng(seed)
        self.rows = units if rows is None else rows
        self.norms = norms(self.rows)
        self.lead = np.arange(len(units)) if lead is None else lead
        self.next_lead = np.full(len(units), NO_ID) if next_lead is None else next_lead
        # How far two dot products of one pair can be apart, and two of its distances.
        self.margin = 8 * (units.shape[1] + 8) * EPS
        self.slack = 4 * math.sqrt(2 * self.margin)
        self.root = self.build(np.arange(len(units)))

    def build(self, rows):
        if len(rows) <= LEAF:
            return rows
        at = self.draw.integers(len(rows))
        rows[[0, at]] = rows[[at, 0]]
        point, rest = rows[0], rows[1:]
        far = distances(self.units[rest], self.units[point : point + 1])[:, 0]
        radius = np.median(far)
        inside = far < radius
        if inside.sum() < LEAST_SIDE * len(rest):
            return rows  # nearly all are as far: nothing to split by
        return point, radius, self.build(rest[inside]), self.build(rest[~inside])

    def search(self, queries, keep, factor=1.0, asked=None, own=None):
        """Of each query the ``keep`` nearest rows found, as ``(distances, rows)``, rows -1 where there are fewer.

        Nearest is by exact cosine, then by smallest id. ``asked`` (default:
        ``queries``) are the vectors that exact cosines are taken of; ``own``
        are ids that do not count for their query: a row with no other id is no candidate.
        """
        best = Best(queries if asked is None else asked, own, keep)
        self._visit(self.root, queries, np.arange(len(queries)), best, factor)
        return best.reach(), best.rows

    def _offer(self, queries, active, rows, best):
        """Lets the ``active`` queries keep the best of ``rows``; gives the distances."""
        far = np.empty((len(active), len(rows)))
        for start in range(0, len(active), OFFERED_AT_ONCE):
            some = active[start : start + OFFERED_AT_ONCE]
            dots = queries[some] @ self.units[rows].T
            far[start : start + len(some)] = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dots))
            lead = np.broadcast_to(self.lead[rows], dots.shape)
            if best.own is not None:
                lead = np.where(lead == best.own[some][:, None], self.next_lead[rows], lead)
                dots = np.where(lead == NO_ID, -np.inf, dots)
            # All that rounding may have put below the last of the best, however many they are.
            every = np.concatenate([best.scores[some], dots], axis=1)
            last = np.partition(every, -best.keep, axis=1)[:, -best.keep]
            at, row = np.nonzero((dots >= last[:, None] - self.margin) & (dots > -np.inf))
            best.take(some[at], rows[row], lead[at, row], self)
        return far

    def _visit(self, node, queries, active, best, factor):
        if not len(active):
            return
        if isinstance(node, np.ndarray):
            for start in range(0, len(node), 4 * LEAF):
                self._offer(queries, active, node[start : start + 4 * LEAF], best)
            return
        point, radius, inside, outside = node
        far = self._offer(queries, active, np.array([point]), best)[:, 0]
        within = far < radius
        self._visit(inside, queries, active[within], best, factor)
        self._visit(outside, queries, active[~within], best, factor)
        # The other side, where the border is nearer than the worst of the best.
        reach = best.reach(active)[:, -1] * factor + self.slack
        self._visit(outside, queries, active[within & (radius - far <= reach)], best, factor)
        self._visit(inside, queries, active[~within & (far - radius <= reach)], best, factor)


class Best:
    """Of each query the best ``keep`` rows so far, by exact cosine and smallest id."""

    def __init__(self, asked, own, keep):
        self.asked, self.own, self.keep, self.norms = asked, own, keep, norms(asked)
        self.scores = np.full((len(asked), keep), -np.inf)
        self.leads = np.full((len(asked), keep), NO_ID)
        self.rows = np.full((len(asked), keep), -1, dtype=np.int64)

    def reach(self, queries=slice(None)):
        return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * self.scores[queries]))

    def take(self, queries, rows, leads, tree):
        """Merges pairs of a query and a row (with the row's smallest id for that query) into the best."""
        if not len(queries):
            return
        scores = np.empty(len(queries))
        for start in range(0, len(queries), PAIRS_AT_ONCE):
            part = slice(start, start + PAIRS_AT_ONCE)
            q, r = queries[part], rows[part]
            scores[part] = dots_in_order(self.asked[q], tree.rows[r]) / (self.norms[q] * tree.norms[r])
        changed = np.unique(queries)
        queries = np.concatenate([np.repeat(changed, self.keep), queries])
        scores = np.concatenate([self.scores[changed].ravel(), scores])
        leads = np.concatenate([self.leads[changed].ravel(), leads])
        rows = np.concatenate([self.rows[changed].ravel(), rows])
        order = np.lexsort((leads, -scores, queries))
        ordered = queries[order]
        place = np.arange(len(order)) - np.searchsorted(ordered, ordered)
        order, at = order[place < self.keep], (ordered[place < self.keep], place[place < self.keep])
        self.scores[at], self.leads[at], self.rows[at] = scores[order], leads[order], rows[order]


def distances(a, b):
    """Euclidean distances of unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def dots_in_order(a, b):
    """Row by row, summed in the order of the components."""
    return np.cumsum(a * b, axis=1)[:, -1]


def norms(a):
    return np.sqrt(dots_in_order(a, a))


def cosines(a, b):
    """Row by row, summed in the order of the components."""
    return dots_in_order(a, b) / (norms(a) * norms(b))


def search_shard(rows, queries, k, factor):
    """The ``k`` nearest of ``rows`` for each of ``queries`` (frames of ``vec_id, vector``).

    They lie in the ``k`` best of the distinct vectors, those ordered by cosine
    and by their smallest id beside the query's own: each of these has a row
    before all rows of any other.
    """
    found = []
    for size, some in queries.groupby(queries["vector"].map(len)):
        own = rows[rows["vector"].map(len) == size]
        if not len(own):
            continue
        # Copies of one vector stand together behind its smallest ids.
        ids = own["vec_id"].to_numpy(np.int64)
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.stack(own["vector"].to_numpy()).astype(np.float64)[order]
        distinct, of = np.unique(vectors, axis=0, return_inverse=True)
        of = of.ravel()
        by = np.argsort(of, kind="stable")
        ids, of = ids[by], of[by]
        first = np.searchsorted(of, np.arange(len(distinct)))
        end = np.append(first[1:], len(by))
        lead = ids[first]
        next_lead = np.full(len(distinct), NO_ID)
        others = np.flatnonzero(ids != lead[of])
        with_others, at = np.unique(of[others], return_index=True)
        next_lead[with_others] = ids[others[at]]
        asked = np.stack(some["vector"].to_numpy()).astype(np.float64)
        query_ids = some["vec_id"].to_numpy(np.int64)
        scale = lambda v: v / np.sqrt((v * v).sum(axis=1, keepdims=True))
        tree = Tree(scale(distinct), rows=distinct, lead=lead, next_lead=next_lead)
        _, near = tree.search(scale(asked), min(len(distinct), k), factor, asked, query_ids)
        for place, query_id in enumerate(query_ids):
            names = near[place][near[place] >= 0]
            scores = cosines(np.broadcast_to(asked[place], distinct[names].shape), distinct[names])
            rows_found = []
            for score, name in zip(scores, names):
                members = ids[first[name] : end[name]]
                before, after = np.searchsorted(members, query_id), np.searchsorted(members, query_id, side="right")
                rows_found += [(-score, i) for i in [*members[:before][:k], *members[after : after + k]][:k]]
            found += [(query_id, vec_id, -score) for score, vec_id in sorted(rows_found)[:k]]
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def usable(vectors, name="embedding"):
    """``vec_id, vector`` (doubles) of the rows that can be compared: an id, and a vector that is finite and not zero."""
    vector = F.transform(F.col(name), lambda x: x.cast("double"))
    good = (F.size("vector") > 0) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    rows = rows.where("vec_id IS NOT NULL AND vector IS NOT NULL").where(F.coalesce(good, F.lit(False)))
    return rows.where(F.exists("vector", lambda x: x * x > 0))


def nearest(vectors, is_query, k=5, factor=1.0, name="embedding"):
    """The ``k`` nearest rows of each query: ``query_id, rank, vec_id, score``, ties to the smaller ``vec_id``.

    ``is_query`` is a condition on ``vec_id``, as a column or in SQL. A query's own id is no candidate.
    Rows with a null id, and vectors that are null, empty or zero or hold nulls
    or numbers that are not finite, take no part; vectors of different lengths
    are not compared. Repeated rows are candidates each; a repeated query is
    answered once. An empty table gives an empty result. Other columns are not
    read.

    Each shard meets the queries in blocks, so a task holds at most one shard
    and one block, whatever their number is.
    """
    spark = vectors.sparkSession
    is_query = F.expr(is_query) if isinstance(is_query, str) else is_query
    rows = usable(vectors, name)
    n_rows, n_queries = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    per_shard = min(MOST_ROWS, max(LEAST_ROWS, n_rows // (2 * shards(spark))))
    n_shards, n_blocks = max(1, math.ceil(n_rows / per_shard)), max(1, math.ceil(n_queries / QUERIES_AT_ONCE))
    number = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # Dealt by id and vector, so that one id, or one vector, on many rows is spread.
    dealt = F.pmod(F.xxhash64(F.lit("row"), "vec_id", "vector"), F.lit(n_shards)).cast("int")
    side = rows.select("vec_id", "vector", dealt.alias("shard")).withColumn("block", every(n_blocks))
    asked = rows.where(is_query).dropDuplicates(["vec_id", "vector"])
    asked = asked.withColumn("block", number("query", n_blocks)).withColumn("shard", every(n_shards))
    found = (
        side.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInPandas(lambda a, b: search_shard(a, b, k, factor), "query_id long, vec_id long, score double")
    )
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x * x > 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_dot_product(q.e, c.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e))) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""
