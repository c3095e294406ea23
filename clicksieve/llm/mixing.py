"""Mixing sources to target weights by min-cost flow.

Documents may belong to several sources. They are aggregated by membership
pattern; a flow network routes the words of each pattern to the quotas of its
sources, where each further copy of a pattern costs more than the one before.
A pattern's flow says how many copies of its documents are taken: whole copies
of all, and one more of documents in a seeded order, as far as the flow goes.
"""

import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clicksieve.llm.common import WORD, saved, unused
from clicksieve.llm.flow import Network

# Weights by place, the share of all words, the most copies.
WEIGHTS = [5, 2, 1]
SHARE = 1.5
MOST_COPIES = 2
SEED = 17
MOST_PATTERNS = 100_000  # the network is solved on the driver; more patterns than this are refused
SLICES = 1024
AHEAD, MOST_AHEAD = 256, 1_000_000  # units walked on the driver at a time, of a pattern and of all
NEAR = 0.005  # a miss of this share of the words wanted asks for another choice, unless no document is as small
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def targets(sizes, weights=WEIGHTS, share=SHARE, most=MOST_COPIES):
    """Words wanted of each source: by weight, none above ``most`` times its size, the excess shared again.

    ``sizes`` maps sources to words. Sources are weighed in code point order, null last.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    found, open_, left = {}, list(order), share * sum(sizes.values())
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > most * sizes[s]]
        if not over:
            return {**found, **{s: unit * weight[s] for s in open_}}
        found |= {s: float(most * sizes[s]) for s in over}
        left -= sum(most * sizes[s] for s in over)
        open_ = [s for s in open_ if s not in found]
    return found


def route(patterns, quotas, most=MOST_COPIES):
    """Words to take of each pattern: ``patterns`` maps tuples of sources to words, ``quotas`` sources to words."""
    found = {}
    for some in _connected(patterns):
        if len(some) == 1 and len(some[0]) == 1:
            found[some[0]] = min(most * patterns[some[0]], round(quotas[some[0][0]]))
            continue
        net, supply = Network(), {}
        for number, pattern in enumerate(some):
            words = patterns[pattern]
            supply[pattern] = [net.arc("all", ("pattern", number), words, copy * copy) for copy in range(most)]
            for source in pattern:
                net.arc(("pattern", number), ("source", source), most * words, 0)
        for source in dict.fromkeys(source for pattern in some for source in pattern):
            net.arc(("source", source), "mix", round(quotas[source]), 0)
        net.solve("all", "mix")
        found |= {pattern: sum(map(net.flow_on, arcs)) for pattern, arcs in supply.items()}
    return {pattern: found[pattern] for pattern in patterns}


def _connected(patterns):
    """Lists of patterns that share sources, directly or through others; no words flow between two lists."""
    leader = {}

    def find(source):
        while leader.setdefault(source, source) != source:
            leader[source] = leader[leader[source]]
            source = leader[source]
        return source

    for pattern in patterns:
        for source in pattern[1:]:
            leader[find(source)] = find(pattern[0])
    groups = {}
    for pattern in patterns:
        groups.setdefault(find(pattern[0]), []).append(pattern)
    return list(groups.values())


def _plan_frame(spark, rows, *names):
    """One row per pattern of what the driver worked out; at most ``MOST_PATTERNS`` patterns, so it may be broadcast."""
    return F.broadcast(_local_frame(spark, rows, {name: pa.int64() for name in names}))


def _local_frame(spark, rows, types):
    """Rows ``(pattern, ...)`` of the driver as a frame; as an Arrow table they reach Spark without Python workers of their own."""
    schema = pa.schema({"pattern": pa.list_(pa.string()), **types})
    columns = zip(*rows) if rows else [()] * len(schema)
    arrays = [pa.array(column, kind) for column, kind in zip(columns, schema.types)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=schema))


def _boundaries(units, key):
    """Of each pattern, the slice in which the running sum of words passes its ``gap``, and the words before: ``{pattern: (slice, before)}``.

    Where the sum never passes, the slice is ``None`` and all words are before.
    """
    group = W.partitionBy("pattern")
    sums = units.groupBy("pattern", "gap", key).agg(F.sum("size").alias("words"))
    sums = sums.withColumns({"upto": F.sum("words").over(group.orderBy(key)), "all": F.sum("words").over(group)})
    passed = (F.col("upto") > F.col("gap")) & (F.col("upto") - F.col("words") <= F.col("gap"))
    never = (F.col("all") <= F.col("gap")) & (F.col("upto") == F.col("all"))
    found = sums.where(passed | never).collect()
    return {tuple(r["pattern"]): (r[key], r["upto"] - r["words"]) if r["upto"] > r["gap"] else (None, r["all"]) for r in found}


def _placed(rows):
    """``rows`` with their place in the seeded order (draws without sign), and its first ten and next ten bits."""
    return rows.withColumns(
        {
            "place": F.col("draw").bitwiseXOR(F.lit(LEAST)),
            "first_slice": F.shiftrightunsigned("draw", 54),
            "second_slice": F.shiftrightunsigned("draw", 44).bitwiseAND(F.lit(SLICES - 1)),
        }
    )


def _begin(first, second=0):
    """The place at which a slice begins."""
    return (first * SLICES + second << 44) + LEAST


def _go_down(units, state):
    """Takes units in the seeded order, each that fits the rest of its pattern's ``gap``.

    A unit that does not fit is passed over. Each round looks at the units after
    the last one walked that are no larger than the gap, takes what lies before
    the slice where their sum passes it, and walks on from there unit by unit.
    Ends where no unit is left that fits. What is taken of a pattern is all
    before its ``start``, its ``ranges`` ``(pattern, from, to, largest size)`` and its ``singles`` ``(pattern, draw)``.
    """
    spark = units.sparkSession
    ahead = lambda n: max(1, min(AHEAD, MOST_AHEAD // n))
    after = {pattern: (LEAST, MOST) for pattern, s in state.items() if s["gap"] > 0}
    while after:
        rows = [(list(p), at, limit, state[p]["gap"]) for p, (at, limit) in after.items()]
        fitting = units.join(_plan_frame(spark, rows, "at", "limit", "gap"), "pattern")
        fitting = fitting.where("place >= at AND size <= limit AND size > 0").drop("at", "limit", "gap")
        gaps = _plan_frame(spark, [(list(p), state[p]["gap"]) for p in after], "gap")
        firsts = {}
        for pattern, (first, before) in _boundaries(fitting.join(gaps, "pattern"), "first_slice").items():
            state[pattern]["gap"] -= before
            if first is None:
                state[pattern]["ranges"].append((list(pattern), after[pattern][0], MOST, after[pattern][1]))
            else:
                firsts[pattern] = first
        if not firsts:
            return
        rows = [(list(p), first, state[p]["gap"]) for p, first in firsts.items()]
        edge = fitting.join(_plan_frame(spark, rows, "first", "gap"), "pattern").where("first_slice = first")
        starts = {}
        for pattern, (second, before) in _boundaries(edge, "second_slice").items():
            state[pattern]["gap"] -= before
            starts[pattern] = _begin(firsts[pattern], second)
            at, limit = after[pattern]
            if limit == MOST:
                state[pattern]["start"] = starts[pattern]
            elif at < starts[pattern]:
                state[pattern]["ranges"].append((list(pattern), at, starts[pattern] - 1, limit))
        rows = [(list(p), firsts[p], start) for p, start in starts.items()]
        walk = fitting.join(_plan_frame(spark, rows, "first", "start"), "pattern").where("first_slice = first AND place >= start")
        n = ahead(len(starts))
        walk = walk.withColumn("nth", F.row_number().over(W.partitionBy("pattern").orderBy("place"))).where(F.col("nth") <= n)
        walked = {}
        for row in sorted(walk.select("pattern", "place", "draw", "size").collect(), key=lambda r: r["place"]):
            pattern = tuple(row["pattern"])
            walked.setdefault(pattern, []).append(row["place"])
            if row["size"] <= state[pattern]["gap"]:
                state[pattern]["gap"] -= row["size"]
                state[pattern]["singles"].append((list(pattern), row["draw"]))
        after = {}
        for pattern, places in walked.items():
            at = places[-1] + 1 if len(places) == n else _begin(firsts[pattern] + 1)
            if state[pattern]["gap"] > 0 and at <= MOST:
                after[pattern] = (at, state[pattern]["gap"])


def _taken(units, state):
    """``pattern, draw`` of the units taken by ``ranges`` and ``singles``."""
    ranges = [r for s in state.values() for r in s["ranges"]]
    singles = [r for s in state.values() for r in s["singles"]]
    if not ranges:
        return _plan_frame(units.sparkSession, singles, "draw")
    within = units.join(_plan_frame(units.sparkSession, ranges, "from", "to", "limit"), "pattern")
    within = within.where("place BETWEEN `from` AND `to` AND size <= limit AND size > 0").select("pattern", "draw")
    return saved(within.union(_plan_frame(units.sparkSession, singles, "draw")), "mixing-taken").distinct()


def _choose(units, wanted):
    """Of each pattern what is taken to come near the words ``wanted``, as ``_go_down`` describes it.

    The last rest is less than any unit left out; the smallest of these is taken
    if it comes nearer. If the rest is still a good deal and there are units
    smaller than it, long units were left out that the others cannot stand in
    for: the smallest of them is taken before all others, and so on.
    """
    spark, best, ahead = units.sparkSession, {}, {p: [] for p in wanted}
    while ahead:
        held = [(list(p), draw) for p, some in ahead.items() for _, draw in some]
        free = units.join(_plan_frame(spark, held, "draw"), ["pattern", "draw"], "left_anti") if held else units
        state = {
            p: {"gap": wanted[p] - sum(size for size, _ in some), "start": LEAST, "ranges": [], "singles": [(list(p), d) for _, d in some]}
            for p, some in ahead.items()
        }
        _go_down(free, state)
        rows = [(list(p), s["start"]) for p, s in state.items() if s["gap"] > 0]
        all_units = units.where("size > 0").join(_plan_frame(spark, rows, "start"), "pattern")
        all_units = all_units.join(_taken(units, state).withColumn("more", F.lit(1)), ["pattern", "draw"], "left")
        left = F.when(F.col("more").isNull() & (F.col("place") >= F.col("start")), F.struct("size", "draw"))
        rest = all_units.groupBy("pattern").agg(F.min(left).alias("next"), F.min("size").alias("least")) if rows else None
        rest = {tuple(r["pattern"]): r for r in rest.collect()} if rows else {}
        again = {}
        for pattern, s in state.items():
            off, row = s["gap"], rest.get(pattern)
            following = row["next"] if row else None
            if following and following["size"] < 2 * off:
                off = following["size"] - off
                s["singles"].append((list(pattern), following["draw"]))
            if pattern not in best or off < best[pattern]["off"]:
                best[pattern] = {**s, "off": off}
            some = [*ahead[pattern], (following["size"], following["draw"])] if following else []
            if following and off > NEAR * wanted[pattern] and off > row["least"] and sum(n for n, _ in some) <= wanted[pattern]:
                again[pattern] = some
        ahead = again
    return best


def choose_copies(sized, plan, most=MOST_COPIES):
    """A function that adds ``copies`` to rows with ``pattern`` and ``draw``; they bring ``sized`` near the words in ``plan``.

    ``sized`` has ``pattern, size, draw``; ``plan`` maps patterns to ``(words, words wanted)``. All documents get the
    whole copies; one copy more goes to documents in the order of their draws,
    each that fits what is still wanted (see ``_choose`` for the last rest).
    """
    spark = sized.sparkSession
    state = {}
    for pattern, (words, wanted) in plan.items():
        whole = min(most, wanted // words) if words else 0
        state[pattern] = {"whole": whole, "gap": wanted - whole * words, "start": LEAST, "ranges": [], "singles": []}
    # Rows of one draw are copies of one row and go together.
    units = _placed(saved(sized.groupBy("pattern", "draw").agg(F.sum("size").alias("size")), "mixing-units"))
    for pattern, found in _choose(units, {p: s["gap"] for p, s in state.items() if s["gap"] > 0}).items():
        state[pattern].update(found)
    starts = _plan_frame(spark, [(list(p), s["whole"], s["start"]) for p, s in state.items()], "whole", "start")
    taken = _taken(units, state)

    def add(rows):
        full = _placed(rows).join(starts, "pattern").join(taken.withColumn("more", F.lit(1)), ["pattern", "draw"], "left")
        more = F.when(F.col("place") < F.col("start"), 1).otherwise(F.coalesce("more", F.lit(0)))
        return full.select(*[full[c] for c in rows.columns], (F.col("whole") + more).cast("int").alias("copies"))

    return add


def sized_documents(docs, sources="source", seed=SEED):
    """``docs`` with ``size`` (words; null text: 0), ``pattern`` (its sources in order) and ``draw`` (seeded, by id and text).

    ``sources`` is a column with one source or an array of them.
    """
    own = F.col(sources) if docs.schema[sources].dataType.typeName() == "array" else F.array(F.col(sources))
    return docs.select(
        "*",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.array_sort(F.array_distinct(F.coalesce(own, F.array(F.lit(None).cast("string"))))).alias("pattern"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("draw"),
    )


def plan_mix(sized, weights=WEIGHTS, share=SHARE, most=MOST_COPIES):
    """``(sizes, goals, add)``: the words of each source, the words wanted of it, and what adds ``copies`` to rows."""
    found = sized.groupBy("pattern").agg(F.sum("size").alias("words")).limit(MOST_PATTERNS + 1).collect()
    if len(found) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} patterns of sources")
    found = sorted(found, key=lambda r: [(s is None, s or "") for s in r["pattern"]])
    patterns = {tuple(r["pattern"]): r["words"] for r in found}
    sizes = {}
    for pattern, words in patterns.items():
        for source in pattern:
            sizes[source] = sizes.get(source, 0) + words
    # Words that several sources share count once in the mix.
    wanted = targets(sizes, weights, share * sum(patterns.values()) / max(1, sum(sizes.values())), most)
    flows = route(patterns, wanted, most)
    add = choose_copies(sized, {p: (words, flows[p]) for p, words in patterns.items()}, most)
    return {p: sizes[p[0]] for p in patterns}, {p: wanted[p[0]] for p in patterns}, add


def mix(docs, sources="source", weights=WEIGHTS, share=SHARE, most=MOST_COPIES, seed=SEED):
    """One row per document: ``doc_id, pattern, size, source_size, target, copies, taken``.

    ``source_size`` and ``target`` are of the document's first source. Null
    texts have size 0 and are taken with whole copies only. A null source is a
    source of its own, last in order. Rows equal in id and text share their
    draw, and so their copies. Reruns agree. An empty table gives an empty one.
    Other columns are not read.
    """
    sized = sized_documents(docs.select("doc_id", "text", sources), sources, seed)
    sized = saved(sized.select("doc_id", "pattern", "size", "draw"), "mixing-sizes")
    sizes, goals, add = plan_mix(sized, weights, share, most)
    rows = [(list(p), sizes[p], float(goals[p])) for p in sizes]
    goals = _local_frame(docs.sparkSession, rows, {"source_size": pa.int64(), "target": pa.float64()})
    out = add(sized).join(F.broadcast(goals), "pattern")
    return out.select(
        "doc_id", "pattern", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_documents(docs, sources="source", weights=WEIGHTS, share=SHARE, most=MOST_COPIES, seed=SEED):
    """The mix itself: the rows of ``docs``, each as many times as it is taken, with its columns alone.

    What is taken is told by a row's own source and draw, so no text is shuffled.
    """
    names = {name: unused(f"mix_{name}", docs.columns) for name in docs.columns}
    plain = docs.select(*[docs[c].alias(n) for c, n in names.items()])
    keyed = sized_documents(plain.withColumns({c: F.col(names[c]) for c in ("doc_id", "text", sources)}), sources, seed)
    keep = [*names.values(), "pattern", "draw"]
    sized = saved(keyed.select("pattern", "size", "draw"), "mixing-sizes")
    _, _, add = plan_mix(sized, weights, share, most)
    taken = add(keyed.select(*keep)).where("copies > 0")
    taken = taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select(*[F.col(n).alias(c) for c, n in names.items()])
