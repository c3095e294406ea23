"""Quality rules with thresholds that adapt to each language and source.

Per language, source and measure, the values are summarised in a mergeable
quantile sketch: counts of logarithmic buckets of fixed relative width, which
merge by addition. Its quartiles give the fences beyond which a document is an
outlier among its own kind; small groups use the merged sketch of their
language, or of all documents. Documents are then joined to their group's
thresholds and filtered.
"""

import math

import pandas as pd
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clicksieve.llm.common import saved, unused, words_of

# The base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 10
MOST_REPEATED = 20
RUN = 5

BASE_FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
# Of each measure: numerator, denominator, and the least distance of a fence from its quartile. A group without
# spread must not reject what deviates by little.
MEASURES = {
    "word_length": ("word_chars", "n_words", 2.0),
    "symbols": ("n_symbols", "n_words", 0.1),
    "dup_lines": ("n_dup_lines", "n_words", 0.05),
    "repeats": ("n_repeat_words", "n_words", 0.1),
}
TWO_SIDED = ["word_length"]
GAMMA = 1.02  # buckets are 2 % wide: quantiles err by 1 % at most
FENCE = 3.0
LEAST_GROUP = 200
SALTS = 64


def repeated_words(words):
    """How many words lie in windows of five words that the text has twice or more."""
    n = len(words) - RUN + 1
    if n < 2:
        return 0
    runs = list(zip(*(words[i:] for i in range(RUN))))
    if len(set(runs)) == n:
        return 0
    seen = {}
    for run in runs:
        seen[run] = seen.get(run, 0) + 1
    total, reach = 0, 0
    for start, run in enumerate(runs):
        if seen[run] > 1:
            total += start + RUN - max(start, reach)
            reach = start + RUN
    return total


def measures_of(text):
    """The base counts of one text (``None``: all zero)."""
    if not text:
        return 0, 0, 0, 0, 0
    words = words_of(text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dups += 1
        elif line.strip("\x20\x09\x0b\x0c\x0d"):
            seen.add(line)
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), dups, repeated_words(words)


def measured(text):
    """A struct of the base counts for a text column."""

    def run(texts):
        return pd.DataFrame([measures_of(t) for t in texts], columns=[f.split()[0] for f in BASE_FIELDS.split(", ")])

    return F.pandas_udf(lambda texts: run(texts), BASE_FIELDS).asNondeterministic()(text)


def base_failed(stats):
    """The fixed base rules on the counts."""
    return (stats["n_words"] < LEAST_WORDS) | (100 * stats["n_repeat_words"] > MOST_REPEATED * stats["n_words"])


def bucket(value):
    """The sketch's bucket of a value; zero has the lowest."""
    return F.when(value <= 0, F.lit(-100_000)).otherwise(F.ceil(F.log(value) / math.log(GAMMA))).cast("int")


def value_of(bucket_column):
    """The middle of a bucket."""
    return F.when(bucket_column == -100_000, 0.0).otherwise(
        F.lit(2 / (GAMMA + 1)) * F.pow(F.lit(GAMMA), bucket_column.cast("double"))
    )


def sketches(rows):
    """Counts per language, source, measure and bucket: what merges by addition."""
    values = [
        F.struct(F.lit(name).alias("measure"), bucket(F.col(a) / F.col(b)).alias("bucket"))
        for name, (a, b, _) in MEASURES.items()
    ]
    cells = rows.where("n_words > 0").select("lang", "source", F.explode(F.array(*values)).alias("cell"))
    return cells.groupBy("lang", "source", "cell.measure", "cell.bucket").agg(F.count("*").alias("rows"))


def quartiles(counts, keys):
    """The first and third quartile and the size of each merged sketch."""
    merged = counts.groupBy(*keys, "measure", "bucket").agg(F.sum("rows").alias("rows"))
    group = W.partitionBy(*keys, "measure")
    below = F.sum("rows").over(group.orderBy("bucket"))
    cells = merged.select("*", below.alias("below"), F.sum("rows").over(group).alias("size"))
    at = lambda q: F.min(F.when(F.col("below") > F.floor(q * (F.col("size") - 1)), F.col("bucket")))
    return cells.groupBy(*keys, "measure").agg(
        F.max("size").alias("size"), value_of(at(0.25)).alias("q1"), value_of(at(0.75)).alias("q3")
    )


def thresholds(counts, least_group=LEAST_GROUP, fence=FENCE):
    """Per language and source, a low and a high limit for each measure, one row per group."""
    own = quartiles(counts, ["lang", "source"])
    by_lang = quartiles(counts, ["lang"]).select(
        F.col("lang").alias("l_lang"), F.col("measure").alias("l_measure"), F.struct("size", "q1", "q3").alias("of_lang")
    )
    by_all = quartiles(counts, []).select(F.col("measure").alias("a_measure"), F.struct("size", "q1", "q3").alias("of_all"))
    found = own.join(by_lang, (F.col("lang").eqNullSafe(F.col("l_lang"))) & (F.col("measure") == F.col("l_measure")))
    found = found.join(by_all, F.col("measure") == F.col("a_measure"))
    used = (
        F.when(F.col("size") >= least_group, F.struct("size", "q1", "q3"))
        .when(F.col("of_lang.size") >= least_group, F.col("of_lang"))
        .otherwise(F.col("of_all"))
    )
    found = found.select("lang", "source", "measure", used.alias("used"))
    limits = []
    for name, (_, _, least) in MEASURES.items():
        q1, q3 = F.col("used.q1"), F.col("used.q3")
        reach = F.lit(fence) * F.greatest(q3 - q1, F.lit(least))
        of = lambda limit: F.max(F.when(F.col("measure") == name, limit))
        limits.append(of(q3 + reach).alias(f"high_{name}"))
        if name in TWO_SIDED:
            limits.append(of(q1 - reach).alias(f"low_{name}"))
    return found.groupBy("lang", "source").agg(*limits)


def verdicts(rows, least_group=LEAST_GROUP, fence=FENCE, salts=SALTS):
    """``rows`` (counts with ``doc_id, lang, source``) with ``base_failed`` and ``kept``.

    Each group's thresholds are repeated ``salts`` times and its rows dealt over
    the copies, so that a group with a third of all rows is not one task.
    """
    limits = thresholds(sketches(rows), least_group, fence)
    limits = limits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    limits = limits.withColumnsRenamed({"lang": "t_lang", "source": "t_source", "salt": "t_salt"})
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(salts)).cast("int"))
    # A null language or source is a group of its own; eqNullSafe is a hash join key.
    same = (
        F.col("lang").eqNullSafe(F.col("t_lang"))
        & F.col("source").eqNullSafe(F.col("t_source"))
        & (F.col("salt") == F.col("t_salt"))
    )
    joined = rows.join(limits, same, "left")
    passes = F.lit(True)
    for name, (a, b, _) in MEASURES.items():
        value = F.col(a) / F.col(b)
        passes = passes & (value <= F.col(f"high_{name}"))
        if name in TWO_SIDED:
            passes = passes & (value >= F.col(f"low_{name}"))
    failed = base_failed(joined)
    return joined.withColumn("base_failed", failed).withColumn("kept", F.when(failed, False).otherwise(F.coalesce(passes, F.lit(False))))


def judge(docs, **options):
    """One row per document: ``doc_id``, the base counts, ``base_failed`` and ``kept``.

    ``docs`` has ``doc_id, text, lang, source``; other columns are not read.
    Null and empty texts have no words and fail the base rules. A null language
    or source forms a group like any other. Repeated rows count each and get
    equal verdicts; values equal to a limit pass. An empty table gives an empty
    one.
    """
    rows = docs.select("doc_id", "lang", "source", measured(F.col("text")).alias("m")).select("doc_id", "lang", "source", "m.*")
    rows = verdicts(saved(rows, "quality-measures"), **options)
    return rows.select("doc_id", *[f.split()[0] for f in BASE_FIELDS.split(", ")], "base_failed", "kept")


def filter_quality(docs, **options):
    """The documents that are kept, with all their columns; documents are told apart by ``doc_id`` and their whole text."""
    digest = unused("text_digest", docs.columns)
    keyed = docs.withColumn(digest, F.sha2(F.coalesce("text", F.lit("")), 256))
    rows = keyed.select("doc_id", "lang", "source", digest, measured(F.col("text")).alias("m"))
    rows = saved(rows.select("doc_id", "lang", "source", F.col(digest).alias("digest"), "m.*"), "quality-measures")
    kept = verdicts(rows, **options).where("kept").select(F.col("doc_id").alias("k_doc"), F.col("digest").alias("k_digest"), F.col("lang").alias("k_lang"), F.col("source").alias("k_source")).distinct()
    same = [keyed[a].eqNullSafe(kept[b]) for a, b in (("doc_id", "k_doc"), (digest, "k_digest"), ("lang", "k_lang"), ("source", "k_source"))]
    on = same[0]
    for part in same[1:]:
        on = on & part
    return keyed.join(kept, on, "left_semi").drop(digest)


def oracle():
    """The same in SQL."""
    values = " UNION ALL ".join(
        f"SELECT doc_id, lang, source, '{name}' AS measure, {a} / {b} AS v FROM s WHERE n_words > 0"
        for name, (a, b, _) in MEASURES.items()
    )
    least = " ".join(f"WHEN '{name}' THEN {least}" for name, (_, _, least) in MEASURES.items())
    high = ", ".join(f"max(CASE WHEN measure = '{n}' THEN q3 + reach END) AS high_{n}" for n in MEASURES)
    low = ", ".join(f"max(CASE WHEN measure = '{n}' THEN q1 - reach END) AS low_{n}" for n in TWO_SIDED)
    tests = " AND ".join(
        [f"{a} / n_words <= high_{n}" for n, (a, _, _) in MEASURES.items()]
        + [f"{MEASURES[n][0]} / n_words >= low_{n}" for n in TWO_SIDED]
    )

    def quartile_sql(keys):
        part = ", ".join([*keys, "measure"])
        return f"""
  SELECT {part}, any_value(size) AS size,
    min(mid) FILTER (below > floor(0.25 * (size - 1))) AS q1, min(mid) FILTER (below > floor(0.75 * (size - 1))) AS q3
  FROM (SELECT {part}, CASE WHEN bucket = -100000 THEN 0 ELSE {2 / (GAMMA + 1)!r} * pow({GAMMA}, bucket) END AS mid,
      sum(n) OVER (PARTITION BY {part} ORDER BY bucket) AS below, sum(n) OVER (PARTITION BY {part}) AS size
    FROM (SELECT {part}, bucket, sum(n) AS n FROM sketch GROUP BY {part}, bucket))
  GROUP BY {part}"""

    return rf"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), runs AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS r FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)
), twice AS (
  SELECT doc_id, r FROM runs GROUP BY doc_id, r HAVING count(*) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS p FROM runs JOIN twice USING (doc_id, r)) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), s AS (
  SELECT d.doc_id, lang, source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), sketch AS (
  SELECT lang, source, measure, CASE WHEN v <= 0 THEN -100000 ELSE ceil(ln(v) / {math.log(GAMMA)!r}) END AS bucket, count(*) AS n
  FROM ({values}) GROUP BY ALL
), own AS ({quartile_sql(["lang", "source"])}
), of_lang AS ({quartile_sql(["lang"])}
), of_all AS ({quartile_sql([])}
), used AS (
  SELECT o.lang, o.source, o.measure,
    CASE WHEN o.size >= {LEAST_GROUP} THEN o.q1 WHEN l.size >= {LEAST_GROUP} THEN l.q1 ELSE a.q1 END AS q1,
    CASE WHEN o.size >= {LEAST_GROUP} THEN o.q3 WHEN l.size >= {LEAST_GROUP} THEN l.q3 ELSE a.q3 END AS q3
  FROM own o JOIN of_lang l ON o.measure = l.measure AND o.lang IS NOT DISTINCT FROM l.lang JOIN of_all a ON o.measure = a.measure
), reached AS (
  SELECT *, {FENCE} * greatest(q3 - q1, CASE measure {least} END) AS reach FROM used
), limits AS (
  SELECT lang, source, {high}, {low} FROM reached GROUP BY lang, source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {LEAST_WORDS} OR {100} * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND coalesce({tests}, false) AS kept
FROM s LEFT JOIN limits ON s.lang IS NOT DISTINCT FROM limits.lang AND s.source IS NOT DISTINCT FROM limits.source
"""
