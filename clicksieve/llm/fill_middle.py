"""Fill-in-middle: a text cut into prefix, middle and suffix at unit ends, and put together in another order.

A unit is a line with its end. The text's UTF-8 bytes are divided into fixed
blocks; Fenwick trees over the blocks hold how many units end and how many code
points start in each. To find the end of the k-th unit, a descent by binary
lifting finds the block it lies in, and only that block is searched. The code
points before a cut are a prefix sum of the other tree and a count in that
block. So cuts need neither a list of the lines nor a decoded copy of the text.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


BLOCK = 4096
UNIT_END = 0x0A
# The marks of the three pieces, and the salt of the drawn numbers.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SALT = "7:"
PLAIN, PSM, SPM = "plain", "psm", "spm"
DRAWS = 4


class Fenwick:
    """Prefix sums over blocks, as a binary indexed tree (numbers from 1; ``tree[0]`` is unused)."""

    def __init__(self, counts):
        self.size = len(counts)
        sums = np.zeros(self.size + 1, dtype=np.int64)
        np.cumsum(counts, out=sums[1:])
        numbers = np.arange(self.size + 1)
        # A node holds the sum of the blocks its lowest bit spans.
        self.tree = sums - sums[numbers - (numbers & -numbers)]
        self.total = int(sums[-1])
        self.highest = 1 << max(0, self.size.bit_length() - 1)

    def before(self, block):
        """The sum of the blocks in front of ``block`` (numbered from 0)."""
        total = 0
        while block:
            total += int(self.tree[block])
            block &= block - 1
        return total

    def descend(self, rank):
        """``(block, rest)``: the block that holds the ``rank``-th item (from 1), and its rank among that block's items."""
        at, step = 0, self.highest
        while step:
            ahead = at + step
            if ahead <= self.size and self.tree[ahead] < rank:
                at, rank = ahead, rank - int(self.tree[ahead])
            step >>= 1
        return at, rank


class Units:
    """The units and code points of one text, given as UTF-8."""

    def __init__(self, data, block=BLOCK):
        self.bytes, self.block = np.frombuffer(data, dtype=np.uint8), block
        starts = np.arange(0, max(1, len(self.bytes)), block)
        if len(self.bytes):
            ends = np.add.reduceat(self.bytes == UNIT_END, starts, dtype=np.int64)
            points = np.add.reduceat((self.bytes & 0xC0) != 0x80, starts, dtype=np.int64)
        else:
            ends = points = np.zeros(1, dtype=np.int64)
        self.ends, self.points = Fenwick(ends), Fenwick(points)
        open_end = len(self.bytes) > 0 and self.bytes[-1] != UNIT_END
        self.count = self.ends.total + int(open_end)

    def cut(self, units):
        """``(bytes, code points)`` in the first ``units`` units."""
        if units == 0:
            return 0, 0
        if units > self.ends.total:
            return len(self.bytes), self.points.total
        block, rank = self.ends.descend(units)
        start = block * self.block
        inside = self.bytes[start : start + self.block]
        size = int(np.flatnonzero(inside == UNIT_END)[rank - 1]) + 1
        return start + size, self.points.before(block) + int(((inside[:size] & 0xC0) != 0x80).sum())


def arrange(text, draws, rate=100, spm=50, block=BLOCK):
    """``(n, form, prefix_chars, middle_chars, output)`` of a text, by four drawn numbers."""
    data = text.encode("utf-8", "surrogatepass")
    units = Units(data, block)
    n = units.count
    if not n or PREFIX in text or SUFFIX in text or MIDDLE in text or draws[2] % 100 >= rate:
        return n, PLAIN, None, None, text
    first, last = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    (a, a_points), (b, b_points) = units.cut(first), units.cut(last)
    prefix, middle, suffix = [p.decode("utf-8", "surrogatepass") for p in (data[:a], data[a:b], data[b:])]
    if draws[3] % 100 < spm:
        form, output = SPM, "".join([SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle])
    else:
        form, output = PSM, "".join([PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle])
    return n, form, a_points, b_points - a_points, output


def drawn(doc_id, salt=SALT):
    """Four numbers from a hash of a row's id (a null id: of the salt alone), as an array column."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    parts = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(DRAWS)]
    return F.array(*parts)


def transform(docs, rate=100, spm=50, salt=SALT, block=BLOCK, name="text"):
    """``docs`` with the column ``fim``: a struct ``n, form, prefix_chars, middle_chars, output``.

    ``rate`` per cent of the texts are cut (by the third number), and ``spm`` per
    cent of those have the suffix first (by the fourth). A null text counts as
    empty. Empty texts, and texts that hold one of the marks, stay plain. A text
    without a line end is one unit, and blank lines are units too. Cuts may
    coincide with each other or with an end of the text, so pieces may be empty.
    Repeated rows come out alike, as draws depend on ``doc_id`` only; rows without
    an id share one draw. An empty table gives an empty one. All other columns,
    whatever their names, are kept; a column ``fim`` is replaced.
    """
    schema = "n long, form string, prefix_chars long, middle_chars long, output string"

    def run(texts, draws):
        rows = [arrange(text, some, rate, spm, block) for text, some in zip(texts, draws)]
        frame = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
        return frame.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    # The lambda leaves the function's own types out of what Spark makes of them.
    made = F.pandas_udf(lambda texts, draws: run(texts, draws), schema)
    text = F.coalesce(F.col(name), F.lit(""))
    return docs.withColumn("fim", made(text, drawn(docs["doc_id"], salt)))


def restored(form, output):
    """The text that an output was made from: a column, from the columns of :func:`transform`.

    No mark is in a cut text, and none can arise where a piece meets a mark, so the first of each kind is the one put there.
    """
    cut = lambda after, upto: F.substring_index(F.substring_index(output, after, -1), upto, 1)
    psm = F.concat(cut(PREFIX, SUFFIX), F.substring_index(output, MIDDLE, -1), cut(SUFFIX, MIDDLE))
    spm = F.concat(cut(PREFIX, MIDDLE), F.substring_index(output, MIDDLE, -1), cut(SUFFIX, PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def digests(docs):
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of each document."""
    rows = transform(docs.select("doc_id", "text")).select("doc_id", "fim.*")
    back = restored(F.col("form"), F.col("output"))
    hashes = [F.sha2(text, 256).alias(f"{name}_sha256") for name, text in (("output", F.col("output")), ("restored", back))]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashes)


ORACLE = f"""
WITH texts AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS text,
    sha256('{SALT}' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT *, string_split(text, chr(10)) AS lines,
    CAST('0x' || h[1:8] AS UBIGINT) AS h1, CAST('0x' || h[9:16] AS UBIGINT) AS h2,
    CAST('0x' || h[17:24] AS UBIGINT) AS h3, CAST('0x' || h[25:32] AS UBIGINT) AS h4
  FROM texts
), counted AS (
  SELECT *, CAST(len(lines) - CASE WHEN lines[-1] = '' THEN 1 ELSE 0 END AS BIGINT) AS n FROM drawn
), formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
      OR h3 % 100 >= 100 THEN '{PLAIN}' WHEN h4 % 100 < 50 THEN '{SPM}' ELSE '{PSM}' END AS form
  FROM counted
), cut AS (
  SELECT *,
    CASE WHEN a = 0 THEN '' WHEN a < len(lines) THEN array_to_string(lines[1:a], chr(10)) || chr(10) ELSE text END AS upto_a,
    CASE WHEN b = 0 THEN '' WHEN b < len(lines) THEN array_to_string(lines[1:b], chr(10)) || chr(10) ELSE text END AS upto_b
  FROM formed
), pieces AS (
  SELECT *, upto_a AS prefix, substr(upto_b, length(upto_a) + 1) AS middle, substr(text, length(upto_b) + 1) AS suffix FROM cut
), made AS (
  SELECT *, CASE form WHEN '{PLAIN}' THEN text
    WHEN '{PSM}' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
    ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END AS output
  FROM pieces
)
SELECT doc_id, n, form,
  CASE WHEN form <> '{PLAIN}' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> '{PLAIN}' THEN length(middle) END AS middle_chars,
  sha256(output) AS output_sha256, sha256(text) AS restored_sha256
FROM made
"""
