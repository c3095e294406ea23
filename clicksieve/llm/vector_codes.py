"""Vector codes: each part of a vector as the number of its nearest codebook entry, in exact integer arithmetic.

Components become integers. Distances come from dot products of vectors and
codebook entries, taken by the matrix product of BLAS over limbs: every integer
is cut into digits of ``LIMB_BITS`` bits (the highest one keeps the sign), so
that no sum of products of digits reaches 2**53 and each product is exact in
double precision. The digits' products are then put together in 64-bit
integers, or in Python's where a distance may not fit in 64 bits.

Codebooks are fitted by whole passes over all vectors: each task adds up, per
entry, the digits of what it assigned to it, and only these sums are shuffled.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from clicksieve.llm.common import saved
from clicksieve.operators.skew import splittable

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
# With 12 bits the products of parts of up to 2**28 components stay below 2**53, so the width follows from no data.
LIMB_BITS = 12
LIMB = float(2**LIMB_BITS)
COMPONENTS_AT_ONCE = 1 << 21
MOST_LONG = 2**63 - 1


def limbs_of(values, count):
    """Integer-valued doubles as ``count`` arrays of digits, the lowest first; only the highest can be negative."""
    digits = []
    for _ in range(count - 1):
        high = np.floor(values / LIMB)
        digits.append(values - high * LIMB)
        values = high
    return [*digits, values]


def limb_count(largest):
    """How many digits hold integers of up to ``largest``, so that the highest one is below ``LIMB`` too."""
    return max(2, -(-int(largest).bit_length() // LIMB_BITS))


def exact_products(left, right, wide):
    """``left @ right.T`` of arrays given by their digits: 64-bit integers, or Python's if ``wide``."""
    rows = len(right[0])
    digits = np.concatenate(right).T
    total = 0
    for i, own in enumerate(left):
        every = own @ digits
        for j in range(len(right)):
            part = every[:, j * rows : (j + 1) * rows].astype(np.int64)
            total = total + (part.astype(object) if wide else part) * (1 << LIMB_BITS * (i + j))
    return total


def exact_squares(digits, wide):
    """The sum of squares of each row."""
    total = 0
    for i, a in enumerate(digits):
        for j, b in enumerate(digits):
            part = np.einsum("ij,ij->i", a, b).astype(np.int64)
            total = total + (part.astype(object) if wide else part) * (1 << LIMB_BITS * (i + j))
    return total


class Codebooks:
    """Per part a list of entries, each a tuple of integers; ``limbs`` is how many digits any component takes."""

    def __init__(self, entries, limbs):
        self.entries, self.limbs = entries, limbs
        self.digits = [limbs_of(np.array(part, dtype=np.float64), limbs) for part in entries]
        size = len(entries[0][0])
        # Every distance is at most size * (2 * largest) ** 2.
        self.wide = size * 4 * (1 << 2 * LIMB_BITS * limbs) > MOST_LONG
        self.squares = [exact_squares(part, self.wide) for part in self.digits]

    def assign(self, values):
        """``(codes, errors, digits)``: per row and part the first nearest entry; the squared distances, summed over parts; each part's digits."""
        size = len(self.entries[0][0])
        codes = np.empty((len(values), len(self.entries)), dtype=np.int64)
        errors, parts = 0, []
        for number, (entries, squares) in enumerate(zip(self.digits, self.squares)):
            own = limbs_of(values[:, number * size : (number + 1) * size], self.limbs)
            far = exact_squares(own, self.wide)[:, None] - 2 * exact_products(own, entries, self.wide) + squares[None, :]
            best = far.argmin(axis=1)
            codes[:, number] = best
            errors = errors + far[np.arange(len(values)), best]
            parts.append(own)
        return codes, errors, parts

    def moved(self, sums, counts):
        """New codebooks from each entry's summed components and count; entries nothing was assigned to stay."""
        entries = [
            [
                tuple(s // counts[p, k] for s in sums[p, k]) if counts.get((p, k)) else entry
                for k, entry in enumerate(part)
            ]
            for p, part in enumerate(self.entries)
        ]
        return Codebooks(entries, self.limbs)

    def sha256(self):
        """Of all components in decimal, by part, entry and position."""
        text = ",".join(str(int(x)) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(text.encode()).hexdigest()

    def decode(self, code, scale=SCALE):
        """The vector a code stands for."""
        return [x / scale for p, part in enumerate(self.entries) for x in part[int(code[2 * p : 2 * p + 2], 16)]]


def usable(vectors, name="embedding", parts=PARTS):
    """``(rows, size, largest)``: ``vec_id, label, vector`` (doubles) of the rows that get a code, their length and largest size.

    Null vectors and those that hold a null or a number that is not finite take
    no part. Vectors of one table have one length: the most frequent one that
    ``parts`` divides (ties: the smallest). Others have no such parts and take
    no part either.
    """
    vector = F.transform(F.col(name), lambda x: x.cast("double"))
    good = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.col("label") if "label" in [c.lower() for c in vectors.columns] else F.lit(None).cast("int")
    rows = vectors.select(F.col("vec_id"), label.alias("label"), vector.alias("vector"))
    rows = rows.where("vector IS NOT NULL").where(good)
    size = F.size("vector")
    largest = F.greatest(F.array_max("vector"), -F.array_min("vector"))
    lengths = rows.where((size > 0) & (size % parts == 0)).groupBy(size.alias("size"))
    common = lengths.agg(F.count("*").alias("n"), F.max(largest).alias("largest")).orderBy(F.desc("n"), "size").first()
    if common is None:
        return rows.limit(0), 0, 0.0
    return rows.where(size == common["size"]), common["size"], common["largest"]


def components(batch, scale):
    """The integers of the vectors of an Arrow batch, in blocks of bounded size: ``(from, to, values)``."""
    column = batch.column(batch.schema.get_field_index("vector"))
    if not len(column):
        return
    flat = column.flatten().to_numpy(zero_copy_only=False)
    size = len(flat) // len(column)
    step = max(1, COMPONENTS_AT_ONCE // size)
    for start in range(0, len(column), step):
        stop = min(len(column), start + step)
        yield start, stop, np.floor(flat[start * size : stop * size].reshape(-1, size) * scale)


def _sums(books, scale):
    """A task's digit sums and counts per part and entry."""

    def run(batches):
        size, n_parts = len(books.entries[0][0]), len(books.entries)
        n_entries = len(books.entries[0])
        sums = np.zeros((n_parts, n_entries, books.limbs, size), dtype=np.int64)
        counts = np.zeros((n_parts, n_entries), dtype=np.int64)
        for batch in batches:
            for _, _, values in components(batch, scale):
                codes, _, parts = books.assign(values)
                for p, digits in enumerate(parts):
                    chosen = (codes[:, p, None] == np.arange(n_entries)).astype(np.float64)
                    counts[p] += chosen.sum(axis=0).astype(np.int64)
                    for limb, own in enumerate(digits):
                        sums[p, :, limb] += (chosen.T @ own).astype(np.int64)
        used = np.argwhere(counts > 0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(p) for p, _ in used], pa.int32()),
                pa.array([int(k) for _, k in used], pa.int32()),
                pa.array([int(counts[p, k]) for p, k in used], pa.int64()),
                pa.array([sums[p, k].ravel().tolist() for p, k in used], pa.list_(pa.int64())),
            ],
            names=["part", "entry", "members", "sums"],
        )

    return run


def fit(rows, size, largest, parts=PARTS, entries=ENTRIES, rounds=ROUNDS, scale=SCALE):
    """Codebooks from ``rounds`` passes over ``rows`` (of :func:`usable`); ``None`` if there are no rows.

    They start from the first ``entries`` rows by ``vec_id`` (null ids last;
    rows of one id by their vectors), or all rows if there are fewer. Only the
    sums of entries reach the driver, whose number is that of the codebooks.
    """
    order = [F.col("vec_id").asc_nulls_last(), "vector"]
    first = [r["vector"] for r in rows.select("vec_id", "vector").orderBy(*order).limit(entries).collect()]
    if not first:
        return None
    width = size // parts
    first = [[int(np.floor(x * float(scale))) for x in v] for v in first]
    limbs = limb_count(int(largest * scale) + 1)
    books = Codebooks([[tuple(v[p * width : (p + 1) * width]) for v in first] for p in range(parts)], limbs)
    for _ in range(rounds):
        made = rows.select("vector").mapInArrow(_sums(books, scale), "part int, entry int, members long, sums array<long>")
        digit = made.select("part", "entry", "members", F.posexplode("sums").alias("place", "value"))
        added = digit.groupBy("part", "entry", "place").agg(F.sum("members").alias("members"), F.sum("value").alias("value"))
        sums, counts = {}, {}
        for row in added.collect():
            entry = row["part"], row["entry"]
            counts[entry] = row["members"]
            limb, place = divmod(row["place"], width)
            sums.setdefault(entry, [0] * width)[place] += row["value"] << LIMB_BITS * limb
        books = books.moved(sums, counts)
    return books


def encode(rows, books, scale=SCALE):
    """``vec_id, label, code, error`` of each of ``rows`` (of :func:`usable`); an error above the largest long is that long."""
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"vec_id {fields['vec_id']}, label {fields['label']}, code string, error long"

    def run(batches):
        for batch in batches:
            codes, errors = [], []
            for _, _, values in components(batch, scale):
                some, far, _ = books.assign(values)
                text, width = some.astype(np.uint8).tobytes().hex(), 2 * some.shape[1]
                codes += [text[i : i + width] for i in range(0, len(text), width)]
                errors += [min(int(x), MOST_LONG) for x in far] if books.wide else far.tolist()
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("vec_id", "label")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"]
            )

    return rows.mapInArrow(run, schema)


def compress(vectors, name="embedding", parts=PARTS, entries=ENTRIES, rounds=ROUNDS, scale=SCALE):
    """One row per usable vector: ``vec_id, code, error, label_error, codebooks_sha256``.

    ``code`` holds two hex digits a part, ``error`` the squared distance to the
    coded vector in units of ``1 / scale``, ``label_error`` its sum over the
    rows of the same label (null labels together; a sum above the largest long
    is that long). Repeated rows are rows each. Rows that :func:`usable` leaves
    out are not in the result; a null ``vec_id`` stays, and starts no entry
    before other ids. Of equally near entries the first counts. A table without
    usable rows gives an empty result. Other columns are not read.
    """
    if entries > 256:
        raise ValueError("two hex digits name at most 256 entries")
    rows, size, largest = usable(vectors, name, parts)
    books = fit(rows, size, largest, parts, entries, rounds, scale) if size else None
    if books is None:
        empty = F.lit(None).cast("string")
        long = F.lit(None).cast("long")
        return rows.select("vec_id", empty.alias("code"), long.alias("error"), long.alias("label_error"), empty.alias("codebooks_sha256"))
    coded = saved(encode(rows, books, scale), "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(20,0)")), F.lit(MOST_LONG).cast("decimal(20,0)")).cast("long")
    # Null labels are one group, told from empty ones; a label on very many rows is split by the join.
    coded = coded.withColumns({"unlabelled": F.col("label").isNull(), "label": F.coalesce(F.col("label").cast("string"), F.lit(""))})
    by_label = coded.groupBy("label", "unlabelled").agg(total.alias("label_error"))
    coded, by_label, on = splittable(coded, by_label, ["label", "unlabelled"])
    joined = coded.join(by_label, on)
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def oracle(parts=PARTS, entries=ENTRIES, rounds=ROUNDS, scale=SCALE):
    """SQL for :func:`compress` over ``embeddings``, in whole numbers throughout."""
    distance = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for number in range(rounds + 1):
        steps.append(f"""
a{number} AS MATERIALIZED (
  SELECT rn, p, min({{'far': {distance}, 'k': k}}) AS best FROM parts JOIN b{number} USING (p) GROUP BY rn, p
)""")
        if number < rounds:
            steps.append(f"""
m{number} AS (
  SELECT p, k, list(c ORDER BY i) AS c FROM (
    SELECT p, k, i, (s - ((s % n) + n) % n) // n AS c FROM (
      SELECT p, a.best.k AS k, i, sum(v[i]) AS s, count(*) AS n
      FROM parts JOIN a{number} a USING (rn, p), width, range(1, w + 1) AS places(i) GROUP BY ALL
    )
  ) GROUP BY p, k
), b{number + 1} AS MATERIALIZED (
  SELECT p, k, coalesce(m.c, b.c) AS c FROM b{number} b LEFT JOIN m{number} m USING (p, k)
)""")
    return f"""
WITH finite AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(embedding) > 0 AND len(embedding) % {parts} = 0
), common AS (
  SELECT len(e) AS size FROM finite GROUP BY size ORDER BY count(*) DESC, size LIMIT 1
), width AS (
  SELECT CAST(size // {parts} AS BIGINT) AS w FROM common
), kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(e, lambda x: CAST(floor({scale} * x) AS HUGEINT)) AS e,
    row_number() OVER (ORDER BY vec_id NULLS LAST, e) AS rn
  FROM finite JOIN common ON len(e) = size
), parts AS MATERIALIZED (
  SELECT rn, p, e[p * w + 1 : (p + 1) * w] AS v FROM kept, width, range({parts}) AS numbers(p)
), b0 AS (
  SELECT p, rn - 1 AS k, v AS c FROM parts WHERE rn <= {entries}
), {", ".join(steps)}, coded AS (
  SELECT rn, string_agg(printf('%02x', best.k), '' ORDER BY p) AS code, CAST(sum(best.far) AS BIGINT) AS error
  FROM a{rounds} GROUP BY rn
), books AS (
  SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(x AS VARCHAR)), ','), ',' ORDER BY p, k)) AS codebooks_sha256
  FROM b{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rn), books
"""
