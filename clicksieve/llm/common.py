"""What the operators share: words, inputs, tables written to the shared folder, worker caches."""

import ctypes
import gc
import re
import sys

import pyarrow as pa
from pyspark.sql import functions as F

from clicksieve.session import fresh_path

# White space of the word contracts, as Java and Python patterns read it.
WORD = r"[^\x20\x09-\x0D]+"
# What Python takes for white space beside those.
OTHER_SPACES = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
_words = re.compile(WORD).findall


def words_of(text):
    """The words of one text (``None``: none)."""
    if not text:
        return []
    return _words(text) if OTHER_SPACES(text) else text.split()


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df, name):
    """``df`` written once to the shared folder and read back.

    What follows reads the files, so it neither computes ``df`` again nor
    depends on executors that computed it. The folder is left to the owner of
    ``spark.checkpoint.dir`` to clear, as checkpoints are.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(name, columns):
    """``name``, or ``name`` with underscores before it until no column has it (case does not count)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def sample_of(df, key, rows):
    """About ``rows`` rows, chosen by a hash of ``key``, so that reruns choose the same ones.

    Above twice ``rows`` (chance, or one key on many rows) the rest is cut.
    """
    total = df.count()
    if total > rows:
        part = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1_000_000))
        df = df.where(part < int(1_000_000 * rows / total) + 1)
    return df.limit(2 * rows)


def worker_cache(name, build=dict):
    """An object that lives as long as the Python worker, whatever module or task asks for it."""
    caches = sys.__dict__.setdefault("_clicksieve_caches", {})
    if name not in caches:
        caches[name] = build()
    return caches[name]


def free_worker(keep=None):
    """Gives back what operators before this one left in the worker's caches (not the one named ``keep``)."""
    caches = sys.__dict__.get("_clicksieve_caches", {})
    others = [name for name in caches if name != keep]
    for name in others:
        del caches[name]
    if others:
        gc.collect()
    if others or keep not in caches:
        give_back()


def give_back():
    """Hands memory that was freed back to the system, which allocators otherwise keep for later."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def join_spans(spans, kinds):
    """``kind:start:end`` by start, then by the order of ``kinds``, joined by commas."""
    order = {kind: place for place, kind in enumerate(kinds)}
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted((a, order[k], b, k) for k, a, b in spans))


def shards(spark):
    """How many parts a job that deals rows by a key of its own should use."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

