"""Token ids in bit-packed files.

A file holds blocks of ``BLOCK`` ids, each id in as many bits as the vocabulary
needs, and after them the offset of each block, the documents and a trailer:

    blocks | block offsets (u64) | first id of each document and the end (u64)
    | doc ids (i64) | null marks (u8) | n_blocks, n_docs, n_ids (u64), bits, BLOCK (u32), magic (8 bytes)

All numbers are little-endian. 64 ids of b bits fill b words of 64 bits, so
packing and unpacking are 64 shifts of whole arrays.
"""

import json
import os
import re
import struct
import uuid
import zlib
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clicksieve.llm.common import saved, worker_cache
from clicksieve.session import fresh_path

MAGIC = b"PACKIDS1"
TRAILER = "<QQQII8s"
BLOCK = 4096
GROUP = 64
CHUNK_BLOCKS = 64
PACKED_AT_ONCE = 16  # blocks
CACHED_WORDS = 800_000
CACHED_RUNS = 400_000
ENCODED_AT_ONCE = 20_000
RUNS_IN_LINE = 1_000
CHARS_AT_ONCE = 8_000_000
# Words of ASCII and Latin letters, how the vocabulary splits them in lower case, and runs of letters alone.
PLAIN = re.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch
RUNS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+").findall
LETTERS = re.compile("[a-z\xdf-\xf6\xf8-\xff]+").fullmatch


def pack(ids, bits):
    """Bytes of ``ids`` at ``bits`` bits each, filled up with zeros to a multiple of 64 ids."""
    rows = -(-len(ids) // GROUP)
    lanes = np.zeros(rows * GROUP, dtype=np.uint64)
    lanes[: len(ids)] = ids
    lanes = lanes.reshape(rows, GROUP)
    words = np.zeros((rows, bits), dtype="<u8")
    for lane in range(GROUP):
        word, shift = divmod(lane * bits, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.tobytes()


def unpack(data, bits, count):
    """The first ``count`` ids of packed bytes."""
    words = np.frombuffer(data, dtype="<u8").reshape(-1, bits)
    lanes = np.empty((len(words), GROUP), dtype=np.uint64)
    for lane in range(GROUP):
        word, shift = divmod(lane * bits, 64)
        lanes[:, lane] = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            lanes[:, lane] |= words[:, word + 1] << np.uint64(64 - shift)
    return (lanes & np.uint64((1 << bits) - 1)).ravel()[:count].astype(np.uint32)


class PackedWriter:
    """Writes documents one after another; what it keeps in memory is a few blocks and the document table."""

    def __init__(self, out, bits):
        self.out, self.bits = out, bits
        self.waiting, self.held, self.at, self.total = [], 0, 0, 0
        self.offsets, self.starts, self.doc_ids, self.nulls = [], [0], [], []

    def add(self, doc_id, ids):
        self.doc_ids.append(0 if doc_id is None else doc_id)
        self.nulls.append(doc_id is None)
        self.total += len(ids)
        self.starts.append(self.total)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= PACKED_AT_ONCE * BLOCK:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // BLOCK * BLOCK
            for start in range(0, whole, PACKED_AT_ONCE * BLOCK):
                self._blocks(ids[start : min(whole, start + PACKED_AT_ONCE * BLOCK)])
            self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def _blocks(self, ids):
        """Whole blocks, or the last ones of a file, of which one may be short."""
        data = pack(ids, self.bits)
        self.offsets += range(self.at, self.at + len(data), BLOCK // GROUP * self.bits * 8)
        self.out.write(data)
        self.at += len(data)

    def close(self):
        if self.held:
            self._blocks(np.concatenate(self.waiting))
        for values, kind in ((self.offsets, "<u8"), (self.starts, "<u8"), (self.doc_ids, "<i8"), (self.nulls, "u1")):
            self.out.write(np.array(values, dtype=kind).tobytes())
        self.out.write(
            struct.pack(TRAILER, len(self.offsets), len(self.doc_ids), self.total, self.bits, BLOCK, MAGIC)
        )


class PackedReader:
    """Random access to a file: the document table is read at once, blocks when they are asked for."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        end = size - struct.calcsize(TRAILER)
        file.seek(end)
        self.n_blocks, self.n_docs, self.n_ids, self.bits, self.block, magic = struct.unpack(TRAILER, file.read(size - end))
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")
        table = 8 * self.n_blocks + 8 * (self.n_docs + 1) + 9 * self.n_docs
        self.end = end - table
        file.seek(self.end)
        data = file.read(table)
        at = 8 * self.n_blocks
        self.offsets = np.frombuffer(data[:at], dtype="<u8").astype(np.int64)
        self.starts = np.frombuffer(data[at : at + 8 * (self.n_docs + 1)], dtype="<u8").astype(np.int64)
        at += 8 * (self.n_docs + 1)
        self.doc_ids = np.frombuffer(data[at : at + 8 * self.n_docs], dtype="<i8")
        self.nulls = np.frombuffer(data[at + 8 * self.n_docs :], dtype="u1").astype(bool)

    def blocks(self, first, last):
        """The ids of blocks ``first`` to ``last - 1``."""
        if first >= last:
            return np.zeros(0, dtype=np.uint32)
        start = self.offsets[first]
        stop = self.offsets[last] if last < self.n_blocks else self.end
        self.file.seek(int(start))
        data = self.file.read(int(stop - start))
        return unpack(data, self.bits, min(last * self.block, self.n_ids) - first * self.block)

    def document(self, place):
        """The ids of the document at ``place``."""
        start, stop = int(self.starts[place]), int(self.starts[place + 1])
        first = start // self.block
        ids = self.blocks(first, -(-stop // self.block))
        return ids[start - first * self.block : stop - first * self.block]


class WordEncoder:
    """Words to the bytes of their ids (u32), by the tokenizers library.

    The vocabulary drops white space, and none of its steps looks across it, so
    a text's ids are those of its words one after another. It also lowers case
    and encodes runs of letters, digits and marks each by itself, so the ids of
    a plain word are those of its lower-case runs. The distinct words of some
    texts are encoded once, and words and runs are remembered as long as there
    is room; words that are not plain, or may hold a special token, are encoded
    whole. Runs of letters need none of the library's steps before the merges,
    so many stand in one line, and the vocabulary marks the last token of each.
    """

    def __init__(self, text_json):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text_json)
        whole = json.loads(text_json)
        whole["normalizer"] = None
        whole["pre_tokenizer"] = {
            "type": "Sequence",
            "pretokenizers": [
                {"type": "WhitespaceSplit"},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
            ],
        }
        self.letters = Tokenizer.from_str(json.dumps(whole))
        vocabulary, mark = self.tokenizer.get_vocab(True), whole["model"].get("end_of_word_suffix")
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        if mark:
            self.last[[number for token, number in vocabulary.items() if token.endswith(mark)]] = True
        self.words, self.runs = {}, {}

    def _library(self, texts):
        for start in range(0, len(texts), ENCODED_AT_ONCE):
            part = texts[start : start + ENCODED_AT_ONCE]
            for text, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                yield text, struct.pack(f"<{len(found.ids)}I", *found.ids)

    def _letters(self, runs):
        """The ids of runs of letters, by run."""
        for start in range(0, len(runs), RUNS_IN_LINE):
            part = runs[start : start + RUNS_IN_LINE]
            line = self.letters.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0]
            ids = np.array(line.ids, dtype="<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(part):
                yield from self._library(part)
                continue
            data, ends = ids.tobytes(), (4 * ends).tolist()
            for run, low, high in zip(part, [0, *ends], ends):
                yield run, data[low:high]

    def learn(self, words):
        """The ids of ``words`` by word; what there is room for is remembered."""
        # Words that are one run, or are encoded whole, have no list of their own.
        single, split, letters, others, runs = {}, {}, set(), set(), self.runs
        for w in words:
            if not PLAIN(w) or "<|" in w:
                single[w] = w
                others.add(w)
                continue
            low = w.lower()
            if LETTERS(low):
                single[w] = low
                letters.add(low)
            else:
                split[w] = RUNS(low)
        for r in set(chain.from_iterable(split.values())):
            (letters if LETTERS(r) else others).add(r)
        known = {r: runs[r] for part in (letters, others) for r in part if r in runs}
        new = dict(self._letters([r for r in letters if r not in known]))
        new.update(self._library([r for r in others if r not in known]))
        if len(runs) < CACHED_RUNS:
            runs.update(new)
        known.update(new)
        found = {w: known[r] for w, r in single.items()}
        for w, own in split.items():
            found[w] = b"".join([known[r] for r in own])
        if len(self.words) < CACHED_WORDS:
            self.words.update(found)
        return found

    def encode_all(self, texts):
        """The ids of each text (u32)."""
        texts, at = [t or "" for t in texts], 0
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and held < CHARS_AT_ONCE:
                held += len(texts[end])
                end += 1
            yield from self._encode_some(texts[at:end])
            at = end

    def _encode_some(self, texts):
        words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        bounds = words.offsets.to_numpy()
        words = words.flatten().dictionary_encode()
        which, distinct = words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.words.get, distinct))
        new = [w for w, ids in zip(distinct, found) if ids is None]
        if new:
            new = self.learn(new)
            found = [new[w] if ids is None else ids for w, ids in zip(distinct, found)]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(found), dtype="<u4")
        # Each word's ids stand where those of the words before it end.
        lengths = sizes[which]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = ids[np.repeat(starts[which] - ends[:-1], lengths) + np.arange(ends[-1])]
        return np.split(ids, ends[bounds[1:-1]])


def write_shards(docs, folder, tokenizer_json, end_id):
    """Writes ``docs`` in doc_id order as one file per partition; returns the manifest ``shard, path, n_docs, n_ids``.

    Files have names of their own per task attempt, and only those of attempts
    that succeeded are in the manifest.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(tokenizer_json)
    where, base = fs.FileSystem.from_uri(folder)
    where.create_dir(base, recursive=True)

    def run(frames):
        from tokenizers import Tokenizer

        encoder = worker_cache(("packed", hash(shipped.value)), lambda: WordEncoder(shipped.value))
        bits = worker_cache(
            ("bits", hash(shipped.value)),
            lambda: max(1, (max(Tokenizer.from_str(shipped.value).get_vocab(True).values())).bit_length()),
        )
        store, base = fs.FileSystem.from_uri(folder)
        shard = TaskContext.get().partitionId()
        path = f"{base}/ids-{shard:06d}-{uuid.uuid4().hex}"
        out = writer = None
        for frame in frames:
            if writer is None and len(frame):
                out = store.open_output_stream(path)
                writer = PackedWriter(out, bits)
            for doc_id, null, ids in zip(frame["doc_id"], frame["no_id"], encoder.encode_all(frame["text"])):
                writer.add(None if null else int(doc_id), np.append(ids, np.uint32(end_id)))
        if writer:
            writer.close()
            out.close()
            yield pd.DataFrame([(shard, path, len(writer.doc_ids), writer.total)], columns=["shard", "path", "n_docs", "n_ids"])

    rows = docs.select(
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "text"
    )
    # Ties are ordered by their texts, so that rows with one id, or none, are spread over partitions too.
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = [F.col("no_id").desc(), F.col("doc_id"), F.col("tie")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return saved(rows.mapInPandas(run, "shard int, path string, n_docs long, n_ids long"), "packed-manifest")


def read_shards(manifest, folder):
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``; ``start`` counts the ids of all files before."""
    before = F.sum("n_ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    files = manifest.select("path", F.coalesce(before, F.lit(0)).alias("base"))

    def run(frames):
        store, _ = fs.FileSystem.from_uri(folder)
        for frame in frames:
            for path, base in zip(frame["path"], frame["base"]):
                with store.open_input_file(path) as file:
                    reader = PackedReader(file)
                    crc = np.zeros(reader.n_docs, dtype=np.int64)
                    for first in range(0, reader.n_blocks, CHUNK_BLOCKS):
                        ids = reader.blocks(first, min(reader.n_blocks, first + CHUNK_BLOCKS))
                        low, high = first * reader.block, first * reader.block + len(ids)
                        data = memoryview(ids.astype("<u4").tobytes())
                        one = int(np.searchsorted(reader.starts, low, side="right")) - 1
                        end = int(np.searchsorted(reader.starts, high, side="left"))
                        for place in range(one, end):
                            a, b = max(low, reader.starts[place]) - low, min(high, reader.starts[place + 1]) - low
                            crc[place] = zlib.crc32(data[4 * int(a) : 4 * int(b)], int(crc[place]))
                    yield pd.DataFrame(
                        {
                            "doc_id": pd.array(reader.doc_ids, dtype="Int64"),
                            "start": reader.starts[:-1] + base,
                            "n_tokens": np.diff(reader.starts),
                            "ids_crc32": crc,
                        }
                    ).assign(doc_id=lambda d: d["doc_id"].mask(reader.nulls))

    # A fixed number of partitions: adaptive execution would merge the few short rows into one task.
    files = files.repartition(max(1, min(manifest.count(), 100_000)))
    return files.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_packed(docs, tokenizer_json, end_id=1, folder=None):
    """``(manifest, folder)`` of ``docs`` (``doc_id, text``) encoded and written in doc_id order.

    Null texts are empty and hold ``end_id`` alone. Null ids come first. Rows
    that share an id are ordered by a hash of their texts; repeated rows stand
    side by side. An empty table has no files. Other columns are not read.
    """
    folder = folder or fresh_path(docs.sparkSession, "packed-ids")
    return write_shards(docs, folder, tokenizer_json, end_id), folder


def packed_round_trip(docs, tokenizer_path, end_id=1):
    """Writes the ids of all documents and reads the files back: one row per document."""
    with open(tokenizer_path, encoding="utf-8") as file:
        manifest, folder = write_packed(docs, file.read(), end_id)
    return read_shards(manifest, folder)
