"""Byte-level BPE encoding and decoding with a transducer.

A sequence of tokens is the BPE encoding of its bytes if and only if each two
neighbours are the encoding of their own bytes. So the encodings of all
prefixes are paths of a finite-state transducer that reads bytes and walks the
trie of the vocabulary: an item is the last token taken and the trie node of
the bytes after it. Sets of items with their pending tokens are the states of a
deterministic transducer, which is built as texts ask for it. It emits what all
items of a state agree on; the rest waits for some more bytes, never more than
the longest token has. Decoding runs an incremental UTF-8 machine.
"""

import base64
import hashlib
import marshal
import math
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicksieve.llm.common import free_worker, worker_cache

START = -1
MOST_STEPS = 500_000  # transitions kept; beyond that the machine is built anew
MOST_NEIGHBOURS = 300_000  # neighbours whose fit is remembered
MOST_JUMPS = 120_000  # steps over several bytes at once that are remembered
JUMP = 4
CACHED_PIECES = 300_000
BESIDE_OTHERS = 4  # in a job of several operators a worker remembers this part of all that
ROWS_AT_ONCE = 500
CHARS_AT_ONCE = 2_000_000
DECODED_AT_ONCE = 4096


def read_ranks(path):
    """Byte strings by rank of a rank file: a base64 text and a number per line."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    tokens = {int(rank): base64.b64decode(text) for text, rank in pairs}
    return [tokens.get(rank, b"") for rank in range(max(tokens) + 1)]


def merge_plainly(piece, ranks, below=math.inf):
    """BPE by definition: the neighbours with the lowest rank (under ``below``) merge first, the leftmost of equal ones."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        found = [(ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, at = min(((r, i) for r, i in found if r is not None and r < below), default=(None, 0))
        if rank is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class States:
    """Sets of items by number, each kept as bytes: a machine asks for the items of a state only to build a step from it."""

    def __init__(self):
        self.numbers, self.kept = {}, []

    def number(self, items):
        """The number of a state, which is a new one if the items are."""
        # Of this version equal items have equal bytes.
        data = marshal.dumps(items, 2)
        found = self.numbers.get(data)
        if found is None:
            found = self.numbers[data] = len(self.kept)
            self.kept.append(data)
        return found

    def __getitem__(self, state):
        return marshal.loads(self.kept[state])

    def __len__(self):
        return len(self.kept)


class Transducer:
    """Bytes to the bytes of token ids (u32)."""

    def __init__(self, tokens, part=1):
        self.tokens = tokens
        self.most_steps, self.most_neighbours, self.most_jumps = MOST_STEPS // part, MOST_NEIGHBOURS // part, MOST_JUMPS // part
        self.ranks = {token: rank for rank, token in enumerate(tokens) if token}
        self.child, self.token_at = {}, [None]
        for token, rank in self.ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                node = self.child.get(key)
                if node is None:
                    node = self.child[key] = len(self.token_at)
                    self.token_at.append(None)
            self.token_at[node] = rank
        self.fits, self.halves = {}, {}
        self.forget()

    def forget(self):
        """An empty machine with its first state."""
        self.items, self.ends, self.steps, self.jumps, self.packed = States(), {}, {}, {}, {}
        self.items.number(((START, 0, ()),))

    def end(self, state):
        """What is left to emit where a piece ends in a state."""
        found = self.ends.get(state)
        if found is None:
            whole = next(pending for _, node, pending in self.items[state] if node == 0)
            found = self.ends[state] = self.ids(whole)
        return found

    def ids(self, tokens):
        """Tokens as bytes; equal ones are one object."""
        found = self.packed.get(tokens)
        if found is None:
            found = self.packed[tokens] = struct.pack(f"<{len(tokens)}I", *tokens)
        return found

    def parts(self, token):
        """The two tokens whose merge is ``token``; ``()`` for a single byte, ``None`` if its bytes do not merge to it."""
        if token not in self.halves:
            data = self.tokens[token]
            own = merge_plainly(data, self.ranks, below=token)
            whole = len(own) == 2 and merge_plainly(data, self.ranks) == [token]
            self.halves[token] = () if len(data) == 1 else tuple(own) if whole else None
        return self.halves[token]

    def neighbours(self, last, token):
        """Whether ``last`` and ``token`` side by side are the encoding of their bytes."""
        if last == START:
            return self.parts(token) is not None
        key = last << 20 | token
        fit = self.fits.get(key)
        if fit is None:
            if len(self.fits) > self.most_neighbours:
                self.fits.clear()
            fit = self.fits[key] = self.stay_apart(last, token)
        return fit

    def stay_apart(self, left, right):
        """Whether no merge ever joins the end of ``left`` with the start of ``right``.

        Merges are undone from the last to the first: each time, the two tokens
        at the seam must not merge before the next one that did change them. Of
        merges of one rank the leftmost comes first.
        """
        if self.parts(left) is None or self.parts(right) is None:
            return False
        tokens, ranks, before = self.tokens, self.ranks, len(self.tokens)
        while True:
            if ranks.get(tokens[left] + tokens[right], before) < before:
                return False
            of_left, of_right = self.parts(left), self.parts(right)
            if of_left and (left > right or not of_right):
                before, left = left, of_left[1]
            elif of_right:
                before, right = right + 1, of_right[0]
            else:
                return True

    def advance(self, state, byte):
        """The transition of a state on a byte: the next state and what all its items agree on."""
        found = []
        for last, node, pending in self.items[state]:
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            found.append((last, node, pending))
            token = self.token_at[node]
            if token is not None and self.neighbours(last, token):
                found.append((token, 0, (*pending, token)))
        agreed = 0
        shortest = min(len(pending) for _, _, pending in found)
        while agreed < shortest and len({pending[agreed] for _, _, pending in found}) == 1:
            agreed += 1
        emitted = found[0][2][:agreed]
        items = tuple(sorted((last, node, pending[agreed:]) for last, node, pending in found))
        step = self.items.number(items), self.ids(emitted)
        self.steps[state << 8 | byte] = step
        return step

    def encode(self, piece):
        """The ids of one piece of text, as bytes."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return struct.pack("<I", whole)
        if len(self.steps) > self.most_steps:
            self.forget()
        jumps, state, out = self.jumps, 0, []
        whole = len(piece) // JUMP * JUMP
        for at in range(0, whole, JUMP):
            bytes_ = piece[at : at + JUMP]
            jump = jumps.get((state, bytes_))
            if jump is None:
                jump = self.walk(state, bytes_)
                if len(jumps) < self.most_jumps:
                    jumps[state, bytes_] = jump
            state, emitted = jump
            if emitted:
                out.append(emitted)
        if whole < len(piece):
            state, emitted = self.walk(state, piece[whole:])
            out.append(emitted)
        out.append(self.end(state))
        return b"".join(out)

    def walk(self, state, data):
        """From a state over some bytes, one by one: the state after them and what was emitted."""
        steps, out = self.steps, b""
        for byte in data:
            step = steps.get(state << 8 | byte)
            if step is None:
                step = self.advance(state, byte)
            state, emitted = step
            if emitted:
                out += emitted
        return state, out


class Encoder:
    """Texts to ids: pieces by the pattern, each through the transducer, with the frequent ones remembered.

    What is remembered, at most one ``part``-th of the bounds above, changes the time alone.
    """

    def __init__(self, tokens, pattern, part=1):
        import regex

        self.pieces = regex.compile(pattern).findall
        self.machine = Transducer(tokens, part)
        self.known, self.most_known = {}, CACHED_PIECES // part

    def encode(self, text):
        """The ids of a text as bytes (u32)."""
        return next(self.encode_all([text]))

    def encode_all(self, texts):
        """The ids of each text as bytes (u32).

        Pieces of several texts that are not remembered go through the machine
        once and in order, so that those with one start meet steps just built.
        """
        at = 0
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and held < CHARS_AT_ONCE:
                held += len(texts[end])
                end += 1
            yield from self._encode_some(texts[at:end])
            at = end

    def _encode_some(self, texts):
        known, texts = self.known, list(map(self.pieces, texts))
        found = [list(map(known.get, pieces)) for pieces in texts]
        missing = [(pieces, ids) for pieces, ids in zip(texts, found) if None in ids]
        new = {p for pieces, ids in missing for p, i in zip(pieces, ids) if i is None}
        encode = self.machine.encode
        new = {p: encode(p.encode("utf-8")) for p in sorted(new)}
        for pieces, ids in missing:
            ids[:] = [new[p] if i is None else i for p, i in zip(pieces, ids)]
        if len(known) < self.most_known:
            known.update(new)
        return list(map(b"".join, found))


# The UTF-8 machine: from each state, the ranges of bytes that lead on. State 0 is between characters.
UTF8_STEPS = {
    0: [(0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5), (0xEE, 0xEF, 2),
        (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7)],
    1: [(0x80, 0xBF, 0)],
    2: [(0x80, 0xBF, 1)],
    3: [(0x80, 0xBF, 2)],
    4: [(0xA0, 0xBF, 1)],
    5: [(0x80, 0x9F, 1)],
    6: [(0x90, 0xBF, 2)],
    7: [(0x80, 0x8F, 2)],
}
UTF8_NEXT = {
    (state, byte): after for state, ranges in UTF8_STEPS.items() for low, high, after in ranges for byte in range(low, high + 1)
}


class Utf8Stream:
    """Bytes in, text out: characters whose bytes are not all there wait for the next call."""

    def __init__(self):
        self.waiting = b""

    def feed(self, data):
        data = self.waiting + data
        cut = len(data)
        for start in range(max(0, cut - 3), cut):
            state = 0
            for byte in data[start:]:
                state = UTF8_NEXT.get((state, byte)) if state is not None else None
            # The bytes from a first byte on are the start of a character that is not complete.
            if state and data[start] >= 0xC2:
                cut = start
                break
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self):
        text, self.waiting = self.waiting.decode("utf-8", "replace"), b""
        return text


def decode_stream(ids, tokens):
    """Pieces of text for a sequence of ids, as they become complete."""
    stream = Utf8Stream()
    for start in range(0, len(ids), DECODED_AT_ONCE):
        yield stream.feed(b"".join([tokens[i] for i in ids[start : start + DECODED_AT_ONCE]]))
    yield stream.finish()


def _shipped(spark, path, pattern):
    """The vocabulary, read on the driver and sent to the workers once; its size does not depend on the data."""
    return spark.sparkContext.broadcast((hashlib.sha256((path + pattern).encode()).hexdigest(), read_ranks(path), pattern))


def _encoder(shipped, part=1):
    """The worker's encoder; what other operators left goes before one is built."""
    name, tokens, pattern = shipped.value
    own = ("byte-bpe", name, part)
    free_worker(keep=own)
    return worker_cache(own, lambda: Encoder(tokens, pattern, part))


def text_column(spark, ids, path):
    """The text of an array of ids (null: null); bytes that are no UTF-8 become U+FFFD."""
    shipped = _shipped(spark, path, "")

    def run(columns):
        tokens = shipped.value[1]
        return pd.Series([None if ids is None else "".join(decode_stream(ids, tokens)) for ids in columns], dtype=object)

    return F.pandas_udf(lambda columns: run(columns), "string").asNondeterministic()(ids)


def encode_documents(docs, path, pattern):
    """All columns of ``docs`` with ``ids`` (in place of a column of that name).

    Null and empty texts have no ids. Rows are encoded each by itself, so
    repeated rows give repeated results and an empty table an empty one. Rows
    leave in short batches, which bounds what a task holds, and workers
    remember little, as this is one step among others in a job.
    """
    shipped = _shipped(docs.sparkSession, path, pattern)
    plain = docs.drop("ids")

    def run(batches):
        encoder = _encoder(shipped, BESIDE_OTHERS)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                found = list(encoder.encode_all([text or "" for text in part.column("text").to_pylist()]))
                ends = np.cumsum([0, *map(len, found)], dtype=np.int64) // 4
                values = pa.array(np.frombuffer(b"".join(found), dtype="<i4"))
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*part.schema.names, "ids"])

    schema = T.StructType([*plain.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return plain.mapInArrow(run, schema)


def round_trip(docs, path, pattern):
    """Encodes each document and decodes its ids again: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    The digests are of the ids as little-endian u32, and of the decoded text's
    bytes. Null texts count as empty. Other columns are not read.
    """
    shipped = _shipped(docs.sparkSession, path, pattern)

    def run(texts):
        encoder, tokens, rows = _encoder(shipped), shipped.value[1], []
        for data in encoder.encode_all([text or "" for text in texts]):
            ids = np.frombuffer(data, dtype="<u4").tolist()
            digest = hashlib.sha256()
            for piece in decode_stream(ids, tokens):
                digest.update(piece.encode("utf-8"))
            rows.append((len(ids), hashlib.sha256(data).hexdigest(), digest.hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    made = F.pandas_udf(lambda texts: run(texts), fields).asNondeterministic()(F.col("text"))
    return docs.select("doc_id", made.alias("made")).select("doc_id", "made.*")
