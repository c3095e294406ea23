import base64
import hashlib
import os
import random
import sys
import tracemalloc

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from cases import awkward_rows, clashing, documents, empty, rows_of

from clicksieve.llm import byte_bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(tokens):
    draw = random.Random(1)
    for _ in range(3000):
        kind = draw.random()
        if kind < 0.3:
            yield "".join(draw.choice("abcabcde  aa'st\n09") for _ in range(draw.randint(0, 40)))
        elif kind < 0.6:
            yield "".join(chr(draw.choice([draw.randint(32, 126), draw.randint(0xA0, 0x2000), draw.randint(0x4E00, 0x9FFF), 0x1F600])) for _ in range(20))
        else:
            yield "".join(draw.choice(tokens).decode("utf-8", "ignore") for _ in range(draw.randint(1, 6)))


def test_ids_are_those_of_the_library(library):
    tokens = byte_bpe.read_ranks(PATH)
    encoder = byte_bpe.Encoder(tokens, P.PATTERN)
    for text in [*odd_texts(tokens), *[t for _, t, *_ in awkward_rows() if t]]:
        ids = np.frombuffer(encoder.encode(text), dtype="<u4").tolist()
        assert ids == library.encode_ordinary(text), text
        assert "".join(byte_bpe.decode_stream(ids, tokens)) == text


def test_a_forgetful_machine_is_right_too(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MOST_STEPS", 50)
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 5)
    tokens = byte_bpe.read_ranks(PATH)
    encoder = byte_bpe.Encoder(tokens, P.PATTERN)
    for text in list(odd_texts(tokens))[:300]:
        assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == library.encode_ordinary(text)


def test_tokens_leave_before_the_piece_ends():
    """Of a long piece most tokens are emitted while it is read: what waits is bounded."""
    machine = byte_bpe.Transducer(byte_bpe.read_ranks(PATH))
    state, waits = 0, 0
    for byte in b"antidisestablishmentarianism" * 20:
        state, _ = machine.steps.get(state << 8 | byte) or machine.advance(state, byte)
        waits = max(waits, max(len(p) for _, _, p in machine.items[state]))
    assert waits < 10


def test_streams_of_bytes_decode_as_a_whole():
    for _ in range(500):
        data = os.urandom(40)
        stream = byte_bpe.Utf8Stream()
        assert "".join(stream.feed(data[i : i + 1]) for i in range(40)) + stream.finish() == data.decode("utf-8", "replace")


def test_awkward_rows(spark, library):
    found = byte_bpe.round_trip(documents(spark), PATH, P.PATTERN)
    expected = []
    for doc_id, text, *_ in awkward_rows():
        ids = np.array(library.encode_ordinary(text or ""), dtype="<u4").tobytes()
        expected.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert rows_of(found) == sorted(tuple(map(repr, e)) for e in expected)
    assert rows_of(found) == rows_of(byte_bpe.round_trip(clashing(spark), PATH, P.PATTERN))
    assert byte_bpe.round_trip(empty(spark), PATH, P.PATTERN).count() == 0
    again = byte_bpe.encode_documents(clashing(spark), PATH, P.PATTERN)
    texts = again.select("text", byte_bpe.text_column(spark, again["ids"], PATH).alias("back")).collect()
    assert all((r["text"] or "") == r["back"] for r in texts)


def test_neighbours_stay_apart_as_plain_merges_say():
    machine = byte_bpe.Transducer(byte_bpe.read_ranks(PATH))
    draw = random.Random(8)
    every = [rank for rank, token in enumerate(machine.tokens) if token]
    short = [rank for rank in every if len(machine.tokens[rank]) < 4]
    for turn in range(20_000):
        left, right = draw.choice(short if turn % 2 else every), draw.choice(short if turn % 3 else every)
        plain = byte_bpe.merge_plainly(machine.tokens[left] + machine.tokens[right], machine.ranks)
        assert machine.stay_apart(left, right) == (plain == [left, right])


def test_an_encoder_beside_others_holds_little(library):
    """On texts of ever new words, whatever their number, and with the same ids."""
    draw = random.Random(5)
    tokens = byte_bpe.read_ranks(PATH)
    texts = [" ".join("".join(draw.choice("aeioudfklmnrst\u00e9\u00df") for _ in range(9)) for _ in range(300)) for _ in range(150)]
    rows = iter([pa.RecordBatch.from_pydict({"text": texts})])
    byte_bpe.free_worker()
    shipped = type("Shipped", (), {"value": ("test", tokens, P.PATTERN)})
    byte_bpe.worker_cache("left by another operator")
    tracemalloc.start()
    try:
        encoder = byte_bpe._encoder(shipped, byte_bpe.BESIDE_OTHERS)
        found = list(encoder.encode_all(next(rows).column("text").to_pylist()))
        held = tracemalloc.get_traced_memory()[0] / 1e6
    finally:
        tracemalloc.stop()
    assert [np.frombuffer(ids, dtype="<u4").tolist() for ids in found] == [library.encode_ordinary(t) for t in texts]
    assert held < 80 and byte_bpe._encoder(shipped, byte_bpe.BESIDE_OTHERS) is encoder
    assert "left by another operator" not in sys.__dict__["_clicksieve_caches"]
    byte_bpe.free_worker()
