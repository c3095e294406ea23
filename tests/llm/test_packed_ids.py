import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import awkward_rows, clashing, documents, empty, rows_of
from tokenizers import Tokenizer

from clicksieve.llm import packed_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("bits", [1, 2, 7, 15, 16, 17, 31, 32])
@pytest.mark.parametrize("count", [0, 1, 63, 64, 65, 1000])
def test_packing_is_a_round_trip(bits, count):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, count, dtype=np.uint64).astype(np.uint32)
    data = packed_ids.pack(ids, bits)
    assert len(data) == -(-count // 64) * 8 * bits
    assert (packed_ids.unpack(data, bits, count) == ids).all()


class Sized(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_random_access_reads_one_document():
    draw = np.random.default_rng(2)
    docs = [draw.integers(0, 50_000, n, dtype=np.uint32) for n in (0, 1, 5000, 3, 9000, 0, 2)]
    file = Sized()
    writer = packed_ids.PackedWriter(file, 16)
    for number, ids in enumerate(docs):
        writer.add(None if number == 0 else number, ids)
    writer.close()
    reader = packed_ids.PackedReader(file)
    for place in draw.permutation(len(docs)):
        assert (reader.document(place) == docs[place]).all()
    assert reader.nulls.tolist() == [True] + [False] * 6


def test_words_encode_as_whole_texts_do():
    with open(PATH, encoding="utf-8") as file:
        encoder = packed_ids.WordEncoder(file.read())
    library = Tokenizer.from_file(PATH)
    odd = ["It's DON'T we'LL 'S", "ΑΣ ΣΑΣ İx é é", "<|endoftext|>a <|ENDOFTEXT|>", "a\x1cb c d", "x1y22--z!?", "", None, "漢字 ｆｕｌｌ"]
    odd += [t for _, t, *_ in awkward_rows() if t and len(t) < 10_000]
    for text, data in zip(odd, encoder.encode_all(odd)):
        assert np.frombuffer(data, dtype="<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def test_files_hold_what_the_library_gives(spark):
    rows = [r for r in awkward_rows() if r[0] is not None]
    found = packed_ids.packed_round_trip(documents(spark, rows), PATH).orderBy("start").collect()
    library, start, expected = Tokenizer.from_file(PATH), 0, []
    for doc_id, text, *_ in sorted(rows, key=lambda r: r[0]):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        expected.append((doc_id, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
    assert [r["doc_id"] for r in found] == [e[0] for e in expected]
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == sorted(expected)
    for row in found:
        assert row["start"] == start
        start += row["n_tokens"]


def test_awkward_rows(spark):
    found = packed_ids.packed_round_trip(documents(spark), PATH)
    assert found.count() == documents(spark).count()
    assert rows_of(found) == rows_of(packed_ids.packed_round_trip(clashing(spark), PATH))
    assert packed_ids.packed_round_trip(empty(spark), PATH).count() == 0


def test_words_of_letters_go_to_the_library_in_lines():
    """Distinct words of many texts are a few inputs of the library, and their ids are those of the words alone."""
    with open(PATH, encoding="utf-8") as file:
        encoder = packed_ids.WordEncoder(file.read())
    draw = random.Random(7)
    words = sorted({"".join(draw.choice("abcdefgstz\xdf\xe9\xf1\xc9Z") for _ in range(draw.randint(1, 9))) for _ in range(6000)})
    counts = []

    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, texts, **options):
            counts.append(len(texts))
            return self.tokenizer.encode_batch_fast(texts, **options)

    library, encoder.tokenizer = encoder.tokenizer, Counting(encoder.tokenizer)
    if hasattr(encoder, "letters"):
        encoder.letters = Counting(encoder.letters)
    texts = [" ".join(words[i : i + 100]) for i in range(0, len(words), 100)] * 2
    for text, ids in zip(texts, encoder.encode_all(texts)):
        assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert sum(counts) < len(words) // 100


def test_blocks_of_a_file_may_be_packed_together():
    ids = np.random.default_rng(4).integers(0, 1 << 17, 5 * packed_ids.BLOCK + 77, dtype=np.uint32)
    apart = b"".join(packed_ids.pack(ids[i : i + packed_ids.BLOCK], 17) for i in range(0, len(ids), packed_ids.BLOCK))
    file = Sized()
    writer = packed_ids.PackedWriter(file, 17)
    writer.add(3, ids)
    writer.close()
    assert file.getvalue().startswith(apart)
    reader = packed_ids.PackedReader(file)
    assert reader.n_blocks == 6 and (reader.document(0) == ids).all() and (reader.blocks(5, 6) == ids[5 * packed_ids.BLOCK :]).all()
