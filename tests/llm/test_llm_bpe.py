"""Chunked BPE against the library's own encoding of whole texts."""

import hashlib
import os
import random
import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))

from llm_fixtures import SCHEMA, awkward_rows, empty  # noqa: E402

from lakevault.llm import chunkbpe  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
# what could make words depend on each other: marks, ligatures, other white space, special strings, apostrophes
ODD = ["́", "é", "ﬁ", " ", "\x85", "\xa0", "　", "\x1c", "​", "\x00", "\U0001f600", "日本", "İ",
       "Σ", "가", "가", "<|endoftext|>", "<|startoftext|>", "<|endof", "text|>", "'s", "'ll", "it's", "DON'T", "123", "$%", "\r\n",
       "\t", "\x0b", "\x0c", "\n\n", "  ", "end.", "é.", "İ.", "a.́", "?!", "x,", "Σ;"]


@pytest.fixture(scope="module")
def spec():
    with open(PATH, encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_text(rng, n, blanks=0.8):
    words = ["alpha", "Beta", "gamma-ray", "x"]
    return "".join(rng.choice(ODD if rng.random() < 0.4 else words) + (" " if rng.random() < blanks else "") for _ in range(n))


@pytest.mark.parametrize("blanks", [0.9, 0.3, 0.0])
def test_joins_of_shared_chunks_equal_the_library(spec, library, blanks):
    rng = random.Random(int(blanks * 10))
    coder = chunkbpe.WordCoder(spec)
    for n in (0, 1, 50, 3000, 12_000):
        raw = odd_text(rng, n, blanks).encode()
        chunks = chunkbpe.chunks_of(raw)
        assert b"".join(chunks) == raw and all(0 < len(c) <= chunkbpe.MOST for c in chunks)
        shared = {}
        for c in chunks:
            c.decode()  # cut between characters
            part = chunkbpe.inner_part(c)
            if part and rng.random() < 0.8:
                shared[hashlib.sha256(c).digest()] = coder.encode_part(c[part[0] : part[1]])
        ids, texts = coder.encode([chunkbpe.text_parts(raw, shared), chunkbpe.text_parts(raw, {})])
        want = library.encode(raw.decode(), add_special_tokens=False).ids
        assert ids.to_pylist() == [want, want]
        assert texts.to_pylist() == [library.decode(want, skip_special_tokens=False)] * 2


def test_cuts_are_those_of_the_plain_hash():
    rng = random.Random(4)
    raw = bytes(rng.randrange(32, 127) for _ in range(40_000))
    value = [int(v) for v in chunkbpe._VALUES]
    asked = []
    for end in range(chunkbpe.WINDOW, len(raw)):
        h = 0
        for b in raw[end - chunkbpe.WINDOW : end]:
            h = (h * chunkbpe._FACTOR + value[b]) & 0xFFFFFFFFFFFFFFFF
        if (h >> 40) % chunkbpe.MEAN == 0:  # MEAN is a power of two
            asked.append(end)
    data = np.frombuffer(raw, np.uint8)
    assert asked and chunkbpe._hash_cuts(data, 0, len(raw)).tolist() == asked
    halves = [*chunkbpe._hash_cuts(data, 0, 20_000), *chunkbpe._hash_cuts(data, 20_000, len(raw))]
    assert halves == asked  # slabs find the same cuts


def rows_with_passages():
    rng = random.Random(9)
    passage = " ".join(rng.choice(["shared", "passage", "of", "many", "texts"]) + str(rng.randint(0, 99)) for _ in range(1500))
    rows = awkward_rows()
    for i in range(200, 230):
        text = odd_text(rng, rng.randint(0, 400)) + passage + odd_text(rng, rng.randint(0, 400))
        rows.append((i, text, "en", "s", len(text), "x", 1, 2, "y", 3))
    copies = [(None if k % 5 == 0 else 300 + k, passage, "en", "s", 1, "x", 1, 2, "y", 3) for k in range(40)]
    return rows + copies + copies[:3]


def test_documents_equal_the_library(spark, spec, library):
    rows = rows_with_passages()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = chunkbpe.encoding_digests(chunkbpe.encode_documents(docs, spec)).collect()
    want = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_real_outputs_and_no_rows(spark, spec, library):
    docs = spark.createDataFrame([(1, "Hello <|endoftext|> it's"), (2, None)], "doc_id bigint, text string")
    got = {r.id: (r.ids, r.decoded) for r in chunkbpe.encode_documents(docs, spec).collect()}
    ids = library.encode("Hello <|endoftext|> it's", add_special_tokens=False).ids
    assert got == {1: (ids, library.decode(ids, skip_special_tokens=False)), 2: ([], "")}
    assert chunkbpe.encode_documents(empty(spark), spec).count() == 0


class Counted:
    """A tokenizer that notes how many words each call gets."""

    def __init__(self, tokenizer):
        self.tokenizer, self.calls = tokenizer, []

    def encode_batch_fast(self, words, **options):
        self.calls.append(len(words))
        return self.tokenizer.encode_batch_fast(words, **options)


def test_encodings_of_many_distinct_words_are_not_held_together(spec, library):
    coder = chunkbpe.WordCoder(spec)
    coder.tokenizer = counted = Counted(coder.tokenizer)
    text = " ".join(f"w{i}x{i * 7 % 1000}" for i in range(3 * chunkbpe.TOGETHER))
    ids, _ = coder.encode([[text.encode()]])
    assert ids.to_pylist() == [library.encode(text, add_special_tokens=False).ids]
    assert max(counted.calls) <= chunkbpe.TOGETHER < sum(counted.calls)


def test_long_words_leave_the_cache(spec, library):
    coder = chunkbpe.WordCoder(spec)
    for k in range(6):
        text = " ".join(f"{k}a{i}" + "ab" * 50_000 for i in range(20))
        ids, _ = coder.encode([[text.encode()]])
    assert ids.to_pylist() == [library.encode(text, add_special_tokens=False).ids]
    assert sum(map(len, coder.known)) <= chunkbpe.LETTERS_KEPT + len(text)


def test_rows_of_one_long_text_leave_in_bounded_batches(spec, library):
    rng = random.Random(3)
    long = " ".join(rng.choice(["some", "words", "of", "a", "text."]) + str(rng.randint(0, 9)) for _ in range(20_000))
    texts = ["a first text", *[long] * 200, "another text", ""]
    press = zstandard.ZstdCompressor()
    packed = [press.compress(t.encode()) for t in texts]
    shared = pa.nulls(len(texts), pa.list_(pa.struct([("chunk", pa.binary()), ("ids", pa.binary())])))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), "int64"), pa.array(packed), shared], names=["id", "packed", "shared"])
    want = {t: library.encode(t, add_special_tokens=False).ids for t in set(texts)}
    row = 4 * len(want[long]) + len(library.decode(want[long], skip_special_tokens=False))
    got = []
    for out in chunkbpe._assemble(spec)(iter([batch])):
        assert sum(4 * len(r["ids"]) + len(r["decoded"]) for r in out.to_pylist()) <= chunkbpe.OUT + row
        got += [(r["id"], r["ids"], r["decoded"]) for r in out.to_pylist()]
    assert got == [(i, want[t], library.decode(want[t], skip_special_tokens=False)) for i, t in enumerate(texts)]
