"""BPE encoding and decoding with chunks that documents share.

Texts are cut where a rolling hash over 32 bytes says so, thus equal passages
have equal chunks wherever they stand.  A chunk that occurs in several distinct texts is
encoded once, at one place of the table, and its ids travel to the other texts; a chunk
of a single text is encoded where the text is.

A chunk's ids hold from its first to its last gap only: what stands outside
depends on the neighbours.  Each join of chunks is therefore repaired: the open end
of the left one and the open beginning of the right one are encoded again as one
word, which grows over whole chunks until there is a gap on either side.  From
a gap on both encodings agree exactly: the tokenizer turns runs of white space into
splits that no token crosses, its normalisation composes nothing across them, and its special strings hold none.  Only ASCII white space
counts as a gap here; any other is left to the tokenizer inside a word.

Distinct words of a batch are encoded, some at a time, without the stop behind an ASCII
letter, which the tokenizer splits off anyway; a cache bounded by words and characters keeps
their ids.  Texts are put together and leave in slices, so that a worker's memory follows
neither the number of distinct words nor that of the rows of one text.

Edges: NULL and empty texts have no ids and decode to "".  Special strings in
a text become their tokens, as the library's default has it.  Repeated rows and
ids, NULL ids and very long texts or words need nothing special; an empty table gives no rows;
extra columns are ignored.  Rows of one text meet in one place, where it is encoded once; they are
keyed by a 64-bit hash of the text, which only routes: ids are taken by the
chunk's own SHA-256.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import string
from collections.abc import Callable, Iterator
from struct import Struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakevault.llm.common import staged, staged_matches, table

WINDOW = 32  # bytes under the rolling hash
MEAN, LEAST, MOST = 1024, 256, 8192  # bytes of a chunk; MEAN is a power of two
SLAB = 1 << 20  # bytes hashed together
GROUP, ROWS = 1 << 22, 5_000  # bytes of text and rows whose words are looked up together
SLICE = 1 << 17  # words and shared ids put together at once
OUT = 1 << 23  # bytes of ids and decoded texts that leave together, each row of a text counted
WORDS, LETTERS_KEPT = 200_000, 1 << 22  # cached words and their characters
TOGETHER = 2_000  # words of one call, whose encodings are in memory together
STOPS, LETTERS = ".,;:!?", frozenset(string.ascii_letters)  # the tokenizer splits between a letter and a stop
GAP = re.compile(rb"[ \t\n\r]")
_FACTOR = 0x9E3779B97F4A7C15


def _byte_values() -> np.ndarray:
    """A 64-bit value for each byte, mixed from its number."""
    x = (np.arange(1, 257, dtype=np.uint64)) * np.uint64(_FACTOR)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


_VALUES = _byte_values()
_ASK = np.uint64((MEAN - 1) << 40)  # the bits that are zero at a cut


def _hash_cuts(data: np.ndarray, at: int, to: int) -> np.ndarray:
    """Offsets in (at, to] after which the window's hash asks for a cut, at beginnings of characters."""
    lead = max(0, at - WINDOW + 1)
    h = _VALUES[data[lead:to]]
    width, factor = 1, _FACTOR
    while width < WINDOW:  # the hash of 2w bytes from two of w bytes
        longer = h.copy()
        longer[width:] += h[:-width] * np.uint64(factor)
        h, width, factor = longer, 2 * width, factor * factor & 0xFFFFFFFFFFFFFFFF
    ends = np.flatnonzero((h & _ASK) == 0) + lead + 1
    ends = ends[(ends > max(at, WINDOW - 1)) & (ends < len(data))]
    return ends[(data[ends] & 0xC0) != 0x80]


def chunk_ends(raw: bytes) -> list[int]:
    """Ends of the chunks of a text; no chunk is longer than MOST bytes."""
    data = np.frombuffer(raw, np.uint8)
    slabs = [_hash_cuts(data, at, min(at + SLAB, len(raw))) for at in range(0, len(raw), SLAB)]
    asked = np.concatenate(slabs) if slabs else np.empty(0, np.int64)
    ends, at = [], 0
    while at < len(raw):
        i = int(np.searchsorted(asked, at + LEAST))
        end = int(asked[i]) if i < len(asked) else len(raw)
        if end - at > MOST:
            end = at + MOST
            while raw[end] & 0xC0 == 0x80:
                end -= 1
        ends.append(end)
        at = end
    return ends


def chunks_of(raw: bytes) -> list[bytes]:
    ends = chunk_ends(raw)
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def inner_part(chunk: bytes) -> tuple[int, int] | None:
    """From behind the first gap character to the last one; None without two of them around a word."""
    first = GAP.search(chunk)
    if first is None:
        return None
    a = first.end()
    b = max(chunk.rfind(c) for c in (b" ", b"\t", b"\n", b"\r"))
    return (a, b) if b > a else None


class Ids(bytes):
    """Packed ids of a shared chunk's inner part."""


class WordCoder:
    """Ids of words by a tokenizer, with a bounded cache, and the texts put together from them."""

    def __init__(self, spec: str):
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.code = "H" if max(vocabulary.values()) < 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        # without a decoder the library joins the tokens by blanks
        self.tokens = None
        if not json.loads(spec)["decoder"]:
            names = dict(zip(vocabulary.values(), vocabulary))
            self.tokens = pa.array([names.get(i, "") for i in range(max(names) + 1)], pa.large_string())
        self.known: dict[str, bytes] = {}
        self.letters = 0  # characters of the known words
        self.packers: dict[int, Callable] = {}

    def _pack(self, ids: list[int]) -> bytes:
        packer = self.packers.get(len(ids))
        if packer is None:
            packer = self.packers[len(ids)] = Struct(f"<{len(ids)}{self.code}").pack
        return packer(*ids)

    def learn(self, words: list[str]) -> None:
        """Afterwards ``known`` has these words."""
        known = self.known
        if len(known) > WORDS or self.letters > LETTERS_KEPT:
            known.clear()
            self.packers.clear()
            self.letters = 0
        new = [w for w in words if w not in known]
        stopped = [w for w in new if w[-1:] in STOPS and w[-2:-1] in LETTERS]
        need = set(new).difference(stopped)
        need.update([w[:-1] for w in stopped])
        need.update(STOPS)
        alone = [w for w in need if w not in known]
        for at in range(0, len(alone), TOGETHER):  # an encoding is far larger than its ids
            some = alone[at : at + TOGETHER]
            for w, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                known[w] = self._pack(e.ids)
        for w in stopped:
            known[w] = known[w[:-1]] + known[w[-1]]
        self.letters += sum(map(len, alone)) + sum(map(len, stopped))

    def encode_part(self, raw: bytes) -> bytes:
        words = pc.ascii_split_whitespace(pa.array([_text(raw)], pa.large_string())).flatten().to_pylist()
        self.learn(words)
        return b"".join([self.known[w] for w in words])

    def encode(self, documents: list[list[bytes]]) -> tuple[pa.ListArray, pa.StringArray]:
        """Ids and decoded texts of documents given as parts (see ``text_parts``)."""
        ids, texts = zip(*self.encode_slices(documents))
        return pa.concat_arrays(ids), pa.concat_arrays(texts)

    def encode_slices(self, documents: list[list[bytes]]) -> Iterator[tuple[pa.ListArray, pa.StringArray]]:
        """Ids and decoded texts of documents, some documents at a time.

        Words are looked up once for all documents; everything that is done for each
        occurrence of a word is done by arrays, which a slice bounds.
        """
        flat = [p for d in documents for p in d]
        texts = [_text(p) for p in flat if type(p) is not Ids]
        words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self.learn(distinct)
        units = [self.known[w] for w in distinct] + [p for p in flat if type(p) is Ids]
        sizes = np.fromiter(map(len, units), np.int64, len(units)) // self.dtype.itemsize
        starts, packed = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(units), self.dtype)

        # the documents as numbers of units: their words, and shared parts behind the words
        numbers, counts = coded.indices.to_numpy(), np.diff(words.offsets.to_numpy()).tolist()
        text_at, word_at, shared_at = 0, 0, len(distinct)
        del flat, texts, words, coded, distinct, units
        pieces, ends, at, held = [], [], 0, 0
        for i, d in enumerate(documents):
            for p in d:
                if type(p) is Ids:
                    pieces.append(np.array([shared_at], numbers.dtype))
                    shared_at, at = shared_at + 1, at + 1
                    held += len(p) // self.dtype.itemsize
                else:
                    n = counts[text_at]
                    pieces.append(numbers[word_at : word_at + n])
                    text_at, word_at, at = text_at + 1, word_at + n, at + n
                    held += n
            ends.append(at)
            if held >= SLICE or i == len(documents) - 1:
                yield self._put_together(np.concatenate(pieces), ends, sizes, starts, packed)
                pieces, ends, at, held = [], [], 0, 0

    def _put_together(self, order, ends, sizes, starts, packed) -> tuple[pa.ListArray, pa.StringArray]:
        """Ids and decoded texts of documents that end at these places of ``order``, the numbers of their units."""
        own = sizes[order]
        id_ends = np.concatenate([[0], np.cumsum(own)])
        shift = starts[order] - id_ends[:-1]
        ids = packed[np.repeat(shift, own) + np.arange(id_ends[-1])].astype(np.int32)
        ends_out = pa.array(id_ends[[0, *ends]], pa.int32())
        ids_out = pa.ListArray.from_arrays(ends_out, pa.array(ids))
        if self.tokens is None:
            decoded = [self.tokenizer.decode(x, skip_special_tokens=False) for x in ids_out.to_pylist()]
            return ids_out, pa.array(decoded, pa.string())
        names = pa.ListArray.from_arrays(ends_out, self.tokens.take(pa.array(ids)))
        return ids_out, pc.binary_join(names, pa.scalar(" ", pa.large_string())).cast(pa.string())


_CODERS: dict[str, WordCoder] = {}


def _coder(spec: str) -> WordCoder:
    """One coder per worker process and vocabulary."""
    name = hashlib.sha256(spec.encode()).hexdigest()
    if name not in _CODERS:
        # a task has one core, and threads of the library would each keep memory
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _CODERS.clear()
        _CODERS[name] = WordCoder(spec)
    return _CODERS[name]


def _text(raw: bytes) -> str:
    return raw.decode("utf-8", "replace")


def text_parts(raw: bytes, shared: dict[bytes, bytes]) -> list[bytes]:
    """A text as runs of bytes to encode and ids of shared inner parts, in order.

    ``shared`` has ids by the chunk's SHA-256.  Text between two shared inner parts
    is the repaired join; it is encoded as a whole.
    """
    parts: list[bytes] = []
    done = at = 0
    if shared:
        for chunk in chunks_of(raw):
            part = inner_part(chunk)
            known = shared.get(hashlib.sha256(chunk).digest()) if part else None
            if known is not None:
                parts += [raw[done : at + part[0]], Ids(known)]
                done = at + part[1]
            at += len(chunk)
    return [*parts, raw[done:]]


def _references(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct chunks of each text that have an inner part."""
    for batch in batches:
        routes, places, digests = [], [], []
        for route, place, text in zip(*[batch.column(c) for c in ("route", "place", "raw")]):
            raw = text.as_py()
            found = {hashlib.sha256(c).digest() for c in chunks_of(raw) if inner_part(c)}
            routes += [route.as_py()] * len(found)
            places += [place.as_py()] * len(found)
            digests += found
        yield pa.RecordBatch.from_arrays(
            [pa.array(routes, pa.int64()), pa.array(places, pa.int64()), pa.array(digests, pa.binary())], names=["route", "place", "chunk"])


def _encode_chunks(spec: str) -> Callable:
    """Ids of the wanted chunks of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(spec)
        for batch in batches:
            for text, names in zip(batch.column("raw"), batch.column("wanted")):
                raw, wanted = text.as_py(), set(names.as_py())
                ids = {}
                for chunk in chunks_of(raw):
                    name = hashlib.sha256(chunk).digest()
                    if name in wanted:
                        a, b = inner_part(chunk)
                        ids[name] = coder.encode_part(chunk[a:b])
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()) for c in (ids.keys(), ids.values())], names=["chunk", "ids"])

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the exchange."""
    for batch in batches:
        press = zstandard.ZstdCompressor(level=3)
        packed = pa.array([press.compress(text.as_py()) for text in batch.column("raw")], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("route"), packed], names=["id", "route", "packed"])


def _assemble(spec: str) -> Callable:
    """Ids and decoded texts; rows come by route, so rows of one text are neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(spec)

        def finish(keys, which, documents):
            rows, first = np.array(which, np.int32), 0
            for ids, texts in coder.encode_slices(documents):
                at, end = np.searchsorted(rows, [first, first + len(ids)]).tolist()
                sizes = 4 * pc.list_value_length(ids).to_numpy().astype(np.int64) + pc.binary_length(texts).to_numpy()
                sizes = sizes[rows[at:end] - first]
                cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // OUT)) + at + 1
                for a, b in zip([at, *cuts], [*cuts, end]):
                    own = pa.array(rows[a:b] - first)
                    yield pa.RecordBatch.from_arrays([pa.array(keys[a:b], pa.int64()), ids.take(own), texts.take(own)], names=["id", "ids", "decoded"])
                first += len(ids)

        for batch in batches:
            unpress = zstandard.ZstdDecompressor()
            columns = [batch.column(c) for c in ("id", "packed", "shared")]
            keys, which, documents, size, last = [], [], [], 0, None
            for i in range(batch.num_rows):
                key, packed, shared = (c[i].as_py() for c in columns)
                raw = unpress.decompress(packed)
                if raw != last:
                    documents.append(text_parts(raw, {s["chunk"]: s["ids"] for s in shared or ()}))
                    size += len(raw)
                    last = raw
                keys.append(key)
                which.append(len(documents) - 1)
                if size >= GROUP or len(keys) >= ROWS:
                    yield from finish(keys, which, documents)
                    keys, which, documents, size, last = [], [], [], 0, None
            if keys:
                yield from finish(keys, which, documents)

    return run


def encode_documents(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) of every row; ``spec`` is the tokenizer's JSON text, of fixed size."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), raw.alias("raw"))
    rows = rows.select("id", F.xxhash64("raw").alias("route"), F.xxhash64("raw", "id").alias("place"), "raw")

    refs = rows.select("route", "place", "raw").mapInArrow(_references, "route long, place long, chunk binary")
    refs = staged(refs.groupBy("chunk", "route").agg(F.min("place").alias("place")), "chunkrefs")
    owners = staged(refs.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("place")).filter("n > 1"), "owners")
    wanted = staged(owners.groupBy("place").agg(F.collect_list("chunk").alias("wanted")), "wanted")
    owning = staged_matches(rows.select("place", "raw"), wanted, "place", "owning")
    encoded = owning.mapInArrow(_encode_chunks(spec), "chunk binary, ids binary")
    # rows that repeat an id and a text encode the same chunks
    encoded = staged(encoded.groupBy("chunk", "ids").agg(F.count(F.lit(1)).alias("n")).drop("n"), "encoded")

    uses = refs.select("chunk", "route").join(encoded, "chunk")
    uses = uses.groupBy("route").agg(F.collect_list(F.struct("chunk", "ids")).alias("shared"))
    packed = rows.select("id", "route", "raw").mapInArrow(_pack, "id long, route long, packed binary")
    joined = packed.join(staged(uses, "uses"), "route", "left").sortWithinPartitions("route")
    return joined.select("id", "packed", "shared").mapInArrow(_assemble(spec), "id long, ids array<int>, decoded string")


def encoding_digests(coded: DataFrame) -> DataFrame:
    """Token counts and digests of ids and decoded texts, by built-in functions."""
    return coded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_chunk_bpe(spark, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    return encoding_digests(encode_documents(table(spark, sf_dir, "documents"), spec))
