"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie.

The vocabulary (pieces with log scores, byte pieces) is read from a model file
and compiled into a double-array trie of the pieces' UTF-8 bytes.  A text is
prefixed by the marker U+2581, its blanks become markers, and the segmentation
with the highest total score is found by dynamic programming over the trie's
matches; among equal scores the piece that begins first wins.  A character
without a piece costs UNKNOWN less than the worst piece and is written as its
bytes' pieces.  Decoding joins the pieces, puts the bytes together and turns
markers into blanks.

No piece holds a marker after another character (checked when the vocabulary
is compiled), so the best segmentation is found word by word.  Distinct words
of a batch are segmented together with numpy, by length; a bounded cache keeps
their ids.  Very long words run through the same recurrence one at a time.

Edge cases: NULL and empty texts have no tokens and decode to ""; a literal
U+2581 decodes to a blank, as the format has it (``round_trip`` is then
false); repeated rows, NULL ids and texts of any length are coded one by one;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN = 10.0
LONG = 48  # bytes; longer words aren't batched
CACHE = 400_000  # words
BATCH = 20_000  # words segmented together
SLICE = 1 << 22  # characters coded together


class Trie:
    """Double array: the child of state s by byte c is base[s] + c if check there is s."""

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for key, v in keys.items():
            s = 0
            for c in key:
                t = children[s].get(c)
                if t is None:
                    t = children[s][c] = len(children)
                    children.append({})
                    value.append(-1)
                s = t
            value[s] = v
        base, check, taken = [0] * (len(children) + 1024), [-1] * (len(children) + 1024), [-1] * (len(children) + 1024)
        place, hints = [0] * len(children), [1, 1]
        check[0] = 0
        for node, kids in enumerate(children):  # a parent comes before its children
            taken[place[node]] = value[node]
            if not kids:
                continue
            codes, which = sorted(kids), len(kids) > 1
            at = start = max(hints[which], codes[0] + 1)
            while True:
                if at - codes[0] + 512 >= len(check):
                    more = len(check) // 2
                    base += [0] * more
                    check += [-1] * more
                    taken += [-1] * more
                if all(check[at + c - codes[0]] < 0 for c in codes):
                    break
                at += 1
            if at - start > 32:
                hints[which] = at  # the front is dense: search on from here
            begin = at - codes[0]
            base[place[node]] = begin
            for c in codes:
                check[begin + c] = place[node]
                place[kids[c]] = begin + c
        # base + 255 stays inside
        self.base, self.check, self.value = (np.array(x, np.int32) for x in (base, check, taken))


@dataclass
class Vocabulary:
    trie: Trie
    scores: np.ndarray  # by piece id
    bytes_of: list[bytes]  # what a piece decodes to, markers included
    byte_ids: list[int]  # the piece of each byte
    unknown: float


def compile_vocabulary(pieces: list[tuple[str, float, str]]) -> Vocabulary:
    """``pieces``: (piece, log score, kind) by id; kinds: normal, byte, other."""
    keys, texts, byte_ids = {}, [], [-1] * 256
    scores = np.array([s for _, s, _ in pieces], float)
    for i, (piece, _, kind) in enumerate(pieces):
        texts.append(b"")
        if kind == "byte":
            byte_ids[int(piece[3:5], 16)] = i
            texts[-1] = bytes([int(piece[3:5], 16)])
        elif kind == "normal":
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} crosses words")
            keys[piece.encode()] = i
            texts[-1] = piece.encode()
    if min(byte_ids) < 0:
        raise ValueError("the vocabulary has no piece for some byte")
    usual = [s for p, s, k in pieces if k == "normal" and p.strip(MARK)]
    return Vocabulary(Trie(keys), scores, texts, byte_ids, min(usual, default=0.0) - UNKNOWN)


def read_vocabulary(path: str = MODEL) -> Vocabulary:
    """Pieces and scores of a model file (the library only reads the file)."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = lambda i: "byte" if m.is_byte(i) else "other" if m.is_control(i) or m.is_unknown(i) or m.is_unused(i) else "normal"
    return compile_vocabulary([(m.id_to_piece(i), m.get_score(i), kind(i)) for i in range(m.get_piece_size())])


_WORDS = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")


class Coder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.cache: dict[str, bytes] = {}

    def _one(self, word: bytes) -> bytes:
        """Ids of one word, by plain recurrence."""
        t, n = self.v.trie, len(word)
        base, check, value, scores = t.base, t.check, t.value, self.v.scores
        best, back, piece = [float("-inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        i = 0
        while i < n:
            c = word[i]
            width = 1 if c < 0x80 else 2 if c < 0xE0 else 3 if c < 0xF0 else 4
            single, s, j = False, 0, i
            while j < n:
                to = int(base[s]) + word[j]
                if check[to] != s or to == 0:
                    break
                s, j = to, j + 1
                if value[s] >= 0:
                    single |= j - i == width
                    x = best[i] + scores[value[s]]
                    if x > best[j]:
                        best[j], back[j], piece[j] = x, i, int(value[s])
            if not single and best[i] + self.v.unknown > best[i + width]:
                best[i + width], back[i + width], piece[i + width] = best[i] + self.v.unknown, i, -1
            i += width
        out, j = [], n
        while j:
            i = back[j]
            out += [piece[j]] if piece[j] >= 0 else [self.v.byte_ids[b] for b in reversed(word[i:j])]
            j = i
        return np.array(out[::-1], "<i4").tobytes()

    def _many(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of up to LONG bytes, sorted by falling length, all at once."""
        t, w = self.v.trie, len(words)
        lengths = np.array([len(x) for x in words])
        n = int(lengths[0])
        text = np.frombuffer(b"".join(x.ljust(n, b"\0") for x in words), np.uint8).reshape(w, n)
        best = np.full((w, n + 1), -np.inf)
        back, piece = np.zeros((w, n + 1), np.int8), np.full((w, n + 1), -1, np.int32)
        best[:, 0] = 0.0
        for i in range(n):
            lead = text[: np.searchsorted(-lengths, -i), i]  # words of more than i bytes come first
            rows = np.flatnonzero((lead & 0xC0) != 0x80)
            lead = lead[rows]
            width = 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
            open_rows, single = np.arange(len(rows)), np.zeros(len(rows), bool)
            state = np.zeros(len(rows), np.int32)
            for j in range(i, n):
                at = rows[open_rows]
                to = t.base[state] + text[at, j]
                ok = (t.check[to] == state) & (to != 0) & (lengths[at] > j)
                open_rows, state = open_rows[ok], to[ok]
                if not len(open_rows):
                    break
                found = t.value[state]
                hit = found >= 0
                if hit.any():
                    at, ids = open_rows[hit], found[hit]
                    single[at] |= width[at] == j + 1 - i
                    self._offer(best, back, piece, rows[at], i, j + 1, self.v.scores[ids], ids)
            for k in np.unique(width[~single]).tolist():
                alone = rows[~single & (width == k)]
                self._offer(best, back, piece, alone, i, i + k, np.full(len(alone), self.v.unknown), np.full(len(alone), -1))
        # walk back from the ends of all words together; ids fill rows from the right
        ids, at, used, unknown = np.zeros((w, n), "<i4"), lengths.copy(), np.zeros(w, np.int64), np.zeros(w, bool)
        rows = np.arange(w)
        while len(rows):
            p = piece[rows, at[rows]]
            unknown[rows] |= p < 0
            used[rows] += 1
            ids[rows, n - used[rows]] = p
            at[rows] = back[rows, at[rows]]
            rows = rows[at[rows] > 0]
        raw, step = ids.tobytes(), 4 * n
        return [
            self._one(x) if u else raw[(r + 1) * step - 4 * k : (r + 1) * step]
            for r, (x, k, u) in enumerate(zip(words, used.tolist(), unknown.tolist(), strict=True))
        ]

    @staticmethod
    def _offer(best, back, piece, rows, i: int, end: int, gain, ids) -> None:
        x = best[rows, i] + gain
        better = x > best[rows, end]
        rows = rows[better]
        best[rows, end], back[rows, end], piece[rows, end] = x[better], i, ids[better]

    def learn(self, words: set[str]) -> None:
        """Put the ids of new words into the cache."""
        if len(self.cache) > CACHE:
            self.cache = {}
        new = [(x, x.encode()) for x in words if x not in self.cache]
        self.cache.update((x, self._one(b)) for x, b in new if len(b) > LONG)
        short = sorted((p for p in new if len(p[1]) <= LONG), key=lambda p: -len(p[1]))
        for lo in range(0, len(short), BATCH):
            part = short[lo : lo + BATCH]
            self.cache.update(zip([x for x, _ in part], self._many([b for _, b in part]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        words = [_WORDS.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        need = set().union(*words) if words else set()
        if len(self.cache) > CACHE:
            self.cache = {}
        self.learn(need)
        get = self.cache.__getitem__
        return [b"".join(map(get, x)) for x in words]

    def decode(self, ids: bytes) -> str:
        pieces = self.v.bytes_of
        raw = b"".join([pieces[i] for i in np.frombuffer(ids, "<i4").tolist()])
        text = raw.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _encode(vocabulary: Vocabulary, check: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(vocabulary)
        for f in frames:
            texts = [t or "" for t in f["text"]]
            for lo, hi in _slices(texts):
                ids = coder.encode(texts[lo:hi])
                out = pd.DataFrame({"doc_id": f["doc_id"].iloc[lo:hi].to_numpy(), "ids": ids})
                if check:
                    back = [coder.decode(x) for x in ids]
                    out = pd.DataFrame(
                        {
                            "doc_id": out["doc_id"],
                            "n_tokens": [len(x) // 4 for x in ids],
                            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                            "decoded_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in back],
                            "round_trip": [a == b for a, b in zip(back, texts[lo:hi], strict=True)],
                        }
                    )
                yield out

    return run


def _as_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (binary, little-endian 32-bit) of every row."""
    out = _as_text(docs, id_col, text_col).mapInPandas(_encode(vocabulary, False), "doc_id string, ids binary")
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def decode_documents(coded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and text of rows of ``encode_documents``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(vocabulary)
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"], "text": [coder.decode(x or b"") for x in f["ids"]]})

    kind = coded.schema["doc_id"].dataType
    out = coded.select(F.col("doc_id").cast("string").alias("doc_id"), "ids").mapInPandas(run, "doc_id string, text string")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def token_digests(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip of every row."""
    out = _as_text(docs, id_col, text_col).mapInPandas(
        _encode(vocabulary, True), "doc_id string, n_tokens bigint, ids_sha256 string, decoded_sha256 string, round_trip boolean"
    )
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def op9_sentencepiece(spark, sf_dir: str, model: str = MODEL) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), read_vocabulary(model))
