"""Removal of every passage of ``length`` bytes that also starts elsewhere.

The suffix array of the whole corpus is never built in one place.  Suffixes
that can share ``length`` bytes are routed to the same shard first:

1. Every window of ``length`` bytes is named by its smallest GRAM-byte hash
   (leftmost at ties).  Equal windows have the same name and the same place of
   it, so consecutive windows with one name form a *piece*, and a window
   repeats only if its name occurs in two pieces.  Names held by one piece
   are dropped after a partial count.
2. Pieces with equal bytes are counted as one *content* (a passage in a third
   of all documents is then one row per task).  Contents found twice
   are repeats as a whole.
3. Of each name with several contents, one copy of each content goes to the
   name's shard, where induced sorting (``induced.suffix_order``) yields the
   suffix array with common-prefix values; neighbours that share ``length``
   bytes are repeats.  A name with more than HOT contents (say the only
   frequent line in otherwise different documents) is split over shards by
   its windows' digests, which are counted with a partial aggregate.
4. Repeats of a content are carried to all its places, merged per document
   and cut out.

Edge cases: NULL text is empty; texts shorter than ``length`` keep all bytes;
rows that repeat an id and text are documents of their own (each is a copy of
the other); NULL ids are documents, too; overlapping copies count, also inside
one text; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import staged, staged_matches, table
from lakevault.llm.hashing import Prefix, mix, slices_by_size, text_buffers
from lakevault.llm.induced import suffix_order

LENGTH = 200
GRAM = 64
HOT = 2000  # contents of one name that are sorted in one shard
SHARD_BYTES = 2 << 20  # names are sorted together up to about this size
MOST = 4 << 20  # bytes of one text hashed at a time (longer texts overlap by a window)
NO_ID = -(1 << 63)

PIECES = "name bigint, content bigint, d bigint, t bigint, start bigint, windows int"
COPIES = "name bigint, content bigint, piece binary"
RANGES = "name bigint, content bigint, lo int, hi int"


def window_names(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(name, content, start, windows) of the pieces of a batch of texts."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    hashes = Prefix(data)
    at = np.arange(len(data) - gram + 1)
    names = hashes.of(at, at + gram)
    # least hash, then least place: both in one word
    place_bits = np.uint64(int(len(data)).bit_length())
    low = (names >> place_bits << place_bits) | at.astype(np.uint64)
    width, have = length - gram + 1, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    anchor = (low & ((np.uint64(1) << place_bits) - np.uint64(1))).astype(np.int64)
    fits = np.zeros(len(data) + 1, np.int32)
    long = np.diff(offsets) >= length
    np.add.at(fits, offsets[:-1][long], 1)
    np.add.at(fits, offsets[1:][long] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(fits[: len(anchor)]) > 0)
    if not len(start):
        return none, none, none, none
    chosen = anchor[start]
    first = np.flatnonzero(np.concatenate([[True], np.diff(chosen) != 0]))
    windows = np.diff(np.append(first, len(start)))
    start, chosen = start[first], chosen[first]
    content = mix(hashes.of(start, start + windows + length - 1) ^ mix(windows.astype(np.uint64)))
    return names[chosen].view(np.int64), content.view(np.int64), start, windows


def _parts(data: np.ndarray, offsets: np.ndarray, length: int):
    """(first text, first byte in it, bytes, offsets) of batches of bounded size."""
    for lo, hi in slices_by_size(offsets, 1 << 19):
        if offsets[hi] - offsets[lo] <= MOST:
            yield lo, 0, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            continue
        whole = data[offsets[lo] : offsets[hi]]  # one long text
        for begin in range(0, max(1, len(whole) - length + 1), MOST):
            part = whole[begin : begin + MOST + length - 1]
            yield lo, begin, part, np.array([0, len(part)])


def _pieces(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PIECES.split(", ")]
        for batch in batches:
            d, t = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            data, offsets = text_buffers(batch.column(2))
            for lo, begin, part, at in _parts(data, offsets, length):
                name, content, start, windows = window_names(part, at, length, gram)
                which = np.searchsorted(at, start, "right") - 1
                yield pa.record_batch(
                    [pa.array(name), pa.array(content), pa.array(d[lo + which]), pa.array(t[lo + which]),
                     pa.array(start - at[which] + begin), pa.array(windows.astype(np.int32))],
                    names=names,
                )

    return run


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d, t, text, doc_id): a document is known by its id and a hash of its text."""
    i = F.col(id_col).cast("bigint")
    return docs.select(
        F.coalesce(i, F.lit(NO_ID)).alias("d"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("t"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"), i.alias("doc_id"),
    )


def _cut_copies(length: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()  # rows that repeat an id and text have the same pieces
        for f in frames:
            rows = []
            for d, t, text, pieces in zip(f["d"], f["t"], f["text"], f["pieces"], strict=True):
                if (d, t) in seen:
                    continue
                seen.add((d, t))
                b = text.encode()
                rows += [(p["name"], p["content"], b[p["start"] : p["start"] + p["windows"] + length - 1]) for p in pieces]
            yield pd.DataFrame(rows, columns=["name", "content", "piece"])

    return run


def covered(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Merged ranges [s, s + length) of sorted starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + length).tolist(), strict=True))


def repeats_in_shard(pieces: list[bytes], length: int, **limits) -> list[tuple[int, int, int]]:
    """(piece, lo, hi): the bytes of each piece covered by a string that starts twice in the shard."""
    ends = np.cumsum([len(p) + 1 for p in pieces])
    # bytes are 1 to 256, 257 ends a piece, 0 ends the text
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int64) + 1
    text[ends - 1] = 257
    order, common = suffix_order(np.append(text, 0), length, **limits)
    same = np.flatnonzero(common >= length)
    start = np.unique(np.concatenate([order[same], order[same - 1]]))
    piece = np.searchsorted(ends, start, "right")
    inside = start + length < ends[np.minimum(piece, len(ends) - 1)]
    start, piece = start[inside], piece[inside]
    out = []
    for p in np.unique(piece).tolist():
        begin = int(ends[p - 1]) if p else 0
        own = start[np.searchsorted(piece, p) : np.searchsorted(piece, p, "right")] - begin
        out += [(p, lo, hi) for lo, hi in covered(own, length)]
    return out


def _sort_shards(length: int, shard_bytes: int):
    """Rows in name order: whole names are gathered up to the shard size, then sorted together."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys: list[tuple] = []
        pieces: list[bytes] = []
        size, last = 0, None

        def flush() -> pd.DataFrame:
            found = repeats_in_shard(pieces, length) if pieces else []
            return pd.DataFrame([(*keys[p], lo, hi) for p, lo, hi in found], columns=["name", "content", "lo", "hi"])

        for f in frames:
            for name, content, piece in zip(f["name"], f["content"], f["piece"], strict=True):
                if size >= shard_bytes and name != last:
                    yield flush()
                    keys, pieces, size = [], [], 0
                keys.append((name, content))
                pieces.append(piece)
                size += len(piece)
                last = name
        yield flush()

    return run


def _windows(length: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, content, piece in zip(f["name"], f["content"], f["piece"], strict=True):
                n = len(piece) - length + 1
                digests = [hashlib.blake2b(piece[i : i + length], digest_size=16).digest() for i in range(n)]
                yield pd.DataFrame({"w": digests, "name": name, "content": content, "at": np.arange(n, dtype=np.int32)})

    return run


def _ranges(length: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(n, c, lo, hi) for n, c, starts in zip(f["name"], f["content"], f["starts"], strict=True)
                    for lo, hi in covered(np.sort(np.asarray(starts)), length)]
            yield pd.DataFrame(rows, columns=["name", "content", "lo", "hi"])

    return run


def _hot_ranges(copies: DataFrame, length: int) -> DataFrame:
    """Repeats among the contents of names too frequent for one shard."""
    w = copies.mapInPandas(_windows(length), "w binary, name bigint, content bigint, at int")
    twice = staged(w.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w"), "hot-windows")
    hits = w.join(twice, "w").groupBy("name", "content").agg(F.collect_list("at").alias("starts"))  # at most a piece's windows
    return hits.mapInPandas(_ranges(length), RANGES)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(d, t, spans): for each document that has any, the byte ranges to remove.

    ``docs`` is the output of ``keyed``.
    """
    pieces = docs.select("d", "t", "text").mapInArrow(_pieces(length, gram), PIECES)
    # a table of its own: both sides of the join are then dealt out anew, and AQE can split a hot name
    shared = staged(pieces.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name"), "shared-names")
    found = staged(pieces.join(shared, "name"), "shared-pieces")

    contents = found.groupBy("name", "content").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("d", "t", "start", "windows")).alias("at")
    )
    contents = staged(contents, "contents")
    kinds = staged(contents.groupBy("name").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "name-kinds")
    wanted = contents.join(kinds, "name").select("name", "content", "kinds", "at.*")
    wanted = wanted.groupBy("d", "t").agg(F.collect_list(F.struct("name", "content", "kinds", "start", "windows")).alias("pieces"))
    wanted = staged(wanted, "wanted-pieces")
    texts = staged_matches(docs.select("d", "t", "text"), wanted, ["d", "t"], "piece-texts")
    copies = texts.select("d", "t", "text", "pieces").mapInPandas(_cut_copies(length), COPIES)
    copies = staged(copies.join(kinds, "name"), "copies")

    cold = copies.filter(F.col("kinds") <= hot).repartition("name").sortWithinPartitions("name")
    ranges = cold.select("name", "content", "piece").mapInPandas(_sort_shards(length, shard_bytes), RANGES)
    ranges = ranges.union(_hot_ranges(copies.filter(F.col("kinds") > hot), length))
    twice = contents.filter("n > 1").select("name", "content", F.lit(0).alias("lo"), (F.col("at.windows") + length - 1).cast("int").alias("hi"))
    ranges = ranges.union(twice).groupBy("name", "content").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    ranges = staged(ranges, "content-ranges")
    spans = found.join(ranges, ["name", "content"]).select("d", "t", F.explode("ranges").alias("r"), "start")
    spans = spans.groupBy("d", "t").agg(
        # a set, as rows that repeat an id and text have the same spans
        F.collect_set(F.struct((F.col("start") + F.col("r.lo")).alias("lo"), (F.col("start") + F.col("r.hi")).alias("hi"))).alias("spans")
    )
    return staged(spans, "spans")


def merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = []
        for d, t, text, spans in zip(f["d"], f["t"], f["text"], f["spans"], strict=True):
            b, kept, at, gone = text.encode(), [], 0, 0
            cuts = merged(spans)
            for lo, hi in cuts:
                kept.append(b[at:lo])
                gone, at = gone + hi - lo, hi
            kept.append(b[at:])
            kept = b"".join(kept)
            rows.append((d, t, gone, len(cuts), hashlib.sha256(kept).hexdigest(), kept))
        yield pd.DataFrame(rows, columns=["d", "t", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """(d, t, n_removed, n_spans, kept_sha256, kept) of the documents that lose bytes, one row per (d, t)."""
    k = keyed(docs, id_col, text_col)
    spans = repeated_spans(k, length, **limits)
    texts = staged_matches(k.select("d", "t", "text"), spans, ["d", "t"], "cut-texts")
    out = texts.select("d", "t", "text", "spans").mapInPandas(
        _cut, "d bigint, t bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    )
    return out


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cut = staged(remove_repeats(docs).drop("kept").dropDuplicates(["d", "t"]), "cut-digests")
    k = keyed(docs, "doc_id", "text")
    whole = k.select("doc_id", "d", "t", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    out = whole.join(cut, ["d", "t"], "left")
    zero = F.lit(0).cast("bigint")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
                      F.coalesce("kept_sha256", "sha").alias("kept_sha256"))


# every window of 200 bytes as hexadecimal digits, cut out of pieces of 512 starts
OP1_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
c AS (SELECT doc_id, o, substr(h, 2 * o + 1, 1422) AS piece FROM (SELECT doc_id, h, unnest(range(0, n - 199, 512)) AS o FROM d WHERE n >= 200)),
w AS (SELECT doc_id, o + j AS p, substr(piece, 2 * j + 1, 400) AS x
      FROM (SELECT doc_id, o, piece, unnest(range(0, least(512, length(piece) // 2 - 199))) AS j FROM c)),
t AS (SELECT doc_id, p FROM w WHERE x IN (SELECT x FROM w GROUP BY x HAVING count(*) > 1)),
o AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200 THEN 0 ELSE 1 END AS opens FROM t),
i AS (SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM o),
r AS (SELECT doc_id, min(p) AS a, max(p) + 200 AS b FROM i GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS after FROM r),
q AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
             string_agg(substr(h, 2 * after + 1, 2 * (a - after)), '' ORDER BY a) AS head
      FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN q.doc_id IS NULL THEN h ELSE head || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN q USING (doc_id)
"""
