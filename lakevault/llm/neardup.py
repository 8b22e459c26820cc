"""MinHash near-duplicates by a multi-index Hamming join.

A document's set holds its distinct shingles of ``shingle`` words (ASCII
letters in lower case; with fewer words the whole sequence is one shingle).
Documents are linked if their sets' Jaccard similarity is ``percent`` % or
more; the classes are the connected components.

1. Signature: ``CHUNKS * CHUNK`` minimum hashes of 16 bits each.  Documents
   with equal sets are one class from here on.
2. Multi-index: the signature is split into CHUNKS chunks of CHUNK values.
   Two signatures that differ in at most 2 * CHUNKS - 1 = 31 of the 80 values
   have, by pigeonhole, a chunk with at most one error; so each chunk is
   entered once for each value that may be wrong (the others form the key),
   and every pair under that distance meets in a bucket.  A pair at 80 %
   similarity differs in 16 values on average; it fails to meet with a
   probability of 0.263 ** 16 = 5e-10.
3. Buckets: only keys held by two classes or more are kept.  Each class of a
   bucket is compared with the bucket's smallest; verified links are merged
   into components.  Buckets that still hold several components are searched
   for pairs across components whose signatures differ in at most ERRORS
   values; a bucket yields a spanning forest of them, not the pairs.  The
   forests' trees (candidate clusters) are then compared text by text.  Buckets
   and clusters of more than BLOCK members are dealt out as pairs of blocks,
   so none is gathered in one task and no pair of documents becomes a row.
4. Links are confirmed on the full sets of words.

Edge cases: NULL or blank texts have an empty set and are linked with
nothing; NULL ids aren't linked by ``near_duplicates`` (component NULL, kept),
and rows that repeat an id are one document to it, linked by each of its texts.  To
``drop_near_duplicates`` each row without an id of its own is a document of its
own, so of a row that came twice one stays, and a different text under the same id stays too.
An empty table gives no rows; extra columns are ignored by
``near_duplicates`` and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import staged, staged_matches, table
from lakevault.llm.graph import connected_components
from lakevault.llm.hashing import M1, Prefix, mix, slices_by_size, text_buffers

CHUNKS, CHUNK = 16, 5
VALUES = CHUNKS * CHUNK
ERRORS = 40  # of 80 values; a pair at 80 % differs in 16 on average, deviation 3.6
BLOCK = 1024  # members of a group that are compared in one place
LANE = 100_000  # rows of buckets, about, that are searched in one place
CELL = 256  # members compared with one copy of a text

SIGNATURES = "doc_id bigint, n_shingles bigint, set_hi bigint, set_lo bigint, sig binary"
KEYS = "key bigint, doc_id bigint"

_FACTORS = np.random.default_rng(20240).integers(0, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words before each text) of a batch."""
    data = _LOWER[data]
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True  # texts begin and end words
    after_gap = np.ones(len(data), bool)
    after_gap[1:] = gap[:-1]
    before_gap = np.ones(len(data), bool)
    before_gap[:-1] = gap[1:]
    start = np.flatnonzero(~gap & (after_gap | edge[:-1]))
    end = np.flatnonzero(~gap & (before_gap | edge[1:])) + 1
    return Prefix(data).of(start, end), np.searchsorted(start, offsets)


def shingle_set(words: np.ndarray, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of one text's word hashes."""
    if not len(words):
        return words
    n = min(shingle, len(words))
    h = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        h = mix(h * M1 + words[i : i + len(h)])
    return np.unique(h)


def signature(hashes: np.ndarray) -> np.ndarray:
    low = np.full(VALUES, ~np.uint64(0))
    for lo in range(0, len(hashes), 1024):  # bounded for very long texts
        np.minimum(low, (hashes[lo : lo + 1024, None] * _FACTORS).min(axis=0), out=low)
    return (mix(low) >> np.uint64(48)).astype("<u2")


def _signatures(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, (data, offsets) = batch.column(0), text_buffers(batch.column(1))
            for lo, hi in slices_by_size(offsets, 1 << 20):
                at = offsets[lo : hi + 1] - offsets[lo]
                words, first = word_hashes(data[offsets[lo] : offsets[hi]], at)
                n, fp, sigs = [], [], []
                for i in range(hi - lo):
                    s = shingle_set(words[first[i] : first[i + 1]], shingle)
                    n.append(len(s))
                    fp.append((int(mix(s).sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mix(s * M1)))) if len(s) else (0, 0))
                    sigs.append(signature(s).tobytes() if len(s) else None)
                both = np.array(fp, np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.record_batch(
                    [ids.slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(sigs, pa.binary())],
                    names=["doc_id", "n_shingles", "set_hi", "set_lo", "sig"],
                )

    return run


def signatures(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return staged(d.mapInArrow(_signatures(shingle), SIGNATURES), "signatures")


def chunk_keys(sigs: np.ndarray) -> np.ndarray:
    """rows x CHUNKS * CHUNK keys: each chunk without one of its values."""
    v = sigs.astype(np.uint64)
    out = np.empty((len(v), VALUES), np.uint64)
    for c in range(CHUNKS):
        for wrong in range(CHUNK):
            k = np.full(len(v), c * CHUNK + wrong + 1, np.uint64)
            for i in range(CHUNK):
                if i != wrong:
                    k = mix(k * M1 + v[:, c * CHUNK + i] + np.uint64(1))
            out[:, c * CHUNK + wrong] = k
    return out


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, whole.num_rows, 2000):
            batch = whole.slice(lo, 2000)
            sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, VALUES)
            yield pa.record_batch(
                [pa.array(chunk_keys(sigs).ravel().view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), VALUES))],
                names=["key", "doc_id"],
            )


def buckets(classes: DataFrame) -> DataFrame:
    """(key, doc_id) of the keys that two classes or more hold."""
    rows = classes.select("doc_id", "sig").mapInArrow(_keys, KEYS)
    # a table of its own: both sides of the join are then dealt out anew, and AQE can split a hot key
    shared = staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "shared-keys")
    return staged(rows.join(shared, "key"), "buckets")


def exact_set(text: str | None, shingle: int) -> set:
    words = (text or "").encode().lower().split()
    n = min(shingle, len(words))
    return set(zip(*[words[i:] for i in range(n)], strict=False)) if n else set()


def _compare(shingle: int, percent: int):
    """Rows in (a, cell, doc_id <> a) order: the texts of ``a`` first, then its partners."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, own = None, []
        for f in frames:
            found = []
            for a, c, b, text in zip(f["a"], f["cell"], f["doc_id"], f["text"], strict=True):
                if cell != (a, c):
                    cell, own = (a, c), []
                s = exact_set(text, shingle)
                if a == b:
                    own.append(s)
                    continue
                for o in own:
                    if len(o) * 100 < percent * len(s) or len(s) * 100 < percent * len(o) or not s:
                        continue
                    both = len(o & s)
                    if 100 * both >= percent * (len(o) + len(s) - both):
                        found.append((a, b))
                        break
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def confirmed(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    A text goes to the cells it is compared in; a text with many partners has
    a cell, and a copy, for every CELL of them.
    """
    pairs = staged(pairs.distinct(), "pairs")
    many = staged(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("cells")), "cell-counts")
    placed = staged(pairs.join(many, "a").withColumn("cell", F.pmod(F.xxhash64("b"), F.col("cells"))).drop("cells"), "cells")
    wanted = placed.select("a", "cell", F.col("b").alias("doc_id")).union(
        placed.select("a", "cell", F.col("a").alias("doc_id")).distinct()
    )
    texts = staged_matches(docs, staged(wanted.select("doc_id").distinct(), "wanted"), "doc_id", "texts")
    rows = texts.join(wanted, "doc_id").repartition("a", "cell")
    rows = rows.sortWithinPartitions("a", "cell", F.col("doc_id") != F.col("a"), "doc_id")
    return staged(rows.select("a", "cell", "doc_id", "text").mapInPandas(_compare(shingle, percent), "a bigint, b bigint").distinct(), "links")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    sigs = signatures(docs, shingle, id_col, text_col)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    full = sigs.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # equal sets: one class, named by its smallest id (a partial aggregate meets hot copies)
    same = ["set_hi", "set_lo", "n_shingles"]
    classes = staged(full.groupBy(*same).agg(F.min("doc_id").alias("doc_id"), F.min("sig").alias("sig")), "classes")
    class_of = full.select("doc_id", *same).join(classes.select(*same, F.col("doc_id").alias("class_id")), same)
    class_of = staged(class_of.select("doc_id", "class_id"), "class-of")
    # rows that repeat an id with another text tie the classes of their texts
    ties = class_of.groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("b")).filter("a <> b")
    ties = class_of.join(ties.select("doc_id", "a"), "doc_id").select("a", F.col("class_id").alias("b")).filter("a <> b")

    held = buckets(classes)
    least = staged(held.groupBy("key").agg(F.min("doc_id").alias("a")), "least")
    star = held.join(least, "key").filter("doc_id <> a").select("a", F.col("doc_id").alias("b"))
    links = confirmed(star, texts, shingle, percent).union(ties)
    comp = staged(connected_components(links), "components")

    more = _across(held, comp, classes, texts, shingle, percent)
    comp = connected_components(comp.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    of_doc = class_of.join(comp, class_of["class_id"] == comp["node"], "left")
    of_doc = of_doc.groupBy("doc_id").agg(F.min(F.coalesce("component", "class_id")).alias("_component"))
    out = sigs.select("doc_id", "n_shingles").join(of_doc, "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def block_pairs(members: DataFrame, group: str, member: str, sizes: DataFrame) -> DataFrame:
    """Adds (i, j, side): each member goes to every pair of blocks of its group that holds
    its block.  ``sizes``: (group, n).  A group of up to BLOCK members is the one pair (0, 0)."""
    blocks = F.ceil(F.col("n") / BLOCK)
    m = members.join(sizes, group).withColumn("_b", F.pmod(F.xxhash64(member, F.lit("block")), blocks))
    m = m.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    out = m.withColumns({"i": F.least("_b", "_o"), "j": F.greatest("_b", "_o"), "side": F.col("_b") > F.col("_o")})
    return out.drop("_b", "_o", "n")


def _close_rows(sig: np.ndarray, comp: np.ndarray, side: np.ndarray, one_block: bool) -> Iterator[tuple[int, np.ndarray]]:
    """For each row, the rows of other components whose signatures differ in at most ERRORS values."""
    rows = np.flatnonzero(~side)
    cols = rows if one_block else np.flatnonzero(side)
    for lo in range(0, len(rows), 32):
        r = rows[lo : lo + 32]
        near = (sig[r][:, None, :] != sig[cols][None, :, :]).sum(axis=2) <= ERRORS
        near &= comp[r][:, None] != comp[cols][None, :]
        for x, hit in zip(r.tolist(), near, strict=True):
            if hit.any():
                yield x, cols[hit]


class _Union:
    """Disjoint sets, each named by its smallest member."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (y := self.up.get(root, root)) != root:
            root = y
        while (y := self.up.get(x, x)) != root:
            self.up[x], x = root, y
        return root

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def _groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of rows that arrive sorted by ``keys``."""
    held: list[pd.DataFrame] = []
    for f in frames:
        if not len(f):
            continue
        k = f[keys].to_numpy()
        cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), len(f)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = f.iloc[a:b]
            if held and (held[-1][keys].to_numpy()[-1] != k[a]).any():
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _matrix(sigs) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), "<u2").reshape(-1, VALUES)


def _forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges that join what no earlier bucket of this task has joined."""
    out, union = [], _Union()
    for g in _groups(frames, ["key", "i", "j"]):
        ids = g["doc_id"].to_numpy()
        tree = np.array([union.find(i) for i in ids.tolist()])
        one_block = g["i"].iloc[0] == g["j"].iloc[0]
        for x, near in _close_rows(_matrix(g["sig"]), g["component"].to_numpy(), g["side"].to_numpy(), one_block):
            near = near[tree[near] != tree[x]]
            if len(near):  # one edge to each tree not joined yet
                trees, first = np.unique(tree[near], return_index=True)
                for y in near[first].tolist():
                    union.join(int(ids[x]), int(ids[y]))
                    out.append((ids[x], ids[y]))
                tree[np.isin(tree, np.append(trees, tree[x]))] = union.find(int(ids[x]))
        if len(out) > 10_000:
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
            out = []
    yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _compare_clusters(shingle: int, percent: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for g in _groups(frames, ["cluster", "i", "j"]):
            ids, comp, texts = g["doc_id"].to_numpy(), g["component"].to_numpy(), g["text"].to_numpy()
            sets: dict[int, set] = {}
            linked = comp.copy()
            one_block = g["i"].iloc[0] == g["j"].iloc[0]
            for x, near in _close_rows(_matrix(g["sig"]), comp, g["side"].to_numpy(), one_block):
                for y in near[linked[near] != linked[x]].tolist():
                    if linked[x] == linked[y]:
                        continue  # by now, by way of others
                    for z in (x, y):
                        if z not in sets:
                            sets[z] = exact_set(texts[z], shingle)
                    s, o = sets[x], sets[y]
                    if 100 * min(len(s), len(o)) < percent * max(len(s), len(o)):
                        continue
                    both = len(s & o)
                    if both and 100 * both >= percent * (len(s) + len(o) - both):
                        out.append((ids[x], ids[y]))
                        linked[linked == linked[y]] = linked[x]
        yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _across(held: DataFrame, comp: DataFrame, classes: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between different components; enough of them to connect what is connected."""
    c = held.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    c = c.withColumn("component", F.coalesce("component", "doc_id"))
    split = c.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n"))
    split = staged(split.filter("lo <> hi").select("key", "n"), "split-buckets")
    # a lane's buckets meet in one task, whatever the number of partitions: the forest spans all of them
    rows = split.agg(F.sum(F.col("n") * F.ceil(F.col("n") / BLOCK))).first()[0] or 0
    lanes = max(1, -(-int(rows) // LANE))
    c = block_pairs(c, "key", "doc_id", split).join(classes.select("doc_id", "sig"), "doc_id")
    c = c.withColumn("lane", F.pmod(F.xxhash64("key", "i", "j"), F.lit(lanes)))
    c = c.repartition("lane").sortWithinPartitions("lane", "key", "i", "j")
    forest = c.select("key", "i", "j", "side", "doc_id", "component", "sig").mapInPandas(_forest, "a bigint, b bigint")

    clusters = staged(connected_components(forest).withColumnRenamed("component", "cluster"), "clusters")
    sizes = staged(clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")), "cluster-sizes")
    m = clusters.withColumnRenamed("node", "doc_id").join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    m = block_pairs(m.withColumn("component", F.coalesce("component", "doc_id")), "cluster", "doc_id", sizes)
    placed = staged(m.join(classes.select("doc_id", "sig"), "doc_id"), "cluster-blocks")
    found = staged_matches(texts, staged(placed.select("doc_id").distinct(), "wanted"), "doc_id", "cluster-texts")
    rows = found.join(placed, "doc_id").repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    cols = ["cluster", "i", "j", "side", "doc_id", "component", "sig", "text"]
    return staged(rows.select(*cols).mapInPandas(_compare_clusters(shingle, percent), "a bigint, b bigint").distinct(), "links-across")


def keys_without_id(least: int | None, greatest: int | None, rows: int) -> int:
    """The first of ``rows`` consecutive bigints that are no id: after the greatest id or, without room there, before the least."""
    if greatest is None:
        return 0
    if greatest + rows < 1 << 63:
        return greatest + 1
    if least - rows >= -(1 << 63):
        return least - rows
    raise ValueError("no keys are left for the rows without an id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class, with all columns: the one of the smallest id that no other row has, or any row if there is none."""
    key = F.col(id_col).cast("bigint")
    ids = docs.agg(F.min(key).alias("least"), F.max(key).alias("greatest"), F.count_if(key.isNull()).alias("without")).first()
    again = staged(docs.filter(key.isNotNull()).groupBy(key.alias("_again")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "repeated-ids")
    repeated = not again.isEmpty()
    named, lone = docs.filter(key.isNotNull()), docs.filter(key.isNull())
    if repeated:
        lone = lone.union(named.join(again, key == F.col("_again"), "left_semi"))
        named = named.join(again, key == F.col("_again"), "left_anti")
    alone = bool(ids["without"]) or repeated
    if alone:
        # a row without an id of its own is a document of its own; numbered in a table, so that a task run again finds the same keys
        lone = staged(lone.select(F.monotonically_increasing_id().alias("n"), F.struct("*").alias("row")), "without-id")
        first = keys_without_id(ids["least"], ids["greatest"], lone.agg(F.max("n")).first()[0] + 1)
        lone = lone.select((F.col("n") + F.lit(first)).alias("key"), "row")
        texts = named.select(key.alias("doc_id"), F.col(text_col).alias("text")).union(lone.select("key", f"row.{text_col}"))
        found = near_duplicates(texts, shingle, percent)
    else:
        found = near_duplicates(docs, shingle, percent, id_col, text_col)
    gone = staged(found.filter("NOT kept").select(F.col("doc_id").alias("_gone")).distinct(), "copies")
    out = named.join(gone, F.col(id_col) == gone["_gone"], "left_anti")
    return out.union(lone.join(gone, F.col("key") == gone["_gone"], "left_anti").select("row.*")) if alone else out


def op3_minhash_components(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


# pairs that share a shingle, their overlap counted, then everything that can be reached
OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, CASE WHEN len(ws) < 2 THEN ws ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS gs
      FROM w),
s AS (SELECT doc_id, len(gs) AS n, unnest(gs) AS x FROM g),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id
        AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, CAST(len(gs) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM g JOIN c USING (doc_id)
"""
