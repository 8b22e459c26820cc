"""Exact top-k inner products by a bit-sliced index.

Components are quantised to integers floor(scale * x).  ``build_index`` packs
up to ``block_rows`` rows into one index row: for each dimension the bits of
(value - smallest value of the dimension) as one bitmap per bit (slice), rows
in id order.  ``search_block`` answers a query on one block: it adds the
dimension's slices, shifted by the bits of the query's component, with
ripple-carry bitmap arithmetic into a bit-sliced sum; then it selects the k
best rows from the most significant slice downward.  Rows that still tie at
the last slice have exactly equal scores; the smallest ids win.

Blocks and blocks of queries meet in a join on the block number (each block
needs each query: that is the stated work), each pair yields at most k rows
per query, and a row number per query picks the final k.

Edge cases: rows whose id or vector is NULL, or whose vector holds a NULL or
non-finite component, take no part; vectors of other lengths than the query's
are no candidates of it; repeated ids are candidates each, but a query never
finds rows of its own id, and it is asked once per distinct vector of that id;
fewer than k candidates give all of them; an empty table gives no rows; empty
vectors score 0.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakevault.llm.common import staged, table

SCALE = 256
BLOCK_ROWS = 65_536
QUERY_ROWS = 256

INDEX = "block string, rows int, dims int, ids binary, lows array<bigint>, widths array<int>, slices binary"
HITS = "query_id bigint, query_no bigint, vec_id bigint, score bigint"


def quantised(vec: Column, scale: int = SCALE) -> Column:
    return F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))


def usable(id_col: Column, vec: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return id_col.isNotNull() & vec.isNotNull() & ~F.coalesce(F.exists(vec, bad), F.lit(True))


def vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the rows that take part, quantised."""
    r = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).alias("e"))
    return r.filter(usable(F.col("vec_id"), F.col("e"))).select("vec_id", quantised(F.col("e"), scale).alias("v"))


def pack(ids: np.ndarray, values: np.ndarray) -> tuple:
    """One index row of a block: ``values`` is rows x dims."""
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order]
    lows = values.min(axis=0) if values.shape[1] else np.zeros(0, np.int64)
    above = values - lows
    widths = [int(m).bit_length() for m in (above.max(axis=0) if values.shape[1] else [])]
    parts = []
    for d, w in enumerate(widths):
        for b in range(w):
            parts.append(np.packbits((above[:, d] >> b) & 1, bitorder="little").tobytes())
    return (len(ids), values.shape[1], ids.astype("<i8").tobytes(), lows.tolist(), widths, b"".join(parts))


def _index_blocks(block_rows: int):
    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def flush(dims: int) -> pd.DataFrame:
            parts = held.pop(dims)
            row = (uuid.uuid4().hex, *pack(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])))
            return pd.DataFrame([row], columns=[c.split()[0] for c in INDEX.split(", ")])

        for f in frames:
            dims_of = f["v"].map(len).to_numpy() if len(f) else np.zeros(0, int)
            for dims in np.unique(dims_of):
                at = np.flatnonzero(dims_of == dims)
                for lo in range(0, len(at), block_rows):
                    part = at[lo : lo + block_rows]
                    values = np.stack(f["v"].iloc[part].to_list()).astype(np.int64).reshape(len(part), int(dims))
                    if sum(len(p[0]) for p in held.get(int(dims), [])) + len(part) > block_rows:
                        yield flush(int(dims))
                    held.setdefault(int(dims), []).append((f["vec_id"].to_numpy()[part].astype(np.int64), values))
        for dims in list(held):
            yield flush(dims)

    return build


def build_index(vecs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The index as a table in the shared folder, one row per block."""
    return staged(vecs.mapInPandas(_index_blocks(block_rows), INDEX), "bit-sliced-index")


class Sliced:
    """A block with its slices as Python integers: one machine loop per bitmap operation."""

    def __init__(self, rows: int, ids: bytes, lows, widths, slices: bytes):
        self.rows, self.ids, self.lows = rows, np.frombuffer(ids, "<i8"), [int(x) for x in lows]
        self.all = (1 << rows) - 1
        step, at, self.slices = -(-rows // 8), 0, []
        for w in widths:
            self.slices.append([int.from_bytes(slices[at + i * step : at + (i + 1) * step], "little") for i in range(w)])
            at += w * step

    def sums(self, query) -> tuple[list[int], int]:
        """Bit slices of sum(query * row) - constant, and the constant.

        A negative factor adds the complement: -q v = |q| (top - v) - |q| top.
        """
        total: list[int] = []
        constant = 0
        for d, q in enumerate(query):
            q = int(q)
            constant += q * self.lows[d]
            bits = self.slices[d]
            if not q or not bits:
                continue
            if q < 0:
                constant += q * ((1 << len(bits)) - 1)
                bits, q = [self.all ^ b for b in bits], -q
            shift = 0
            while q:
                if q & 1:
                    self._add(total, bits, shift)
                q >>= 1
                shift += 1
        return total, constant

    @staticmethod
    def _add(total: list[int], bits: list[int], shift: int) -> None:
        while len(total) < shift + len(bits):
            total.append(0)
        carry = 0
        for i, b in enumerate(bits, shift):
            t = total[i]
            half = t ^ b
            total[i] = half ^ carry
            carry = (t & b) | (half & carry)
        i = shift + len(bits)
        while carry:
            if i == len(total):
                total.append(carry)
                return
            t = total[i]
            total[i] = t ^ carry
            carry &= t
            i += 1

    def best(self, query, query_id: int, k: int) -> list[tuple[int, int]]:
        """(row, score) of the k best rows; ties to the smaller id."""
        total, constant = self.sums(query)
        lo, hi = np.searchsorted(self.ids, [query_id, query_id + 1])
        open_rows = self.all ^ (((1 << int(hi - lo)) - 1) << int(lo))  # all but the query's own
        sure = 0
        need = min(k, open_rows.bit_count())
        if not need:
            return []
        for s in reversed(total):
            ones = open_rows & s
            n = ones.bit_count()
            if n >= need:
                open_rows = ones
            else:
                sure |= ones
                need -= n
                open_rows &= ~s
            if not need:
                break
        rows = _lowest(sure, sure.bit_count()) + _lowest(open_rows, need)  # rows stand in id order
        return [(r, constant + sum(((s >> r) & 1) << i for i, s in enumerate(total))) for r in rows]


def _lowest(bitmap: int, n: int) -> list[int]:
    out = []
    while bitmap and len(out) < n:
        low = bitmap & -bitmap
        out.append(low.bit_length() - 1)
        bitmap ^= low
    return out


def _search(k: int):
    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            hits = []
            for r in f.itertuples(index=False):
                block = Sliced(r.rows, r.ids, r.lows, r.widths, r.slices)
                for q_id, q_no, v in zip(r.query_ids, r.query_nos, r.queries, strict=True):
                    if len(v) == r.dims:
                        hits += [(q_id, q_no, block.ids[row], score) for row, score in block.best(v, int(q_id), k)]
            yield pd.DataFrame(hits, columns=["query_id", "query_no", "vec_id", "score"])

    return search


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The k best rows of ``rows`` for each of ``queries`` (both vec_id, v):
    query_id, query_no (distinct vectors of one id), rank, vec_id, score."""
    index = build_index(rows, block_rows)
    # names of blocks only (one in BLOCK_ROWS rows), numbered
    blocks = index.select("block").withColumn("no", F.row_number().over(W.orderBy("block")))
    n_blocks = index.count()
    asked = queries.distinct().select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    # a query's number tells apart distinct vectors of one id
    asked = staged(asked.withColumn("query_no", F.xxhash64("q")), "top-k-queries")
    n_groups = max(1, -(-asked.count() // query_rows))
    groups = asked.groupBy(F.pmod(F.xxhash64("query_id", "query_no"), F.lit(n_groups)).alias("g")).agg(
        F.collect_list(F.struct("query_id", "query_no", "q")).alias("qs")
    )
    groups = groups.select(
        F.explode(F.sequence(F.lit(1), F.lit(max(1, n_blocks)))).alias("no"), F.col("qs.query_id").alias("query_ids"),
        F.col("qs.query_no").alias("query_nos"), F.col("qs.q").alias("queries"),
    )
    pairs = groups.join(blocks, "no").join(index, "block").repartition(F.col("block"), F.col("query_ids")[0], F.col("query_nos")[0])
    hits = pairs.select("query_ids", "query_nos", "queries", "rows", "dims", "ids", "lows", "widths", "slices").mapInPandas(_search(k), HITS)
    by_score = W.partitionBy("query_id", "query_no").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return hits.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)


def op5_bit_sliced_topk(spark, sf_dir: str) -> DataFrame:
    v = vectors(table(spark, sf_dir, "embeddings"))
    return top_k(v, v.filter(F.col("vec_id") % 50 == 0)).select("query_id", "rank", "vec_id", "score")


OP5_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rnk FROM s)
SELECT query_id, CAST(rnk AS INTEGER) AS rank, vec_id, score FROM r WHERE rnk <= 5
"""
