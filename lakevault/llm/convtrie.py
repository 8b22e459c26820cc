"""Conversation prefix trie by blocks of turns.

Conversations are rebuilt (a borrowed head, then their own turns) and cut into
blocks of ``BLOCK`` turns.  A block's key is the SHA-256 of the key before it
and its turns' digests, so equal keys are equal prefixes.  Conversations are
grouped by block keys first.  Where all conversations of a block's start go on
with one and the same full block, its turns have no siblings: the block stays
one unit.  Only blocks whose starts diverge (or where a conversation ends) are
refined into units of one turn.  A node is a unit, or a turn within one.

Sums over subtrees need no rounds.  A node is named by its smallest member; the
nodes that a conversation names are a tail of its path, its chain.  Within a
chain sums run upwards; each chain hands its total to the units above it, found
on its own path.  That is one row for each unit of a path, never one for each
pair of nodes.

Texts are read once and become digests before any exchange.  Counts by key are
partial aggregates.  The members that end at a node are hashed from sorted
pieces of at most ``PIECE`` ids, so that no list of them is ever whole.

Edges: rows without a conv_id are left out.  NULL roles and texts are empty.
Turns with one number are ordered by role, then by the turn's digest; equal
rows are turns of their own.  For negative ids, c % 100 has the sign of c.  A
conversation without any rebuilt turn is a member of the root only.  An empty
table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakevault.llm.common import staged, table

BLOCK = 4
PIECE = 4096
# Fixed values of the rebuilding: heads come from the id divisible by SPAN, and have less than HEADS turns.
SPAN, HEADS = 100, 6


def _root() -> Column:
    """The root's key: no bytes."""
    return F.unhex(F.lit("")).alias("key")



def head_length(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("int")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, d, digest, points): digests of role and text, numbered from 1 by turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    material = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.select("conv_id", "turn", "role", F.unhex(F.sha2(material, 256)).alias("digest"), F.char_length("text").alias("points"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return rows.select("conv_id", F.row_number().over(order).alias("d"), "digest", "points")


def rebuilt(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, d, digest, points) of the rebuilt conversations; a head is at most HEADS - 1 turns."""
    heads = turns.filter((F.col("conv_id") % SPAN == 0) & (F.col("d") < HEADS)).withColumnRenamed("conv_id", "base")
    asks = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % SPAN).alias("base"), head_length(F.col("conv_id")).alias("h"))
    borrowed = asks.filter("h > 0").join(heads, "base").filter("d <= h")
    own = turns.filter(F.col("d") > head_length(F.col("conv_id")))
    both = borrowed.select("conv_id", F.lit(0).alias("part"), "d", "digest", "points").unionByName(
        own.select("conv_id", F.lit(1).alias("part"), "d", "digest", "points"))
    order = Window.partitionBy("conv_id").orderBy("part", "d")
    return both.select("conv_id", F.row_number().over(order).alias("d"), "digest", "points")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each block's start and key; rows come by conversation and block."""
    conv, key = None, b""
    for batch in batches:
        starts, keys = [], []
        for c, body in zip(batch.column("conv_id").to_pylist(), batch.column("body").to_pylist()):
            if c != conv:
                conv, key = c, b""
            starts.append(key)
            key = hashlib.sha256(key + body).digest()
            keys.append(key)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(starts, pa.binary()), pa.array(keys, pa.binary())], names=[*batch.schema.names, "start", "key"])


def turn_blocks(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, k, n, body, points, last, start, key): a row for each block of a conversation.

    Turns, blocks and chain are in one exchange by conv_id; a conversation of any
    length streams through the chain.
    """
    k = F.floor((F.col("d") - 1) / block).cast("long").alias("k")
    rows = turns.groupBy("conv_id", k).agg(F.sort_array(F.collect_list(F.struct("d", "digest", "points"))).alias("t"))
    order = Window.partitionBy("conv_id").orderBy("k")
    rows = rows.select(
        "conv_id", "k", F.size("t").alias("n"),
        F.reduce("t.digest", F.unhex(F.lit("")), lambda a, x: F.concat(a, x)).alias("body"),
        F.col("t.points").alias("points"), F.lead("k").over(order).isNull().alias("last"))
    out = "conv_id long, k long, n int, body binary, points array<int>, last boolean, start binary, key binary"
    return rows.sortWithinPartitions("conv_id", "k").mapInArrow(_chain, out)


def solid_blocks(blocks: DataFrame, n_all: int, block: int = BLOCK) -> DataFrame:
    """Keys of the full blocks that all conversations of their start go on with."""
    groups = staged(blocks.filter(F.col("n") == block).groupBy("start", "key").agg(F.count(F.lit(1)).alias("n")), "blockgroups")
    at = groups.select(F.col("key").alias("start"), F.col("n").alias("n_start"))
    below = groups.join(at, "start").filter("n = n_start")
    first = groups.filter((F.length("start") == 0) & (F.col("n") == n_all))
    return staged(below.select("key").union(first.select("key")), "solid")


def path_units(blocks: DataFrame, solid: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, size, key, parent, points, ends): the units of each path, ``depth`` after its last turn."""
    rows = blocks.join(solid.withColumn("solid", F.lit(True)), "key", "left")
    base = F.col("k") * block
    common = ["conv_id"]
    whole = rows.filter("solid").select(
        *common, (base + F.col("n")).alias("depth"), F.col("n").alias("size"), "key", F.col("start").alias("parent"), "points",
        F.col("last").alias("ends"))
    parts = rows.filter("solid IS NULL").withColumn(
        "keys", F.transform(F.sequence(F.lit(1), F.col("n")), lambda j: F.unhex(F.sha2(F.concat(F.col("start"), F.substring("body", F.lit(1), 32 * j)), 256))))
    parts = parts.select(
        *common, "n", base.alias("base"), "last",
        F.posexplode(F.arrays_zip("keys", F.array_prepend("keys", F.col("start")).alias("parents"), "points")).alias("j", "u"))
    parts = parts.filter("j < n").select(
        *common, (F.col("base") + F.col("j") + 1).alias("depth"), F.lit(1).alias("size"), F.col("u.keys").alias("key"),
        F.col("u.parents").alias("parent"), F.array("u.points").alias("points"),
        (F.col("last") & (F.col("j") == F.col("n") - 1)).alias("ends"))
    return whole.unionByName(parts)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Comma-joined runs of the ids of one key, at most PIECE ids each."""
    key, ids = None, []

    def rows(found: list) -> pa.RecordBatch:
        columns = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.string()))], names=["key", "first", "text"])

    for batch in batches:
        found = []
        for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (k != key or len(ids) == PIECE):
                found.append((key, ids[0], ",".join(map(str, ids))))
                ids = []
            key = k
            ids.append(c)
        yield rows(found)
    if ids:
        yield rows([(key, ids[0], ",".join(map(str, ids)))])


def _piece_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per key over its pieces, which come in order."""
    key, state = None, None
    for batch in batches:
        out = []
        for k, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
            if state is not None and k == key:
                state.update(b"," + text.encode())
            else:
                if state is not None:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(text.encode())
        yield _digest_rows(out)
    if state is not None:
        yield _digest_rows([(key, state.hexdigest())])


def _digest_rows(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in rows], pa.binary()), pa.array([h for _, h in rows], pa.string())], names=["key", "ends_sha256"])


def member_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) over the ascending conv_ids of each key; a hot key is split by id until its pieces are joined."""
    dealt = ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = staged(dealt.mapInArrow(_pieces, "key binary, first long, text string"), "pieces")
    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_piece_digests, "key binary, ends_sha256 string")


def chains(units: DataFrame) -> DataFrame:
    """Units with their number of children and the sums within the chain of conversations that name them."""
    children = units.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    rows = units.join(staged(children, "children"), "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    weight = (F.col("n_convs") - 1) * F.aggregate("points", F.lit(0).cast("long"), lambda a, x: a + x)
    up = Window.partitionBy("conv_id").orderBy(F.col("depth").desc())
    return rows.withColumn("weight", weight).select(
        "*",
        F.coalesce(F.sum("weight").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")).alias("under"),
        # only the last unit of a chain can be childless
        F.max((F.col("n_children") == 0).cast("long")).over(Window.partitionBy("conv_id")).alias("leaf"),
        F.lead("depth").over(up).isNull().alias("top"))


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations."""
    spark = conversations.sparkSession
    own = staged(ordered_turns(conversations), "turns")
    ids = staged(own.filter("d = 1").select("conv_id"), "convs")
    n_all, least = ids.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    blocks = staged(turn_blocks(rebuilt(own, ids), block), "blocks")
    paths = staged(path_units(blocks, solid_blocks(blocks, n_all, block), block), "paths")

    root = spark.range(1 if n_all else 0).select(
        _root(), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(1).alias("size"),
        F.array(F.lit(0)).alias("points"), F.lit(n_all).cast("long").alias("n_convs"), F.lit(least).cast("long").alias("conv_id"))
    units = paths.groupBy("key", "parent", "depth", "size", "points").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
    units = staged(chains(staged(units.unionByName(root), "units")), "chains")

    tops = staged(units.filter("top").select(
        "conv_id", F.col("depth").alias("top_depth"), (F.col("under") + F.col("weight")).alias("total"), "leaf", "key", "parent"), "tops")
    above = paths.select("conv_id", "depth", "key").join(tops.drop("key", "parent"), "conv_id").filter("depth < top_depth")
    above = above.select("key", "total", "leaf").union(tops.filter("top_depth > 0").select(_root(), "total", "leaf"))
    above = staged(above.groupBy("key").agg(F.sum("total").alias("handed"), F.sum("leaf").alias("leaves")), "handed")
    parents = tops.filter("parent IS NOT NULL").select(F.col("key").alias("child"), F.col("parent").alias("key")).join(
        units.select("key", F.col("conv_id").alias("parent_conv")), "key")
    parents = staged(parents.select(F.col("child").alias("key"), "parent_conv"), "parents")
    silent = ids.join(blocks.filter("k = 0").select("conv_id"), "conv_id", "left_anti").select(_root(), "conv_id")
    ends = staged(member_digests(paths.filter("ends").select("key", "conv_id").union(silent)), "ends")

    rows = units.join(above, "key", "left").join(parents, "key", "left").join(ends, "key", "left")
    zero = F.lit(0).cast("long")
    rows = rows.select(
        "*", (F.col("under") + F.coalesce("handed", zero)).alias("below"), (F.col("leaf") + F.coalesce("leaves", zero)).alias("n_leaves"),
        F.explode(F.sequence(F.lit(1), F.col("size"))).alias("j"))
    final = F.col("j") == F.col("size")
    rest = F.aggregate(F.slice("points", F.col("j"), F.col("size")), zero, lambda a, x: a + x)
    parent = F.when(F.col("j") > 1, F.col("conv_id")).when(F.col("depth") > 0, F.coalesce("parent_conv", "conv_id"))
    return rows.select(
        "conv_id", (F.col("depth") - F.col("size") + F.col("j")).alias("depth"), parent.alias("parent_conv_id"), "n_convs",
        F.when(final, F.col("n_children")).otherwise(F.lit(1).cast("long")).alias("n_children"), "n_leaves",
        (F.col("below") + (F.col("n_convs") - 1) * rest).alias("saved_tokens"),
        F.when(final & F.col("ends_sha256").isNotNull(), F.col("ends_sha256")).otherwise(F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op13_conversation_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


# crc32 by its table; prefixes are compared as joined texts, subtrees as pairs of a node and one below it
OP13_SQL = r"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
               lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
v AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
               sha256(length(role) || ':' || role || text)) AS pos FROM v),
i AS (SELECT conv_id, conv_id - conv_id % 100 AS base,
             xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
               list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 6 AS h
      FROM (SELECT DISTINCT conv_id FROM v), tab),
b AS (SELECT i.conv_id, 0 AS part, pos, role, text FROM i JOIN o ON o.conv_id = i.base AND pos <= h
      UNION ALL SELECT i.conv_id, 1, pos, role, text FROM i JOIN o ON o.conv_id = i.conv_id AND pos > h),
r AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS d FROM b),
p AS (SELECT conv_id, d, length(text) AS points,
             string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY d) AS prefix
      FROM r UNION ALL SELECT conv_id, 0, 0, '' FROM i),
k AS (SELECT conv_id, d, points, sha256(prefix) AS key, max(d) OVER (PARTITION BY conv_id) AS len,
             lag(sha256(prefix)) OVER (PARTITION BY conv_id ORDER BY d) AS parent FROM p),
n AS (SELECT key, any_value(d) AS depth, any_value(parent) AS parent, any_value(points) AS points, min(conv_id) AS conv_id,
             count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = len), '') AS ends
      FROM k GROUP BY key),
c AS (SELECT parent AS key, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (key)),
q AS (SELECT DISTINCT a.key AS key, z.key AS low FROM k a JOIN k z ON a.conv_id = z.conv_id AND a.d <= z.d),
s AS (SELECT q.key, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * points) AS saved
      FROM q JOIN m ON m.key = q.low GROUP BY q.key)
SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN s USING (key) LEFT JOIN m u ON u.key = m.parent
"""
