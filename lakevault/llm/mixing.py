"""Mixing sources to target weights by Sainte-Laguë apportionment.

1. ``source_targets``: sources in code-point order (NULL last) get the weights
   in turn; together they ask for ``share`` of all words.  No source may take
   more than ``cap`` times its size; what it can't take goes to the others by
   weight (water filling in closed form: sources sorted by cap / weight).
2. The words asked for are cut into blocks of ``block_words``.  The blocks go
   to sources, and each source's blocks to its shards, by highest quotients
   target / (2 j + 1).  All quotients but about three per party are
   counted by a divisor, only those near the cut are listed and ranked.
3. A shard holds about ``shard_words`` words of one source, dealt by a seeded
   hash of the id, so a source with a third of all rows is many shards.  Its
   documents stand in the order of that hash; its blocks are taken from a
   seeded start, round the shard if need be, each word at most ``cap`` times.

Everything is DataFrame code.  Edge cases: a NULL text has size 0; sizes of 0
give targets of 0; sources may be NULL; repeated rows count each; repeated or
NULL ids fall in one shard; an empty table gives no rows.  Ties of quotients
go to the earlier source or shard.  Extra columns are ignored by ``mix_plan``
and kept by ``mix_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakevault.llm.common import GAP, n_words_of, staged, table

WEIGHTS = (3, 1, 2)
CAP = 2  # times a source's or document's size
BLOCK_WORDS = 64
SHARD_WORDS = 1_000_000
SEED = "mix-1"


def _seeded(col: Column, seed: str) -> Column:
    """60 bits of a hash of the id, as a long."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, src, weight, source_size, target) for sizes (source, size); 150 % of all words in all."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    s = s.withColumn("src", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("src") % len(weights)) + 1).cast("long"))
    # caps in the order in which they bind: cap * size / weight ascending (scaled to integers)
    scale = 1
    for w in weights:
        scale *= w
    order = [(F.col("source_size") * (F.lit(scale) / F.col("weight")).cast("long")).asc(), F.col("src").asc()]
    before = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    rest = W.orderBy(*order).rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.partitionBy()
    s = s.withColumns(
        {
            "_all": F.sum("source_size").over(whole),
            "_full": F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0)),
            "_weights": F.sum("weight").over(rest),
        }
    )
    # cap * size <= (1.5 all - full) * weight / weights, in integers
    s = s.withColumn(
        "_capped",
        2 * cap * F.col("source_size") * F.col("_weights") <= (3 * F.col("_all") - 2 * F.col("_full")) * F.col("weight"),
    )
    s = s.withColumns(
        {
            "_taken": F.sum(F.when(F.col("_capped"), cap * F.col("source_size")).otherwise(0)).over(whole),
            "_open": F.sum(F.when(~F.col("_capped"), F.col("weight")).otherwise(0)).over(whole),
        }
    )
    left = (3 * F.col("_all") - 2 * F.col("_taken")).cast("double") / 2
    target = F.when(F.col("_capped"), (cap * F.col("source_size")).cast("double")).otherwise(
        left * F.col("weight").cast("double") / F.col("_open").cast("double")
    )
    return s.select("source", "src", "weight", "source_size", target.alias("target"))


def sainte_lague(parties: DataFrame, group: list[str], party: str, share: str, seats: str) -> DataFrame:
    """Adds ``quota``: in each group the ``seats`` go one by one to the party with
    the highest quotient share / (2 j + 1), j being the seats that it has; ties
    to the smaller party.  The column ``seats`` is constant in a group.

    Parties whose quotient is at least all / (2 m) for m = seats less the number
    of parties are counted by division; of the rest only the quotients above
    the same bound for m = seats plus that number are listed.
    """
    g = W.partitionBy(*group) if group else W.partitionBy()
    p = parties.withColumns({"_sum": F.sum(share).over(g), "_n": F.count(F.lit(1)).over(g)})

    def seats_at(m: Column) -> Column:
        at = F.floor(m * F.col(share) / F.col("_sum") + 0.5)
        return F.when((F.col("_sum") > 0) & (m > 0), at).otherwise(0).cast("long")

    p = p.withColumns({"_base": seats_at(F.col(seats) - F.col("_n")), "_top": seats_at(F.col(seats) + F.col("_n"))})
    p = p.withColumn("_left", F.col(seats) - F.sum("_base").over(g))
    listed = p.filter(F.col("_top") > F.col("_base")).select(
        *group, party, "_left", F.col(share).alias("_share"), F.explode(F.sequence(F.col("_base"), F.col("_top") - 1)).alias("_j")
    )
    quotient = F.col("_share").cast("double") / (2 * F.col("_j") + 1).cast("double")
    rank = W.partitionBy(*group).orderBy(quotient.desc(), F.col(party).asc(), F.col("_j").asc())
    won = listed.withColumn("_rank", F.row_number().over(rank)).filter(F.col("_rank") <= F.col("_left"))
    more = won.groupBy(*group, party).agg(F.count(F.lit(1)).alias("_more"))
    out = p.join(more, [*group, party], "left")
    return out.withColumn("quota", F.col("_base") + F.coalesce(F.col("_more"), F.lit(0))).drop(
        "_sum", "_n", "_base", "_top", "_left", "_more"
    )


def _shard_of(src_shards: Column) -> Column:
    return F.col("_h") % src_shards


def mix_shards(sizes: DataFrame, block_words: int, shard_words: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """(sources with their number of shards, shards with quota, whole passes, start and length of the rest)."""
    sources = source_targets(sizes)
    sources = sources.withColumns(
        {
            "shards": F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long"),
            # 150 % of all words in blocks, rounded
            "blocks": F.floor((3 * F.sum("source_size").over(W.partitionBy()) + block_words) / (2 * block_words)).cast("long"),
        }
    )
    sources = staged(sainte_lague(sources, [], "src", "target", "blocks").withColumnRenamed("quota", "source_quota"), "mix-sources")
    placed = with_shard(sizes, sources)
    shards = placed.groupBy("src", "shard").agg(F.sum("size").alias("shard_size"), F.first("source_quota").alias("source_quota"))
    shards = sainte_lague(shards, ["src"], "shard", "shard_size", "source_quota")
    words = F.least(F.col("quota") * block_words, CAP * F.col("shard_size"))
    n_blocks = F.ceil(F.col("shard_size") / block_words)
    start = F.when(n_blocks > 0, _seeded(F.concat_ws(":", F.col("src"), F.col("shard")), seed) % n_blocks).otherwise(0) * block_words
    passes = F.when(F.col("shard_size") > 0, F.floor(words / F.col("shard_size"))).otherwise(0).cast("long")
    shards = shards.withColumns({"passes": passes, "start": start.cast("long"), "_words": words})
    shards = shards.select("src", "shard", "shard_size", "passes", "start", (F.col("_words") - F.col("passes") * F.col("shard_size")).alias("rest"))
    return sources, staged(shards, "mix-shards")


def with_shard(rows: DataFrame, sources: DataFrame) -> DataFrame:
    s = sources.withColumnRenamed("source", "_source")
    j = rows.join(s, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return j.withColumn("shard", _shard_of(F.col("shards")))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and its place in its shard."""
    sizes = staged(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words_of(F.col(text_col)).alias("size"),
            _seeded(F.col(id_col), seed).alias("_h"),
        ),
        "mix-sizes",
    )
    return _plan(sizes, *mix_shards(sizes, block_words, shard_words, seed))


def _plan(sizes: DataFrame, sources: DataFrame, shards: DataFrame) -> DataFrame:
    placed = with_shard(sizes, sources).join(shards, ["src", "shard"])
    upto = W.partitionBy("src", "shard").orderBy("_h", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    p = placed.withColumn("_end", F.sum("size").over(upto)).withColumn("_begin", F.col("_end") - F.col("size"))

    def overlap(lo: Column, hi: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("_end"), hi) - F.greatest(F.col("_begin"), lo))

    stop = F.col("start") + F.col("rest")
    taken = F.col("passes") * F.col("size") + overlap(F.col("start"), stop) + overlap(F.lit(0), stop - F.col("shard_size"))
    return p.withColumn("taken", taken.cast("long"))


def mix_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source",
                  block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: str = SEED) -> DataFrame:
    """The mixture as rows of ``docs``: each document as often as its words are
    taken, rounded to whole copies (0 to 2).

    The rounded choice is one or two runs of the hash order in each shard, so
    the texts aren't shuffled: a row is judged by its shard's bounds.
    """
    sizes = staged(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words_of(F.col(text_col)).alias("size"),
            _seeded(F.col(id_col), seed).alias("_h"),
        ),
        "mix-sizes",
    )
    sources, shards = mix_shards(sizes, block_words, shard_words, seed)
    plan = _plan(sizes, sources, shards)
    middle = F.col("_begin") + F.col("_end")  # twice the middle word
    stop = 2 * (F.col("start") + F.col("rest"))
    first = (F.col("size") > 0) & (middle >= 2 * F.col("start")) & (middle < stop)
    again = (F.col("size") > 0) & (middle < stop - 2 * F.col("shard_size"))
    bounds = plan.groupBy("src", "shard").agg(
        F.first("passes").alias("_passes"),
        F.min(F.when(first, F.col("_h"))).alias("_lo"), F.max(F.when(first, F.col("_h"))).alias("_hi"),
        F.max(F.when(again, F.col("_h"))).alias("_hi2"),
    )
    bounds = staged(bounds, "mix-bounds")
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(source_col).alias("source"), _seeded(F.col(id_col), seed).alias("_h"),
    )
    j = with_shard(row, sources.select("source", "src", "shards")).join(bounds, ["src", "shard"])
    more = F.coalesce(F.col("_h").between(F.col("_lo"), F.col("_hi")), F.lit(False)) | F.coalesce(F.col("_h") <= F.col("_hi2"), F.lit(False))
    copies = F.col("_passes") + F.when(more, 1).otherwise(0)
    return j.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.least(copies, F.lit(CAP)).cast("int")))).select("_row.*")


def op4_source_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def _sainte_lague_sql(name: str, parties: str, group: str, party: str, share: str, seats: str) -> str:
    """Seats one by one in closed form, as in ``sainte_lague``; CTEs ``name``."""
    by = f"PARTITION BY {group}" if group else ""
    keys = f"{group + ', ' if group else ''}{party}"
    at = lambda m: f"CASE WHEN al > 0 AND {m} > 0 THEN CAST(floor(({m}) * {share} / al + 0.5) AS BIGINT) ELSE 0 END"
    return f"""
{name}_a AS (SELECT *, sum({share}) OVER ({by}) AS al, count(*) OVER ({by}) AS np FROM {parties}),
{name}_b AS (SELECT *, {at(f'({seats} - np)')} AS base, {at(f'({seats} + np)')} AS topj FROM {name}_a),
{name}_c AS (SELECT *, {seats} - sum(base) OVER ({by}) AS lft FROM {name}_b),
{name}_d AS (SELECT {keys}, lft, {share} AS sh, unnest(range(base, topj)) AS j FROM {name}_c),
{name}_e AS (SELECT *, row_number() OVER ({by} ORDER BY CAST(sh AS DOUBLE) / CAST(2 * j + 1 AS DOUBLE) DESC, {party}, j) AS rk FROM {name}_d),
{name}_f AS (SELECT {keys}, count(*) AS more FROM {name}_e WHERE rk <= lft GROUP BY {keys}),
{name} AS (SELECT c.*, c.base + coalesce(f.more, 0) AS quota FROM {name}_c c LEFT JOIN {name}_f f USING ({keys}))"""


_H = f"CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST({{}} AS VARCHAR), '')), 1, 15) AS BIGINT)"

OP4_SQL = rf"""
WITH z AS (SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '{GAP}'), lambda x: x <> '')) AS BIGINT) AS size,
                  {_H.format('doc_id')} AS h FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM z GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src FROM s0),
s2 AS (SELECT *, CASE src % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s1),
s3 AS (SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(2 * source_size) OVER (ORDER BY source_size * (6 // weight), src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
         sum(weight) OVER (ORDER BY source_size * (6 // weight), src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wrest FROM s2),
s4 AS (SELECT *, 4 * source_size * wrest <= (3 * total - 2 * filled) * weight AS capped FROM s3),
s5 AS (SELECT *, sum(CASE WHEN capped THEN 2 * source_size ELSE 0 END) OVER () AS given,
         sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS wopen FROM s4),
s6 AS (SELECT source, src, source_size, CASE WHEN capped THEN CAST(2 * source_size AS DOUBLE)
         ELSE CAST(3 * total - 2 * given AS DOUBLE) / 2 * CAST(weight AS DOUBLE) / CAST(wopen AS DOUBLE) END AS target FROM s5),
s7 AS (SELECT *, greatest(1, CAST(ceil(source_size / {SHARD_WORDS}) AS BIGINT)) AS shards,
         CAST((3 * sum(source_size) OVER () + {BLOCK_WORDS}) // (2 * {BLOCK_WORDS}) AS BIGINT) AS blocks FROM s6),
{_sainte_lague_sql('q', 's7', '', 'src', 'target', 'blocks')},
p AS (SELECT z.*, q.src, q.source_size, q.target, q.quota AS source_quota, z.h % q.shards AS shard
      FROM z JOIN q ON z.source IS NOT DISTINCT FROM q.source),
h0 AS (SELECT src, shard, CAST(sum(size) AS BIGINT) AS shard_size, any_value(source_quota) AS source_quota FROM p GROUP BY src, shard),
{_sainte_lague_sql('g', 'h0', 'src', 'shard', 'shard_size', 'source_quota')},
h1 AS (SELECT src, shard, shard_size, least(quota * {BLOCK_WORDS}, 2 * shard_size) AS wrds, CAST(ceil(shard_size / {BLOCK_WORDS}) AS BIGINT) AS nb FROM g),
h2 AS (SELECT *, CASE WHEN shard_size > 0 THEN wrds // shard_size ELSE 0 END AS passes,
         CASE WHEN nb > 0 THEN {_H.format("(CAST(src AS VARCHAR) || ':' || CAST(shard AS VARCHAR))")} % nb ELSE 0 END * {BLOCK_WORDS} AS st FROM h1),
h3 AS (SELECT src, shard, shard_size, passes, st, wrds - passes * shard_size AS rest FROM h2),
r AS (SELECT p.*, h3.* EXCLUDE (src, shard), sum(size) OVER (PARTITION BY p.src, p.shard ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e
      FROM p JOIN h3 ON p.src = h3.src AND p.shard = h3.shard)
SELECT doc_id, size, source_size, target,
       CAST(passes * size + greatest(0, least(e, st + rest) - greatest(e - size, st))
            + greatest(0, least(e, st + rest - shard_size) - (e - size)) AS BIGINT) AS taken
FROM r
"""
