"""Filter interaction audit: what each filter removes in every order, and its Shapley value.

Every document gets a mask of the filters it fails.  ``removals`` tabulates,
for each coalition of filters, how many documents it removes (those failing
any of its filters); every figure of every order is a difference of two
coalitions.  The Shapley value of a filter is the solution of a least-squares
problem: an additive game fitted to all coalitions, weighted by the Shapley
kernel, with the efficiency constraint that the values sum to what all filters
remove together.  Its normal equations are solved in rationals, once, for
every right side at the same time (``shapley_operator``); applied to the table
of a part they give whole numbers, as the sum over all orders is asked for.

Edges: a NULL text is empty, a NULL language is the part ''.  A document
without an id has no smaller ids and is nobody's smaller one, so it never fails
E; rows that repeat an id with one text don't fail E by each other.  An id
labelled several times counts as good (toxic) if any of its labels says so;
labels without an id are left out.  Equal texts are found by SHA-256 of their bytes.  No documents,
no rows.
"""

from __future__ import annotations

import json
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import staged, table, words_of

FILTERS = "ABCDE"
COUNTS = ("n", "good", "toxic")


def shapley_operator(m: int) -> list[list[int]]:
    """Row i: weights of the 2^m coalition values whose sum is m! times filter i's Shapley value.

    Minimises the kernel-weighted squares of v(S) - sum of x_i over S, with the
    x summing to v(all): normal equations with one multiplier, eliminated in
    rationals.  The right sides are the unit vectors of the coalitions.
    """
    size = 1 << m
    full = size - 1
    weight = [Fraction(0)] * size
    for s in range(1, full):
        k = s.bit_count()
        weight[s] = Fraction(m - 1, comb(m, k) * k * (m - k))
    rows = []
    for i in range(m):
        left = [sum((weight[s] for s in range(size) if s >> i & 1 and s >> j & 1), Fraction(0)) for j in range(m)]
        rows.append(left + [Fraction(1)] + [weight[s] if s >> i & 1 else Fraction(0) for s in range(size)])
    rows.append([Fraction(1)] * m + [Fraction(0)] + [Fraction(s == full) for s in range(size)])
    for c in range(m + 1):
        pivot = next(r for r in range(c, m + 1) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(m + 1):
            if r != c and rows[r][c]:
                factor = rows[r][c]
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[c])]
    scaled = [[x * factorial(m) for x in row[m + 1 :]] for row in rows[:m]]
    if any(x.denominator != 1 for row in scaled for x in row):
        raise ArithmeticError("the solution isn't a whole multiple of 1 / m!")
    return [[int(x) for x in row] for row in scaled]


def text_failures(text: Column) -> list[Column]:
    """Conditions A to D over a text that isn't NULL."""
    words = words_of(text)
    n_words, n_chars = F.size(words).cast("long"), F.char_length(text).cast("long")
    capitals = n_chars - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [
        n_words < 200,
        100 * F.size(F.array_distinct(words)).cast("long") < 50 * n_words,
        100 * capitals > 3 * n_chars,
        text.rlike("[#$%&*|]"),
    ]


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic) of every document; bit i of ``mask`` is filter i.

    One pass over the texts leaves narrow rows.  The smallest id of each text
    is a partial aggregate, and the join back is on text and id together, so a
    text that fills a third of the table is spread over the tasks.
    """
    text = F.coalesce("text", F.lit(""))
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(text_failures(F.col("text")))]
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text"), F.coalesce("lang", F.lit("")).alias("part"))
    rows = rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), sum(bits[1:], bits[0]).alias("mask"))
    rows = staged(rows, "masks")
    first = staged(rows.groupBy("digest").agg(F.min("id").alias("id")).filter("id IS NOT NULL"), "firsts")
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        *[F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(g) for c, g in (("quality", "good"), ("toxic", "toxic"))]
    )
    rows = rows.join(first.withColumn("is_first", F.lit(True)), ["digest", "id"], "left")
    rows = rows.join(staged(marks, "marks"), "id", "left")
    copy = F.when(F.col("id").isNotNull() & F.col("is_first").isNull(), F.lit(1 << 4)).otherwise(F.lit(0))
    return rows.select(
        "part", F.col("mask").bitwiseOR(copy).alias("mask"),
        F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )


def removals(masks: DataFrame, m: int = len(FILTERS)) -> DataFrame:
    """One row per part: documents, and for each count an array by coalition of what it removes.

    Documents are first counted by part and mask, at most 2^m rows a part.
    """
    by_mask = masks.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    def removed(count: str) -> Column:
        sums = [F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, F.col(count)).otherwise(F.lit(0))) for s in range(1 << m)]
        return F.array(*sums).alias(f"v_{count}")

    return by_mask.groupBy("part").agg(F.sum("n").alias("n_docs"), *[removed(c) for c in COUNTS])


def _steps(filters: str) -> Column:
    """Every order's steps as one literal array: the filter's number and the coalitions before and after it."""
    out = []
    for order in permutations(range(len(filters))):
        before = 0
        name = "".join(filters[j] for j in order)
        for step, i in enumerate(order, 1):
            out.append({"filter_order": name, "step": step, "i": i, "s": before, "t": before | 1 << i})
            before |= 1 << i
    return F.from_json(F.lit(json.dumps(out)), "array<struct<filter_order:string,step:int,i:int,s:int,t:int>>")


def order_audit(table_of_removals: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step, from the coalition table."""
    m = len(filters)
    full = (1 << m) - 1

    def v(count: str, s: Column | int) -> Column:
        return F.element_at(f"v_{count}", (F.lit(s) if isinstance(s, int) else s) + 1)

    weights = shapley_operator(m)
    shapley = F.array(*[sum((v("n", s) * F.lit(w) for s, w in enumerate(row) if w), F.lit(0).cast("long")) for row in weights])
    unique = F.array(*[v("n", full) - v("n", full & ~(1 << i)) for i in range(m)])
    fails = F.array(*[v("n", 1 << i) for i in range(m)])
    wide = table_of_removals.select("part", "n_docs", *[f"v_{c}" for c in COUNTS], shapley.alias("shapley"),
                                    unique.alias("unique"), fails.alias("fails"), F.explode(_steps(filters)).alias("o"))
    own = F.col("o.i") + 1
    gone = v("n", F.col("o.t")) - v("n", F.col("o.s"))
    return wide.select(
        "part", "o.filter_order", "o.step",
        (F.col("n_docs") - v("n", F.col("o.t"))).alias("kept"),
        gone.alias("removed"),
        (F.element_at("fails", own) - gone).alias("redundant"),
        F.element_at("unique", own).alias("unique_fails"),
        (v("good", F.col("o.t")) - v("good", F.col("o.s"))).alias("good_lost"),
        (v("toxic", F.col("o.t")) - v("toxic", F.col("o.s"))).alias("toxic_lost"),
        F.element_at("shapley", own).alias("shapley"),
    )


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    masks = failure_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return order_audit(staged(removals(masks), "removals"))


# every order is run step by step over the documents, and Shapley is the sum over the orders
OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM d),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             (CASE WHEN len(words) < 200 THEN 'A' ELSE '' END)
             || (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END)
             || (CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) THEN 'C' ELSE '' END)
             || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
             || (CASE WHEN doc_id > first_id THEN 'E' ELSE '' END) AS failed
      FROM w LEFT JOIN l USING (doc_id)),
g AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, failed),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
p AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
o AS (SELECT filter_order, step, substr(filter_order, step, 1) AS filter, substr(filter_order, 1, step - 1) AS earlier
      FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
s AS (SELECT part, filter_order, step, filter, n, good, toxic, contains(failed, filter) AS fails, failed = filter AS only_this,
             len(list_intersect(string_split(failed, ''), string_split(earlier, ''))) > 0 AND earlier <> '' AND failed <> '' AS gone
      FROM g, o),
r AS (SELECT part, filter_order, step, filter,
             CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0) AS BIGINT) AS kept,
             CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0) AS BIGINT) AS removed,
             CAST(coalesce(sum(n) FILTER (WHERE gone AND fails), 0) AS BIGINT) AS redundant,
             CAST(coalesce(sum(n) FILTER (WHERE only_this), 0) AS BIGINT) AS unique_fails,
             CAST(coalesce(sum(good) FILTER (WHERE NOT gone AND fails), 0) AS BIGINT) AS good_lost,
             CAST(coalesce(sum(toxic) FILTER (WHERE NOT gone AND fails), 0) AS BIGINT) AS toxic_lost
      FROM s GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM r
"""
