"""Quality rules: a table of thresholds compiled into one Spark projection.

``quality_measures`` derives the measures of each text with built-in functions
only (no shuffle, no Python); ``QUALITY_RULES`` names a ratio of two measures
and its bounds; ``compile_rules`` turns the table into one Boolean column.

Edge cases: a NULL text counts as empty (no words, rejected by the length
rule); a ratio with a zero denominator is 0; repeated rows and NULL ids are
judged one by one; columns other than the id and the text are carried along
only by ``quality_filter``, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import table, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that it for was on are as with be at by this from or an he have not they "
    "de la le les des et que un une du en est pour qui dans il elle par sur au pas plus ou avec "
    "der die das und den von zu mit sich ist im dem nicht ein eine auf als auch es an er "
    "el los las y del se por con para su al lo como más una".split()
)


@dataclass(frozen=True)
class Rule:
    """``low <= part / whole <= high`` must hold (None: no bound)."""

    name: str
    part: str
    whole: str
    low: float | None = None
    high: float | None = None


QUALITY_RULES: tuple[Rule, ...] = (
    Rule("word_length", "word_chars", "n_words", 1.5, 25.0),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.4),
    Rule("stop_words", "n_stop_words", "n_words", 0.005, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.6),
)


def quality_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text and the measures; see the module docstring for edge cases."""
    i = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return _measure(i).drop("text")


def _measure(i: DataFrame) -> DataFrame:
    """Adds the measures to a frame with a non-null ``text`` column."""
    lines = F.filter(F.split("text", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    a = i.withColumns({"_words": words_of(F.col("text")), "_lines": lines})
    no_longs = F.array().cast("array<bigint>")
    b = a.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_stop_words": F.size(F.filter("_words", lambda w: F.lower(w).isin(*sorted(set(STOP_WORDS))))).cast("long"),
            # one 64-bit hash for each window of WINDOW words
            "_wins": F.when(
                F.size("_words") > WINDOW,
                F.transform(
                    F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)),
                    lambda p: F.xxhash64(F.slice("_words", p, WINDOW)),
                ),
            ).otherwise(no_longs),
        }
    ).drop("_words", "_lines")
    # windows sorted by hash; only texts that repeat a window pay for it
    c = b.withColumn(
        "_sorted",
        F.when(
            F.size("_wins") > F.size(F.array_distinct("_wins")),
            F.sort_array(F.transform("_wins", lambda h, p: F.struct(h.alias("h"), p.alias("p")))),
        ).otherwise(F.array().cast("array<struct<h:bigint,p:int>>")),
    ).drop("_wins")
    same = lambda s, j: (F.get("_sorted", j)["h"] == s["h"])
    d = c.withColumn(
        "_starts",
        F.sort_array(
            F.transform(
                F.filter("_sorted", lambda s, j: F.coalesce(same(s, j - 1), F.lit(False)) | F.coalesce(same(s, j + 1), F.lit(False))),
                lambda s: s["p"],
            )
        ),
    ).drop("_sorted")
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct(
            (acc["n"] + (p + WINDOW) - F.greatest(p, acc["end"])).alias("n"), (p + WINDOW).alias("end")
        ),
        lambda acc: acc["n"],
    )
    # measured once: a filter on a measure can't move below a generator, where the
    # optimizer would write each measure out again for every use
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words")
    once = F.inline(F.array(F.struct(*[F.col(n) for n in names], covered.alias("n_repeat_words"))))
    return d.select(*[F.col(f"`{c}`") for c in i.columns], once)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def compile_rules(rules: tuple[Rule, ...] = QUALITY_RULES) -> Column:
    """One Boolean expression: TRUE where every rule of the table holds."""
    verdict = F.lit(True)
    for r in rules:
        ratio = F.when(F.col(r.whole) > 0, F.col(r.part).cast("double") / F.col(r.whole)).otherwise(F.lit(0.0))
        if r.low is not None:
            verdict = verdict & (ratio >= r.low)
        if r.high is not None:
            verdict = verdict & (ratio <= r.high)
    return verdict


def quality_verdicts(docs: DataFrame, rules: tuple[Rule, ...] = QUALITY_RULES, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """id, measures, ``base_failed`` and ``kept`` of every row."""
    m = quality_measures(docs, id_col, text_col)
    return m.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & compile_rules(rules)})


def quality_filter(docs: DataFrame, rules: tuple[Rule, ...] = QUALITY_RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all their columns unchanged.

    The row travels as one struct, so its column names can't clash with ours.
    """
    i = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return _measure(i).filter(~base_failed() & compile_rules(rules)).select("_row.*")


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    v = quality_verdicts(table(spark, sf_dir, "documents"))
    return v.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _rules_sql(rules: tuple[Rule, ...] = QUALITY_RULES) -> str:
    parts = []
    for r in rules:
        ratio = f"(CASE WHEN {r.whole} > 0 THEN CAST({r.part} AS DOUBLE) / {r.whole} ELSE 0 END)"
        if r.low is not None:
            parts.append(f"{ratio} >= CAST({r.low!r} AS DOUBLE)")
        if r.high is not None:
            parts.append(f"{ratio} <= CAST({r.high!r} AS DOUBLE)")
    return " AND ".join(parts)


_STOP_SQL = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

OP6_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
wins AS (SELECT rid, p, list_aggregate(list_slice(words, p, p + {WINDOW - 1}), 'string_agg', ' ') AS win
         FROM (SELECT rid, words, unnest(range(1, len(words) - {WINDOW - 2})) AS p FROM w WHERE len(words) > {WINDOW})),
twice AS (SELECT rid, win FROM wins GROUP BY rid, win HAVING count(*) > 1),
starts AS (SELECT rid, p, lead(p) OVER (PARTITION BY rid ORDER BY p) AS nxt FROM wins JOIN twice USING (rid, win)),
rep AS (SELECT rid, CAST(sum(least({WINDOW}, coalesce(nxt - p, {WINDOW}))) AS BIGINT) AS n FROM starts GROUP BY rid),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(len(list_filter(words, lambda x: lower(x) IN ({_STOP_SQL}))) AS BIGINT) AS n_stop_words,
             coalesce(rep.n, 0) AS n_repeat_words
      FROM w LEFT JOIN rep USING (rid)),
b AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND {_rules_sql()}) AS kept
FROM b
"""
