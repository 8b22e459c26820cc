"""Secret scans with a trigram index.

``trigram_query`` derives from each rule's pattern a Boolean condition on the
trigrams that every match must contain (lower case; OR of ANDs).
``build_postings`` indexes those trigrams only: one row per (trigram, text).
``candidates`` intersects the postings of each branch by counting them per
text; the postings of one trigram are spread over all tasks, because they
meet by text, not by trigram.  Candidates are then verified with the pattern.
Rules without a mandatory trigram (long hexadecimal runs) scan every text.

Spans are found with built-in functions: the texts between the matches
(``split``) and the matches (``regexp_extract_all``) add up to positions.
Everything is DataFrame code.

Edge cases: a NULL text is empty; spans count code points; rows that repeat an
id are scanned each (a posting names the id and a hash of the text); NULL ids
are kept; an empty table gives no rows; extra columns are ignored by
``secret_spans`` and kept by ``mask_secrets``.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _parser as re_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import staged, table


@dataclass(frozen=True)
class SecretRule:
    """``kind`` of the spans, the pattern, and what a match must fulfil to count:
    at least ``least`` characters in capture group ``group``.
    """

    kind: str
    pattern: str
    group: int
    least: int


# The base patterns, in the order in which kinds are listed.
BASE_RULES = (
    SecretRule(
        "assign",
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2, 6,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20),
    SecretRule("hex", r"[0-9a-f]+", 0, 24),
)
# Well-known public token formats that the base kinds don't name.
MORE_RULES = (
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    SecretRule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
)
RULES = BASE_RULES + MORE_RULES


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _literals(items, branches: list[tuple[str, ...]], most: int = 64) -> list[tuple[str, ...]]:
    """Extends each branch (literal runs, the last one open) by parsed pattern items.

    A branch forks at alternatives, optional parts and small character
    classes; whatever else isn't a literal ends the open run.
    """
    closed = lambda bs: [b if b[-1] == "" else (*b, "") for b in bs]
    for op, arg in items:
        name = str(op)
        if name == "LITERAL":
            branches = [(*b[:-1], b[-1] + chr(arg).lower()) for b in branches]
            continue
        if name == "SUBPATTERN":
            forks = [_literals(arg[3], branches)]
        elif name == "BRANCH":
            forks = [_literals(x, branches) for x in arg[1]]
        elif name == "MAX_REPEAT" and arg[:2] == (0, 1):
            forks = [branches, _literals(arg[2], branches)]
        elif name == "MAX_REPEAT" and arg[0] > 0:
            forks = [closed(_literals(arg[2], branches))]
        elif name == "IN" and len(arg) <= 8 and all(str(o) == "LITERAL" for o, _ in arg):
            forks = [_literals([x], branches) for x in arg]
        else:
            forks = [closed(branches)]
        merged = list(dict.fromkeys(b for f in forks for b in f))
        branches = merged if len(merged) <= most else closed(branches)
    return branches


def trigram_query(rule: SecretRule) -> list[frozenset[str]] | None:
    """OR of ANDs of lower-case trigrams, derived from the pattern; None: nothing is mandatory."""
    branches = [frozenset().union(*(trigrams(x) for x in b)) for b in _literals(re_parser.parse(rule.pattern), [("",)])]
    if any(not b for b in branches):
        return None
    return [b for b in dict.fromkeys(branches) if not any(o < b for o in branches)]


def _key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _fingerprint() -> Column:
    return F.xxhash64("text")


def build_postings(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """(trigram, doc_id, t): the texts that hold each trigram of the rules' queries."""
    needed = sorted({g for r in rules for b in trigram_query(r) or [] for g in b})
    low = docs.select("doc_id", _fingerprint().alias("t"), F.lower("text").alias("_low"))
    held = F.filter(F.array(*[F.lit(g) for g in needed]), lambda g: F.contains(F.col("_low"), g))
    return low.select("doc_id", "t", F.explode(held).alias("trigram")).distinct()


def candidates(postings: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """(doc_id, t, kinds): the rules whose trigram query each text fulfils."""
    spark = postings.sparkSession
    rows = [
        (r.kind, f"{r.kind}/{n}", len(branch), g)
        for r in rules
        for n, branch in enumerate(trigram_query(r) or [])
        for g in sorted(branch)
    ]
    wanted = spark.createDataFrame(rows, "kind string, branch string, needed int, trigram string")  # the rules' size
    met = postings.join(F.broadcast(wanted), "trigram").groupBy("doc_id", "t", "kind", "branch", "needed").agg(F.count(F.lit(1)).alias("n"))
    return met.filter("n = needed").groupBy("doc_id", "t").agg(F.collect_set("kind").alias("kinds"))


def _spans(text: Column, rule: SecretRule, kind_no: int) -> Column:
    """array<struct<start, kind_no, end>> of the rule's matches, failing ones dropped."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = whole if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    zipped = F.zip_with(
        F.zip_with(gaps, whole, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m"))),
        part,
        lambda gm, p: F.struct(gm["g"].alias("g"), gm["m"].alias("m"), F.length(p).alias("p")),
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    walked = F.aggregate(
        zipped,
        F.struct(F.lit(0).alias("at"), none.alias("found")),
        lambda acc, x: F.struct(
            (acc["at"] + x["g"] + F.coalesce(x["m"], F.lit(0))).alias("at"),
            F.when(
                x["p"] >= rule.least,
                F.concat(
                    acc["found"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["g"]).alias("start"),
                            F.lit(kind_no).alias("kind"),
                            (acc["at"] + x["g"] + x["m"]).alias("end"),
                        )
                    ),
                ),
            ).otherwise(acc["found"]).alias("found"),
        ),
        lambda acc: acc["found"],
    )
    # most texts have no match at all
    return F.when(text.rlike(_quick(rule)), walked).otherwise(none)


def _quick(rule: SecretRule) -> str:
    """A pattern that every text with a counted match fulfils."""
    return r"[0-9a-f]{24}" if rule.kind == "hex" else rule.pattern


def scanned(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, spans (array of start, kind, end in order) of every row."""
    k = _key(docs, id_col, text_col)
    found = staged(candidates(build_postings(k, rules), rules), "secret-candidates")
    keyed = k.withColumn("t", _fingerprint()).alias("k")
    f = found.alias("f")
    same = F.col("k.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("k.t") == F.col("f.t"))
    j = keyed.join(f, same, "left").select("k.doc_id", "k.text", F.col("f.kinds").alias("_kinds"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    parts = []
    for no, r in enumerate(rules):
        if trigram_query(r) is None:
            parts.append(_spans(F.col("text"), r, no))
        else:
            parts.append(F.when(F.array_contains("_kinds", r.kind), _spans(F.col("text"), r, no)).otherwise(none))
    return j.withColumn("spans", F.array_sort(F.concat(*parts))).drop("_kinds")


def joined(spans: Column, rules: tuple[SecretRule, ...] = RULES) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def secret_spans(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (start, kind number, end) of every row."""
    return scanned(docs, rules, id_col, text_col).drop("text")


def mask_secrets(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with each span (overlapping ones merged) replaced by ``[SECRET]``.

    The row travels as one struct; the length column, if there is one, follows the text.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), F.col(text_col).alias("text"))
    # rows are joined by a hash of the whole row
    k = packed.select(F.xxhash64(F.struct("doc_id")).alias("h"), "doc_id", "text").withColumnRenamed("doc_id", "_row")
    s = _scan_rows(k, rules)
    ends = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, x: F.struct(
            F.when(
                x["start"] >= acc["at"],
                F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, x["start"] - acc["at"]), F.lit("[SECRET]")),
            ).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], x["end"]).alias("at"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))),
    )
    original = F.col("_row").getField(text_col)
    s = s.withColumn("_new", F.when(F.size("spans") > 0, ends).otherwise(original))
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.col("_new").alias(c))
        elif c == length_col:
            changed = F.length("_new").cast(docs.schema[c].dataType)
            cols.append(F.when(F.size("spans") > 0, changed).otherwise(F.col("_row").getField(c)).alias(c))
        else:
            cols.append(F.col("_row").getField(c).alias(c))
    return s.select(*cols)


def _scan_rows(k: DataFrame, rules: tuple[SecretRule, ...]) -> DataFrame:
    """Adds spans to (h, _row, text): as ``scanned``, the row being carried along."""
    texts = k.select(F.col("h").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = staged(candidates(build_postings(texts, rules), rules), "secret-candidates")
    full = k.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("t", _fingerprint())
    f = found.select(F.col("doc_id").alias("h"), "t", "kinds")
    j = full.join(f, ["h", "t"], "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    parts = []
    for no, r in enumerate(rules):
        own = _spans(F.col("text"), r, no)
        parts.append(own if trigram_query(r) is None else F.when(F.array_contains("kinds", r.kind), own).otherwise(none))
    return j.withColumn("spans", F.array_sort(F.concat(*parts)))


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    s = scanned(table(spark, sf_dir, "documents"))
    n_base = len(BASE_RULES)
    base = F.filter("spans", lambda x: x["kind"] < n_base)
    s = s.select("doc_id", "spans", base.alias("base"))
    count = lambda no: F.size(F.filter("base", lambda x: x["kind"] == no)).cast("long")
    return s.select(
        "doc_id", *[count(no).alias(f"n_{r.kind}") for no, r in enumerate(BASE_RULES)],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def _found_sql(no: int, rule: SecretRule) -> str:
    p = rule.pattern.replace("'", "''")
    return f"""
f{no} AS (SELECT rid, regexp_extract_all(text, '{p}', 0) AS m, regexp_extract_all(text, '{p}', {rule.group}) AS g,
          regexp_split_to_array(text, '{p}') AS gaps FROM d),
s{no} AS (SELECT rid, {no} AS kind_no, '{rule.kind}' AS kind, i, length(g[i]) AS glen,
          list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS b,
          length(m[i]) AS mlen FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM f{no})),
k{no} AS (SELECT rid, kind_no, kind, CAST(b AS BIGINT) AS b, CAST(b + mlen AS BIGINT) AS e FROM s{no} WHERE glen >= {rule.least})"""


_ALL_SQL = " UNION ALL ".join(f"SELECT * FROM k{no}" for no in range(len(RULES)))
OP7_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
{','.join(_found_sql(no, r) for no, r in enumerate(RULES))},
u AS (SELECT *, kind || ':' || b || ':' || e AS one FROM ({_ALL_SQL})),
a AS (SELECT rid, {', '.join(f"count(*) FILTER (kind_no = {no}) AS n_{r.kind}" for no, r in enumerate(BASE_RULES))},
             coalesce(string_agg(one, ',' ORDER BY b, kind_no) FILTER (kind_no < {len(BASE_RULES)}), '') AS base,
             string_agg(one, ',' ORDER BY b, kind_no) AS spans FROM u GROUP BY rid)
SELECT doc_id, {', '.join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (rid)
"""
