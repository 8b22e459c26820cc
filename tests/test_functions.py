import hashlib

from pyspark.sql import functions as F

from lakevault.functions import (
    FIELD_SEPARATOR,
    changed_any,
    clean_positive_int,
    clean_text,
    default_if_blank,
    default_if_null,
    drop_null_tokens,
    hash_diff,
    hash_key,
    require_not_null,
    split_phone,
)
import pytest


def sha(text, bits):
    return getattr(hashlib, f"sha{bits}")(text.encode()).hexdigest()


def test_hash_key_matches_hashlib_in_every_form(spark):
    df = spark.createDataFrame([(7,), (123456,)], "k int")
    rows = df.select(
        "k",
        hash_key("k", form="hex").alias("hex"),
        hash_key("k").alias("hexbin"),
        hash_key("k", form="digest").alias("digest"),
        hash_key("k", bits=512, form="hex").alias("hex512"),
    ).collect()
    for r in rows:
        assert r["hex"] == sha(str(r["k"]), 256)
        assert bytes(r["hexbin"]) == sha(str(r["k"]), 256).encode()  # hex text bytes, 64 long
        assert len(r["hexbin"]) == 64
        assert bytes(r["digest"]).hex() == sha(str(r["k"]), 256) and len(r["digest"]) == 32
        assert r["hex512"] == sha(str(r["k"]), 512)


def test_hash_key_null_and_composite(spark):
    df = spark.createDataFrame([(None, "a"), (1, None)], "k int, s string")
    r = df.select(hash_key("k", form="hex").alias("h"), hash_key("k", "s", form="hex").alias("c")).collect()
    assert r[0]["h"] is None
    assert r[0]["c"] == sha(FIELD_SEPARATOR.join(["", "a"]), 256)
    assert r[1]["c"] == sha(FIELD_SEPARATOR.join(["1", ""]), 256)


def test_hash_diff_default_512_and_separator(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "x string, y string")
    with_sep = [r[0] for r in df.select(hash_diff("x", "y", form="hex")).collect()]
    no_sep = [r[0] for r in df.select(hash_diff("x", "y", sep="", form="hex")).collect()]
    assert with_sep[0] != with_sep[1]
    assert no_sep[0] == no_sep[1] == sha("abc", 512)
    assert with_sep[0] == sha("ab" + FIELD_SEPARATOR + "c", 512)


def test_clean_text_edge_rows(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("\t",), (" Ann ",)], "v string")
    got = [r[0] for r in df.select(clean_text("v", "No Registra")).collect()]
    assert got == ["No Registra", "No Registra", "No Registra", "\t", "Ann"]


def test_clean_positive_int(spark):
    df = spark.createDataFrame([(None,), (0,), (-5,), (12345,)], "z int")
    assert [r[0] for r in df.select(clean_positive_int("z")).collect()] == [-1, -1, -1, 12345]


def test_defaults(spark):
    df = spark.createDataFrame([(None,), ("",), ("(916)",)], "v string")
    got = df.select(default_if_null("v", "x").alias("a"), default_if_blank("v", "(N/D)").alias("b")).collect()
    assert [r["a"] for r in got] == ["x", "", "(916)"]
    assert [r["b"] for r in got] == [None, "(N/D)", "(916)"]


def test_null_token_predicates(spark):
    df = spark.createDataFrame([(None,), ("NULL",), ("a@x",)], "v string")
    and_kept = [r[0] for r in df.filter(drop_null_tokens("v", ("NULL",))).collect()]
    or_kept = [r[0] for r in df.filter(drop_null_tokens("v", ())).collect()]
    assert and_kept == ["a@x"]
    assert sorted(or_kept) == ["NULL", "a@x"]  # the text 'NULL' passes the OR variant


@pytest.mark.parametrize(
    "phone, area, number",
    [
        ("(916) 381-6003", "(916)", 3816003),
        ("555", "", 555),
        ("9163816003", "", -1),  # INT overflow
        ("(916) abc", "(916)", -1),
        ("(916)", "(916)", -1),
        ("(916) 381.6003", "(916)", -1),
        (None, "", -1),
    ],
)
def test_split_phone_edge_rows(spark, phone, area, number):
    df = spark.createDataFrame([(phone,)], "p string")
    a, _, n = split_phone("p")
    r = df.select(a.alias("a"), n.alias("n")).first()
    assert (r["a"], r["n"]) == (area, number)


def test_changed_any_is_null_safe_and_null_never_overwrites(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), (None, "a"), ("a", None)], "n string, o string")
    got = [r[0] for r in df.select(changed_any([F.col("n")], [F.col("o")])).collect()]
    assert got == [False, True, False, True]


def test_require_not_null_fails_inside_the_job(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    checked = require_not_null(df, ["a", "b"], "t")
    with pytest.raises(Exception, match="NULL in NOT NULL column t.b"):
        checked.collect()
    assert require_not_null(spark.createDataFrame([(1, "x")], "a int, b string"), ["a", "b"]).count() == 1
