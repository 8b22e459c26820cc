"""Small tables with the awkward rows every operator must take."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, name string, key bigint, size int, t string, spans int"
BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"


def awkward_rows():
    rng = random.Random(5)
    words = BASE.split()
    base = [rng.choice(words) + str(rng.randint(0, 60)) for _ in range(120)]
    rows = []

    def add(i, text, source="s1"):
        rows.append((i, text, "en", source, None if text is None else len(text), "x", 1, 2, "y", 3))

    add(1, " ".join(base))
    near = list(base)
    near[60] = "changed"
    add(2, " ".join(near))
    add(3, " ".join(base).upper())  # equal but for the case
    add(4, " ".join(base))  # exact copy
    add(5, "")
    add(6, None, None)
    add(7, "   \n\t ", "s2")
    add(8, "one", None)
    add(9, "one two", "é")
    add(10, "token = 'abcdef0123456789abcdef0123' and AKIA" + "Q" * 20 + " é mail a.b@c.example.org +1 (743) 555-3824", "s2")
    add(11, "line one is here\n" * 40, "s2")
    add(12, "ab" * 20_000, "s3")  # one long word
    add(13, " ".join(rng.choice(words) for _ in range(30_000)), "s3")  # many words
    add(14, "x" * 150 + " ".join(base[:50]), "s3")
    add(None, "no id here but some text to look at", "s1")
    add(15, "repeated row of text", "s1")
    add(15, "repeated row of text", "s1")
    add(16, "the▁mark \U0001d4b3 \u0000 end", "s1")
    for i in range(17, 40):
        add(i, " ".join(rng.choice(words) + str(rng.randint(0, 999)) for _ in range(rng.randint(1, 90))), f"s{i % 4}")
    add(41, "the house of the king and the sea is in that land where it was told to me by a man with his hat on the road")
    return rows


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
