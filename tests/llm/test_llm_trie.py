"""The prefix trie against brute force over rebuilt conversations."""

import hashlib
import os
import random
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from lakevault.llm import convtrie  # noqa: E402

SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, depth int, n bigint, parent string, d int"


def rows_of(convs):
    """Rows in mixed order, with columns whose names the operator uses itself."""
    rows = [(c, t, r, x, "k", 1, 2, "p", 3) for c, turns in convs for t, r, x in turns]
    random.Random(3).shuffle(rows)
    return rows


def awkward_conversations():
    rng = random.Random(11)
    out = []
    for c in list(range(0, 60)) + list(range(100, 130)) + [250, 999, -1, -100, -101, -105, 10**12, 10**12 + 7]:
        out.append((c, [(t, rng.choice(["user", "assistant"]), rng.choice(["hi", "yes", "no", "é \U0001d4b3", ""]))
                        for t in range(rng.randint(1, 11))]))
    hot = [(t, "user", f"the same {t}") for t in range(9)]
    out += [(c, hot) for c in range(300, 360)]  # one base and many copies
    out += [(400, [(t, "user", f"long {t}") for t in range(500)]), (401, [(t, "user", f"long {t}") for t in range(499)])]
    out += [(500, [(None, "user", "null turn"), (0, None, None), (None, "assistant", "null turn"), (0, "user", "tied")])]
    out += [(500, [(0, None, None), (None, "user", "null turn")])]  # repeated rows
    out += [(None, [(0, "user", "no id")])]
    return out


def brute(convs):
    turns = {}
    for c, own in convs:
        if c is not None:
            turns.setdefault(c, []).extend((t, r or "", x or "") for t, r, x in own)

    def order(turn):
        t, r, x = turn
        return (t is not None, t or 0, r.encode(), hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest())

    turns = {c: [(r, x) for _, r, x in sorted(own, key=order)] for c, own in turns.items()}
    paths = {}
    for c, own in turns.items():
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(turns.get(base, [])[:h] + own[h:])
    nodes = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    kids = {}
    for prefix in nodes:
        if prefix:
            kids.setdefault(prefix[:-1], []).append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(nodes, key=len, reverse=True):
        below = kids.get(prefix, [])
        leaves[prefix] = sum(leaves[k] for k in below) or 1
        own = (len(nodes[prefix]) - 1) * len(prefix[-1][1]) if prefix else 0
        saved[prefix] = own + sum(saved[k] for k in below)
    out = []
    for prefix, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(paths[c]) == len(prefix))
        out.append((min(members), len(prefix), min(nodes[prefix[:-1]]) if prefix else None, len(members), len(kids.get(prefix, [])),
                    leaves[prefix], saved[prefix], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def trie(spark, convs, block):
    df = spark.createDataFrame(rows_of(convs), SCHEMA).repartition(4)
    return sorted((tuple(r) for r in convtrie.prefix_trie(df, block).collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("block", [1, 4])
def test_trie_equals_brute_force(spark, block):
    convs = awkward_conversations()
    assert trie(spark, convs, block) == brute(convs)


def test_turnless_conversations_and_no_rows(spark):
    assert trie(spark, [], 4) == []
    short = [(c, [(0, "user", "a")]) for c in range(701, 760)]  # no base: those with a head lose their only turn
    assert trie(spark, short, 4) == brute(short)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in brute(short))


def test_only_diverging_blocks_are_refined(spark):
    """Copies go on as whole blocks: a unit of their paths holds a block of turns."""
    same = [(c, [(t, "user", f"turn {t}") for t in range(12)]) for c in (0, 100, 200)]
    other = same[:2] + [(200, same[2][1][:5] + [(5, "user", "another")] + same[2][1][6:])]
    sizes = []
    for convs in (same, other):
        df = spark.createDataFrame(rows_of(convs), SCHEMA)
        own = convtrie.ordered_turns(df)
        ids = own.filter("d = 1").select("conv_id")
        blocks = convtrie.turn_blocks(convtrie.rebuilt(own, ids))
        paths = convtrie.path_units(blocks, convtrie.solid_blocks(blocks, 3))
        sizes.append(sorted(r["size"] for r in paths.filter("conv_id = 0").collect()))
    assert sizes == [[4, 4, 4], [1, 1, 1, 1, 4, 4]]


def test_pieces_of_a_hot_key(spark):
    """A key with many members is hashed from pieces; the result is that of the whole list."""
    ids = spark.range(0, 20_000, 1, 6).selectExpr("id * 7 AS conv_id", "CASE WHEN id % 3 = 0 THEN X'AA' ELSE X'AB' END AS key")
    got = {bytes(r.key): r.ends_sha256 for r in convtrie.member_digests(ids).collect()}
    for key, keep in ((b"\xaa", lambda i: i % 3 == 0), (b"\xab", lambda i: i % 3)):
        text = ",".join(str(i * 7) for i in range(20_000) if keep(i))
        assert got[key] == hashlib.sha256(text.encode()).hexdigest()
