"""Deduplication, mixing, search, archives: against brute force on awkward rows."""

import base64
import hashlib
import os
import random
import re
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from llm_fixtures import awkward, awkward_rows, empty  # noqa: E402

from lakevault.llm import graph, induced, mixing, neardup, suffixdedup, topk, warc  # noqa: E402


def test_induced_order_and_prefixes_equal_brute_force():
    rng = random.Random(3)
    for it in range(400):
        k = rng.choice([1, 2, 3, 5, 50])
        t = [rng.randint(1, k) for _ in range(rng.randint(1, 60))]
        t = (t * 4 if rng.random() < 0.3 else t) + [0]
        order = sorted(range(len(t)), key=lambda i: t[i:])

        def common(a, b):
            n = 0
            while max(a, b) + n < len(t) and t[a + n] == t[b + n]:
                n += 1
            return n

        got, prefix = induced.suffix_order(np.array(t), 10**6, base=rng.choice([0, 2, 10**9]), memory=rng.choice([0, 100, 1 << 20]))
        assert got.tolist() == order
        assert prefix.tolist() == [0] + [common(a, b) for a, b in zip(order, order[1:])]


def brute_cut(texts, length):
    seen = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("limits", [{}, {"hot": 1, "shard_bytes": 300}])
def test_repeated_passages(spark, limits):
    rows = awkward_rows()
    want = brute_cut([(r[1] or "").encode() for r in rows], 200)
    found = {(r.d, r.t): r for r in suffixdedup.remove_repeats(awkward(spark), **limits).collect()}
    keyed = suffixdedup.keyed(awkward(spark), "doc_id", "text").collect()
    got = sorted((str(k.doc_id), *((f.n_removed, f.n_spans, f.kept_sha256) if (f := found.get((k.d, k.t))) else
                                   (0, 0, hashlib.sha256(k.text.encode()).hexdigest()))) for k in keyed)
    assert got == sorted((str(r[0]), *w) for r, w in zip(rows, want))
    assert any(w[0] for w in want)


def test_repeated_passages_of_nothing(spark):
    assert suffixdedup.remove_repeats(empty(spark)).count() == 0


def test_rows_that_share_an_id_meet_their_own_text_only(spark, monkeypatch):
    """40 rows without an id and 40 with one id, all with other texts; and 20 equal rows."""
    rng = random.Random(7)
    shared = ["".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(3)]
    words = lambda: "".join(rng.choice("abcdefgh ") for _ in range(250))
    rows = [(i, words() + rng.choice(shared) + words()) for i in [None] * 40 + [7] * 40] + [(8, shared[0] + words())] * 20
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    written = {}

    def counted(big, ids, on, name):
        out = matches(big, ids, on, name)
        written[name] = out.count()
        return out

    matches = suffixdedup.staged_matches
    monkeypatch.setattr(suffixdedup, "staged_matches", counted)
    found = {(r.d, r.t): r for r in suffixdedup.remove_repeats(docs).collect()}
    assert written["cut-texts"] == len(rows) and written["piece-texts"] <= len(rows)
    keyed = suffixdedup.keyed(docs, "doc_id", "text").collect()
    got = sorted((str(k.doc_id), *((f.n_removed, f.n_spans, f.kept_sha256) if (f := found.get((k.d, k.t))) else
                                   (0, 0, hashlib.sha256(k.text.encode()).hexdigest()))) for k in keyed)
    want = brute_cut([r[1].encode() for r in rows], 200)
    assert got == sorted((str(r[0]), *w) for r, w in zip(rows, want))


def brute_components(rows, shingle):
    sets = [(r[0], neardup.exact_set(r[1], shingle)) for r in rows if r[0] is not None]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in sets:
        for j, b in sets:
            both = len(a & b)
            if i < j and both and 100 * both >= 80 * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in up}


def test_near_duplicates(spark):
    rows = awkward_rows()
    got = neardup.near_duplicates(awkward(spark), shingle=2).collect()
    want = brute_components(rows, 2)
    assert len(got) == len(rows)
    assert all(r.component_id == want[r.doc_id] for r in got if r.doc_id is not None)
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert {r.doc_id: r.n_shingles for r in got}[8] == 1 and want[4] == 1
    assert neardup.drop_near_duplicates(empty(spark)).count() == 0


def test_copies_among_rows_without_an_id_go(spark):
    words = [f"w{i}" for i in range(60)]
    near = " ".join(words[:59] + ["other"])
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(None, " ".join(words), 1), (5, " ".join(words), 2), (None, near, 3), (None, other, 4), (None, other, 5), (None, "lone row", 6),
            (None, None, 7), (None, "", 8), (9, "lone id", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, key int").repartition(3)
    got = neardup.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    kept = {r.key for r in got.collect()}
    assert len(kept & {4, 5}) == 1 and kept - {4, 5} == {2, 6, 7, 8, 9}


def test_keys_without_id_are_no_ids():
    top = (1 << 63) - 1
    assert neardup.keys_without_id(None, None, 3) == 0 and neardup.keys_without_id(1, 7, 3) == 8
    assert neardup.keys_without_id(-4, top - 2, 3) == -7 and neardup.keys_without_id(-4, top - 3, 3) == top - 2


def test_large_group_of_near_copies_by_blocks(spark, monkeypatch):
    """Chains of links that the bucket's smallest member doesn't see, in blocks of 8."""
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(60):
        t = list(base)
        for _ in range(rng.randint(1, 9)):
            t[rng.randrange(100)] = f"x{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(t)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, shingle=2).collect()}
    assert got == brute_components(rows, 2)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(41))
    assert all(got[a] == got[b] and got[a] <= min(a, b) for a, b in edges if a != b)


def brute_mix(sizes):
    """Targets by repeated resharing, in fractions."""
    names = sorted({s for s, _ in sizes}, key=lambda s: (s is None, s or ""))
    total = {n: sum(z for s, z in sizes if s == n) for n in names}
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    rest, open_, target = 1.5 * sum(total.values()), set(names), {}
    while True:
        w = sum(weight[n] for n in open_)
        over = {n for n in open_ if 2 * total[n] < rest * weight[n] / w}
        if not over:
            break
        for n in over:
            target[n] = 2.0 * total[n]
        rest -= sum(target[n] for n in over)
        open_ -= over
    return total, {**target, **{n: rest * weight[n] / sum(weight[m] for m in open_) for n in open_}}


def test_mixing(spark):
    rows = awkward_rows()
    sizes = [(r[3], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in rows]
    total, target = brute_mix(sizes)
    docs = awkward(spark)
    plan = mixing.mix_plan(docs).collect()
    assert len(plan) == len(rows)
    taken = Counter()
    for r in plan:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == total[r.source] and r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[n] - target[n]) <= 2 * mixing.BLOCK_WORDS for n in target)
    again = mixing.mix_plan(docs.repartition(7)).collect()
    assert sorted((str(r.doc_id), r.taken) for r in again) == sorted((str(r.doc_id), r.taken) for r in plan)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and max(Counter(r.doc_id for r in mixed.collect() if r.doc_id not in (15, None)).values()) <= 2
    assert mixing.mix_plan(empty(spark)).count() == 0


def test_sainte_lague_equals_seat_by_seat(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for g in range(12):
        n, seats = rng.randint(1, 9), rng.randint(0, 60)
        shares = [rng.choice([0, 1, 1, 5, 20, 333]) for _ in range(n)]
        got = [0] * n
        if sum(shares):
            for _ in range(seats):
                best = max(range(n), key=lambda i: (shares[i] / (2 * got[i] + 1), -i))
                got[best] += 1
        for i in range(n):
            rows.append((g, i, shares[i], seats))
            want[g, i] = got[i]
    df = spark.createDataFrame(rows, "g int, p int, share bigint, seats bigint")
    assert {(r.g, r.p): r.quota for r in mixing.sainte_lague(df, ["g"], "p", "share", "seats").collect()} == want


def test_bit_sliced_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 256], "z", 1) for i in range(300)]
    rows += [(50, None, "z", 1), (301, [0.1, None, 0.1, 0.1, 0.1, 0.1], "z", 1), (302, [float("nan")] * 6, "z", 1), (None, [0.5] * 6, "z", 1),
             (303, [float("inf")] * 6, "z", 1), (304, [1.0, 2.0], "z", 1), (0, rows[0][1], "z", 1), (7, [900.0] * 6, "z", 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, block string, score int").repartition(3)
    v = topk.vectors(df)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(v, v.filter("vec_id % 50 = 0"), block_rows=64, query_rows=2).collect())
    ok = [(i, np.floor(256 * np.array(e)).astype(int)) for i, e, _, _ in rows
          if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    want = []
    for q in sorted({i for i, _ in ok if i % 50 == 0}):
        x = next(e for i, e in ok if i == q)
        s = sorted((-int(x @ e), i) for i, e in ok if i != q and len(e) == len(x))[:5]
        want += [(q, n + 1, i, -z) for n, (z, i) in enumerate(s)]
    assert got == sorted(want)
    assert topk.top_k(v.filter("false"), v.filter("false")).count() == 0


def test_archives(spark, scratch):
    rng = random.Random(9)
    rows = [(i, f"http://www.host{i % 3}.example.com:80/p/{i}?q=é x\r\n#f", rng.choice(["same page é", "", f"page {i}"]), 7) for i in range(80)]
    rows += [(90, None, None, 7), (None, "http://x.example", "same page é", 7), (91, "http://[bad", "bad url", 7), (92, "http://a.example/", "x" * 300_000, 7), (92, "http://a.example/", "x" * 300_000, 7)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, offset int").repartition(4)
    got = warc.archive_pages(pages, f"{scratch}/warc", records_per_file=10, rows_per_range=20).collect()
    newest = {}
    for i, _, h, _ in rows:
        newest[h or ""] = max(newest.get(h or "", -1), -1 if i is None else i)
    want = Counter()
    for i, _, h, _ in rows:
        b = (h or "").encode()
        revisit = i != newest[h or ""]
        want[(i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", newest[h or ""] if revisit else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert all(r.intact for r in got)
    keys = [(r.urlkey, r.ts) for r in got]
    assert keys == sorted(keys) and keys[0][0] == "-"
    none = spark.createDataFrame([], pages.schema)
    assert warc.archive_pages(none, f"{scratch}/none").count() == 0


def test_join_of_pages_with_newest_can_be_split(spark):
    """No aggregate lies between the join and its exchanges."""
    from conftest import plan_text

    pages = spark.createDataFrame([(1, "http://x.example", "same"), (2, "http://x.example", "same")], "page_id bigint, url string, html string")
    records = warc.prepare_records(pages)
    assert "Aggregate" not in plan_text(records)
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in records.collect()) == [(1, "revisit", 2), (2, "response", None)]


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(1)
    for k in range(0, 9):
        runs = [sorted(rng.randint(0, 20) for _ in range(rng.randint(0, 12))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_archives_of_any_member_layout(spark, scratch):
    """One member a record, all records in one, a mixture, padding: the same records, each found at its place."""
    import gzip

    pages = spark.createDataFrame([(i, f"http://x.example/{i}", "text %d " % i * (i * 400)) for i in range(9)], "page_id bigint, url string, html string")
    path = warc.write_archives(warc.prepare_records(pages.coalesce(1)), f"{scratch}/w", records_per_file=100)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    data = max((bytes(f.content) for f in files), key=len)
    records = [gzip.decompress(data)[p : p + n] for p, n in _places(gzip.decompress(data))]
    assert len(records) == 9
    layouts = [
        data,
        gzip.compress(b"".join(records)),
        gzip.compress(b"".join(records[:4])) + b"".join(gzip.compress(r) for r in records[4:]) + b"\0" * 700,
        b"".join(gzip.compress(r) for r in records),
    ]
    for layout in layouts:
        found = list(warc.parse_archive(layout))
        assert [x[5] for x in found] == [("text %d " % i * (i * 400)).encode() for i in range(9)]
        for offset, length, inner, headers, _, payload in found:
            assert warc.fetch_record(layout[offset : offset + length], inner) == (headers, payload)
    assert all(inner == 0 for _, _, inner, *_ in warc.parse_archive(layouts[3]))
    assert sum(x[1] for x in warc.parse_archive(layouts[3])) == len(layouts[3])
    with pytest.raises(ValueError):
        list(warc.parse_archive(layouts[3][:-20]))


def _places(stream):
    at = 0
    while at < len(stream):
        end = stream.index(b"\r\n\r\n", at)
        size = end - at + 8 + int(re.search(rb"Content-Length: (\d+)\r\n\r\n", stream[at : end + 4])[1])
        yield at, size
        at += size


def test_archives_are_bounded_by_bytes(spark, scratch):
    rng = random.Random(2)
    pages = spark.createDataFrame([(i, None, "".join(rng.choice("abcdefgh") for _ in range(4000))) for i in range(60)], "page_id bigint, url string, html string")
    path = warc.write_archives(warc.prepare_records(pages.coalesce(1)), f"{scratch}/w", bytes_per_file=20_000)
    sizes = [f.length for f in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()]
    assert len(sizes) > 3 and max(sizes) < 25_000
    assert warc.read_captures(spark, path).count() == 60


def test_a_range_larger_than_memory_merges_from_files(spark):
    rng = random.Random(8)
    rows = [(f"k{rng.randint(0, 40)}", "t", i, f"f{i % 7}", i, 1, 0, "response", "d", 1, None, True) for i in range(900)]
    runs = sorted(rows, key=lambda r: (r[3], warc._sort_key(r)))
    store = warc.RunStore(100)
    for r in runs:
        store.add(r)
    assert store.spilled >= 7 and store.rows <= 100
    assert list(store.merged()) == sorted(rows, key=warc._sort_key)
    merged = warc.merge_runs(spark.createDataFrame(runs, warc.CAPTURES).repartition(4), rows_per_range=500, merge_rows=60).collect()
    assert [tuple(r) for r in merged] == sorted(rows, key=warc._sort_key)
