"""Quality rules, secrets, personal data, toxicity, tokens: against brute force on awkward rows."""

import hashlib
import os
import random
import re
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from llm_fixtures import awkward, awkward_rows, empty  # noqa: E402

from lakevault.llm import pieces, pii, quality, secrets, toxicity  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_quality(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit),
            len(words) < 20 or 100 * len(hit) > 30 * len(words))


def test_quality_measures(spark):
    got = quality.quality_verdicts(awkward(spark)).collect()
    want = sorted((str(r[0]), *brute_quality(r[1] or "")) for r in awkward_rows())
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((str(r.doc_id), *(r[c] for c in cols)) for r in got) == want
    assert all(not r.kept for r in got if r.base_failed)


def test_quality_filter_keeps_the_rows_as_they_are(spark):
    docs = awkward(spark)
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in quality.quality_verdicts(docs).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == ids and ids
    assert quality.quality_filter(empty(spark)).count() == 0


def brute_spans(text):
    out = []
    for no, r in enumerate(secrets.RULES):
        for m in re.finditer(r.pattern, text):
            if len(m.group(r.group)) >= r.least:
                out.append((m.start(), no, m.end()))
    return sorted(out)


def test_secret_spans_and_masks(spark):
    docs = awkward(spark)
    got = sorted((str(r.doc_id), [tuple(s) for s in r.spans]) for r in secrets.secret_spans(docs).collect())
    assert got == sorted((str(r[0]), brute_spans(r[1] or "")) for r in awkward_rows())
    masked = {r.doc_id: r for r in secrets.mask_secrets(docs).collect()}
    assert masked[10].text.count("[SECRET]") == 2 and masked[10].n_chars == len(masked[10].text)
    assert masked[6].text is None and masked[1].text == awkward_rows()[0][1]
    assert secrets.mask_secrets(docs).count() == docs.count()
    assert secrets.secret_spans(empty(spark)).count() == 0


def test_trigram_queries_come_from_the_patterns():
    by = {r.kind: secrets.trigram_query(r) for r in secrets.RULES}
    assert by["hex"] is None and by["access"] == [frozenset({"aki", "kia"})]
    assert frozenset({"tok", "oke", "ken"}) in by["assign"] and len(by["assign"]) == 6
    for text in ("my_API_KEY: abcdefgh", "passwd=abcdefgh", "apikey=abcdefgh"):
        grams = secrets.trigrams(text.lower())
        assert any(b <= grams for b in by["assign"])


def brute_pii(s):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", s)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", s) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", s):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and pii.luhn(d):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", s) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans_equal_plain_patterns():
    rng = random.Random(1)
    for _ in range(4000):
        s = "".join(rng.choice("0012.5+- ()@a.b9é\n") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(s) == brute_pii(s), s


def test_ip_parts_of_thousands_of_zeros():
    zeros = "0" * 5000
    assert (1, 0, 5006) in pii.base_spans(zeros + ".1.1.1")
    assert (1, 0, 5009) in pii.base_spans(zeros + "255.1.1.1")
    assert not any(k == 1 for k, _, _ in pii.base_spans(zeros + "256.1.1.1"))


def test_field_best_segmentation_is_the_best_of_all():
    rng = np.random.default_rng(2)
    field = pii.Field(rng.normal(size=(4, pii.N_FEATURES)))
    segs = [(i, j, [0, int(rng.integers(1, 25))], -1) for i in range(6) for j in range(i + 1, 7)]
    scores = [max(s) for s in field.scores(segs)]

    def best(i):  # all segmentations from token i on
        if i >= 6:
            return 0.0
        return max([best(i + 1)] + [s + best(j) for (a, j, _, _), s in zip(segs, scores) if a == i])

    found = field.best(6, segs)
    total = sum(s for (i, j, _, _), s in zip(segs, scores) if any((i, j) == (a, b) for _, a, b in found))
    assert total == pytest.approx(best(0))


def test_personal_data(spark):
    docs = awkward(spark)
    got = {}
    for r in pii.personal_data(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[15]) == 2 and None in got
    for row in awkward_rows():
        base = brute_pii(row[1] or "")
        for r in got[row[0]]:
            assert r.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest()
            assert set(pii.written(base).split(",")) - {""} <= set(r.spans.split(","))
    assert pii.personal_data(empty(spark)).count() == 0


def test_field_finds_merged_numbers():
    texts = [f"call +1 ({a}) 555-{b} now" for a in range(200, 260) for b in (1234, 9876)] + ["pay 4111 1111 1111 1111 now", "year 20240102 x"] * 20
    field = pii.fit(texts)
    _, spans = pii.all_spans("ring +1 (743) 555-3824 4111111111111111 x", field)
    assert (3, 5, 22) in spans and (2, 23, 39) in spans


def test_toxicity_held_out_accuracy_and_edges(spark):
    rng = random.Random(3)
    rows, labels = [], []
    plain = [f"w{i}" for i in range(100)]
    for i in range(4000):
        words = [rng.choice(plain) for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            words[5] = rng.choice(["nastyA", "nastyB"])
            words[9] = rng.choice(["nastyA", "nastyB"])
        rows.append((i, " ".join(words), "en", "s", 1, "x", 1, 2, "y", 3))
        if i % 8 < 6:
            labels.append((i, 1, int(bad)))
    from llm_fixtures import SCHEMA

    docs = spark.createDataFrame(rows + [(None, None, None, None, None, None, None, None, None, None)], SCHEMA)
    lab = spark.createDataFrame(labels + [(None, None, None)], "doc_id bigint, quality int, toxic int")
    out = toxicity.toxicity_scores(docs, toxicity.train(docs, lab)).collect()
    assert len(out) == 4001 and all(0 <= r.score <= 1 for r in out)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out if r.doc_id is not None)
    held = [r for r in out if r.held_out and r.doc_id is not None]
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    nothing = toxicity.train(docs, lab.filter("false"))
    assert {r.score for r in toxicity.toxicity_scores(docs.limit(5), nothing).collect()} == {0.0}
    assert toxicity.toxicity_scores(empty(spark), nothing).count() == 0


def test_non_negative_risk_ignores_the_toxic_part_of_unlabelled():
    rng = np.random.default_rng(0)
    clean = [np.unique(rng.integers(10, 60, 15)).astype(np.uint64) for _ in range(400)]
    toxic = [np.append(np.unique(rng.integers(10, 60, 15)), 99).astype(np.uint64) for _ in range(120)]
    c = toxicity.fit(toxic[:60], clean + toxic[60:], 60 / 460)
    at = int(np.searchsorted(c.words, 99))
    assert c.words[at] == 99 and c.weights[:, at].min() > 1.0


def viterbi(v, word):
    """Plain recurrence over all pieces."""
    by = {b: i for i, b in enumerate(v.bytes_of) if b and i not in v.byte_ids}
    n = len(word)
    best, back = [0.0] + [float("-inf")] * n, [None] * (n + 1)
    text = word.decode()
    ends = np.cumsum([0] + [len(c.encode()) for c in text]).tolist()
    for x, i in enumerate(ends[:-1]):
        for j in ends[x + 1 :]:
            p = by.get(word[i:j])
            s = v.scores[p] if p is not None else v.unknown if j == ends[x + 1] else None
            if s is not None and best[i] + s > best[j]:
                best[j], back[j] = best[i] + s, (i, p)
    out, j = [], n
    while j:
        i, p = back[j]
        out += [p] if p is not None else [v.byte_ids[b] for b in reversed(word[i:j])]
        j = i
    return out[::-1]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.read_vocabulary()


def test_segmentation_equals_plain_recurrence(vocabulary):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefghij  é日\U0001d4b3\n.,the and") for _ in range(rng.randint(0, 90))) for _ in range(150)]
    texts += [r[1] or "" for r in awkward_rows() if len(r[1] or "") < 3000] + ["qz" * 40]
    coder = pieces.Coder(vocabulary)
    for text, ids in zip(texts, coder.encode(texts)):
        want = viterbi(vocabulary, ("▁" + text.replace(" ", "▁")).encode()) if text else []
        assert np.frombuffer(ids, "<i4").tolist() == want, text
        assert coder.decode(ids) == text.replace("▁", " ")


def test_tokens_of_awkward_rows(spark, vocabulary):
    docs = awkward(spark)
    got = pieces.token_digests(docs, vocabulary).collect()
    assert len(got) == docs.count()
    assert {r.doc_id for r in got if not r.round_trip} == {16}
    coded = pieces.encode_documents(docs, vocabulary)
    back = {r.doc_id: r.text for r in pieces.decode_documents(coded, vocabulary).collect()}
    assert back[13] == next(r[1] for r in awkward_rows() if r[0] == 13) and back[6] == ""
    assert pieces.token_digests(empty(spark), vocabulary).count() == 0


def test_added_spans_never_cross_base_spans(spark):
    """However many base spans lie around an added one."""
    rng = random.Random(12)
    bits = ["10.1.2.3", "4111 1111 1111 1111", "+1 (743) 555-3824", "a.b@c.example.org", "1.2.3.4.5.6", "4111-1111-1111-1111-22", "+49 30 1234567"]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    field = pii.fit(texts[:20])
    for text in texts:
        base, spans = pii.all_spans(text, field)
        assert set(base) <= set(spans)
        for k, a, b in set(spans) - set(base):
            assert all(b <= x or y <= a for _, x, y in base)


@pytest.mark.parametrize("shift", [0.0, 6.0])  # 6.0: toxic texts score so high that the corrected part is below zero
def test_gradient_of_the_risk_by_finite_differences(shift):
    rng = np.random.default_rng(4)
    z, p = rng.normal(size=40), np.arange(40) < 15
    z[p] += shift
    z[~p] -= shift
    u, prior = ~p, 0.3
    value, gradient = toxicity.risk_and_gradient(z, p, u, prior)
    soft = np.logaddexp(0, z)
    rest = soft[u].mean() - prior * soft[p].mean()
    assert (rest < 0) == (shift > 0)
    assert np.isclose(value, prior * np.logaddexp(0, -z[p]).mean() + rest if rest >= 0 else -rest)
    for i in range(len(z)):
        up, down = z.copy(), z.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        slope = (toxicity.risk_and_gradient(up, p, u, prior)[0] - toxicity.risk_and_gradient(down, p, u, prior)[0]) / 2e-5
        assert abs(slope - gradient[i]) < 1e-8
