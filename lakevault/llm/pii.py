"""Personal data: base patterns plus spans of a semi-Markov random field.

Base kinds (email, ip, card, phone) are leftmost non-overlapping matches that
pass a check.  The semi-Markov field looks at *regions*, words that hold
a digit or an at sign, cut into tokens.  A candidate segment is a run of at
most MAX_TOKENS tokens; features look at the whole segment (digit count,
grouping, check sum, shape, neighbours, cue words), and one dynamic
programme per region chooses boundaries and kinds together.  Its spans are
added where no base span lies.

Weights are fitted by gradient ascent on the likelihood (forward and backward
sums over segmentations) of at most TRAIN_REGIONS regions of at most
TRAIN_CHARS characters, those with the smallest hashes; their base spans are
the labels, and phone numbers are seen once more without their prefix, so
that the field learns shapes the patterns don't know.

Edge cases: a NULL text is empty; spans count code points; repeated rows, NULL
ids and texts of any length are scanned one by one (time grows linearly with
the text); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import table

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 18
TRAIN_REGIONS = 3000
TRAIN_CHARS = 160
EPOCHS = 6

# The base patterns (digit runs are entered at their first digit only).
MAIL_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
MAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CUES = {"mail": 0, "email": 0, "ip": 1, "host": 1, "server": 1, "card": 2, "visa": 2, "phone": 3, "tel": 3, "call": 3, "fax": 3}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def only_digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def emails(text: str) -> list[tuple[int, int]]:
    """From each at sign to both sides, which is linear where a leftmost search would not be."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        local = len(before) - len(before.rstrip(MAIL_LOCAL))
        m = MAIL_HOST.match(text, at) if local else None
        if m:
            out.append((at - local, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := only_digits(m[0])) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(only_digits(m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


_HIT = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.S)


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of words that hold a digit or an at sign."""
    begin = end = -1
    at = 0
    while m := _HIT.search(text, at):
        i = m.start()
        lo = i
        while lo > at and not _SPACE.match(text, lo - 1):
            lo -= 1
        nxt = _SPACE.search(text, i)
        hi = nxt.start() if nxt else len(text)
        if begin >= 0 and lo <= end + 1:
            end = hi
        else:
            if begin >= 0:
                yield begin, end
            begin, end = lo, hi
        at = hi
    if begin >= 0:
        yield begin, end


def tokens(text: str, lo: int, hi: int) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text, lo, hi)]


N_FEATURES = 26
_MAIL_SHAPE = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_GROUPS = re.compile(r"[0-9]+")


def features(text: str, a: int, b: int, cue: int) -> list[int]:
    """Numbers of the features of the whole segment text[a:b] that are on."""
    s = text[a:b]
    groups = [len(g) for g in _GROUPS.findall(s)]
    n = sum(groups)
    on = [0, 1 + (n >= 8) + (n >= 10) + (n >= 12) + (n >= 16) + (n > 19)]
    letters = any(c.isalpha() for c in s)
    mail = "@" in s and _MAIL_SHAPE.fullmatch(s) is not None
    dotted = s.count(".") == 3 and len(groups) == 4 and not letters and len(s) == n + 3
    checks = (
        s[0] == "+", s[0] == "(", "(" in s and ")" in s, "-" in s, " " in s, "@" in s, mail, letters and not mail,
        dotted, dotted and all(int(p) <= 255 for p in s.split(".") if len(p) <= 4) and max(groups) <= 3,
        13 <= n <= 19 and luhn(only_digits(s)), groups[-3:] == [3, 3, 4], len(groups) > 1 and set(groups[:-1]) == {4},
        a > 0 and text[a - 1].isalnum(), b < len(text) and text[b].isalnum(),
        a > 0 and text[a - 1] in "+.-@(", b < len(text) and text[b : b + 1] in "-@" , len(groups) == 1 and not letters,
    )
    on += [7 + i for i, c in enumerate(checks) if c]
    if cue >= 0:
        on.append(25)
    return on


def candidates(text: str, lo: int, hi: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, list[int], int]]]:
    """(tokens, segments (first token, token after, features, cue)) of a region.

    A segment begins with a digit, a letter, '+' or '(' and ends with a digit
    or a letter; without an at sign it holds 7 digits at least and no letter.
    """
    toks = tokens(text, lo, hi)
    before = re.findall(r"[A-Za-z]+", text[max(0, lo - 24) : lo])
    cue = CUES.get(before[-1].lower(), -1) if before else -1
    kind = []
    for a, _ in toks:
        c = text[a]
        kind.append("d" if "0" <= c <= "9" else "a" if c.isascii() and c.isalpha() else c if c in "+(@" else "s")
    out = []
    for i, k in enumerate(kind):
        if k not in "da+(" :
            continue
        digits, at, letters = 0, False, False
        for j in range(i, min(i + MAX_TOKENS, len(toks))):
            x = kind[j]
            digits += toks[j][1] - toks[j][0] if x == "d" else 0
            at |= x == "@"
            letters |= x == "a"
            if letters and not at and j - i > 8:
                break
            if x in "da" and (at or (digits >= 7 and not letters)):
                out.append((i, j + 1, features(text, toks[i][0], toks[j][1], cue), cue))
    return toks, out


class Field:
    """Weights (kind x feature) and the two dynamic programmes of the semi-Markov field."""

    def __init__(self, weights: np.ndarray | None = None):
        self.w = np.zeros((len(KINDS), N_FEATURES)) if weights is None else weights

    def scores(self, segs) -> list[list[float]]:
        return [self.w[:, f].sum(axis=1).tolist() for _, _, f, _ in segs]

    def best(self, n: int, segs) -> list[tuple[int, int, int]]:
        """Best segmentation of n tokens: (kind, first token, token after)."""
        by_end: dict[int, list[tuple[int, float, int]]] = {}
        for (i, j, _, _), s in zip(segs, self.scores(segs), strict=True):
            k = max(range(len(KINDS)), key=s.__getitem__)
            if s[k] > 0:
                by_end.setdefault(j, []).append((i, s[k], k))
        top, back = [0.0] * (n + 1), [None] * (n + 1)
        for j in range(1, n + 1):
            top[j] = top[j - 1]
            for i, s, k in by_end.get(j, ()):
                if top[i] + s > top[j]:
                    top[j], back[j] = top[i] + s, (k, i, j)
        out, j = [], n
        while j:
            if back[j]:
                out.append(back[j])
                j = back[j][1]
            else:
                j -= 1
        return out[::-1]

    def step(self, n: int, segs, gold: set[tuple[int, int, int]], rate: float) -> None:
        """One step up the gradient of the log likelihood of ``gold``."""
        sc = self.scores(segs)
        begins: dict[int, list[int]] = {}
        ends: dict[int, list[int]] = {}
        for no, (i, j, _, _) in enumerate(segs):
            begins.setdefault(i, []).append(no)
            ends.setdefault(j, []).append(no)
        mass = [_log_sum(s) for s in sc]
        fwd = [0.0] * (n + 1)
        for j in range(1, n + 1):
            fwd[j] = _log_sum([fwd[j - 1], *(fwd[segs[no][0]] + mass[no] for no in ends.get(j, ()))])
        bwd = [0.0] * (n + 1)
        for i in range(n - 1, -1, -1):
            bwd[i] = _log_sum([bwd[i + 1], *(bwd[segs[no][1]] + mass[no] for no in begins.get(i, ()))])
        for no, (i, j, f, _) in enumerate(segs):
            for k in range(len(KINDS)):
                p = math.exp(min(0.0, fwd[i] + sc[no][k] + bwd[j] - fwd[n]))
                g = ((k, i, j) in gold) - p
                if abs(g) > 1e-4:
                    self.w[k, f] += rate * g


def _log_sum(xs: list[float]) -> float:
    m = max(xs)
    return m + math.log(sum(math.exp(x - m) for x in xs))


def fit(samples: list[str]) -> Field:
    """The field fitted to the base spans of the sampled regions."""
    field, work = Field(), []
    for text in samples:
        variants = [(text, base_spans(text))]
        for k, a, b in variants[0][1]:
            if k == 3 and (m := re.match(r"\+[0-9]{1,3}[ .-]", text[a:b])) and len(only_digits(text[a + m.end() : b])) >= 9:
                bare = text[:a] + text[a + m.end() : b]
                variants.append((bare, [(3, a, len(bare))]))
        for t, spans in variants:
            for lo, hi in regions(t):
                toks, segs = candidates(t, lo, hi)
                first, last = {x[0]: i for i, x in enumerate(toks)}, {x[1]: i + 1 for i, x in enumerate(toks)}
                gold = {(k, first[a], last[b]) for k, a, b in spans if a in first and b in last}
                if segs:
                    work.append((len(toks), segs, gold))
    for epoch in range(EPOCHS):
        for n, segs, gold in work:
            field.step(n, segs, gold, 0.3 / (1 + epoch))
        field.w *= 0.999
    return field


def _sample(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = []
        for text in f["text"]:
            for lo, hi in regions(text or ""):
                if hi - lo <= TRAIN_CHARS // 2:
                    rows.append(text[max(0, lo - 30) : hi + 10])
        yield pd.DataFrame({"sample": rows}, dtype=object)


def train(docs: DataFrame, text_col: str = "text", most: int = TRAIN_REGIONS) -> Field:
    """Fit on at most ``most`` distinct regions of the table, by hash."""
    r = docs.select(F.col(text_col).alias("text")).filter(F.col("text").rlike("[0-9@]")).mapInPandas(_sample, "sample string")
    r = r.select(F.xxhash64("sample").alias("h"), "sample").distinct().orderBy("h", "sample").limit(most)
    return fit([x["sample"] for x in r.collect()])


def all_spans(text: str, field: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, base and added spans), each by kind, then start."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    added = []
    for lo, hi in regions(text):
        toks, segs = candidates(text, lo, hi)
        for k, i, j in field.best(len(toks), segs) if segs else ():
            a, b = toks[i][0], toks[j - 1][1]
            before = bisect_left(starts, b)  # base spans that begin before this one ends
            if not before or reach[before - 1] <= a:
                added.append((k, a, b))
    return base, sorted(base + added)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _scan(weights: np.ndarray):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field = Field(weights)
        nothing = (0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
        for f in frames:
            rows = []
            for text in f["text"]:
                if not text or not _HIT.search(text):
                    rows.append(nothing)
                    continue
                base, spans = all_spans(text, field)
                n = [sum(k == x for x, _, _ in base) for k in range(len(KINDS))]
                rows.append((*n, hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
            out = pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
            out.insert(0, "doc_id", f["doc_id"].to_numpy())
            yield out

    return run


def personal_data(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans, of every row."""
    field = field or train(docs, text_col)
    # the id travels as text, so that any type and NULLs come back unchanged
    d = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    out = d.mapInPandas(
        _scan(field.w), "doc_id string, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    )
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def op8_personal_data(spark, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
