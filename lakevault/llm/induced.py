"""External induced sorting of suffixes with common-prefix values.

``suffix_order`` sorts the suffixes of an integer text by induction:

* the suffixes that start a rise after a fall (S* suffixes) are found, the
  substrings between them sorted and named, and the names' text is sorted in
  the same way (recursion; below ``base`` names by doubling in memory);
* a first pass in ascending order induces the suffixes that fall (L) from
  the S* suffixes, a second pass in descending order those that rise (S);
* both passes draw (first symbol, order of arrival) -> (position,
  common-prefix value) tuples from a disk-backed priority queue.  Tuples of one
  symbol arrive in their final order, so the queue keeps a run per symbol and
  writes its runs to a scratch file whenever they exceed ``memory`` bytes;
* a tuple's common prefix with its forerunner of the same symbol is one more
  than the minimum of the common prefixes between the two tuples that pushed
  them, so values are carried along and texts aren't compared again.

Common prefixes are capped at ``cap`` and suffixes that agree in ``cap``
symbols may stand in either order, which is all that a search for repeated
strings of up to ``cap`` symbols needs.
"""

from __future__ import annotations

import tempfile

import numpy as np

MEMORY = 64 << 20
BASE = 4_000_000


class SymbolQueue:
    """Priority queue of (symbol; position, common prefix), first in first out per symbol."""

    def __init__(self, memory: int):
        self.memory, self.held, self.runs, self.spilled, self.file = memory, 0, {}, {}, None

    def push(self, symbol: int, positions: np.ndarray, prefixes: np.ndarray) -> None:
        self.runs.setdefault(symbol, []).append((positions, prefixes))
        self.held += positions.nbytes + prefixes.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:  # unlinked at once: nothing stays behind, even if the task dies
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for symbol, parts in self.runs.items():
            at, n = self.file.tell(), 0
            for k in range(2):
                for p in parts:
                    self.file.write(p[k].tobytes())
            n = sum(len(p[0]) for p in parts)
            self.spilled.setdefault(symbol, []).append((at, n))
        self.runs, self.held = {}, 0

    def pop_all(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for at, n in self.spilled.pop(symbol, []):
            self.file.seek(at)
            positions = np.frombuffer(self.file.read(8 * n), np.int64)
            parts.append((positions, np.frombuffer(self.file.read(4 * n), np.int32)))
        here = self.runs.pop(symbol, [])
        self.held -= sum(p.nbytes + x.nbytes for p, x in here)
        parts += here
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        if len(parts) == 1:
            return parts[0]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class _Pass:
    """One inducing pass: takes tuples in order, pushes their predecessors of the wanted type."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, cap: int, memory: int):
        self.text, self.wanted, self.cap = text, wanted, cap
        self.queue = SymbolQueue(memory)
        self.since = np.zeros(int(text.max()) + 1, np.int32)  # least prefix since the last push of a symbol

    def take(self, positions: np.ndarray, prefixes: np.ndarray) -> None:
        if not len(positions):
            return
        before = positions - 1
        ok = np.flatnonzero((positions > 0) & self.wanted[before])
        symbols = self.text[before[ok]]
        order = np.argsort(symbols, kind="stable")
        ok, symbols = ok[order], symbols[order]
        cuts = np.flatnonzero(np.diff(symbols)) + 1
        pushed = symbols[np.concatenate([[0], cuts])] if len(ok) else symbols
        whole = prefixes.min()
        old = self.since[pushed].copy()
        np.minimum(self.since, whole, out=self.since)
        for symbol, at, seen in zip(pushed.tolist(), np.split(ok, cuts) if len(ok) else [], old.tolist(), strict=True):
            least = np.minimum.reduceat(prefixes, np.concatenate([[0], at[:-1] + 1]))
            # reduceat ends the last piece at the end: cut it at the pusher
            least[-1] = prefixes[(at[-2] + 1 if len(at) > 1 else 0) : at[-1] + 1].min()
            least[0] = min(least[0], seen)
            rest = prefixes[at[-1] + 1 :]
            self.since[symbol] = rest.min() if len(rest) else self.cap
            self.queue.push(symbol, before[at], np.minimum(least + 1, self.cap).astype(np.int32))


def _runs(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is S type, length of the run of equal symbols that begins) at each position."""
    n = len(text)
    ends = np.flatnonzero(np.append(text[1:] != text[:-1], True))
    lengths = np.diff(np.concatenate([[-1], ends]))
    rises = np.append(text[ends[:-1]] < text[ends[:-1] + 1], True)
    return np.repeat(rises, lengths), (np.repeat(ends, lengths) - np.arange(n) + 1).astype(np.int32)


def _quads(text: np.ndarray, bits: int) -> np.ndarray:
    """Symbols i, i + 1, ... packed in one word for each i (first symbol highest)."""
    per = 64 // bits
    padded = np.concatenate([text, np.zeros(per, text.dtype)]).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for k in range(per):
        out |= padded[k : k + len(text)] << np.uint64(bits * (per - 1 - k))
    return out


def _common(words: np.ndarray, bits: int, a: np.ndarray, b: np.ndarray, start: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of suffixes a and b, known to be ``start`` at least, capped."""
    per, n = 64 // bits, len(words)
    out = np.minimum(start, cap).astype(np.int64)
    live = np.flatnonzero(out < cap)
    while len(live):
        i, j = a[live] + out[live], b[live] + out[live]
        inside = (i < n) & (j < n)
        live, i, j = live[inside], i[inside], j[inside]
        x = words[i] ^ words[j]
        same = np.zeros(len(live), np.int64)
        for k in range(per):
            same += x < (np.uint64(1) << np.uint64(bits * (per - 1 - k))) if k < per - 1 else x == 0
        out[live] += same
        live = live[(same == per) & (out[live] < cap)]
    return np.minimum(out, cap).astype(np.int32)


def _name_substrings(text: np.ndarray, stars: np.ndarray, bits: int) -> np.ndarray:
    """Names 0, 1, ... of the S* substrings (each up to the next S* position, included), by order.

    Past its end a substring counts as larger than any symbol, which is how a
    prefix of another S* substring compares.
    """
    m, per = len(stars), 64 // bits
    last = np.append(stars[1:], stars[-1])
    beyond = np.uint64((1 << bits) - 1)
    name = np.zeros(m, np.int64)
    live, offset = np.arange(m), 0
    while len(live):
        word = np.zeros(len(live), np.uint64)
        for k in range(per):
            at = stars[live] + offset + k
            inside = at <= last[live]
            symbol = np.where(inside, text[np.minimum(at, len(text) - 1)].astype(np.uint64) , beyond)
            word |= symbol << np.uint64(bits * (per - 1 - k))
        order = np.lexsort((word, name[live]))
        live, word = live[order], word[order]
        group = name[live]
        new = np.ones(len(live), bool)
        new[1:] = (group[1:] != group[:-1]) | (word[1:] != word[:-1])
        first = np.ones(len(live), bool)
        first[1:] = group[1:] != group[:-1]
        # a group's name is the number of smaller substrings: its own place plus that in the group
        place = np.arange(len(live))
        name[live] = group + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(first, place, 0))
        offset += per
        alone = new & np.append(new[1:], True)
        live = live[~alone & (stars[live] + offset <= last[live])]
        live = np.sort(live)
    used = np.unique(name)
    return np.searchsorted(used, name)


def _doubling(names: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a short text in memory: ranks of prefixes of 1, 2, 4, ... symbols.

    A rank is the place of the group's first suffix; only suffixes whose group
    is shared are sorted again.
    """
    n = len(names)
    order = np.argsort(names, kind="stable")
    ranks = [_group_ranks(order, names[order], np.zeros(n, np.int64))]
    live = _shared(ranks[0])
    while len(live) and (1 << (len(ranks) - 1)) < cap:
        step, old = 1 << (len(ranks) - 1), ranks[-1]
        after = np.where(live + step < n, old[np.minimum(live + step, n - 1)] + 1, 0)
        key = old[live] * (n + 1) + after
        at = np.argsort(key, kind="stable")
        live, key = live[at], key[at]
        new = old.copy()
        new[live] = _group_ranks(live, key, old[live], whole=False)
        ranks.append(new)
        live = _shared(new)
    order = np.argsort(ranks[-1], kind="stable")
    a, b = order[:-1], order[1:]
    common = np.zeros(max(0, n - 1), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        i, j = a + common, b + common
        inside = (i < n) & (j < n)
        same = np.zeros(len(a), bool)
        same[inside] = ranks[k][i[inside]] == ranks[k][j[inside]]
        common += same.astype(np.int64) << k
    return order, np.concatenate([[0], common])


def _group_ranks(order: np.ndarray, key: np.ndarray, base: np.ndarray, whole: bool = True) -> np.ndarray:
    """Ranks of suffixes sorted by key; ``base``: the rank of their former group."""
    place = np.arange(len(order))
    new = np.append(True, key[1:] != key[:-1])
    first = np.append(True, base[1:] != base[:-1])
    rank = base + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(first, place, 0))
    if not whole:
        return rank
    out = np.empty(len(order), np.int64)
    out[order] = rank
    return out


def _shared(rank: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.bincount(rank, minlength=len(rank))[rank] > 1)


def suffix_order(text: np.ndarray, cap: int, base: int = BASE, memory: int = MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, common prefix of each with the one before, capped).

    The last symbol of ``text`` is 0 and occurs nowhere else.
    """
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64), np.zeros(1, np.int32)
    text = text.astype(np.uint16 if int(text.max()) < 65_535 else np.int64)
    rises, run = _runs(text)
    stars = np.flatnonzero(rises[1:] & ~rises[:-1]) + 1
    bits = 16 if int(text.max()) < 65_535 else 32
    words = _quads(text, bits)
    names = _name_substrings(text, stars, bits)
    if len(names) <= base or int(names.max()) == len(names) - 1:
        order, same = _doubling(names, cap)
    else:
        order, same = suffix_order(names, cap, base, memory)
    star, known = stars[order], np.zeros(len(order), np.int64)
    if len(order) > 1:
        # equal names cover the text up to the first S* substring that differs
        skip = np.minimum(same[1:], np.minimum(len(order) - 1 - order[1:], len(order) - 1 - order[:-1])).astype(np.int64)
        known[1:] = stars[order[1:] + skip] - star[1:]
        known[1:] = _common(words, bits, star[:-1], star[1:], known[1:], cap)
    del words
    known = known.astype(np.int32)

    # ascending pass: L suffixes
    symbols = text[star]
    bounds = np.searchsorted(symbols, np.arange(int(text.max()) + 2))
    down = _Pass(text, ~rises, cap, memory)
    falls: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    present = np.flatnonzero(np.bincount(text)).tolist()
    for c in present:
        parts, last = [], None
        while True:
            at, pre = down.queue.pop_all(c)
            if not len(at):
                break
            if last is None:
                pre = pre.copy()
                pre[0] = 0
            last = int(at[-1])
            parts.append((at, pre))
            down.take(at, pre)
        if parts:
            falls[c] = (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        lo, hi = bounds[c], bounds[c + 1]
        if hi > lo:
            pre = known[lo:hi].copy()
            pre[0] = 0 if last is None else min(int(run[last]), int(run[star[lo]]), cap)
            down.take(star[lo:hi], pre)
    down.queue.close()

    # descending pass: S suffixes; prefixes are those with the next larger suffix
    up = _Pass(text, rises, cap, memory)
    out_at, out_pre = [], []
    for c in reversed(present):
        last = None
        while True:
            at, pre = up.queue.pop_all(c)
            if not len(at):
                break
            if last is None:
                pre = pre.copy()
                pre[0] = 0
            last = int(at[-1])
            out_at.append(at)
            out_pre.append(pre)
            up.take(at, pre)
        if c in falls:
            at, pre = falls.pop(c)
            at, pre = at[::-1], np.append(pre[1:], 0)[::-1].astype(np.int32)
            pre[0] = 0 if last is None else min(int(run[last]), int(run[at[0]]), cap)
            out_at.append(at)
            out_pre.append(pre)
            up.take(at, pre)
    up.queue.close()
    order = np.concatenate([*out_at, [n - 1]])[::-1]
    larger = np.concatenate([*out_pre, [0]])[::-1]
    return order, np.concatenate([[0], larger[:-1]]).astype(np.int32)
