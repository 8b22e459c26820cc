"""The filter audit against a simulation of every order, the solver against the definition."""

import os
import re
import sys
from fractions import Fraction
from itertools import permutations
from math import factorial

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from llm_fixtures import awkward, awkward_rows, empty  # noqa: E402

from lakevault.llm.filteraudit import FILTERS, failure_masks, order_audit, removals, shapley_operator  # noqa: E402

LABELS = "doc_id bigint, quality int, toxic int, part string, mask int"


def label_rows():
    rows = [(i, i % 2, int(i % 5 == 0), "p", 9) for i in range(1, 41, 3)]
    return rows + [(1, 1, 0, "p", 9), (1, 0, 1, "p", 9), (None, 1, 1, "p", 9), (2, None, None, "p", 9), (999, 1, 1, "p", 9)]


def failures(text, i, smallest):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = set()
    if len(words) < 200:
        out.add("A")
    if 100 * len(set(words)) < 50 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
        out.add("C")
    if re.search("[#$%&*|]", text):
        out.add("D")
    if i is not None and smallest is not None and smallest < i:
        out.add("E")
    return out


def simulate(rows, labels):
    texts = {}
    for r in rows:
        if r[0] is not None:
            texts.setdefault(r[1] or "", []).append(r[0])
    docs = []
    for r in rows:
        text = r[1] or ""
        good = any(x[0] == r[0] and x[1] == 1 for x in labels if x[0] is not None)
        toxic = any(x[0] == r[0] and x[2] == 1 for x in labels if x[0] is not None)
        docs.append((r[2] or "", failures(text, r[0], min(texts.get(text, []), default=None)), good, toxic))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        total = dict.fromkeys(FILTERS, 0)
        for order in permutations(FILTERS):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own),
                    sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


def audited(docs, labels):
    rows = order_audit(removals(failure_masks(docs, labels))).collect()
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in rows}


def rows_of_parts():
    """The awkward rows in several languages, with copies of one text in a third of the rows and no, equal and NULL ids."""
    rows = [r[:2] + (("en", "de", None, "")[k % 4],) + r[3:] for k, r in enumerate(awkward_rows())]
    copy = "THE SAME TEXT | AGAIN"
    more = [(1000 - k if k % 7 else None, copy, ("en", None)[k % 2], "s", 1, "x", 1, 2, "y", 3) for k in range(30)]
    return rows + more + more[:2]


def test_audit_equals_simulation(spark):
    rows, labels = rows_of_parts(), label_rows()
    docs = spark.createDataFrame(rows, awkward(spark).schema).repartition(4)
    assert audited(docs, spark.createDataFrame(labels, LABELS)) == simulate(rows, labels)


def test_audit_of_nothing(spark):
    docs, no_labels = awkward(spark), spark.createDataFrame([], LABELS)
    assert audited(empty(spark), no_labels) == {}
    assert audited(docs, no_labels) == simulate(awkward_rows(), [])


@pytest.mark.parametrize("m", [2, 3, 5])
def test_least_squares_gives_the_shapley_value(m):
    value = [(s * 7919 + s * s * 31) % 101 if s else 0 for s in range(1 << m)]
    weights = shapley_operator(m)
    for i in range(m):
        want = Fraction(0)
        for order in permutations(range(m)):
            before = sum(1 << j for j in order[: order.index(i)])
            want += value[before | 1 << i] - value[before]
        assert sum(w * v for w, v in zip(weights[i], value)) == want
    assert sum(sum(w * v for w, v in zip(row, value)) for row in weights) == factorial(m) * value[-1]
