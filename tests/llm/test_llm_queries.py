"""Registered queries against their SQL, the pipeline against brute force."""

import hashlib
import os
import re
import sys
from collections import Counter

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from conftest import SF_SMALL  # noqa: E402
from llm_fixtures import awkward, awkward_rows, empty  # noqa: E402

import corpus_pipeline  # noqa: E402
from lakevault.llm import neardup, quality, secrets  # noqa: E402
from lakevault.llm.registry import LLM_QUERIES, LLM_SQL  # noqa: E402


def norm(v):
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = LLM_QUERIES[name](spark, SF_SMALL)
    res = con.execute(LLM_SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    got = sorted(tuple(norm(r[c]) for c in sorted(cols)) for r in df.collect())
    want = sorted(tuple(norm(r[cols.index(c)]) for c in sorted(cols)) for r in res.fetchall())
    assert got == want


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES if n.startswith("op")) == list(range(1, 14))
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries() and set(LLM_QUERIES) < set(entry.queries())


def test_stages_on_awkward_rows(spark):
    docs = awkward(spark).select(*corpus_pipeline.COLUMNS)
    texts = {r[0]: r[1] for r in awkward_rows()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stages = [f for _, f in corpus_pipeline.STAGES]

    kept = stages[0](spark, docs, "")
    assert kept.columns == docs.columns
    verdict = {r.doc_id for r in quality.quality_verdicts(docs).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == verdict and 41 in verdict

    # the next stages on everything, as the rules keep little of this fixture
    one = stages[1](spark, docs, "")
    comps = {}
    sets = [(i, neardup.exact_set(t, 5)) for i, t in texts.items() if i is not None]
    for i, a in sets:
        comps[i] = min([j for j, b in sets if a and b and 100 * len(a & b) >= 80 * len(a | b)] or [i])
    want = Counter(r[0] for r in awkward_rows() if r[0] is None or comps[r[0]] == r[0])
    want[15] = 1  # the row that came twice
    assert Counter(r.doc_id for r in one.collect()) == want

    masked = {r.doc_id: r for r in stages[2](spark, one, "").collect()}
    for i, r in masked.items():
        spans = [(m.start(), m.end()) for x in secrets.RULES for m in re.finditer(x.pattern, texts[i] or "") if len(m.group(x.group)) >= x.least]
        assert (r.text == texts[i]) == (not spans)

    mixed = stages[3](spark, one, "")
    assert mixed.columns == docs.columns
    assert {r.doc_id for r in mixed.collect()} <= set(want)
    out = stages[4](spark, mixed, "").collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in mixed.collect())
    for r in out:
        if r.round_trip:
            assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_rows_that_repeat_an_id(spark):
    """Of equal and near rows under one id one stays, whatever else has that id; other texts stay."""
    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words[:-1], "other"])
    rows = [(7, " ".join(words)), (7, " ".join(words)), (7, near), (7, "quite another text under the same id"), (3, " ".join(words)),
            (8, ""), (8, ""), (9, "alone")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted((r.doc_id, r.text) for r in neardup.drop_near_duplicates(docs).collect())
    assert got == [(3, " ".join(words)), (7, "quite another text under the same id"), (8, ""), (8, ""), (9, "alone")]


def test_pipeline_of_nothing(spark, scratch):
    empty(spark).select(*corpus_pipeline.COLUMNS).write.parquet(f"{scratch}/documents.parquet")
    assert corpus_pipeline.run(spark, scratch).count() == 0


def test_entry_without_the_subpackage(tmp_path):
    """The entry imports, with the other queries, when the folder and the pipeline are gone."""
    import shutil
    import subprocess

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/lakevault", tmp_path / "lakevault", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'scd1_merged' in q and 'pipeline' not in q; print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
