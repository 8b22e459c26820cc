"""A training-data pipeline over ``documents``: five stages, each one operator of ``lakevault.llm``.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; all but
the last return the columns of ``documents``.  ``run`` writes each stage's rows
to the shared folder and reads them back as the next stage's input.

Empty tables, NULL texts, NULL ids, repeated rows and extra columns pass
through every stage as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.llm.common import staged, table
from lakevault.llm.mixing import mix_documents
from lakevault.llm.neardup import drop_near_duplicates
from lakevault.llm.pieces import MODEL, read_vocabulary, token_digests
from lakevault.llm.quality import quality_filter
from lakevault.llm.secrets import mask_secrets

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 80 %) stays."""
    return drop_near_duplicates(docs, shingle=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets become ``[SECRET]``; ``n_chars`` follows the text."""
    return mask_secrets(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out, taken or taken twice, so that sources meet their targets."""
    return mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str, model: str = MODEL) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    return token_digests(docs, read_vocabulary(model))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", source_mixing),
    ("SentencePiece encoding and decoding", token_ids),
]

# DuckDB has no MinHash, Sainte-Lague seats over its result or Viterbi segmentation
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents").select(*[F.col(c) for c in COLUMNS])
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
