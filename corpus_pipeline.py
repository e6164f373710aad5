"""Training-corpus pipeline: quality, near duplicates, benchmark passages, source mix, token files.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns a DataFrame; all but the last return the columns of `documents`.

Defined cases: a document of NULL or empty text is judged by the statistics of an empty
text, is no near duplicate of another, holds no benchmark passage, and has no words, so
the mix takes nothing of it; rows alike are near duplicates of one another, of which one
stays; a document without an id is kept by the near duplicates and comes first in the
token files; a NULL source is a source of its own; further columns pass through; without
labels of both classes all documents score alike; an empty table gives no files and no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layerwright.llm.decontamination import decontaminate
from layerwright.llm.frames import prepare, stored
from layerwright.llm.mixing import mixed_documents
from layerwright.llm.near_duplicates import without_near_duplicates
from layerwright.llm.quality import keep_good
from layerwright.llm.queries import TOKENIZER
from layerwright.llm.token_files import read_tokens, write_tokens
from layerwright.session import run_dir, use_engine_settings


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts (operator 5); it learns from the labelled documents among its input."""
    return keep_good(docs, _table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (operator 4)."""
    return without_near_duplicates(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage (operator 2)."""
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources (operator 9): a row for each time a document is taken."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix (operator 3), read back: doc_id, start, n_tokens, ids_crc32."""
    folder = run_dir(spark, "pipeline-tokens")
    return read_tokens(spark, folder, write_tokens(docs, folder, TOKENIZER))


STAGES = [("quality", good_quality), ("near_duplicates", distinct), ("decontamination", clean), ("mixing", mixed), ("token_files", tokens)]

# Byte-level BPE and the classifier can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again by the next."""
    prepare(use_engine_settings(spark))
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
