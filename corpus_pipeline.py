"""From raw documents to packed training windows: five stages, each written and read again by the next.

In every stage a null text counts as empty, a null doc_id as the smallest, rows repeated with id and text as copies, and an
empty table gives an empty one; ties go by id and then by a hash of the text. Other columns go along as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import table
from folio.llm.jaccard import keep_one
from folio.llm.lines import line_dedup
from folio.llm.packing import pack
from folio.llm.quality import quality_rules
from folio.llm.suffixes import remove_repeats


def _with_text(done: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, with kept_text for text and its length for n_chars."""
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return done.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, null and empty texts among them; repeated rows are judged each by itself."""
    return quality_rules(docs).filter("kept").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines near an earlier line go; a document stays, even if nothing is left of it."""
    return _with_text(line_dedup(docs), docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate documents the one of smallest id stays, of rows repeated with id and text one; texts without words all stay."""
    return keep_one(docs).select(docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes in strings that also start earlier go; a document stays, even if nothing is left of it."""
    return _with_text(remove_repeats(docs, carry=[c for c in docs.columns if c not in ("doc_id", "text")], with_text=True), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of the tokens of all documents; a row per piece. An empty text is its end token alone; repeated rows are packed each by itself."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near), ("suffix-array dedup", repeats), ("packing", packing)]

#: SQL has no byte-pair encoding; tests/llm/test_pipeline.py compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
