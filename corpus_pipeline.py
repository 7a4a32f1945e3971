"""A training corpus from raw documents: five stages, each written as Parquet and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aftermerge.llm import decontaminate, lines, near_duplicates, packing, quality
from aftermerge.llm.common import shared_root
from aftermerge.llm.queries import table, word_tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects, with their columns.

    A null text counts as the empty text, which has too few words and goes; repeated rows are judged
    each on its own; an empty table stays empty; a null doc_id and columns of any name stay as they are.
    """
    return quality.filter_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat earlier ones; ``n_chars`` follows the text, if there is one.

    A document that loses all its words goes; one that had none stays, and so does a null text.
    Repeated rows (same doc_id and text) count as one document and lose the same lines; among equal
    lines the first by doc_id and line number stays, documents without doc_id coming last; an empty
    table stays empty; columns of any name stay as they are.
    """
    deduped = lines.dedup_lines(docs)
    left = (F.col("n_removed") == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    made = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    kept = (made.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns)
    return deduped.where(left).select(*kept)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the first by doc_id, with its columns.

    Documents without words, null texts included, are no one's copies and stay; of repeated rows one
    stays; a null doc_id comes last; an empty table stays empty.
    """
    return near_duplicates.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark, with their columns.

    Null and empty texts and items match nothing; repeated rows go or stay together; an empty
    table on either side changes nothing.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 4096 tokens.

    A null or empty text is its end id alone; repeated rows are packed each; a null doc_id stays
    null; an empty table gives no pieces; other columns are not read.
    """
    return packing.pack(docs, word_tokenizer())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: SQL can neither tokenise nor pack; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each is written below the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{name}")
    return docs
