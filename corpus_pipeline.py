"""The corpus pipeline: five stages, each on all that the one before it kept.

Rejected documents, repeated lines and near copies go; sources are mixed to target
weights; what the mix takes is packed into sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.llm.common import table
from innkeep.llm.jaccard import first_of_groups
from innkeep.llm.lines import dedup_lines
from innkeep.llm.mixing import mixed_documents
from innkeep.llm.packing import pack_documents
from innkeep.llm.queries import tokenizer_path
from innkeep.llm.toxicity import clean_documents
from innkeep.session import scratch_path

#: Near copies: five-word shingles, a similarity of at least 80 %.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not rejected as toxic; every other one stays as it is.

    Null and empty texts have no toxic term and stay unless most labels are toxic;
    repeated rows and ids are judged row by row; an empty table stays empty."""
    return clean_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that one with a smaller id holds.

    Rows with one id are one document, null ids together the last one; ties can't
    arise.  Null texts stay null; texts that lose nothing stay as they are; a text may end up empty.  An
    empty table stays empty."""
    kept = dedup_lines(docs).withColumn("kept", F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("row.text")))
    length = F.length("kept").cast(docs.schema["n_chars"].dataType)
    changed = {"text": F.col("kept"), "n_chars": F.when(F.col("n_dropped") > 0, length).otherwise(F.col("row.n_chars"))}
    return kept.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id, null ids last, of
    several texts with that id the one with the smallest hash.

    Texts without words (null, empty, blanks) are copies of nothing and all stay, and so
    do texts that only share lines which the stage before has taken out: near copies are
    sought in what is left of them.  An empty table stays empty."""
    return first_of_groups(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as a mix of the sources takes them, whole; repeats are repeated rows.

    Null sources are one source; documents without words take no part and go; rows equal
    in all columns are drawn each for themselves.  An empty table stays empty."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 4096 tokens.

    Null and empty texts are one piece, the end token; repeated rows are packed each; an
    empty table gives no rows."""
    return pack_documents(docs, tokenizer_path(), 4096, 1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: Scores, sketches and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
