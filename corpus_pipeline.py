"""A training-data pipeline over ``documents`` in five stages, each an operator
of ``lathe.llm``.  A stage's rows are written as Parquet in the shared
checkpoint folder and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lathe.llm.common import stage_table, table
from lathe.llm.line_dedup import dedup_lines
from lathe.llm.mixing import mixed_documents
from lathe.llm.ngram_join import one_of_each_group
from lathe.llm.packing import pack
from lathe.llm.quality_rules import kept_documents


#: rows that a task hands to Python at once; the stages share executors, whose Python
#: workers keep the memory of their largest batch
BATCH_ROWS = 1_000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned quality rules keep."""
    _small_batches(spark)
    return kept_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later repeated runs of lines; documents left without any
    line go.  n_chars follows the text."""
    from pyspark.sql import functions as F
    _small_batches(spark)
    cleaned = dedup_lines(docs).where("n_removed < n_lines or n_removed = 0")
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*[F.col(f"`{c}`") for c in docs.columns])


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    _small_batches(spark)
    return one_of_each_group(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out as the sources' target weights ask."""
    _small_batches(spark)
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences of tokens."""
    _small_batches(spark)
    return pack(docs)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram Jaccard join", ngram_join),
          ("mixing to target weights", mixing), ("packing", packing)]

#: The learned rules, MinHash and the tokenizer have no SQL form; the tests hold
#: every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
