"""Corpus pipeline: language ID, line dedup, near-copy removal, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on every row its predecessor kept and
returns a DataFrame; ``run`` writes each result as Parquet and rereads it for the next.
All stages but the last return the columns of ``documents``.  A stage deletes the work tables
its result does not depend on.

Cases.  Null or empty text, or text without a letter: of no language, dropped by the first
stage.  Long texts are worked on whole by every stage and cut into pieces by the last.  Ties:
the smallest id (then line number) of a class stays.  Rows of equal id and text are repeats and
one stays; rows of equal id and different text stay or go together where a stage decides by id.
Empty table: no rows.  Other columns pass through whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeload.llm import decontaminate, language_id, line_dedup, ngram_jaccard, packing, queries
from lakeload.llm.graph import stage


#: Rows of an Arrow batch: whole documents go to Python, and both sides hold a batch or two.
BATCH_ROWS = "1000"


def small_batches(spark: SparkSession) -> None:
    """Bound the batches that stages hand to Python, unless the session says otherwise."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) == 10_000:  # Spark's own default
        spark.conf.set(key, BATCH_ROWS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of no or of ambiguous language."""
    small_batches(spark)
    return language_id.keep_clear(docs, queries.language_model(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first of each class of near-equal lines; documents that lose every line go."""
    return line_dedup.drop_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near copies."""
    return ngram_jaccard.drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents contaminated by benchmark items."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into sequences of at most 2048 tokens."""
    _, places = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return places.withColumnRenamed("crc", "ids_crc32")


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("ngram_jaccard", near_copies),
    ("decontamination", decontamination),
    ("best_fit_packing", packed),
]

#: Trained classifiers and tokenizers have no SQL form; tests/llm compares run() with the stages called one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
