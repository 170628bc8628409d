"""From raw documents to packed training sequences, one written table a stage.

``STAGES`` are (name, function); a function takes the session, the documents its predecessor
kept and the directory of tables, and returns a DataFrame.  All but the last return the
columns of ``documents``.  ``run`` writes each result as Parquet and reads it again for the
next stage, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import read_table
from basketry.llm.decontaminate import decontaminate, without_spans
from basketry.llm.lines import line_dedup
from basketry.llm.packing import best_fit_packing
from basketry.llm.quality import quality_rules
from basketry.llm.simhash import simhash_groups
from basketry.sources.shared import new_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
CAPACITY = 2048
TOKENIZER = "byte_bpe_50k.json"


def _documents(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs).filter("quality.kept").select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that are boilerplate of their source."""
    return _documents(line_dedup(docs, host="source"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest id.

    Where several rows have that id, or a group has no id at all, the row of the least text hash
    stays, and of equal hashes the least row.  Rows of one id in different groups are different
    documents.
    """
    grouped = simhash_groups(docs, shingle=3, max_bits=2)
    # All of a group have the same id, or none.
    first = grouped.filter(
        (F.col("doc_id") == F.col("component_id")) | F.col("component_id").isNull()
    )
    row = F.min(F.struct(F.xxhash64("text").alias("mark"), *COLUMNS)).alias("row")
    return first.groupBy("component_root").agg(row).select("row.*").select(COLUMNS)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark passages; those of nothing else go."""
    found = decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    left = found.filter((F.col("leak.n_hit") == 0) | (F.col("leak.n_hit") < F.col("leak.n_words")))
    return _documents(left.withColumn("text", without_spans(F.col("text"), F.col("leak.spans"))))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's pieces in sequences of at most 2048 tokens."""
    return best_fit_packing(docs, public_tokenizers.path(TOKENIZER), CAPACITY, keep_ids=False)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmarks),
    ("best-fit packing", packing),
]

#: SQL can express neither the tokenizer nor the components.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, from the ``documents`` in ``sf_dir``."""
    folder = new_folder(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents").select(COLUMNS)
    for number, (_, stage) in enumerate(STAGES, 1):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
