"""The corpus operators as registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (
    chat,
    decontaminate,
    html,
    kdtree,
    lines,
    negatives,
    ngramjoin,
    oracle,
    packing,
    prefixtrie,
    quality,
    simhash,
    substrings,
    tokens,
)
from basketry.llm.common import checkpointed, read_table

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 40
CAPACITY = 2048
PACKED_BY, COUNTED_BY = "byte_bpe_50k.json", "word_bpe_49k.json"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = quality.quality_rules(docs)
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    return judged.select("doc_id", *[f"quality.{name}" for name in names])


def op2_budgeted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], given.schema)
    windows = chat.budgeted_windows(given.unionByName(more))
    new = lambda turns: F.slice(turns, F.col("n_context") + 1, F.size(turns))
    read = windows.withColumn("turns", chat.read_turns(F.col("formatted"))).select(
        "conv_id",
        "window",
        new(F.col("turns")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").alias("chars"),
    )
    told = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    parts = read.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "window",
                    F.array_join(F.transform("turns", told), "").alias("told"),
                    "loss",
                )
            )
        ).alias("parts"),
        F.sum(F.size("turns")).alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
    )
    joined = lambda name: F.array_join(F.col(f"parts.{name}"), "")
    return parts.select(
        "conv_id",
        "n_turns",
        F.sha2(joined("told"), 256).alias("turns_sha256"),
        F.length(joined("loss")).cast("long").alias("loss_chars"),
        F.sha2(joined("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    path = public_tokenizers.path(PACKED_BY)
    return packing.best_fit_packing(docs, path, CAPACITY, keep_ids=False)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokens.token_counts(docs, public_tokenizers.path(COUNTED_BY))
    return tokens.with_bytes(counted).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > CAPACITY).alias("over_limit")
    )


def op7_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kdtree.document_metadata(read_table(spark, sf_dir, "documents"))
    dims = [F.log2("size"), F.col("doc_id"), F.col("source_code"), F.col("lang_code")]
    placed = kdtree.kd_tree_shards(rows, "size", dims, ["doc_id", "text_crc32", "size"], SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.main_text(pages).withColumn("n_chars", F.length("text").cast("long"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.line_dedup(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.substring_dedup(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256")
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "leak.n_words",
        "leak.n_hit",
        F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leak.items", ","), 256).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    printed = checkpointed(simhash.fingerprints(docs, "text", shingle=3))
    grouped = simhash.fingerprint_groups(printed, max_bits=2)
    return grouped.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10)
    rows = rows.withColumn("label", moved.otherwise(F.col("label")))
    return negatives.hard_negatives(rows, F.col("ident") % 100 == 0)


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngramjoin.jaccard_groups(docs, shingle=4, percent=85)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    head = F.crc32(F.col("conv").cast("string")) % 4
    base = F.col("conv") - F.col("conv") % 20
    return prefixtrie.conversation_trie(conversations, head, base)


_QUERIES = (
    op1_quality_rules,
    op2_budgeted_windows,
    op3_substring_dedup,
    op4_decontamination,
    op5_best_fit_packing,
    op6_token_counts,
    op7_kd_tree_shards,
    op8_main_text,
    op9_line_dedup,
    op10_simhash,
    op11_hard_negatives,
    op12_ngram_join,
    op13_prefix_trie,
)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": oracle.quality_rules(),
        "op2_budgeted_windows": oracle.chat_windows(),
        "op3_substring_dedup": oracle.substring_dedup(),
        "op4_decontamination": oracle.decontamination(),
        "op9_line_dedup": oracle.line_dedup(),
        "op11_hard_negatives": oracle.hard_negatives(),
        "op12_ngram_join": oracle.ngram_join(),
        "op13_prefix_trie": oracle.prefix_trie(),
    }
