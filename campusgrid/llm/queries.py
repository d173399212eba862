"""The queries of this package over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campusgrid.llm import bpe, brown, chat, decontaminate, language, lines, quality, repair, repeats, rules, similar, spotsigs, trie
from campusgrid.llm.common import fold_of, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


@_query("op1_spotsigs")
def spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


@_query("op2_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    outputs = ("n_tokens", "ids_sha256", "decoded_sha256")
    return bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, outputs)


@_query("op3_language")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold_of(F.col("doc_id"), 4) == 2
    model = language.train(docs.filter(~held_out))
    return language.identify(docs.withColumn("held_out", held_out), model, ("doc_id", "held_out"))


@_query("op4_perspectives", chat.ROTATE_SQL)
def perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


@_query("op5_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.find_contamination(docs, items, digests=True)
    return found.withColumn("contaminated", F.col("n_hit") > 0)


@_query("op6_class_lm")
def class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold_of(F.col("doc_id"), 5) == 1)
    model = brown.train(docs.filter(~F.col("held_out")))
    return brown.score(docs, model, ("doc_id", "held_out"))


@_query("op7_repeated_spans")
def repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), digests=True)


@_query(
    "op8_line_templates",
    f"""WITH {lines.drop_recurring_sql("documents")}
    SELECT doc_id, n_lines, n_dropped, sha256(coalesce(text, '')) AS text_sha256 FROM lined""",
)
def line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_recurring(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )


@_query("op9_near_duplicates")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.near_duplicates(table(spark, sf_dir, "documents"))


@_query("op10_quality")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("fold", fold_of(F.col("doc_id"), 4))
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(quality.document_statistics(docs, ("doc_id", "fold")), model, ("doc_id", "fold"))
    return scored.select(
        "doc_id",
        (F.col("fold") == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


@_query("op11_prefix_trie", trie.TRIE_SQL)
def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(*trie.rebuilt(table(spark, sf_dir, "conversations"))).drop("node")


@_query("op12_structure_repair")
def structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, sf_dir, "conversations")), "report")


@_query("op13_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    trusted = labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0))
    return rules.judge(docs, rules.train(docs, trusted))
