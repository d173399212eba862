"""From documents to token ids: quality, line dedup, near duplicates, decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and gives a table that is written before the
next one reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campusgrid.llm import bpe, decontaminate, lines, quality, similar
from campusgrid.llm.common import fold_of, table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, doesn't reject.

    Null texts are scored as empty ones; rows with null ids are scored, but never
    learned from. Repeated rows are scored alike. Without labels every document stays.
    """
    folds = docs.select("doc_id", "text", fold_of(F.col("doc_id"), 4).alias("fold"))
    model = quality.train(folds, table(spark, sf_dir, "labels"))
    score = f"_{'_'.join(docs.columns)}_score"  # no column is named so
    scored = quality.score_texts(docs, model, score)
    return scored.filter(F.col(f"`{score}`") >= quality.THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts without lines of recurring templates; n_chars follows the text.

    No document goes, null and empty texts stay as they are, an empty table gives one.
    """
    counts = tuple(f"_{'_'.join(docs.columns)}_{name}" for name in ("lines", "dropped"))  # no column is named so
    kept = lines.drop_recurring(docs, counts=counts)
    counted = F.when(F.col(f"`{counts[1]}`") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", counted).select(*[F.col(f"`{c}`") for c in docs.columns])


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id, null last.

    Documents without words, null texts too, are no one's duplicates and stay.
    """
    return similar.drop_near_duplicates(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item; null texts hold none.

    Without benchmark items every document stays.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of every text, with the digest of the bytes
    its ids decode to. Null and empty texts have no ids; repeated rows are coded alike."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    outputs = ("n_tokens", "ids", "ids_sha256", "decoded_sha256")
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, outputs)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_boilerplate),
    ("n-gram Jaccard join", without_near_duplicates),
    ("benchmark decontamination", without_benchmarks),
    ("byte-level BPE", token_ids),
]

# Neither the classifier nor BPE can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
