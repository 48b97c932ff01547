"""From raw documents to packed training sequences: each stage is written as Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanweave.llm import line_dedup, minhash_dedup, packing, quality_model, quality_rules
from urbanweave.llm.common import table, text_of
from urbanweave.session import use_checkpoint_dir


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the outlier test of their language and source reject go."""
    return quality_rules.quality_rules(docs).where("kept").select("row.*")


def model_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts as bad go. It learns from the labelled rows of the raw documents."""
    model = quality_model.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_model.score_quality(docs, model).where("predicted = 1").select("row.*")


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share go; ``n_chars`` follows the text. No document goes."""
    out = line_dedup.dedup_lines(docs)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return out.select(*[new.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns])


def copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8) stays; repeated rows count once, rows without id stay."""
    kept = minhash_dedup.near_documents(docs).where("kept and doc_id is not null").select("doc_id", "t").distinct()
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64(text_of("text")).alias("hash"), F.struct("*").alias("row"))
    named = rows.join(kept.toDF("id", "hash"), ["id", "hash"]).groupBy("id", "hash").agg(F.first("row").alias("row"))
    return named.select("row.*").unionByName(docs.where("doc_id is null"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    return packing.pack(docs, spark, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", rules_stage),
    ("quality classifier", model_stage),
    ("line dedup", lines_stage),
    ("minhash near-dedup", copies_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # robust estimates, a trained network and column generation have no SQL form; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the tables between them lie in the shared checkpoint folder."""
    use_checkpoint_dir(spark)
    place = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{k}")
        docs = spark.read.parquet(f"{place}/{k}")
    return docs
