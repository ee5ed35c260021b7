"""A training corpus in stages: each reads what the one before it kept, as Parquet."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm import bpe, decontaminate, langid, neardup, quality
from fleetpulse.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the likelihood ratio keep."""
    judged = quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return judged.where("kept").select("__row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    return langid.identify(docs, F.col("lang"), F.col("source"), F.col("doc_id")).where("kept").select("__row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal or similar texts."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that the benchmark has; documents of which nothing is left go."""
    clean = decontaminate.cut(decontaminate.scan(docs, table(spark, sf_dir, "benchmark")))
    changed = {"text": F.col("clean")} | ({"n_chars": F.length("clean").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    columns = [F.when(F.col("changed"), changed[c]).otherwise(F.col(f"row.`{c}`")).alias(c) if c in changed else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return clean.where("NOT changed OR clean IS NOT NULL").select(*columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids, digests of ids and of the text decoded from them, in place of columns of these names."""
    found = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=True)
    new = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    return found.select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns if c.lower() not in new], *new)


STAGES = [("quality rules", quality_rules), ("language id", language_id), ("near duplicates", near_duplicates), ("decontamination", decontamination), ("bpe", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{i}")
    return docs
