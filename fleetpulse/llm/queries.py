"""The training-data operators as queries over the benchmark tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm import bpe, chat, decontaminate, langid, licenses, neardup, phrases, ppm, quality, ranking, sharding, spelling, token_counts
from fleetpulse.llm.common import table
from fleetpulse.llm.oracles import ORACLES as ORACLES


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def picked(df: DataFrame, *names: str) -> DataFrame:
    return df.select(F.col("__row.doc_id").alias("doc_id"), *names)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), 8)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    found = langid.identify(docs, F.col("lang"), F.col("source"), F.col("doc_id"))
    return picked(found, "lang", "confidence", "declared", "kept")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over raw pages: declared by the markup, hosts and suffixes of addresses."""
    text = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " "), "(?s)<[^>]*>", " ")
    declared = F.regexp_extract("html", r"""(?is)<html[^>]*?\blang\s*=\s*["']?([A-Za-z_-]+)""", 1)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", declared.alias("declared_lang"), text.alias("text"))
    found = langid.identify(pages, F.col("declared_lang"), F.expr("try_parse_url(url, 'HOST')"), F.col("page_id"))
    return found.select(F.col("__row.page_id").alias("page_id"), "lang", "confidence", "declared", "host", "kept")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return picked(found, "n_bytes", "n_tokens", "over_limit")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(documents(spark, sf_dir))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return picked(found, "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A conversation whose texts look like the template's own marks.
    marks = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", marks), (-7, 1, "assistant", marks)], "conv_id long, turn int, role string, text string")
    pieces = chat.render(rows.unionByName(extra.select("conv_id", F.col("turn").cast(rows.schema["turn"].dataType).alias("turn"), "role", "text")))
    return chat.read_back(pieces, chat.examples(pieces))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return picked(found, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode_decode(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return picked(found, "n_tokens", "ids_sha256", "decoded_sha256")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(documents(spark, sf_dir))
    return picked(found, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return picked(ranking.score(docs, ranking.fit(docs, table(spark, sf_dir, "labels"))), "held_out", "score", "predicted")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_language_id, op3_token_counts, op4_lm_scoring, op5_decontamination, op6_chat_formatting, op7_near_duplicates, op8_quality_rules, op9_bpe, op10_license_scan, op11_quality_classifier, op12_phrase_collocations, op13_spelling_variants, language_id_pages)}
