"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import (
    decontamination,
    fingerprints,
    jaccard,
    langid,
    mixing,
    periods,
    quality,
    rules,
    sharding,
    tokencounts,
    toxicity,
    urls,
    whitening,
)
from tidemart.llm.common import held_out, read

Query = Callable[[SparkSession, str], DataFrame]

_registry: dict[str, Query] = {}

SHARDS = 24


def query(fn: Query) -> Query:
    _registry[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_registry)


@query
def op1_sharding(spark, root):
    rows = read(spark, root, "documents", "doc_id", "text").select(
        "doc_id",
        sharding.text_size(F.col("text")).alias("size"),
        sharding.text_crc(F.col("text")).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
    )
    return sharding.shard_documents(rows, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op2_ngram_jaccard(spark, root):
    return jaccard.jaccard_components(read(spark, root, "documents", "doc_id", "text"), k=4, percent=85)


@query
def op3_quality_classifier(spark, root):
    apart = held_out(F.col("doc_id"), 3, 1)
    scored = quality.quality_scores(
        read(spark, root, "documents", "doc_id", "text"), read(spark, root, "labels", "doc_id", "quality"), ~apart
    )
    return scored.select("doc_id", apart.alias("held_out"), "score", "predicted")


@query
def op4_quality_rules(spark, root):
    rows = rules.ledger(read(spark, root, "documents", "doc_id", "text"))
    base, verdict = rules.fails(rules.POLICIES["base"]), rules.fails(rules.POLICIES["v1"])
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & ~verdict).alias("kept"), "failed",
    )


@query
def op5_url_filters(spark, root):
    return urls.judge_pages(read(spark, root, "pages", "page_id", "url"), urls.RULES)


@query
def op6_decontamination(spark, root):
    found = decontamination.contaminated(
        read(spark, root, "documents", "doc_id", "text"), read(spark, root, "benchmark", "item_id", "text")
    )
    return found.drop("text_hash")


@query
def op7_mixing(spark, root):
    docs = read(spark, root, "documents", "doc_id", "text", "source")
    return mixing.mix_counts(docs).select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_language_id(spark, root):
    apart = held_out(F.col("doc_id"), 5, 0)
    docs = read(spark, root, "documents", "doc_id", "text", "lang")
    found = langid.languages(docs.select("doc_id", "text"), docs.select("doc_id", "lang"), ~apart)
    return found.select("doc_id", apart.alias("held_out"), "lang_pred", "score")


@query
def op9_toxicity(spark, root):
    apart = held_out(F.col("doc_id"), 5, 0)
    scored = toxicity.toxicity(
        read(spark, root, "documents", "doc_id", "text"), read(spark, root, "labels", "doc_id", "toxic"), ~apart
    )
    return scored.select(
        "doc_id", apart.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_sentences", "offending",
    )


@query
def op10_token_counts(spark, root):
    return tokencounts.count_and_redact(read(spark, root, "documents", "doc_id", "text"))


@query
def op11_periodic_runs(spark, root):
    found = periods.periodic_runs(periods.planted(read(spark, root, "documents", "doc_id", "text")))
    found = found.withColumn("most", periods.longest(F.col("runs")))
    length, period = -F.col("most.length"), F.col("most.period")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("most.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_embedding_whitening(spark, root):
    return whitening.whitened(read(spark, root, "embeddings", "vec_id", "embedding"))


@query
def op13_document_fingerprints(spark, root):
    return fingerprints.compared(read(spark, root, "documents", "doc_id", "text"))
