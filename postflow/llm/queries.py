"""A query for each operator of this package, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.llm import (
    chat,
    decontaminate,
    filter_audit,
    language_id,
    language_model,
    licenses,
    line_dedup,
    minhash,
    mixing,
    quality_classifier,
    quality_rules,
    simhash,
    spelling,
)
from postflow.llm.common import join_null_safe

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return mixing.Mix(docs.select("doc_id", "text", "source")).report()


@query
def op2_class_ngram_score(spark, sf_dir):
    return language_model.score_documents(table(spark, sf_dir, "documents"))


@query
def op3_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op4_quality_classifier(spark, sf_dir):
    return quality_classifier.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query
def op5_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


@query
def op6_chat_format(spark, sf_dir):
    verdict, texts = chat.collapse(table(spark, sf_dir, "conversations"))
    whole = texts.groupBy("conv_id").agg(F.sum(F.length("text")).alias("n_chars"))
    return join_null_safe(verdict, whole, ["conv_id"], "left").select(
        "conv_id", "n_turns", "kept", "kept_in", F.coalesce("n_chars", F.lit(0)).alias("n_chars")
    )


@query
def op7_license_scan(spark, sf_dir):
    return licenses.license_report(table(spark, sf_dir, "documents"))


@query
def op8_line_dedup(spark, sf_dir):
    found = line_dedup.line_report(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.array_join(F.transform("dropped", lambda d: d["pos"].cast("string")), ",").alias("dropped"),
        F.array_join(
            F.transform(
                "dropped",
                lambda d: F.concat_ws(
                    ":", F.coalesce(d["first_doc"].cast("string"), F.lit("")), d["first_pos"].cast("string")
                ),
            ),
            ",",
        ).alias("firsts"),
    )


@query
def op9_quality_rules(spark, sf_dir):
    found, _ = quality_rules.quality_verdicts(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("doc_id", *counts, "base_failed", "kept", "rule")


@query
def op10_minhash_near_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = minhash.near_duplicates(docs)
    rows = docs.select("doc_id", minhash.text_id(F.col("text")).alias("i"))
    rows = rows.select(F.col("doc_id").alias("id"), F.col("i.h").alias("hi"), F.col("i.g").alias("gi"))
    match = rows["id"].eqNullSafe(found["doc_id"]) & (rows["hi"] == found["h"]) & (rows["gi"] == found["g"])
    return rows.join(found, match).select(F.col("id").alias("doc_id"), "class_id")


@query
def op11_spelling_variants(spark, sf_dir):
    return spelling.document_variants(table(spark, sf_dir, "documents"))


@query
def op12_simhash(spark, sf_dir):
    return simhash.fingerprint_report(table(spark, sf_dir, "documents"))


@query
def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit_filters(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )
