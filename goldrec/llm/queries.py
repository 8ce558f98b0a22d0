"""The registered queries: each operator over its whole table, with the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.llm.common import table
from goldrec.llm.hard_negatives import mine_negatives
from goldrec.llm.licenses import scan_licenses
from goldrec.llm.mixing import mix_sizes
from goldrec.llm.oracles import ORACLES  # noqa: F401
from goldrec.llm.quality import classify
from goldrec.llm.secret_scan import BASE_RULES, scan_documents
from goldrec.llm.sentencepiece_codec import encode_documents
from goldrec.llm.simhash import simhash_components
from goldrec.llm.substring import dedup_substrings
from goldrec.llm.suffix_dedup import dedup_bytes
from goldrec.llm.topk import scaled, top_k
from goldrec.llm.urls import filter_urls
from goldrec.llm.vector_codes import compress
from goldrec.llm.vectors import near_vectors


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(table(spark, sf_dir, "documents"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_licenses(table(spark, sf_dir, "documents"))
    starts = F.transform("places", lambda p: p["start"])
    return out.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_documents(table(spark, sf_dir, "documents"), keep=["doc_id"])
    kinds = [r.kind for r in BASE_RULES]

    def line(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    counts = [of(k).alias(f"n_{k}") for k in kinds]
    return out.select("row.doc_id", *counts, F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = scaled(table(spark, sf_dir, "embeddings"))
    return top_k(vectors.where("id % 20 = 0"), vectors)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = compress(table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_mixing,
        op3_embedding_near_dedup,
        op4_sentencepiece,
        op5_simhash,
        op6_licenses,
        op7_secrets,
        op8_top_k,
        op9_quality,
        op10_url_filter,
        op11_vector_codes,
        op12_hard_negatives,
        op13_suffix_array,
    )
}

