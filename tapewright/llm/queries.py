"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.llm import (
    bpe,
    covertree,
    decontaminate,
    htmltext,
    jaccard,
    kmeans,
    language,
    licences,
    neighbours,
    ngrams,
    pii,
    tokencount,
    urlfilter,
)
from tapewright.llm.columns import read

URL_RULES = [
    urlfilter.Rule("allow", "org", "/"),
    urlfilter.Rule("block", "example.org", "/es/"),
    urlfilter.Rule("block", "example.org", "/en/1"),
    urlfilter.Rule("allow", "com", "/fr/"),
    urlfilter.Rule("block", "com", "/de/"),
]
BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
TOKEN_LIMIT = 512
QUERY_EVERY = 20
ANCHOR_EVERY = 50
FOLDS = 5


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score(read(spark, sf_dir, "documents"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(
        read(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % QUERY_EVERY == 0
    )


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    return decontaminate.judge(found).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
        "contaminated",
    )


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(read(spark, sf_dir, "pages"), URL_RULES, keep=["page_id"])


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    counted = tokencount.count_tokens(
        docs, public_tokenizers.path(BYTE_BPE), keep=["doc_id", "n_bytes"]
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs), keep=["doc_id"])

    def listed(spans: Column) -> Column:
        part = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
        return F.concat_ws(",", part)

    base = F.filter("pii", lambda x: x["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(number(kind) for kind in pii.KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("pii")).alias("spans"),
    )


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents"))


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_BPE)
    docs = read(spark, sf_dir, "documents")
    return bpe.encode(docs, path, keep=["doc_id"], into="decoded").select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def held_out(doc_id: str = "doc_id") -> Column:
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == 0


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", held_out())
    model = language.train(docs.where("NOT held_out"), sample_by=F.col("doc_id"))
    return language.identify(docs, model, keep=["doc_id", "held_out"])


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(read(spark, sf_dir, "pages"), keep=["page_id"])


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.concat_ws(",", "base_labels").alias("base_labels"),
        F.concat_ws(",", "labels").alias("labels"),
        "score",
    )


def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans.described(kmeans.cluster(read(spark, sf_dir, "embeddings")))


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return covertree.hard_negatives(
        read(spark, sf_dir, "embeddings").withColumn("label", moved),
        is_anchor=F.col("vec_id") % ANCHOR_EVERY == 0,
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_scores": lm_scores,
        "op2_nearest_vectors": nearest_vectors,
        "op3_decontamination": decontamination,
        "op4_url_filter": url_filter,
        "op5_personal_data": personal_data,
        "op6_jaccard_join": jaccard_join,
        "op7_token_counts": token_counts,
        "op8_bpe_round_trip": bpe_round_trip,
        "op9_language_id": language_id,
        "op10_html_text": html_text,
        "op11_license_scan": license_scan,
        "op12_centroid_clusters": centroid_clusters,
        "op13_hard_negatives": hard_negatives,
    }
