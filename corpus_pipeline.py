"""A corpus cleaned in five stages, each over all that the stage before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again
as the next stage's documents. All stages but the last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.llm import bpe, decontaminate, jaccard, language, pii, queries
from tapewright.llm.columns import col
from tapewright.session import scratch_path

# Documents whose language is less likely than this go.
LEAST_SCORE = 0.5


def _apart(docs: DataFrame) -> DataFrame:
    """The documents under names that no operator adds; doc_id and text are told by _name()."""
    return docs.select(*(col(c).alias(_name(docs, c)) for c in docs.columns))


def _name(docs: DataFrame, column: str) -> str:
    return f"own_{docs.columns.index(column)}"


def _back(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*(F.col(_name(docs, c)).alias(c) for c in docs.columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those of no language that the model is fairly sure of.

    The model is fitted on the labelled documents themselves. Without any labelled document there
    is no model, every document is rejected, and the result is empty.
    """
    model = language.train(docs, sample_by=F.col("doc_id"))
    judged = language.identify(_apart(docs), model, text=_name(docs, "text"))
    kept = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return _back(judged.where(kept), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Documents without an id have no group and stay. Rows that repeat a kept id all stay, as they
    are that document.
    """
    path = scratch_path(spark, "copies")
    copies = jaccard.join(docs).where("component_id < doc_id").select("doc_id").distinct()
    copies.write.parquet(path)
    copies = spark.read.parquet(path)
    # few enough ids are sent to every task; else the documents are joined to them by id
    if copies.count() <= jaccard.BROADCAST_IDS:
        copies = F.broadcast(copies)
    own = _apart(docs)
    return _back(own.join(copies, own[_name(docs, "doc_id")] == F.col("doc_id"), "left_anti"), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark passages, by the rule of the operator."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find(_apart(docs), benchmark, text=_name(docs, "text"))
    return _back(decontaminate.judge(found).where(~F.col("contaminated")), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts marks in place of personal data; every document stays, with its new length."""
    text = _name(docs, "text")
    found = _back(pii.find(_apart(docs), pii.train(docs), text=text, redact=True), docs)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", size)
    return found


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids`` (token ids as little-endian 32-bit numbers), ``n_tokens``, ``decoded``."""
    path = public_tokenizers.path(queries.WORD_BPE)
    own = docs.select("doc_id", "text")
    return bpe.encode(own, path, keep=["doc_id"], into="decoded").select(
        "doc_id", "ids", (F.length("ids") / 4).cast("long").alias("n_tokens"), "decoded"
    )


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

# The stages train models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
