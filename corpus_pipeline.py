"""The corpus pipeline: five stages, each on all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``, whatever other columns these
have; they look at doc_id, text, lang and source only. The result of each
stage for nulls, empty and repeated rows is that of its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playback_qos.llm.bpe import encode_documents
from playback_qos.llm.common import table, written
from playback_qos.llm.decontaminate import decontaminate
from playback_qos.llm.jaccard_join import keep_one
from playback_qos.llm.language_id import held_out, identify, train
from playback_qos.llm.line_dedup import drop_boilerplate
from playback_qos.llm.queries import piece_model_path


def _rest(docs: DataFrame):
    """All columns but the text as one, out of reach of an operator's own names."""
    return F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("__rest")


def _unpacked(docs: DataFrame, rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col("text") if c == "text" else F.col("__rest").getField(c).alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told: rejected ones and those without a letter go."""
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    told = identify(docs.select(_rest(docs), "text"), model, keep=["__rest", "text"])
    return _unpacked(docs, told.filter("NOT rejected"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate lines of their source; all documents stay. Copies of a text are one page."""
    packed = docs.select(_rest(docs), "text", F.col("source").alias("__host"))
    return _unpacked(docs, drop_boilerplate(packed, host="__host", distinct_pages=True))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate, which their texts alone decide."""
    identity = F.sha2(F.col("text"), 256)
    texts = docs.select(identity.alias("identity"), "text")
    found = decontaminate(texts, table(spark, sf_dir, "benchmark"), key="identity")
    bad = written(found.filter("contaminated").select(F.col("identity").alias("__bad")).distinct())
    return docs.join(bad, identity == F.col("__bad"), "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and digests of them and of the text they decode to."""
    return encode_documents(docs, piece_model_path()).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("jaccard_join", near_duplicates),
    ("decontamination", clean_of_benchmark),
    ("sentencepiece", tokens),
]

#: SQL cannot express the stages; tests/llm holds each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
