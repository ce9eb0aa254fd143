"""Corpus pipeline: five stages from raw documents to encoded, clean text.

Each stage reads what its predecessor wrote. Documents that the quality model
rejects, all but one of each group of near-duplicates (the smallest ``doc_id``;
rows without an id are told apart by their text), and documents contaminated
with benchmark items go; documents below that limit lose their spans of ``SPAN`` or
more benchmark words; secrets are replaced in the text; the last stage encodes what is left.

Null and empty texts pass through every stage as empty texts and are judged like
others; repeated rows are exact copies, of which one stays; extra columns are
kept where a stage returns documents.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postings_lake.llm import bpe, decontaminate, quality, secrets, simhash
from postings_lake.llm.common import aside, crc_mod, shared_dir
from postings_lake.llm.queries import table, tokenizer_path

QUALITY_LIMIT = 0.7
SHINGLE, MAX_BITS = 3, 3
SPAN = 13
MARK = "[SECRET]"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model scores ``QUALITY_LIMIT`` or more."""
    raw, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(raw, labels, excluded=crc_mod("doc_id", 4) == 2)
    packed, unpack = aside(docs)
    return unpack(quality.score(packed, model).filter(F.col("score") >= QUALITY_LIMIT))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest ``doc_id`` of each near-duplicate group."""
    return simhash.one_of_each(docs, SHINGLE, MAX_BITS)


def with_text(found: DataFrame, changed: Column, text: Column, docs: DataFrame) -> DataFrame:
    """Rows set aside, with ``text`` where it ``changed``; ``n_chars`` follows."""
    found = found.withColumn("text", F.when(changed, text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("__n_chars", F.when(changed, length).otherwise(F.col("__n_chars")))
    return found


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose share of benchmark words stays below the limit, without their
    spans of ``SPAN`` or more such words."""
    packed, unpack = aside(docs)
    hits = decontaminate.find_hits(packed, table(spark, sf_dir, "benchmark"), cut=SPAN)
    kept = decontaminate.judge(hits).filter(~F.col("contaminated"))
    return unpack(with_text(kept, F.col("n_hit") > 0, F.col("cleaned"), docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by ``MARK``; ``n_chars`` follows."""
    ratios = secrets.fit(docs)
    packed, unpack = aside(docs)
    found = secrets.scan(packed, ratios)
    return unpack(with_text(found, F.size("spans") > 0, secrets.redacted(F.col("text"), F.col("spans")), docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and proof that they decode to its text."""
    coded = bpe.encode(docs, tokenizer_path(), keep=["doc_id", "text"], decode=True)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"))


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("BPE encoding and decoding", encode),
]

# The models and fingerprints of the stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
