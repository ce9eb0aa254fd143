"""The registered queries of this subpackage, ``(spark, sf_dir) -> DataFrame``."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postings_lake.llm import bpe, chat, crosspolytope, decontaminate, fillmiddle, hardneg, langid, maxent, quality, secrets, simhash, tokenfiles, toxicity
from postings_lake.llm.common import crc_mod


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_langid(spark, sf_dir):
    docs, held_out = table(spark, sf_dir, "documents"), crc_mod("doc_id", 3) == 1
    model = langid.fit(docs, excluded=held_out)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratios = secrets.fit(docs)
    found = secrets.scan(docs, ratios)
    counts = [F.size(F.filter("base", secrets.of_kind(k))).cast("long").alias(f"n_{name}")
              for k, name in enumerate(secrets.KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(secrets.listed("base"), 256).alias("base_sha256"),
                        secrets.listed("spans").alias("spans"))


def op3_decontaminate(spark, sf_dir):
    hits = decontaminate.judge(decontaminate.find_hits(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]))
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op4_quality(spark, sf_dir):
    docs, held_out = table(spark, sf_dir, "documents"), crc_mod("doc_id", 4) == 2
    model = quality.fit(docs, table(spark, sf_dir, "labels"), excluded=held_out)
    scored = quality.score(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_neighbours(spark, sf_dir):
    return crosspolytope.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_bpe(spark, sf_dir):
    coded = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path(), keep=["doc_id"], decode=True)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_chat(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(F.lit(-7).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"),
                                   F.lit("</s>[INST] ok [/INST]"))
    back = chat.read_back(chat.format_conversations(turns.union(tricky)))
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(every, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op8_toxicity(spark, sf_dir):
    docs, held_out = table(spark, sf_dir, "documents"), crc_mod("doc_id", 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), excluded=held_out)
    scored = toxicity.score(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op9_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_maxent(spark, sf_dir):
    marked, training = maxent.held_out(table(spark, sf_dir, "documents").select("doc_id", "text"), crc_mod("doc_id", 5) == 1)
    model, counts = maxent.fit(training)
    return maxent.score(marked, model, counts, keep=["doc_id", "held_out"], learned=~F.col("held_out"))


def op11_hardneg(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_fillmiddle(spark, sf_dir):
    cut = fillmiddle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return cut.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
                      F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op13_tokenfiles(spark, sf_dir):
    import public_tokenizers

    return tokenfiles.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


QUERIES = {f.__name__: f for f in (
    op1_langid, op2_secrets, op3_decontaminate, op4_quality, op5_neighbours, op6_bpe, op7_chat, op8_toxicity, op9_simhash,
    op10_maxent, op11_hardneg, op12_fillmiddle, op13_tokenfiles)}
