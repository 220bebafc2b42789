"""One registered query per training-data operator, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    chat,
    lm,
    merkle,
    minhash,
    mixing,
    pieces,
    quality,
    ring,
    tokenfile,
    toxicity,
    turns,
    urlrules,
    vafile,
)
from shelfcast.llm.common import lower_ascii, read

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SHARDS = 8
CONTROL_TURN = "</s>[INST] ok [/INST]"


def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Two-word shingles, as the contract of this query says."""
    docs = read(spark, folder, "documents")
    return minhash.near_duplicates(docs, width=2, percent=80)


def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", "severity", F.col("toxic_rejected").alias("rejected"))


def url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urlrules.filter_urls(read(spark, folder, "pages"))


def lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm.train_and_score(read(spark, folder, "documents"))


def chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and conversation -1 whose texts are made of control strings."""
    extra = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_TURN), (-1, 1, "assistant", CONTROL_TURN)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    table = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.format_and_digest(table.unionByName(extra)).drop("rewrites")


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfile.encode_and_index(read(spark, folder, "documents"), WORD_TOKENIZER)


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    return quality.judge(docs).drop("text", "lang")


def exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return vafile.top_k(read(spark, folder, "embeddings"), k=5, every=50)


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sizes(read(spark, folder, "documents"))


def piece_encoding(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    docs = read(spark, folder, "documents")
    decoded = pieces.decode(pieces.encode(docs, PIECE_MODEL), PIECE_MODEL)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_pieces"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents, and what they say of texts of which some were tampered with."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    tampered = F.when(crc % 3 == 0, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    docs = read(spark, folder, "documents")
    manifest = merkle.build(docs, claimed=merkle.leaf_digest(text=tampered))
    proofs = merkle.prove(manifest)
    led = merkle.folded(F.col("claimed"), F.col("places"), F.col("siblings"))
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("siblings")).alias("proof_sha256"),
        led.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def ring_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents on eight shards whose row counts differ by one at most."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = read(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    return ring.assign(rows, SHARDS).withColumn("grown_shard", F.lit(None).cast("int"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with planted faults, by a hash of conversation and turn; nulls are one space."""
    space = F.lit(" ")
    said = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat(said[0], F.lit(":"), said[1])) % 20
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    text = F.when(F.col("_kind") == 1, "").otherwise(F.col("text"))
    text = F.when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(text)
    copies = F.when(F.col("_kind") == 3, 2).otherwise(1)
    return (
        conversations.select(
            "conv_id", "turn", said[2].alias("role"), said[3].alias("text"), kind.alias("_kind")
        )
        .filter("_kind <> 0")
        .select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copies"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
        .drop("_copy", "_copies")
    )


def turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations with planted faults, repaired; one row for every conversation."""
    table = read(spark, folder, "conversations")
    found = turns.report(turns.repair(damaged(table))).withColumnRenamed("conv_id", "_conv")
    every = table.select("conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = F.sha2(F.lit(""), 256)
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": near_dedup,
    "op2_toxicity": toxicity_scores,
    "op3_url_filters": url_filters,
    "op4_lm_scores": lm_scores,
    "op5_chat_format": chat_format,
    "op6_token_files": token_files,
    "op7_quality_rules": quality_rules,
    "op8_exact_top_k": exact_top_k,
    "op9_source_mix": source_mix,
    "op10_piece_encoding": piece_encoding,
    "op11_merkle_manifest": merkle_manifest,
    "op12_ring_shards": ring_shards,
    "op13_turn_repair": turn_repair,
    "pipeline": pipeline,
}
