"""The corpus pipeline: reject toxic texts, apply quality rules, drop near copies, mix the
sources to their weights, encode.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before has kept; all
but the last return the columns of documents. Between stages a table is written and read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import minhash, mixing, pieces, quality, toxicity
from shelfcast.llm.common import read, stored
from shelfcast.llm.queries import PIECE_MODEL


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below the rejection grade.

    Rows are judged one by one, by their whole texts: null and empty ones stay, of rows that
    repeat all stay or none. The model learns from the labels whose documents are left; without
    any, nothing is rejected. Columns keep their values, whatever their names.
    """
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    others = F.struct(*[c for c in docs.columns if c != "text"])
    scored = toxicity.score(docs.select(others.alias("_row"), "text"), model)
    return scored.filter("NOT toxic_rejected").select(
        *["text" if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    )


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null, empty and blank texts go; rows that repeat are judged one by one, texts whole, however
    long. A null language is held to the reference of all. Columns keep their values, whatever
    their names.
    """
    return quality.keep_good(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Of rows that repeat an id one stays; rows without an id all stay, and so do texts without a
    word, which are like no other. Columns keep their values, whatever their names.
    """
    found = minhash.near_duplicates(docs)
    kept = found.filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.filter("doc_id IS NULL")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, in the order of the mix.

    A null source is one of its own, the last; rows that repeat are documents of their own. The
    copy that passes its source's target ends there, one a source at most; all other texts
    are whole. Columns keep their values, whatever their names.
    """
    return mixing.mix_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_pieces, ids`` of every document of the mix, one row per row.

    Null and empty texts have no pieces; texts are encoded whole, however long. Other columns,
    whatever their names, are left out.
    """
    encoded = pieces.encode(docs, PIECE_MODEL)
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids")


STAGES = [
    ("toxicity", reject_toxic),
    ("quality_rules", apply_rules),
    ("near_dedup", drop_copies),
    ("mixing", mix_sources),
    ("piece_encoding", encode_pieces),
]

ORACLE_SQL = None  # trained models and a tokenizer's vocabulary are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
