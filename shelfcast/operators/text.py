"""Product descriptions as tokens, vocabularies and term vectors."""

from __future__ import annotations

from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    Normalizer,
    RegexTokenizer,
    StopWordsRemover,
    Tokenizer,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.text import plain_text

# Vocabulary limits, and what counts as a word in a phrase.
VOCABULARY_SIZE = 1000
MIN_DOCUMENTS = 5
TFIDF_TERMS = 100
WORD = r"(?U)\b\w\w+\b"  # two or more word characters of any script


def descriptions(features: DataFrame) -> DataFrame:
    """Distinct product names with the number of rows each stands for.

    Everything downstream is per name, so names are tokenised and clustered once and
    carry their row count as a weight instead of being repeated for every month.
    """
    return (
        features.filter(F.col("Description").isNotNull())
        .groupBy("Description")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def tokens(docs: DataFrame) -> DataFrame:
    """``words``: lower-cased, split at single blanks; ``filtered``: without stop words."""
    words = Tokenizer(inputCol="Description", outputCol="words").transform(docs)
    return StopWordsRemover(inputCol="words", outputCol="filtered").transform(words)


def term_totals(docs: DataFrame, terms: str) -> DataFrame:
    """Per term: occurrences and documents, both counted in rows."""
    pos = F.col("pos") + 1
    first = F.array_position(F.col(terms), F.col("term")) == pos
    return (
        docs.select("n_rows", terms, F.posexplode(terms).alias("pos", "term"))
        .groupBy("term")
        .agg(
            F.sum("n_rows").alias("occurrences"),
            F.sum(F.when(first, F.col("n_rows")).otherwise(F.lit(0))).alias("documents"),
        )
    )


def vocabulary(
    docs: DataFrame, terms: str, size: int = VOCABULARY_SIZE, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """The ``size`` most frequent terms found in enough rows, ties by term."""
    return (
        term_totals(docs, terms)
        .filter(F.col("documents") >= min_documents)
        .orderBy(F.col("occurrences").desc(), F.col("term").asc())
        .limit(size)
    )


def count_vectors(docs: DataFrame, vocab: list[str], terms: str, output: str) -> DataFrame:
    """Sparse term counts; a vocabulary holds at most ``size`` words, so it can be a model."""
    model = CountVectorizerModel.from_vocabulary(vocab, inputCol=terms, outputCol=output)
    return model.transform(docs)


def phrases(docs: DataFrame) -> DataFrame:
    """``terms``: one- and two-word phrases of the lower-cased name, without stop words."""
    plain = docs.withColumn("_plain", plain_text(F.col("Description")))
    words = RegexTokenizer(inputCol="_plain", outputCol="_all", pattern=WORD, gaps=False)
    stop = StopWordsRemover(inputCol="_all", outputCol="_words")
    pairs = NGram(n=2, inputCol="_words", outputCol="_pairs")
    out = pairs.transform(stop.transform(words.transform(plain)))
    return out.withColumn("terms", F.concat("_words", "_pairs")).drop(
        "_plain", "_all", "_words", "_pairs"
    )


def phrase_vocabulary(docs: DataFrame, size: int = TFIDF_TERMS) -> DataFrame:
    """Vocabulary with its smoothed inverse document frequency."""
    rows = docs.agg(F.sum("n_rows")).first()[0] or 0
    weight = F.log(F.lit(rows + 1.0) / (F.col("documents") + 1)) + 1
    return (
        vocabulary(docs, "terms", size, min_documents=1)
        .select("term", "occurrences", "documents", weight.alias("idf"))
        .orderBy(F.col("occurrences").desc(), F.col("term").asc())
    )


def tfidf_vectors(docs: DataFrame, vocab: list[tuple[str, float]], output: str) -> DataFrame:
    """Counts times inverse document frequency, scaled to unit length."""
    counted = count_vectors(docs, [term for term, _ in vocab], "terms", "_tf")
    scale = ElementwiseProduct(
        scalingVec=Vectors.dense([idf for _, idf in vocab]), inputCol="_tf", outputCol="_tfidf"
    )
    unit = Normalizer(p=2.0, inputCol="_tfidf", outputCol=output)
    return unit.transform(scale.transform(counted)).drop("_tf", "_tfidf")
