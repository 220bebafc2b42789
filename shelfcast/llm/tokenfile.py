"""Token-ID files: Parquet with dictionary-encoded id lists, small pages and page indexes.

Documents lie in ascending id order over range-partitioned files. Row groups and pages are
small and carry column indexes, so that a reader of some ids skips the rest, and a reader of
the counts does not touch the lists.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import ship
from shelfcast.session import scratch_path

END_ID = 1
REMEMBERED = 300_000  # encoded words in each of a worker's two generations, 55 MB each
WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.columnindex.truncate.length": "64",
}


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), {}, {}


def _special(tokenizer) -> list[bytes]:
    """Strings that the library matches in a text before it cuts words; none holds a blank."""
    return [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]


def _stays_letters(word: str) -> bool:
    """Nothing but letters, also when composed and in lower case."""
    if word.isascii():
        return word.isalpha()
    return word.isalpha() and unicodedata.normalize("NFC", word).lower().isalpha()


def _closing(tokenizer) -> np.ndarray | None:
    """Which ids end a run of letters, if the vocabulary says so of every id."""
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    if not suffix:
        return None
    vocabulary = tokenizer.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for piece, i in vocabulary.items() if piece.endswith(suffix)]] = True
    return ends


class WordEncoder:
    """Encodes texts with the library, each distinct word of a batch of texts once.

    Right where the tokenizer drops white space and cuts there first: then the ids of a text
    are those of its blank-separated words, one after the other. ASCII case is folded first
    if the tokenizer lower-cases (its special strings are left as they stand).
    """

    def __init__(self, path: str):
        self.tokenizer, self.known, self.older = _tokenizer(path)
        self.special = _special(self.tokenizer)
        self.folds = self._ids([b"A"]) == self._ids([b"a"])
        self.closing = _closing(self.tokenizer)

    def _ids(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(
            [w.decode("utf-8") for w in words], add_special_tokens=False
        )
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _run_together(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters alone: encoded as one text, cut where the ids say so."""
        text = b" ".join(words).decode("utf-8")
        ids = np.array(
            self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4"
        )
        stops = np.flatnonzero(self.closing[ids]) + 1
        if len(stops) != len(words) or stops[-1] != len(ids):
            return self._ids(words)
        return [part.tobytes() for part in np.split(ids, stops[:-1])]

    def _learn(self, words: list[bytes]) -> None:
        """Encode words not met before. A stop or comma after a letter is cut from its word by
        the tokenizer too, so such words are put together from two."""
        known, together, alone, ended = self.known, [], [], []
        for word in words:
            letters = word.decode("utf-8")
            if self.closing is None:
                alone.append(word)
            elif letters.isalpha():
                together.append(word)
            elif letters[-1] in ".," and _stays_letters(letters[:-1]):
                ended.append(word)
            else:
                alone.append(word)
        if ended:
            together.extend({w[:-1] for w in ended}.difference(known, together))
            alone.extend({w[-1:] for w in ended}.difference(known, alone))
        for i in range(0, len(together), 500):
            part = together[i : i + 500]
            known.update(zip(part, self._run_together(part), strict=True))
        for i in range(0, len(alone), 5000):
            part = alone[i : i + 5000]
            known.update(zip(part, self._ids(part), strict=True))
        for word in ended:
            known[word] = known[word[:-1]] + known[word[-1:]]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of every text, without an end id."""
        cut = []
        for text in texts:
            raw = (text or "").encode("utf-8")
            if self.folds and not any(s in raw for s in self.special):
                raw = raw.lower()
            cut.append(raw.split())
        known, older = self.known, self.older
        if len(known) > REMEMBERED:  # words met since then are kept, others are dropped next time
            older.clear()
            older.update(known)
            known.clear()
        new = set().union(*cut).difference(known) if cut else set()
        met = new.intersection(older)
        known.update((word, older[word]) for word in met)
        self._learn(list(new - met))
        return [b"".join(map(known.__getitem__, words)) for words in cut]


def _encode(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, at = WordEncoder(path), 0
        stop = np.array([end], "<u4").tobytes()
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                found = [ids + stop for ids in encoder(batch.column("text").to_pylist())]
                lengths = np.array([len(ids) // 4 for ids in found], np.int64)
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                values = np.frombuffer(b"".join(found), "<u4").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(np.arange(at, at + len(found)), pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                    ],
                    ["doc_id", "place", "n_tokens", "ids"],
                )
                at += len(found)

    return run


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end: int = END_ID) -> None:
    """Write ``doc_id, place, n_tokens, ids`` to Parquet files in ascending doc_id order.

    File names follow the order of their rows; ``place`` is a row's place in its file. Null
    ids come first, null texts are empty (the end id alone), repeated rows are all written.
    An empty table gives a folder without rows.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text")
    )
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text"
    )
    ordered.mapInArrow(
        _encode(tokenizer, end), "doc_id bigint, place bigint, n_tokens bigint, ids array<int>"
    ).write.options(**WRITE_OPTIONS).parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The table of ``write_tokens``, with the ``file`` of each row."""
    rows = spark.read.schema("doc_id bigint, place bigint, n_tokens bigint, ids array<int>")
    return rows.parquet(folder).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        sums = [
            zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])
        ]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("place"),
                batch.column("file"),
                pa.array(np.diff(offsets), pa.int64()),
                pa.array(sums, pa.int64()),
            ],
            ["doc_id", "place", "file", "n_tokens", "ids_crc32"],
        )


def index_of(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of a token table, read from its lists.

    ``start`` is the number of ids before the document. Sums per file are laid end to end
    (one row per file), then rows are added up inside each file.
    """
    ship(tokens.sparkSession)
    rows = tokens.select("doc_id", "place", "file", "ids").mapInArrow(
        _checked, "doc_id bigint, place bigint, file string, n_tokens bigint, ids_crc32 bigint"
    )
    sizes = tokens.groupBy("file").agg(F.sum("n_tokens").alias("held"))
    every = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("file", F.coalesce(F.sum("held").over(every), F.lit(0)).alias("first"))
    inside = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("own", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(firsts, "file")
        .select("doc_id", (F.col("first") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")
    )


def encode_and_index(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents to token files in the shared folder, read them back and index them."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    write_tokens(docs, tokenizer, folder)
    return index_of(read_tokens(spark, folder))
