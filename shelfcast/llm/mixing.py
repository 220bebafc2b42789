"""Mixing sources to target weights by weighted fair queueing.

The documents of a source are shuffled by a hash and laid end to end, repeatedly; a copy's
virtual finish time is the number of its source's words up to its end, over the source's
target. Sorted by finish time over all sources, the mix keeps the target proportions at
every point, and reaches all targets, and so the total budget, at time 1, where it is cut. The
copy of each source that is under way then is served up to that word.

Sums run inside range partitions of narrow rows (a source that holds a third of all rows is
many partitions), and from partition to partition over a table of one row for each. Texts meet
their place in the mix in the last join; no window or running sum holds them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import SPACE, stored

WEIGHTS = (3, 1, 2)
BUDGET_PERCENT = 150
COPIES = 2  # a document is taken so often at most
PART_ROWS = 200_000  # narrow rows of a range partition whose sums run in one task
WORD_AND_BLANKS = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
SEED = "mix-1"


def size_of(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null: 0."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE))).cast("bigint")


def shuffle_key(id: Column) -> Column:
    return F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(id.cast("string"), F.lit(""))))


def targets(sources: DataFrame, weights=WEIGHTS, percent: int = BUDGET_PERCENT) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``: one row per source.

    Sources by code point, null last, have the weights in turn and share ``percent`` of all
    words. A target stops at ``COPIES`` times its source; what it leaves is shared out again
    by weight. That ends where every target is the lesser of its limit and one level times
    its weight, so the level is found directly: sources sorted by limit over weight, all
    those before some place are at their limit.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    choice = F.array(*map(F.lit, weights))
    rows = sources.withColumn(
        "weight", F.get(choice, F.pmod(nth, F.lit(len(weights)))).cast("double")
    ).withColumn("most", F.col("source_size") * float(COPIES))
    order = Window.orderBy(
        F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    zero = F.lit(0.0)
    rows = rows.withColumns(
        {
            "all": F.sum("source_size").over(whole) * (percent / 100.0),
            "full": F.coalesce(F.sum("most").over(before), zero),
            "open": F.sum("weight").over(after),
        }
    )
    # the level if just the sources before this one are at their limit
    rows = rows.withColumn("level", (F.col("all") - F.col("full")) / F.col("open"))
    # too few or too many sources at their limit lower that level: the right one is the highest
    rows = rows.withColumn("level", F.max("level").over(whole))
    return rows.select(
        "source",
        "source_size",
        F.least("most", F.col("level") * F.col("weight")).alias("target"),
    )


def running(rows: DataFrame, order: list, value: str, by: list[str]) -> DataFrame:
    """``rows`` with ``before``: the sum of ``value`` over the rows that ``order`` puts before
    a row, among those alike in ``by``, which ``order`` starts with.

    Rows are range-partitioned by ``order``, about ``PART_ROWS`` each, and summed within their
    partition; the partitions' own sums, one row for each and ``by``, are summed over all.
    """
    many = rows.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-many // PART_ROWS), min(cores, many // 1000))
    laid = stored(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    sums = laid.groupBy("part", *by).agg(F.sum(value).alias("held"))
    until = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    firsts = sums.select(
        F.col("part").alias("_part"),
        *[F.col(c).alias(f"_{c}") for c in by],
        F.coalesce(F.sum("held").over(until), zero).alias("_first"),
    )
    inside = Window.partitionBy("part", *by).orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    own = laid.withColumn("_inside", F.coalesce(F.sum(value).over(inside), zero))
    alike = F.col("part") == F.col("_part")
    for c in by:
        alike &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return (
        own.join(firsts, alike)
        .withColumn("before", F.col("_first") + F.col("_inside"))
        .drop("part", "_part", "_first", "_inside", *[f"_{c}" for c in by])
    )


def goals_of(sized: DataFrame) -> DataFrame:
    """``source, source_size, target`` of the sources of ``sized`` (``source, size``)."""
    return targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))


def mix(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """``row, copy, take, finish, source, doc_id``: the mix, a row for each copy in it.

    ``sized`` holds ``row, doc_id, source, size``. A copy is in if it begins before its source's
    target; ``take`` of its words are, all but for the copy that passes the target.
    """
    keyed = sized.withColumn("key", shuffle_key(F.col("doc_id")))
    last = F.col("source").asc_nulls_last()
    placed = running(keyed, [last, "key", "doc_id", "size", "row"], "size", ["source"])
    goals = goals.withColumnRenamed("source", "_source")
    due = F.floor("target").cast("bigint")
    begin = F.col("before") + F.col("copy") * F.col("source_size")
    copies = (
        placed.join(goals, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
        .withColumn("begin", begin)
        .filter(F.col("begin") < due)
        .withColumn("take", F.least(F.col("size"), due - F.col("begin")))
        .withColumn("finish", (F.col("begin") + F.col("take")) / F.col("target"))
        .select("row", "doc_id", "source", "copy", "take", "finish")
    )
    budget = goals.agg(F.coalesce(F.sum(due), F.lit(0))).first()[0]
    order = ["finish", last, "doc_id", "row", "copy"]
    served = running(copies, order, "take", []).filter(F.col("before") < budget)
    return served.withColumn("take", F.least(F.col("take"), budget - F.col("before"))).drop("before")


def _sized(rows: DataFrame, id, source, text) -> DataFrame:
    """The narrow rows that are scheduled, written down: ``row`` numbers may not change later."""
    return stored(
        rows.select(
            "row", id.alias("doc_id"), source.cast("string").alias("source"), size_of(text).alias("size")
        )
    )


def mix_sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every document.

    ``taken`` sums the copies that ``mix`` emits. One row per row that went in. The document at a
    source's target is cut there, so taken words meet the target to a word. Null texts have size
    0; null ids are shuffled like any other id; a null source is a source, the last. Rows that
    repeat an id are documents of their own. No words at all: targets are 0. Reruns agree: the
    order is a hash of the id. Other columns are ignored.
    """
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), *[F.col(c).alias(c) for c in ("doc_id", "source", "text")]
    )
    sized = _sized(numbered, F.col("doc_id"), F.col("source"), F.col("text"))
    goals = stored(goals_of(sized))
    taken = mix(sized, goals).groupBy("row").agg(F.sum("take").alias("taken"))
    goals = goals.withColumnRenamed("source", "_source")
    return (
        sized.join(goals, F.col("source").eqNullSafe(F.col("_source")))
        .join(taken, "row", "left")
        .select(
            "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
        )
    )


def first_words(text: Column, many: Column) -> Column:
    """A text up to the end of its ``many``-th word, blanks as they are."""
    each = F.regexp_extract_all(text, F.lit(WORD_AND_BLANKS), F.lit(0))
    return F.array_join(F.slice(each, 1, many.cast("int")), "")


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: the columns of ``docs``, by virtual finish time.

    The same copies as ``mix_sizes`` counts. Documents may come twice; a copy that its source's
    target cuts, one a source at most, has its text up to the last word taken, and its other
    columns as they were. Sorted over all sources by finish time; ties by source and id. Nulls,
    repeated ids and documents without words: as there; a document without words is in if it
    stands before the target. An empty table gives an empty mix. Other columns pass through,
    whatever their names.
    """
    columns = docs.columns
    whole = stored(
        docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*columns).alias("doc"))
    )
    sized = _sized(whole, F.col("doc.doc_id"), F.col("doc.source"), F.col("doc.text"))
    copies = stored(mix(sized, stored(goals_of(sized))).join(sized.select("row", "size"), "row"))
    text = F.when(
        F.col("take") < F.col("size"), first_words(F.col("doc.text"), F.col("take"))
    ).otherwise(F.col("doc.text"))
    return (
        copies.join(whole, "row")
        .orderBy("finish", F.col("source").asc_nulls_last(), "doc_id", "row", "copy")
        .select(*[text.alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in columns])
    )
