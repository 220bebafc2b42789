"""Quality rules: base counts, and divergence of a text's histograms from its language's.

Column expressions only, in one pass over the texts after the references are made. The
references count every document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import BLANKS, stored, words

WINDOW = 5  # words of a repeated window
LEAST_WORDS = 10
REPEATED_PERCENT = 20
COMMON = 24  # common words of a language
POOLED = "*"
BROADCAST_BYTES = 8 << 20  # references of up to this size are broadcast
SIFTED = 2_000  # common words up to which one look-up sorts out all others; for speed only
CLASS_GUARD = 200  # letters and marks below which the character histogram says nothing
WORD_GUARD = 100  # words below which the common-word histogram says nothing
CLASS_DISTANCE = 0.36
WORD_DISTANCE = 0.36
# fixed values: character classes, as patterns of all other characters. Blanks and symbols are
# counted anyway; what belongs to no class, small letters above all, is the last bin
CLASSES = {
    "upper": r"[^A-Z]+",
    "digit": r"[^0-9]+",
    "stop": r"[^.,;:!?'\"()-]+",
}
HELPERS = ("_words", "_lines", "_ref", "_lang", "_own")  # columns while a text is measured


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _left(text: Column, others: str) -> Column:
    return F.length(F.regexp_replace(text, others, ""))


def _without_blanks(content: Column) -> Column:
    return reduce(lambda text, blank: F.replace(text, F.lit(blank), F.lit("")), BLANKS, content)


def symbols(content: Column) -> Column:
    return _left(content, r"[^#*$%&|<>]+")


def _repeated_words(found: Column) -> Column:
    """Words in windows of ``WINDOW`` words that the text has twice or more."""

    def windows(w: Column) -> Column:
        return _let(
            F.transform(w, lambda x: F.xxhash64(x)),
            lambda codes: F.transform(
                F.sequence(F.lit(0), F.size(w) - WINDOW),
                lambda i: F.xxhash64(*(F.get(codes, i + k) for k in range(WINDOW))),
            ),
        )

    def covered(codes: Column) -> Column:
        placed = F.array_sort(
            F.transform(codes, lambda c, i: F.struct(c.alias("c"), i.alias("i")))
        )
        held = F.transform(F.array(placed), lambda p: F.filter(
            p,
            lambda x, i: (F.get(p, i - 1)["c"] == x["c"]) | (F.get(p, i + 1)["c"] == x["c"]),
        ))[0]
        starts = F.array_sort(F.transform(held, lambda x: x["i"]))
        return F.transform(
            F.array(starts),
            lambda s: F.aggregate(
                F.transform(
                    s,
                    lambda x, i: F.least(
                        F.lit(WINDOW), F.coalesce(F.get(s, i + 1) - x, F.lit(WINDOW))
                    ),
                ),
                F.lit(0),
                lambda a, b: a + b,
            ),
        )[0]

    short = F.size(found) <= WINDOW
    codes = F.when(~short, windows(found))
    return F.when(short, F.lit(0)).otherwise(
        F.transform(
            F.array(codes),
            lambda c: F.when(F.size(F.array_distinct(c)) == F.size(c), F.lit(0)).otherwise(
                covered(c)
            ),
        )[0]
    )


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_words`` and the base counts appended (null text: empty)."""
    content = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(content, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    step = docs.withColumn("_words", words(F.col(text))).withColumn("_lines", lines)
    return step.withColumns(
        {
            "n_words": F.size("_words").cast("bigint"),
            "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
            "n_symbols": symbols(content).cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "n_repeat_words": _repeated_words(F.col("_words")).cast("bigint"),
        }
    ).drop("_lines")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")
    )


def class_counts(text: Column, word_chars: Column, n_symbols: Column) -> Column:
    """Characters of each class, blanks, symbols, then all others."""
    content = F.coalesce(text, F.lit(""))
    size = F.length(content)
    known = [*(_left(content, others) for others in CLASSES.values()), size - word_chars, n_symbols]
    return _let(
        F.array(*known),
        lambda a: F.concat(a, F.array(size - F.aggregate(a, F.lit(0), lambda s, x: s + x))),
    )


def references(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """``lang, common, word_share, class_share`` over all documents, and a pooled row ``*``.

    A row for every language. ``common`` are a language's commonest words (ties by word);
    ``word_share`` their shares of its words, then the share of all others. The pooled row
    is for documents without a language.
    """
    base = docs.select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )
    counted = stored(
        base.select("lang", F.explode(words(F.col("text"))).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
    )
    content = F.coalesce("text", F.lit(""))
    classes = stored(
        base.select(
            "lang",
            F.posexplode(
                class_counts(content, F.length(_without_blanks(content)), symbols(content))
            ).alias("k", "n"),
        )
        .groupBy("lang", "k")
        .agg(F.sum("n").alias("n"))
    )

    def rows_of(word_counts: DataFrame, class_sums: DataFrame) -> DataFrame:
        by = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
        top = word_counts.withColumn("at", F.row_number().over(by)).filter(F.col("at") <= COMMON)
        top = top.groupBy("lang").agg(
            F.array_sort(F.collect_list(F.struct("at", "word", "n"))).alias("top")
        )
        totals = word_counts.groupBy("lang").agg(F.sum("n").alias("total"))
        marks = class_sums.groupBy("lang").agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("k", "n"))), lambda x: x["n"]
            ).alias("marks")
        )
        share = F.coalesce(
            F.transform("top", lambda x: x["n"] / F.col("total")), F.array().cast("array<double>")
        )
        rest = F.greatest(F.lit(0.0), 1 - F.aggregate(share, F.lit(0.0), lambda a, x: a + x))
        chars = F.aggregate("marks", F.lit(0).cast("bigint"), lambda a, x: a + x)
        joined = marks.join(top, "lang", "left").join(totals, "lang", "left")
        return joined.select(
            "lang",
            F.coalesce(
                F.transform("top", lambda x: x["word"]), F.array().cast("array<string>")
            ).alias("common"),
            F.concat(share, F.array(rest)).alias("word_share"),
            F.transform(
                "marks", lambda x: F.when(chars > 0, x / chars).otherwise(0.0)
            ).alias("class_share"),
        )

    named = "lang IS NOT NULL AND lang != '*'"
    pooled = F.lit(POOLED).alias("lang")
    none = docs.sparkSession.range(len(CLASSES) + 3).select(
        pooled, F.col("id").cast("int").alias("k"), F.lit(0).cast("bigint").alias("n")
    )
    all_marks = classes.select(pooled, "k", "n").unionByName(none)
    of_all = rows_of(
        counted.groupBy("word").agg(F.sum("n").alias("n")).select(pooled, "word", "n"),
        all_marks.groupBy("lang", "k").agg(F.sum("n").alias("n")),
    )
    return stored(rows_of(counted.filter(named), classes.filter(named)).unionByName(of_all))


def js_distance(counts: Column, share: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of a histogram and a distribution."""

    def distance(p: Column) -> Column:
        def part(a: Column, b: Column) -> Column:
            return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

        parts = F.zip_with(p, share, lambda a, b: part(a, b) + part(b, a))
        total = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
        return F.sqrt(F.greatest(F.lit(0.0), total / 2))

    def of(held: Column) -> Column:
        total = F.aggregate(held, F.lit(0).cast("bigint"), lambda s, x: s + x.cast("bigint"))
        return _let(
            total,
            lambda t: F.when(t > 0, distance(F.transform(held, lambda c: c / t))).otherwise(0.0),
        )

    return _let(counts, of)


def common_counts(found: Column, common: Column, any_common: list[str] | None) -> Column:
    """How often each common word stands in a text, then all other words.

    ``any_common`` holds the common words of all references, if they are few: one look-up
    then sorts out most words. Places in the list then become characters of one string, whose counts are
    string lengths.
    """
    if any_common is None:
        near = F.filter(found, lambda w: F.array_contains(common, w))
    else:
        near = F.filter(found, lambda w: w.isin(any_common)) if any_common else F.slice(found, 1, 0)
    coded = F.array_join(F.transform(near, lambda w: F.char(F.array_position(common, w) + 64)), "")

    def counts(s: Column) -> Column:
        own = F.transform(
            F.sequence(F.lit(65), F.size(common) + 64),
            lambda k: F.length(s) - F.length(F.replace(s, F.char(k), F.lit(""))),
        )
        own = F.when(F.size(common) > 0, own).otherwise(F.array().cast("array<int>"))
        return _let(
            own,
            lambda a: F.concat(
                a, F.array(F.size(found) - F.aggregate(a, F.lit(0), lambda t, x: t + x))
            ),
        )

    return _let(coded, counts)


def _names_away(columns: list[str]) -> dict[str, str]:
    """Other names, free among ``columns``, for those named like a helper."""
    held = {c.lower() for c in columns} | set(HELPERS)
    away = {}
    for c in columns:
        if c.lower() in HELPERS:
            new = c + "_"
            while new.lower() in held:
                new += "_"
            held.add(new.lower())
            away[c] = new
    return away


def judge(
    docs: DataFrame,
    refs: DataFrame | None = None,
    class_distance: float = CLASS_DISTANCE,
    word_distance: float = WORD_DISTANCE,
) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``class_js``, ``word_js`` and ``kept``.

    A document is kept unless it fails the base rules or its histograms lie farther from
    its language's than the two distances. Texts of under ``CLASS_GUARD`` marks or
    ``WORD_GUARD`` words are not held to the respective histogram: distance 0. Null, empty
    and blank texts fail the base rules. Every language has its own reference; a null one, or
    one that given ``refs`` lack, is held to the pooled reference. Rows that repeat are judged
    one by one, and texts whole, however long. Columns of ``docs`` named like an output are
    replaced; all others pass through, whatever their names. References are joined by language: broadcast if they are found to be
    of ``BROADCAST_BYTES`` at most, so that no text is shuffled.
    """
    outputs = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "class_js", "word_js", "kept",
    ]
    held = docs.drop(*outputs)
    away = _names_away(held.columns)
    held = held.withColumnsRenamed(away)
    refs = references(held) if refs is None else refs
    pooled = refs.filter(F.col("lang") == POOLED).first()  # one row
    own = refs.filter(F.col("lang") != POOLED).select(
        F.col("lang").alias("_lang"), F.struct("common", "word_share", "class_share").alias("_own")
    )
    size = F.octet_length(F.array_join("common", "")) + F.octet_length("lang")
    shares = 16 * (F.size("common") + F.size("class_share") + 1)
    if (refs.agg(F.sum(size + shares)).first()[0] or 0) <= BROADCAST_BYTES:
        own = F.broadcast(own)

    def literal(entry) -> Column:
        return F.struct(
            F.array(*map(F.lit, entry.common)).cast("array<string>").alias("common"),
            F.array(*map(F.lit, entry.word_share)).cast("array<double>").alias("word_share"),
            F.array(*map(F.lit, entry.class_share)).cast("array<double>").alias("class_share"),
        )

    joined = held.join(own, F.col("lang").cast("string") == F.col("_lang"), "left")
    counted = base_counts(joined).withColumn("_ref", F.coalesce("_own", literal(pooled)))
    marks = class_counts(
        F.col("text"), F.col("word_chars").cast("int"), F.col("n_symbols").cast("int")
    )
    sifted = refs.select(F.explode("common").alias("word")).distinct().limit(SIFTED + 1).collect()
    any_common = sorted(r.word for r in sifted) if len(sifted) <= SIFTED else None
    measured = counted.withColumns(
        {
            "base_failed": base_failed(),
            "class_js": F.when(
                F.length(F.coalesce("text", F.lit(""))) < CLASS_GUARD, F.lit(0.0)
            ).otherwise(js_distance(marks, F.col("_ref.class_share"))),
            "word_js": F.when(F.col("n_words") < WORD_GUARD, F.lit(0.0)).otherwise(
                js_distance(
                    common_counts(F.col("_words"), F.col("_ref.common"), any_common),
                    F.col("_ref.word_share"),
                )
            ),
        }
    )
    return measured.withColumn(
        "kept",
        ~F.col("base_failed")
        & (F.col("class_js") <= class_distance)
        & (F.col("word_js") <= word_distance),
    ).drop(*HELPERS).withColumnsRenamed({new: old for old, new in away.items()})


def keep_good(docs: DataFrame, refs: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with the columns of ``docs``.

    The verdict is exploded, not filtered on: a filter would be moved below the measures
    and bring a second copy of each of them.
    """
    judged = judge(docs.select(F.struct("*").alias("_row"), "text", "lang"), refs)
    kept = judged.select("_row", F.explode(F.when(F.col("kept"), F.array(F.lit(1)))))
    return kept.select("_row.*")
