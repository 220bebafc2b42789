"""URL filters: stated host and path rules, and association rules mined by FP-growth.

Everything is DataFrame work and MLlib's FP-growth; no Python runs on the executors. A URL's
verdict depends on the URL alone, so each distinct URL is judged once and a URL that fills
a third of the table costs no more than any other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LABEL = "=block"  # the item that marks a blocked URL; no token begins with "="


@dataclass(frozen=True)
class UrlRule:
    """``verdict`` for a host, its subdomains, and paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# fixed values: the stated rules
STATED = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def stated_rule(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """``struct(rule, verdict)`` of the longest stated rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        own = (host == rule.host) | host.endswith("." + rule.host)
        found = F.when(
            own & path.startswith(rule.path),
            F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict")),
        ).otherwise(found)
    return found


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: scheme, host labels and domain, path segments, query keys, fragment.

    Each carries the part it comes from, so that a path segment ``en`` and a host label
    ``en`` differ. Null URLs have none.
    """

    def part(name: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(name), v))

    low = F.translate(url, UPPER, LOWER)
    scheme = F.array(F.regexp_extract(low, r"(?s)^(.*?)://", 1))
    query = F.split(F.regexp_extract(low, r"(?s)\?([^#]*)", 1), "&")
    keys = F.transform(query, lambda q: F.substring_index(q, "=", 1))
    fragment = F.array(F.regexp_extract(low, r"(?s)#(.*)$", 1))
    all_ = F.concat(
        part("scheme:", scheme),
        part("host:", F.split(host, r"\.")),
        part("domain:", F.array(F.substring_index(host, ".", -2))),
        part("path:", F.split(F.translate(path, UPPER, LOWER), "/")),
        part("key:", keys),
        part("fragment:", fragment),
    )
    return F.when(url.isNull(), F.array().cast("array<string>")).otherwise(F.array_distinct(all_))


def mine(
    labelled: DataFrame,
    min_support: float = 0.005,
    min_confidence: float = 0.8,
    max_length: int = 3,
) -> DataFrame:
    """Rules ``tokens -> block`` from rows ``tokens array<string>, blocked boolean``.

    Columns ``antecedent, confidence, support, rare`` (the antecedent's least supported
    token, its place in the inverted index). Rules are pruned by support and confidence,
    by length, and when a shorter part of the antecedent is at least as confident. No
    labelled row gives no rule. Rows with a null label are passed over.
    """
    rows = stored(
        labelled.filter("blocked IS NOT NULL AND tokens IS NOT NULL").select(
            F.when(F.col("blocked"), F.array_append("tokens", F.lit(LABEL)))
            .otherwise(F.col("tokens"))
            .alias("items")
        )
    )
    total = rows.count()
    spark = labelled.sparkSession
    if not total:
        return spark.createDataFrame(
            [], "antecedent array<string>, confidence double, support double, rare string"
        )
    # tokens below the support cannot be in a rule; most URLs then hold few items
    heard = (
        rows.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n"))
    ).filter(F.col("n") >= min_support * total)
    frequent = stored(heard)
    fitted = FPGrowth(
        itemsCol="items", minSupport=min_support, minConfidence=min_confidence
    ).fit(rows)
    sets = stored(
        fitted.freqItemsets.filter(F.size("items") <= max_length + 1).select(
            F.array_sort("items").alias("items"), F.col("freq").alias("freq")
        )
    )
    with_label = sets.filter(F.array_contains("items", LABEL) & (F.size("items") > 1)).select(
        F.array_remove("items", LABEL).alias("antecedent"), F.col("freq").alias("hits")
    )
    rules = with_label.join(
        sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("seen")), "antecedent"
    ).select(
        "antecedent",
        (F.col("hits") / F.col("seen")).alias("confidence"),
        (F.col("hits") / F.lit(total)).alias("support"),
    )
    rules = stored(rules.filter(F.col("confidence") >= min_confidence))
    # a rule is spare if one without one of its tokens is as confident
    parts = rules.filter(F.size("antecedent") > 1).select(
        F.col("antecedent").alias("whole"),
        F.col("confidence").alias("own"),
        F.explode("antecedent").alias("token"),
    ).select("whole", "own", F.array_remove("whole", F.col("token")).alias("antecedent"))
    spare = (
        parts.join(rules, "antecedent")
        .filter(F.col("confidence") >= F.col("own"))
        .select(F.col("whole").alias("antecedent"))
        .distinct()
    )
    kept = rules.join(spare, "antecedent", "left_anti")
    placed = kept.select("*", F.explode("antecedent").alias("item")).join(frequent, "item")
    return stored(
        placed.groupBy("antecedent", "confidence", "support")
        .agg(F.min(F.struct("n", "item")).alias("least"))
        .select("antecedent", "confidence", "support", F.col("least.item").alias("rare"))
    )


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The most confident rule of every row of ``url, tokens`` that one fits.

    Inverted index: a rule is filed under its rarest token only, so a token that all URLs
    share draws no rows; the rest of the antecedent is tested on the row itself.
    """
    posted = urls.select("url", "tokens", F.explode("tokens").alias("rare"))
    fits = posted.join(rules, "rare").filter(
        F.size(F.array_intersect("tokens", "antecedent")) == F.size("antecedent")
    )
    best = F.max(F.struct("confidence", "support", F.array_join("antecedent", " ").alias("name")))
    return fits.groupBy("url").agg(best.alias("best")).select(
        "url", F.col("best.name").alias("mined"), F.col("best.confidence").alias("confidence")
    )


def filter_urls(
    pages: DataFrame,
    labels: DataFrame | None = None,
    stated: tuple[UrlRule, ...] = STATED,
    min_support: float = 0.005,
    min_confidence: float = 0.8,
    max_length: int = 3,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined, confidence`` for every page.

    ``labels`` (``url, blocked``) is what FP-growth learns from. Left out, every distinct URL
    of the pages is learnt from: those that a stated rule blocks as blocked, all others as
    not blocked, uncovered ones too, so that a token of many unblocked pages has no
    confidence. A page that neither a stated nor a mined rule fits is allowed.

    One row per row that went in, repeated rows included. A null URL, or one without
    ``://``, has empty host and path and no stated rule. Other columns are ignored.
    """
    distinct = pages.select(F.col("url").alias("url")).filter("url IS NOT NULL").distinct()
    # two steps: the host and path are read many times below
    parsed = stored(
        distinct.select(
            "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
        )
    )
    judged = parsed.select(
        "*",
        stated_rule(F.col("host"), F.col("path"), stated).alias("stated"),
        tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"),
    )
    if labels is None:
        blocked = F.coalesce(F.col("stated.verdict") == "block", F.lit(False))
        known = judged.select("tokens", blocked.alias("blocked"))
    else:
        labelled = labels.select(F.col("url").alias("own"), "blocked").filter("own IS NOT NULL")
        known = labelled.select(
            tokens(F.col("own"), host_of(F.col("own")), path_of(F.col("own"))).alias("tokens"),
            "blocked",
        )
    rules = mine(known, min_support, min_confidence, max_length)
    fits = match(judged.filter("stated IS NULL").select("url", "tokens"), rules)
    verdicts = judged.join(fits, "url", "left").select(
        "url",
        "host",
        "path",
        F.col("stated.rule").alias("rule"),
        F.coalesce(
            F.col("stated.verdict"),
            F.when(F.col("mined").isNotNull(), "block").otherwise("allow"),
        ).alias("verdict"),
        "mined",
        "confidence",
    )
    return pages.select("page_id", F.col("url").alias("url")).join(verdicts, "url", "left").select(
        "page_id",
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
        "mined",
        "confidence",
    )
