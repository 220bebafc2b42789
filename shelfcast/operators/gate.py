"""Gates: what a table must be like before anything is made from it.

All rules of a table are evaluated in one pass, as one aggregation; the outcome is a table
of rules with the rows that break them, so a skipped step can say why.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.dates import to_month

OUTCOME = "stage string, rule string, n_broken bigint, passed boolean"


@dataclass(frozen=True)
class Rule:
    """``broken`` is true of the rows that break the rule; ``columns`` must be there to tell."""

    name: str
    columns: tuple[str, ...]
    broken: Column | None = None


def column(name: str) -> Rule:
    return Rule(f"has {name}", (name,))


def filled(name: str) -> Rule:
    """No null and no blank text."""
    value = F.trim(F.col(f"`{name}`").cast("string"))
    return Rule(f"{name} is filled", (name,), value.isNull() | (value == ""))


def numeric(name: str) -> Rule:
    """Every value that is there reads as a number."""
    value = F.col(f"`{name}`").cast("string")
    return Rule(f"{name} is a number", (name,), value.isNotNull() & value.try_cast("double").isNull())


def month(name: str) -> Rule:
    """Every value that is there reads as a month."""
    value = F.col(f"`{name}`").cast("string")
    return Rule(f"{name} is a month", (name,), value.isNotNull() & to_month(value).isNull())


def one_of(name: str, known: tuple[str, ...]) -> Rule:
    value = F.col(f"`{name}`").cast("string")
    return Rule(f"{name} is one of {', '.join(known)}", (name,), value.isNotNull() & ~value.isin(*known))


def of_type(name: str, kind: str) -> Rule:
    """The column has this type; every row breaks the rule if not."""
    return Rule(f"{name} is {kind}", (name,), F.typeof(F.col(f"`{name}`")) != kind)


@dataclass(frozen=True)
class Outcome:
    """What a gate found; ``passed`` if no rule is broken."""

    stage: str
    rows: list[tuple[str, str, int, bool]]

    @property
    def passed(self) -> bool:
        return all(row[3] for row in self.rows)

    @property
    def reason(self) -> str:
        """The broken rules, or nothing."""
        return "; ".join(f"{rule}: {n} broken" for _, rule, n, passed in self.rows if not passed)


def check(df: DataFrame, stage: str, rules: list[Rule], allow_empty: bool = False) -> Outcome:
    """Evaluate all rules in one pass over ``df``.

    A rule whose column is missing is broken once, whatever the rows; the others are broken by
    as many rows as break them. An empty table breaks the rule ``is not empty``, unless allowed.
    """
    there = set(df.columns)
    told = [r for r in rules if there.issuperset(r.columns) and r.broken is not None]
    counts = [F.count_if(rule.broken).alias(f"r{i}") for i, rule in enumerate(told)]
    seen = df.agg(F.count(F.lit(1)).alias("n"), *counts).first()
    broken = {rule.name: seen[f"r{i}"] for i, rule in enumerate(told)}
    rows = [] if allow_empty else [(stage, "is not empty", int(not seen["n"]), seen["n"] > 0)]
    for rule in rules:
        missing = not there.issuperset(rule.columns)
        n = 1 if missing else broken.get(rule.name, 0)
        rows.append((stage, rule.name, n, n == 0))
    return Outcome(stage, rows)


def outcome_table(spark: SparkSession, outcomes: list[Outcome]) -> DataFrame:
    """``stage, rule, n_broken, passed`` of several gates."""
    rows = [row for outcome in outcomes for row in outcome.rows]
    names = ["stage", "rule", "n_broken", "passed"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.bool_()]
    columns = {
        name: pa.array([row[i] for row in rows], kind)
        for i, (name, kind) in enumerate(zip(names, kinds, strict=True))
    }
    return spark.createDataFrame(pa.table(columns), OUTCOME)
