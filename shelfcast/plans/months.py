"""Sales and features kept by month: new and late lines rewrite the months they touch.

Three tables, partitioned by month, below one root. ``sales_parts`` holds what each batch of
lines adds to a product's month, ``product_months`` the totals of all batches, and
``product_features`` the labelled features of every product. A batch is summed once; totals are
formed anew for its months only; features only of products whose totals changed, and written
only in months where a row differs. Reads of months are partition filters.

Each step overwrites whole month partitions and the totals are written last, so a run that was
cut off is repeated with the same batch and ends as if it had not been. A batch that is run
again with other lines replaces its former ones. One run at a time.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import schema
from shelfcast.functions.money import from_units, sum_units
from shelfcast.operators import clean, features, rollup
from shelfcast.schema import TxColumns
from shelfcast.session import cut_lineage
from shelfcast.sources.tables import read_or_empty

LOOK_BACK = 3  # months before the first changed one where earlier sales are looked for first
BEFORE = features.ROLLING_MONTHS - 1  # active months that a feature row looks back on
MONTH = "InvoiceMonth"
PARTS = T.StructType(
    [
        T.StructField("Description", T.StringType()),
        T.StructField("units", T.LongType()),
        T.StructField(MONTH, T.DateType()),
        T.StructField("batch", T.StringType()),
    ]
)


@dataclass(frozen=True)
class MonthTables:
    """The tables below ``root``. A month without any row holds one of nulls, left out here."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def parts(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self.path("sales_parts"), PARTS).filter("units IS NOT NULL")

    def totals(self, spark: SparkSession) -> DataFrame:
        table = read_or_empty(spark, self.path("product_months"), schema.MONTHLY_SALES)
        return table.filter("TotalPrice IS NOT NULL").select(*schema.MONTHLY_SALES.names)

    def features(self, spark: SparkSession, n: int | None = None) -> DataFrame:
        """Labelled features of the ``n`` best sellers, or of every product."""
        table = read_or_empty(spark, self.path("product_features"), schema.FEATURES_LABELED)
        table = table.filter("Description IS NOT NULL").select(*schema.FEATURES_LABELED.names)
        if n is None:
            return table
        best = rollup.top_products(rollup.product_revenue(self.totals(spark)), n)
        return table.join(best.select("Description"), "Description", "left_semi")


def _months(df: DataFrame) -> list[date]:
    """Distinct months: as many as the data has, not as it has rows."""
    return sorted(row[0] for row in df.select(MONTH).distinct().collect())


def _among(months: list[date]):
    return F.col(MONTH).isin(months) if months else F.lit(False)


def _write(df: DataFrame, path: str, months: list[date], *keys: str) -> None:
    """Overwrite the partitions of ``months``, one of nulls where ``df`` has no row.

    Ranges of month and product, so that no month is one task's.
    """
    values = {f.name: F.lit(None).cast(f.dataType) for f in df.schema}
    values[MONTH] = F.explode(F.array(*map(F.lit, months)))
    nulls = df.sparkSession.range(1).select(*[v.alias(c) for c, v in values.items()])
    lost = nulls.join(df.select(MONTH).distinct(), MONTH, "left_anti").select(*df.columns)
    for key, value in (k.split("=") for k in keys):
        df, lost = df.withColumn(key, F.lit(value)), lost.withColumn(key, F.lit(value))
    rows = df.unionByName(lost).repartitionByRange(MONTH, "Description")
    names = [MONTH, *(k.split("=")[0] for k in keys)]
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*names).parquet(path)


def _differing(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that only one of two tables holds."""
    old = old.select(*new.columns)
    return old.exceptAll(new).unionByName(new.exceptAll(old))


def _earlier(totals: DataFrame, changed: DataFrame, first: date) -> DataFrame:
    """The last ``BEFORE`` active months before ``first`` of each changed product.

    Looked for in the last ``LOOK_BACK`` months; what was not active there often enough, a new
    product above all, in all months before.
    """
    near = F.add_months(F.lit(first), -LOOK_BACK)
    recent = totals.filter((F.col(MONTH) >= near) & (F.col(MONTH) < F.lit(first)))
    recent = cut_lineage(recent.join(changed.select("Description"), "Description", "left_semi"))
    enough = recent.groupBy("Description").count().filter(F.col("count") >= BEFORE)
    short = changed.select("Description").join(enough, "Description", "left_anti")
    older = totals.filter(F.col(MONTH) < near).join(short, "Description", "left_semi")
    last = Window.partitionBy("Description").orderBy(F.desc(MONTH))
    found = recent.unionByName(older).withColumn("_nth", F.row_number().over(last))
    return found.filter(F.col("_nth") <= BEFORE).drop("_nth")


def update(
    tx: DataFrame,
    tables: MonthTables,
    batch: str,
    holiday_months: DataFrame,
    c: TxColumns = TxColumns(),
) -> dict[str, list[date]]:
    """Take a batch of raw lines in; gives the months written, by table.

    Lines may be of any month. Lines without a date are in no month; unnamed products have
    totals but no series. An empty batch changes nothing, unless it takes the place of a former
    one of its name. Names of batches become folder names: letters, digits, ``-`` and ``_``.
    With another holiday calendar, build the tables anew.
    """
    if not batch or not all(x.isalnum() or x in "-_" for x in batch):
        raise ValueError(f"not the name of a batch: {batch!r}")
    spark = tx.sparkSession
    dated = clean.clean_transactions(tx, c).filter(F.col(MONTH).isNotNull())
    sums = cut_lineage(
        dated.groupBy("Description", MONTH).agg(sum_units("TotalPrice").alias("units"))
    )
    months = sorted({*_months(sums), *_months(tables.parts(spark).filter(F.col("batch") == batch))})
    done = {"sales_parts": months, "product_months": [], "product_features": []}
    if not months:
        return done
    _write(sums, tables.path("sales_parts"), months, f"batch={batch}")

    held = tables.totals(spark)
    new = cut_lineage(
        tables.parts(spark)
        .filter(_among(months))
        .groupBy("Description", MONTH)
        .agg(from_units(F.sum("units")).alias("TotalPrice"))
    )
    differing = cut_lineage(_differing(held.filter(_among(months)), new))
    changed = cut_lineage(
        differing.filter("Description IS NOT NULL").select("Description").distinct()
    )
    done["product_months"] = _months(differing)
    if not done["product_months"]:
        return done

    first = done["product_months"][0]
    since = F.col(MONTH) >= F.lit(first)
    rest = held.filter(~_among(months))
    later = rest.filter(since).unionByName(new.filter(since))
    later = later.join(changed, "Description", "left_semi")
    before = held.filter(F.col(MONTH) < F.lit(first))
    series = later.unionByName(_earlier(before, changed, first))
    fresh = features.label_stock_decision(features.build_features(series, holiday_months))
    fresh = cut_lineage(fresh.filter(since).select(*schema.FEATURES_LABELED.names))
    old = tables.features(spark).filter(since)
    stale = old.join(changed, "Description", "left_semi")
    done["product_features"] = _months(_differing(stale, fresh))
    if done["product_features"]:
        other = old.join(changed, "Description", "left_anti").unionByName(fresh)
        other = cut_lineage(other.filter(_among(done["product_features"])))
        _write(other, tables.path("product_features"), done["product_features"])

    written = new.filter(_among(done["product_months"]))
    _write(written, tables.path("product_months"), done["product_months"])
    return done
