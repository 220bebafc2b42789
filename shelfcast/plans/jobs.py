"""The batch jobs, each reading what earlier jobs wrote.

Stages hand over through tables in one shared root folder, so a job that loses
executors recomputes only its own stage, and jobs can be rerun one by one.
"""

from __future__ import annotations

from contextlib import nullcontext
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from shelfcast import schema
from shelfcast.operators import (
    centers,
    clean,
    features,
    forest,
    gate,
    holidays,
    reports,
    rollup,
    seasonality,
    stats,
    treetables,
)
from shelfcast.operators.runlog import Entry, RunLog
from shelfcast.plans import months
from shelfcast.schema import TxColumns
from shelfcast.session import cut_lineage
from shelfcast.sources import tables, transactions


@dataclass(frozen=True)
class Stages:
    """Where stage tables live, and their format (``parquet`` or ``csv``)."""

    root: str
    fmt: str = "parquet"

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str, table) -> DataFrame:
        return tables.read_stage(spark, self.path(name), table, self.fmt)

    def write(self, df: DataFrame, name: str, sort_by=None, single_file=False) -> int:
        return tables.write_stage(df, self.path(name), self.fmt, sort_by, single_file)

    def logged(self, log: RunLog | None, stage: str):
        """An entry of the log, or one that is not kept."""
        return log.stage(stage) if log else nullcontext(Entry(stage))


def monthly_job(
    tx: DataFrame,
    stages: Stages,
    n: int | None = rollup.TOP_PRODUCTS,
    c: TxColumns = TxColumns(),
    log: RunLog | None = None,
) -> dict[str, int]:
    """Raw transactions to monthly sales of the best sellers.

    Lines read with ``keep_unreadable`` that do not fit their columns become the stage
    ``rejects`` and are counted there; the sales are those of all other lines. The raw file is
    read once: lines are routed to typed tables on both sides, and all else reads those.
    """
    with stages.logged(log, "monthly") as entry:
        counts = {}
        if transactions.UNREADABLE in tx.columns:
            tx, rejected, seen = transactions.routed(tx, stages.path("transactions_routed"))
            counts["rejects"] = stages.write(rejected, "rejects")
            entry.lines, entry.rejects = seen["lines"], seen["rejects"]
        else:
            tx = entry.reading(tx)
        totals = cut_lineage(rollup.monthly_totals(clean.clean_transactions(tx, c)))
        monthly = rollup.restrict_to_top(totals, n)
        keys = ["Description", "InvoiceMonth"]
        entry.rows_out = stages.write(monthly, "monthly_sales", keys)
        return counts | {"monthly_sales": entry.rows_out}


def features_job(
    spark: SparkSession, stages: Stages, holiday_table: DataFrame, log: RunLog | None = None
) -> dict[str, int]:
    """Monthly sales to features, with and without the stock decision.

    The labelled table is computed once and the plain one is a projection of what was
    written, so the windows do not run twice.
    """
    with stages.logged(log, "features") as entry:
        monthly = entry.reading(stages.read(spark, "monthly_sales", schema.MONTHLY_SALES))
        months = holidays.holiday_months(holidays.parse_calendar(holiday_table))
        labeled = features.label_stock_decision(features.build_features(monthly, months))
        counts = {
            "features_with_labels": stages.write(labeled, "features_with_labels"),
        }
        written = stages.read(spark, "features_with_labels", schema.FEATURES_LABELED)
        plain = written.select(*schema.FEATURES.names)
        entry.rows_out = counts["features"] = stages.write(plain, "features")
        return counts


def update_job(
    tx: DataFrame,
    stages: Stages,
    batch: str,
    holiday_table: DataFrame,
    n: int | None = rollup.TOP_PRODUCTS,
    c: TxColumns = TxColumns(),
) -> dict[str, int]:
    """A batch of raw lines into the tables kept by month, and from these the stages that
    ``monthly`` and ``features`` write from all lines."""
    spark, kept = tx.sparkSession, months.MonthTables(stages.path("by_month"))
    calendar = holidays.holiday_months(holidays.parse_calendar(holiday_table))
    months.update(tx, kept, batch, calendar, c)
    monthly = rollup.restrict_to_top(kept.totals(spark), n)
    counts = {
        "monthly_sales": stages.write(monthly, "monthly_sales", ["Description", "InvoiceMonth"]),
        "features_with_labels": stages.write(kept.features(spark, n), "features_with_labels"),
    }
    plain = _labeled(spark, stages).select(*schema.FEATURES.names)
    return counts | {"features": stages.write(plain, "features")}


def _features(spark: SparkSession, stages: Stages) -> DataFrame:
    return stages.read(spark, "features", schema.FEATURES)


def _labeled(spark: SparkSession, stages: Stages) -> DataFrame:
    return stages.read(spark, "features_with_labels", schema.FEATURES_LABELED)


def holiday_impact_job(spark: SparkSession, stages: Stages, holiday_table: DataFrame) -> None:
    impact = holidays.holiday_impact(
        _features(spark, stages), holidays.parse_calendar(holiday_table)
    )
    # One row per holiday name.
    order = [impact.avg_sales.desc(), impact.Name.asc()]
    stages.write(impact, "holiday_impact", order, single_file=True)


def holiday_products_job(
    tx: DataFrame, stages: Stages, holiday_table: DataFrame, c: TxColumns = TxColumns()
) -> dict[str, int]:
    """Best sellers of holiday months, from uncleaned lines."""
    months = holidays.holiday_months(holidays.parse_calendar(holiday_table))
    products = holidays.holiday_products(clean.with_sales(tx, c), months)
    order = [products.total_sales.desc(), products.Description.asc()]
    return {"top_holiday_products": stages.write(products, "top_holiday_products", order)}


def seasonality_job(spark: SparkSession, stages: Stages) -> dict[str, int]:
    table = _features(spark, stages)
    quarterly = seasonality.quarterly_summary(table)
    seasonal = seasonality.newyear_vs_christmas(table)
    return {
        "quarterly_summary": stages.write(
            quarterly, "quarterly_summary", ["Description", "Quarter"]
        ),
        "newyear_vs_christmas": stages.write(
            seasonal, "newyear_vs_christmas", ["Description", "Year", "Month"]
        ),
    }


def demand_job(
    spark: SparkSession, stages: Stages, grid: treetables.TreeGrid = treetables.TreeGrid()
) -> treetables.TableForest:
    """Forecast, metric document, and the model: its nodes and how the grid points scored."""
    result = treetables.demand_forecast(_features(spark, stages), grid=grid)
    stages.write(result.predictions, "predictions")
    written = stages.read(spark, "predictions", schema.PREDICTIONS)
    stored = replace(result, predictions=written)
    tables.write_metrics(forest.demand_metrics(stored), stages.path("model_metrics"))
    _write_model(stored, stages, "model")
    return stored


def stock_job(
    spark: SparkSession, stages: Stages, grid: treetables.TreeGrid = treetables.TreeGrid()
) -> treetables.TableForest:
    result = treetables.stock_forecast(_labeled(spark, stages), grid=grid)
    stages.write(result.predictions, "predictions_inventory")
    written = stages.read(spark, "predictions_inventory", schema.PREDICTIONS_INVENTORY)
    stored = replace(result, predictions=written)
    tables.write_metrics(forest.stock_metrics(stored), stages.path("model_metrics_inventory"))
    _write_model(stored, stages, "model_inventory")
    return stored


def _write_model(found: treetables.TableForest, stages: Stages, name: str) -> None:
    """Node tables hold arrays, so they are Parquet whatever the format of the stages."""
    tables.write_stage(found.nodes, stages.path(f"{name}_nodes"))
    tables.write_stage(found.tuning, stages.path(f"{name}_tuning"))


def clusters_job(spark: SparkSession, stages: Stages) -> dict[str, int]:
    found = centers.count_clusters(_labeled(spark, stages))
    assigned = found.assigned.select("Description", "NLP_Category")
    return {
        "description_clusters": stages.write(assigned, "description_clusters"),
        "description_centers": tables.write_stage(found.centers, stages.path("description_centers")),
    }


def correlation_job(spark: SparkSession, stages: Stages) -> None:
    matrix = stats.correlation_matrix(_labeled(spark, stages))
    tables.write_stage(matrix, stages.path("correlation_matrix"), "csv", ["col_a"], True)


# What each report is made from, and what its stage must be like.
REPORT_INPUTS = {
    "forecast_explorer": "predictions",
    "product_mae": "predictions",
    "top_holiday_products": "top_holiday_products",
    "quarterly_heatmap": "quarterly_summary",
    "month_labels": "newyear_vs_christmas",
    "holiday_impact": "holiday_impact",
    "inventory_matches": "predictions_inventory",
    "match_counts": "predictions_inventory",
    "class_by_match": "predictions_inventory",
}
REPORT_STAGES = {
    "predictions": (schema.PREDICTIONS, ("TotalPrice", "prediction")),
    "predictions_inventory": (schema.PREDICTIONS_INVENTORY, ("predicted_label",)),
    "quarterly_summary": (schema.QUARTERLY_SUMMARY, ("Quarter", "avg_quarter_sales")),
    "newyear_vs_christmas": (schema.NEWYEAR_VS_CHRISTMAS, ("avg_monthly_sales",)),
    "top_holiday_products": (schema.HOLIDAY_PRODUCTS, ("total_sales",)),
    "holiday_impact": (schema.HOLIDAY_IMPACT, ("Name", "avg_sales")),
}


def _loaded(spark: SparkSession, stages: Stages, name: str) -> DataFrame:
    table, _ = REPORT_STAGES[name]
    if stages.fmt == "csv":
        return tables.tidy_header(tables.read_tolerant(spark, stages.path(name), table))
    return tables.read_or_empty(spark, stages.path(name), table)


def report_gates(spark: SparkSession, stages: Stages) -> dict[str, gate.Outcome]:
    """Each stage that reports are made from, held to its rules in one pass.

    A stage must be there with rows and with its measures filled.
    """
    return {
        name: gate.check(
            _loaded(spark, stages, name),
            name,
            [*map(gate.column, table.names), *map(gate.filled, measures)],
        )
        for name, (table, measures) in REPORT_STAGES.items()
    }


def report_tables(
    spark: SparkSession,
    stages: Stages,
    products: list[str] | None = None,
    first: date | None = None,
    last: date | None = None,
) -> dict[str, DataFrame]:
    """The tables behind the dashboard; a stage that was not run gives an empty table.

    ``products`` restricts the forecast explorer and the January / December view,
    ``first`` and ``last`` the months of the explorer; None is no restriction.
    """

    def load(name: str) -> DataFrame:
        return _loaded(spark, stages, name)

    def chosen(df: DataFrame) -> DataFrame:
        return df if products is None else reports.for_products(df, products)

    predictions = load("predictions")
    decisions = load("predictions_inventory")
    quarterly = load("quarterly_summary")
    seasonal = load("newyear_vs_christmas")
    sold = load("top_holiday_products")
    impact = load("holiday_impact")
    return {
        "regression_metrics": tables.read_metrics(
            spark, stages.path("model_metrics"), schema.REGRESSION_METRICS
        ),
        "inventory_metrics": tables.read_metrics(
            spark, stages.path("model_metrics_inventory"), schema.CLASSIFICATION_METRICS
        ),
        "forecast_explorer": reports.forecast_explorer(predictions, products, first, last),
        "product_mae": reports.product_mae(predictions),
        "top_holiday_products": reports.top_holiday_products(sold),
        "quarterly_heatmap": reports.quarterly_heatmap(quarterly),
        "month_labels": reports.with_month_label(chosen(seasonal)),
        "holiday_impact": reports.ranked(
            reports.numeric_only(impact, "avg_sales"), "avg_sales", "Name"
        ),
        "inventory_matches": reports.with_match(decisions),
        "match_counts": reports.match_counts(decisions),
        "class_by_match": reports.class_by_match(decisions),
    }


def report_job(
    spark: SparkSession,
    stages: Stages,
    products: list[str] | None = None,
    first: date | None = None,
    last: date | None = None,
) -> dict[str, int]:
    """Write the report tables below ``report/``; returns their rows.

    A report whose stage does not pass its gate is skipped; ``report/gates`` says of every stage
    which rules hold and how many rows break the others. A choice of products and months that
    leaves nothing gives an empty report.
    """
    gates = report_gates(spark, stages)
    tables.write_stage(
        gate.outcome_table(spark, list(gates.values())), stages.path("report/gates"), stages.fmt
    )
    for name, source in REPORT_INPUTS.items():
        if not gates[source].passed:
            print(f"report {name} skipped: {source}: {gates[source].reason}")
    return {
        name: stages.write(df, f"report/{name}")
        for name, df in report_tables(spark, stages, products, first, last).items()
        if name in REPORT_INPUTS and gates[REPORT_INPUTS[name]].passed
    }
