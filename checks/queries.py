"""One registered query per operator, over the star-schema test tables.

Every query builds its input from the whole tables. Dates leave as ISO text so that
two engines compare the same bytes.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import schema
from shelfcast.operators import (
    audit,
    centers,
    clean,
    clusters,
    encode,
    features,
    forest,
    gate,
    holidays,
    metrics,
    reports,
    rollup,
    seasonality,
    split,
    stats,
    text,
    treetables,
)
from shelfcast.operators.runlog import RunLog
from shelfcast.plans import jobs
from shelfcast.plans.months import MonthTables, update
from shelfcast.session import cut_lineage, scratch_path
from shelfcast.sources import tables
from shelfcast.sources.holidays import read_holidays, uk_bank_holidays
from shelfcast.sources.star import star_transactions
from shelfcast.sources.transactions import read_transactions, readable, rejects

Query = Callable[[SparkSession, str], DataFrame]

TOP_CUT = 100  # below the number of products in the test tables, so the cut does work
EXPLORED = (date(2010, 3, 1), date(2013, 6, 1))  # a part of the months the tables cover
SPOILT_EVERY = 7  # lines of the spoilt file whose order number this divides
CHOSEN_PRODUCTS = ["ECONOMY blue rod", "LARGE red gear", "PROMO red anvil", "SMALL hot plate"]


def _iso(df: DataFrame) -> DataFrame:
    dates = [f.name for f in df.schema if isinstance(f.dataType, T.DateType)]
    return df.withColumns({name: F.date_format(name, "yyyy-MM-dd") for name in dates})


# -- shared inputs -------------------------------------------------------------------


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean_transactions(star_transactions(spark, folder))


def _uncleaned(spark: SparkSession, folder: str) -> DataFrame:
    return clean.with_sales(star_transactions(spark, folder))


def _calendar(spark: SparkSession) -> DataFrame:
    return holidays.parse_calendar(uk_bank_holidays(spark))


def _months(spark: SparkSession) -> DataFrame:
    return holidays.holiday_months(_calendar(spark))


def _features(spark: SparkSession, folder: str, staged: bool = False) -> DataFrame:
    """Features; ``staged`` for queries that filter products, so that lines are scanned once."""
    totals = rollup.monthly_totals(_clean(spark, folder))
    monthly = rollup.restrict_to_top(cut_lineage(totals) if staged else totals)
    return features.build_features(monthly, _months(spark))


def _labeled(spark: SparkSession, folder: str, staged: bool = False) -> DataFrame:
    return features.label_stock_decision(_features(spark, folder, staged))


def _quarterly(spark: SparkSession, folder: str, staged: bool = False) -> DataFrame:
    return seasonality.quarterly_summary(_features(spark, folder, staged))


def _baseline(spark: SparkSession, folder: str, staged: bool = False) -> DataFrame:
    """Predictions that need no training: last month again, and the decision it implies."""
    last = F.col("prev_month_sales")
    mean = F.col("rolling_3m_avg")
    return _labeled(spark, folder, staged).select(
        "Description",
        "InvoiceMonth",
        "TotalPrice",
        last.alias("prediction"),
        "stock_decision",
        F.when(last > mean * features.INCREASE_ABOVE, "Increase")
        .when(last < mean * features.REDUCE_BELOW, "Reduce")
        .otherwise("Maintain")
        .alias("predicted_label"),
    )


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return text.descriptions(_labeled(spark, folder, staged=True))


# -- transactions --------------------------------------------------------------------


def clean_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _iso(_clean(spark, folder))


def transactions_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Write the raw lines as quoted CSV, scan them back with a schema, clean them."""
    path = scratch_path(spark, "transactions")
    raw = star_transactions(spark, folder)
    tables.write_stage(raw, path, "csv")
    layout = T.StructType([f for name in raw.columns for f in schema.TRANSACTIONS if f.name == name])
    return _iso(clean.clean_transactions(read_transactions(spark, path, layout)))


def _spoilt_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The raw lines as CSV with one field of some lines unreadable, scanned with care."""
    path = scratch_path(spark, "spoilt")
    raw = star_transactions(spark, folder)
    number = F.regexp_replace("Invoice", "^C", "").cast("bigint")
    turn = F.pmod(number, F.lit(3 * SPOILT_EVERY))

    def spoilt(name: str, at: int, value: str):
        return F.when(turn == at, value).otherwise(F.col(name).cast("string"))

    dirty = raw.withColumns(
        {
            "Quantity": spoilt("Quantity", 0, "many"),
            "InvoiceDate": spoilt("InvoiceDate", SPOILT_EVERY, "12/1/2009 7:45"),
            "Price": spoilt("Price", 2 * SPOILT_EVERY, "free"),
        }
    )
    tables.write_stage(dirty, path, "csv")
    layout = T.StructType([f for name in raw.columns for f in schema.TRANSACTIONS if f.name == name])
    return read_transactions(spark, path, layout, keep_unreadable=True)


def transactions_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a spoilt file that do not fit their types, by kind of line."""
    rejected = rejects(_spoilt_scan(spark, folder))
    cancelled = F.col("Invoice").startswith("C").alias("cancelled")
    return rejected.groupBy(cancelled).agg(F.count("*").alias("n_lines"))


def transactions_spoilt(spark: SparkSession, folder: str) -> DataFrame:
    """Clean sales of the readable lines of a spoilt file."""
    return _iso(clean.clean_transactions(readable(_spoilt_scan(spark, folder))))


def product_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.product_revenue(_clean(spark, folder))


def top_products(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.top_products(product_revenue(spark, folder), TOP_CUT)


def monthly_totals(spark: SparkSession, folder: str) -> DataFrame:
    return _iso(rollup.monthly_totals(_clean(spark, folder)))


def monthly_sales(spark: SparkSession, folder: str) -> DataFrame:
    return _iso(rollup.monthly_sales(_clean(spark, folder)))


def monthly_sales_all(spark: SparkSession, folder: str) -> DataFrame:
    return _iso(rollup.monthly_sales(_clean(spark, folder), n=None))


def monthly_sales_top(spark: SparkSession, folder: str) -> DataFrame:
    return _iso(rollup.monthly_sales(_clean(spark, folder), TOP_CUT))


# -- holidays ------------------------------------------------------------------------


def _lines_per_month(spark: SparkSession, folder: str) -> DataFrame:
    lines = _uncleaned(spark, folder).groupBy("InvoiceMonth")
    return lines.agg(F.count(F.lit(1)).alias("n_lines")).withColumnRenamed(
        "InvoiceMonth", "holiday_month_start"
    )


def holiday_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Parsed holidays with the number of transaction lines in their month."""
    lines = _lines_per_month(spark, folder)
    return _iso(
        _calendar(spark)
        .join(lines, "holiday_month_start", "left")
        .select(
            "Name",
            "DateParsed",
            "holiday_month",
            F.coalesce("n_lines", F.lit(0).cast("bigint")).alias("n_lines"),
        )
    )


def holiday_months(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct holiday months with the transaction lines that fall into them."""
    lines = holidays.in_holiday_months(_uncleaned(spark, folder), _months(spark))
    per_month = lines.groupBy(F.col("InvoiceMonth").alias("holiday_month_start")).agg(
        F.count(F.lit(1)).alias("n_lines")
    )
    return (
        _months(spark)
        .join(per_month, "holiday_month_start", "left")
        .select(
            "holiday_month",
            F.coalesce("n_lines", F.lit(0).cast("bigint")).alias("n_lines"),
        )
    )


def holiday_fanout(spark: SparkSession, folder: str) -> DataFrame:
    rows = holidays.holiday_rows(_features(spark, folder), _calendar(spark))
    return rows.select("Description", "month_key", "TotalPrice", "Name")


def holiday_impact(spark: SparkSession, folder: str) -> DataFrame:
    impact = holidays.holiday_impact(_features(spark, folder), _calendar(spark))
    return reports.ranked(impact, "avg_sales", "Name")


def _holiday_products(spark: SparkSession, folder: str) -> DataFrame:
    return holidays.holiday_products(_uncleaned(spark, folder), _months(spark))


def holiday_products(spark: SparkSession, folder: str) -> DataFrame:
    return reports.ranked(_holiday_products(spark, folder), "total_sales", "Description")


def holiday_products_top_n(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_holiday_products(_holiday_products(spark, folder))


def calendar_file(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar written as CSV and scanned back, with the lines of each holiday's month."""
    path = scratch_path(spark, "holidays")
    tables.write_stage(uk_bank_holidays(spark), path, "csv")
    calendar = holidays.parse_calendar(read_holidays(spark, path))
    lines = _lines_per_month(spark, folder)
    return _iso(calendar.join(lines, "holiday_month_start").select("Name", "DateParsed", "n_lines"))


# -- features ------------------------------------------------------------------------


def features_plain(spark: SparkSession, folder: str) -> DataFrame:
    return _iso(_features(spark, folder))


def features_labeled(spark: SparkSession, folder: str) -> DataFrame:
    return _iso(_labeled(spark, folder))


def feature_correlation(spark: SparkSession, folder: str) -> DataFrame:
    return stats.feature_correlation(_labeled(spark, folder), places=6)


def correlation_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return stats.correlation_matrix(_labeled(spark, folder))


# -- seasons -------------------------------------------------------------------------


def quarterly_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _quarterly(spark, folder).orderBy("Description", "Quarter")


def _seasonal(spark: SparkSession, folder: str) -> DataFrame:
    return seasonality.newyear_vs_christmas(_features(spark, folder))


def newyear_vs_christmas(spark: SparkSession, folder: str) -> DataFrame:
    return _seasonal(spark, folder).orderBy("Description", "Year", "Month")


def month_labels(spark: SparkSession, folder: str) -> DataFrame:
    return reports.with_month_label(_seasonal(spark, folder))


def quarterly_scores(spark: SparkSession, folder: str) -> DataFrame:
    return reports.quarterly_scores(_quarterly(spark, folder))


def heatmap_rows(spark: SparkSession, folder: str) -> DataFrame:
    return reports.heatmap_rows(_quarterly(spark, folder))


def quarterly_heatmap(spark: SparkSession, folder: str) -> DataFrame:
    return reports.quarterly_heatmap(_quarterly(spark, folder))


def quarter_by_product(spark: SparkSession, folder: str) -> DataFrame:
    return reports.quarter_by_product(_quarterly(spark, folder, staged=True), CHOSEN_PRODUCTS)


# -- splits, indexes, vectors --------------------------------------------------------


def split_regression(spark: SparkSession, folder: str) -> DataFrame:
    parts = split.split_by_key(_features(spark, folder), split.REGRESSION_PARTS)
    return _iso(parts.select("Description", "InvoiceMonth", "split"))


def split_inventory(spark: SparkSession, folder: str) -> DataFrame:
    parts = split.split_by_key(_labeled(spark, folder), split.INVENTORY_PARTS)
    return _iso(parts.select("Description", "InvoiceMonth", "split"))


def product_index(spark: SparkSession, folder: str) -> DataFrame:
    return encode.product_index(_features(spark, folder))


def label_index(spark: SparkSession, folder: str) -> DataFrame:
    return encode.label_index(_labeled(spark, folder))


def _vector_columns(spark: SparkSession, folder: str, inputs: list[str]) -> DataFrame:
    vectors, *_ = forest.model_inputs(cut_lineage(_labeled(spark, folder)), inputs)
    array = vector_to_array("features")
    return _iso(
        vectors.select(
            "Description",
            "InvoiceMonth",
            *[array[i].alias(f"f{i}") for i in range(len(inputs))],
        )
    )


def regression_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return _vector_columns(spark, folder, encode.REGRESSION_INPUTS)


def inventory_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return _vector_columns(spark, folder, encode.INVENTORY_INPUTS)


# -- quality and reports over baseline predictions -----------------------------------


def metrics_regression(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.regression_metrics(_baseline(spark, folder))


def metrics_classification(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.classification_metrics(_baseline(spark, folder))


def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion(_baseline(spark, folder))


def product_mae(spark: SparkSession, folder: str) -> DataFrame:
    errors = reports.product_mae(_baseline(spark, folder))
    return errors.withColumn("mae", F.round("mae", 4))


def inventory_matches(spark: SparkSession, folder: str) -> DataFrame:
    rows = reports.with_match(_baseline(spark, folder))
    return _iso(
        rows.select("Description", "InvoiceMonth", "stock_decision", "predicted_label", "match")
    )


def match_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.match_counts(_baseline(spark, folder))


def class_by_match(spark: SparkSession, folder: str) -> DataFrame:
    return reports.class_by_match(_baseline(spark, folder))


def forecast_explorer(spark: SparkSession, folder: str) -> DataFrame:
    """Chosen products in a part of the months the predictions cover."""
    return _iso(
        reports.forecast_explorer(
            _baseline(spark, folder, staged=True), CHOSEN_PRODUCTS, *EXPLORED
        )
    )


def single_product(spark: SparkSession, folder: str) -> DataFrame:
    return _iso(reports.for_product(_baseline(spark, folder, staged=True), CHOSEN_PRODUCTS[0]))


def product_list(spark: SparkSession, folder: str) -> DataFrame:
    return reports.product_list(_baseline(spark, folder))


def product_count(spark: SparkSession, folder: str) -> DataFrame:
    return reports.product_count(_baseline(spark, folder))


def month_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return _iso(reports.month_bounds(_baseline(spark, folder)))


def preview_features(spark: SparkSession, folder: str) -> DataFrame:
    return _iso(reports.preview(_features(spark, folder), ["Description", "InvoiceMonth"]))


# -- text ----------------------------------------------------------------------------


def description_tokens(spark: SparkSession, folder: str) -> DataFrame:
    docs = text.tokens(_documents(spark, folder))
    return docs.select("Description", "n_rows", F.posexplode("filtered").alias("position", "token"))


def description_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return text.vocabulary(text.tokens(_documents(spark, folder)), "filtered")


def description_term_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Term-count vectors in long form."""
    docs = cut_lineage(text.tokens(_documents(spark, folder)))
    vocab = [row.term for row in text.vocabulary(docs, "filtered").collect()]
    vectors = text.count_vectors(docs, vocab, "filtered", "features")
    return (
        vectors.select(
            "Description", F.posexplode(vector_to_array("features")).alias("term_index", "n")
        )
        .filter(F.col("n") > 0)
        .select(
            "Description",
            F.element_at(F.lit(vocab), F.col("term_index") + 1).alias("term"),
            "term_index",
            F.col("n").cast("bigint").alias("n"),
        )
    )


def tfidf_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    vocab = text.phrase_vocabulary(cut_lineage(text.phrases(_documents(spark, folder))))
    return vocab.withColumn("idf", F.round("idf", 6))


def tfidf_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Unit-length phrase vectors in long form."""
    docs = cut_lineage(text.phrases(_documents(spark, folder)))
    vocab = [(row.term, row.idf) for row in text.phrase_vocabulary(docs).collect()]
    vectors = text.tfidf_vectors(docs, vocab, "features")
    return (
        vectors.select(
            "Description", F.posexplode(vector_to_array("features")).alias("_i", "weight")
        )
        .filter(F.col("weight") > 0)
        .select(
            "Description",
            F.element_at(F.lit([term for term, _ in vocab]), F.col("_i") + 1).alias("term"),
            F.round("weight", 6).alias("weight"),
        )
    )


def description_clusters(spark: SparkSession, folder: str) -> DataFrame:
    found = centers.count_clusters(cut_lineage(_labeled(spark, folder)))
    return found.assigned.select("Description", "NLP_Category")


def description_centers(spark: SparkSession, folder: str) -> DataFrame:
    """The centres: weighted sums of their points, and their weights."""
    return centers.count_clusters(cut_lineage(_labeled(spark, folder))).centers


def _phrase_clusters(spark: SparkSession, folder: str) -> centers.TableClusters:
    return centers.tfidf_clusters(cut_lineage(_labeled(spark, folder)))


def tfidf_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return _phrase_clusters(spark, folder).assigned.select("Description", "NLP_Category")


def cluster_cost(spark: SparkSession, folder: str) -> DataFrame:
    """Names and cost of each cluster of the phrases."""
    found = _phrase_clusters(spark, folder).assigned.groupBy("NLP_Category")
    return found.agg(F.count("*").alias("n_names"), F.round(F.sum("cost"), 4).alias("cost"))


def cluster_terms(spark: SparkSession, folder: str) -> DataFrame:
    return centers.cluster_terms(_phrase_clusters(spark, folder))


# -- trained models ------------------------------------------------------------------


def _demand(spark: SparkSession, folder: str) -> treetables.TableForest:
    return treetables.demand_forecast(cut_lineage(_features(spark, folder)))


def _stock(spark: SparkSession, folder: str) -> treetables.TableForest:
    return treetables.stock_forecast(cut_lineage(_labeled(spark, folder)))


def demand_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return _iso(_demand(spark, folder).predictions)


def demand_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Scores and chosen parameters of a fresh fit."""
    return forest.demand_metrics(_demand(spark, folder)).select("RMSE", "MAE", "Best Hyperparameters.*")


def stock_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return _iso(_stock(spark, folder).predictions)


def stock_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return forest.stock_metrics(_stock(spark, folder))


def _tuning(found: treetables.TableForest) -> DataFrame:
    return found.tuning.withColumn("score", F.round("score", 4))


def demand_tuning(spark: SparkSession, folder: str) -> DataFrame:
    """Hold-out score of each grid point, and which one is best."""
    return _tuning(_demand(spark, folder))


def stock_tuning(spark: SparkSession, folder: str) -> DataFrame:
    return _tuning(_stock(spark, folder))


def _trees(found: treetables.TableForest) -> DataFrame:
    columns = ["tree", "node", "feature", "threshold", "n_rows"]
    label = F.element_at("sums", 1).alias("label_sum")
    return found.nodes.filter(F.col("view") == treetables.FINAL).select(*columns, label)


def demand_trees(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes of all trees of the final forest."""
    return _trees(_demand(spark, folder))


def stock_trees(spark: SparkSession, folder: str) -> DataFrame:
    """The same; the label sum is that of the most frequent decision."""
    return _trees(_stock(spark, folder))


# -- what any fit must satisfy -------------------------------------------------------
# For the forests and clusters of MLlib, which SQL cannot fit: which rows a fit must score, and
# that every property computed from the fit must hold.


def demand_forecast_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Scored test rows, and whether the prediction lies among the training sales.

    A forest averages training labels, so no prediction can leave their range.
    """
    table = cut_lineage(_features(spark, folder))
    train = split.split_by_key(table, split.REGRESSION_PARTS).filter("split = 'train'")
    low, high = train.agg(F.min("TotalPrice"), F.max("TotalPrice")).first()
    slack = 1e-9 * (abs(low) + abs(high))
    rows = forest.demand_forecast(table).predictions
    return _iso(
        rows.select(
            "Description",
            "InvoiceMonth",
            "TotalPrice",
            F.col("prediction").between(low - slack, high + slack).alias("in_range"),
        )
    )


def stock_forecast_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Scored test rows, and whether the predicted decision is one of those in the table."""
    table = cut_lineage(_labeled(spark, folder))
    known = [r.stock_decision for r in table.select("stock_decision").distinct().collect()]
    rows = forest.stock_forecast(table).predictions
    return _iso(
        rows.select(
            "Description",
            "InvoiceMonth",
            "stock_decision",
            F.coalesce(F.col("predicted_label").isin(known), F.lit(False)).alias("is_known"),
        )
    )


def demand_metrics_agree(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of a fit next to the same scores worked out from its stored predictions."""
    found = forest.demand_forecast(cut_lineage(_features(spark, folder)))
    found = forest.Forecast(cut_lineage(found.predictions), found.model)
    said, best = forest.demand_metrics(found).first(), found.best_parameters
    error = F.col("TotalPrice") - F.col("prediction")
    in_grid = best["numTrees"] in forest.TREES and best["maxDepth"] in forest.DEPTHS
    return found.predictions.agg(
        F.count("*").alias("n_rows"),
        (F.abs(F.sqrt(F.avg(error * error)) - said.RMSE) <= 0.0051).alias("rmse_agrees"),
        (F.abs(F.avg(F.abs(error)) - said.MAE) <= 0.0051).alias("mae_agrees"),
        F.lit(in_grid).alias("in_grid"),
    )


def stock_metrics_agree(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy of a fit next to the share of right decisions among its stored predictions."""
    found = forest.stock_forecast(cut_lineage(_labeled(spark, folder)))
    found = forest.Forecast(cut_lineage(found.predictions), found.model)
    said = forest.stock_metrics(found).first()
    right = F.avg((F.col("stock_decision") == F.col("predicted_label")).cast("double"))
    return found.predictions.agg(
        F.count("*").alias("n_rows"),
        (F.abs(right - said.accuracy) <= 0.000051).alias("accuracy_agrees"),
        F.lit(said.weightedRecall == said.accuracy).alias("recall_agrees"),
    )


def _nearest(found: clusters.DescriptionClusters, vectors: DataFrame) -> DataFrame:
    """``Description``, ``is_nearest``: no centre is nearer than that of the assigned cluster."""
    centers = F.array(
        *[F.array(*map(F.lit, map(float, c))) for c in found.model.clusterCenters()]
    )  # as many numbers as clusters times terms
    own = vector_to_array("features")

    def apart(center):
        gaps = F.zip_with(own, center, lambda a, b: (a - b) * (a - b))
        return F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x)

    measured = vectors.select("Description", F.transform(centers, apart).alias("apart"))
    assigned = F.get("apart", "NLP_Category")
    return measured.join(found.assigned, "Description").select(
        "Description", (assigned <= F.array_min("apart") + 1e-9).alias("is_nearest")
    )


def description_clusters_rows(spark: SparkSession, folder: str) -> DataFrame:
    table = cut_lineage(_labeled(spark, folder))
    found = clusters.count_clusters(table)
    docs = text.tokens(text.descriptions(table))
    return _nearest(found, text.count_vectors(docs, found.vocabulary, "filtered", "features"))


def tfidf_clusters_rows(spark: SparkSession, folder: str) -> DataFrame:
    table = cut_lineage(_labeled(spark, folder))
    found = clusters.tfidf_clusters(table)
    docs = cut_lineage(text.phrases(text.descriptions(table)))
    vocab = [(row.term, row.idf) for row in text.phrase_vocabulary(docs).collect()]
    return _nearest(found, text.tfidf_vectors(docs, vocab, "features"))


def cluster_terms_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Places of the terms of each cluster, and whether weights fall from place to place."""
    found = clusters.tfidf_clusters(cut_lineage(_labeled(spark, folder)))
    terms = clusters.cluster_terms(found)
    above = F.lag("weight").over(Window.partitionBy("NLP_Category").orderBy("position"))
    return terms.select(
        "NLP_Category", "position", (F.coalesce(above, F.col("weight")) >= F.col("weight")).alias("falls")
    )


# -- scans, sinks, audit -------------------------------------------------------------


def stage_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled features written as a stage table and read back."""
    path = scratch_path(spark, "features_with_labels")
    tables.write_stage(_labeled(spark, folder), path)
    return _iso(tables.read_stage(spark, path, schema.FEATURES_LABELED))


def csv_stage_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """The same through sorted CSV files."""
    path = scratch_path(spark, "features_csv")
    tables.write_stage(_labeled(spark, folder), path, "csv", ["Description", "InvoiceMonth"])
    return _iso(tables.read_stage(spark, path, schema.FEATURES_LABELED, "csv"))


def tolerant_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A report with padded headers and text in its measure, read back leniently."""
    path = scratch_path(spark, "quarterly_dirty")
    measure = F.when(F.col("Quarter") == "Q4", "n/a").otherwise(
        F.col("avg_quarter_sales").cast("string")
    )
    dirty = _quarterly(spark, folder).withColumn("avg_quarter_sales", measure)
    tables.write_stage(dirty.toDF(*[f" {name} " for name in dirty.columns]), path, "csv")
    layout = T.StructType([T.StructField(f" {name} ", T.StringType()) for name in dirty.columns])
    rows = tables.tidy_header(tables.read_tolerant(spark, path, layout))
    if not tables.has_columns(rows, {"Description", "avg_quarter_sales"}):
        raise ValueError("report lacks its columns")
    return reports.numeric_only(rows, "avg_quarter_sales")


def metrics_document(spark: SparkSession, folder: str) -> DataFrame:
    """Classification metrics written as a JSON document and read back."""
    path = scratch_path(spark, "metrics")
    tables.write_metrics(metrics.classification_metrics(_baseline(spark, folder)), path)
    return tables.read_metrics(spark, path, schema.CLASSIFICATION_METRICS)


def stage_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts observed while the stages are written, in the order they are written."""
    counts: dict[str, int] = {}

    def stage(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        counts[name] = tables.write_stage(df, path)
        return tables.read_stage(spark, path, df.schema)

    raw = stage(star_transactions(spark, folder), "transactions")
    sales = stage(clean.clean_transactions(raw), "clean")
    monthly = stage(rollup.monthly_sales(sales), "monthly_sales")
    table = stage(features.build_features(monthly, _months(spark)), "features")
    stage(holidays.holiday_rows(table, _calendar(spark)), "holiday_rows")
    stage(holidays.in_holiday_months(clean.with_sales(raw), _months(spark)), "holiday_lines")
    return audit.audit_table(spark, counts)


def stage_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Gates of stages that are sound, lack a column, are empty, hold over-long lines and
    unreadable fields, or are not there."""
    labeled = cut_lineage(_labeled(spark, folder))
    spoilt = F.when(F.col("Month") == 2, "2010/13").otherwise(
        F.date_format("InvoiceMonth", "yyyy-MM-dd")
    )
    rules = [
        gate.column("stock_decision"),
        gate.filled("Description"),
        gate.numeric("TotalPrice"),
        gate.month("InvoiceMonth"),
        gate.one_of("stock_decision", ("Increase", "Maintain")),
    ]
    path = scratch_path(spark, "overlong")
    measure = F.when(F.col("Quarter") == "Q3", "n/a").otherwise(
        F.col("avg_quarter_sales").cast("string")
    )
    lines = _quarterly(spark, folder).select(
        F.concat_ws(",", F.concat(F.lit('"'), "Description", F.lit('"')), "Quarter", measure,
                    F.when(F.col("Quarter") == "Q4", "one field more"))
    )
    lines.write.text(path)
    layout = T.StructType(
        [T.StructField(c, T.StringType()) for c in ("Description", "Quarter", "avg_quarter_sales")]
    )
    read = tables.read_tolerant(spark, path, layout, header=False)
    missing = tables.read_tolerant(spark, scratch_path(spark, "nowhere"), layout)
    report = [
        gate.numeric("avg_quarter_sales"),
        gate.one_of("Quarter", ("Q1", "Q2", "Q3")),
    ]
    found = [
        gate.check(labeled.withColumn("InvoiceMonth", spoilt), "spoilt", rules),
        gate.check(labeled.drop("stock_decision"), "lacking", rules),
        gate.check(labeled.limit(0), "empty", rules),
        gate.check(read, "overlong", report),
        gate.check(missing, "missing", report),
    ]
    return gate.outcome_table(spark, found)


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log after two runs: raw lines with rejects, then the same stages again."""
    root = scratch_path(spark, "logged")
    stages, path = jobs.Stages(root), f"{root}/run_log"
    for run in ("first", "second"):
        log = RunLog(spark, path, run)
        jobs.monthly_job(_spoilt_scan(spark, folder), stages, log=log)
        jobs.features_job(spark, stages, uk_bank_holidays(spark), log)
    return log.read().select("run", "stage", "rows_in", "rows_out", "rejects")


def features_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled features kept by month: older lines first, then the last month with late lines."""
    kept = MonthTables(scratch_path(spark, "by_month"))
    lines = star_transactions(spark, folder)
    last = lines.agg(F.trunc(F.max("InvoiceDate"), "month")).first()[0]
    later = (F.col("InvoiceDate") >= F.lit(last)) | (F.col("Quantity") > 45)
    later = F.coalesce(later, F.lit(False))
    for batch, part in (("first", lines.filter(~later)), ("second", lines.filter(later))):
        update(part, kept, batch, _months(spark))
    return _iso(kept.features(spark, rollup.TOP_PRODUCTS))


REGISTERED: dict[str, Query] = {
    "clean_transactions": clean_transactions,
    "transactions_csv_scan": transactions_csv_scan,
    "transactions_rejects": transactions_rejects,
    "transactions_spoilt": transactions_spoilt,
    "product_revenue": product_revenue,
    "top_products": top_products,
    "monthly_totals": monthly_totals,
    "monthly_sales": monthly_sales,
    "monthly_sales_all": monthly_sales_all,
    "monthly_sales_top": monthly_sales_top,
    "holiday_calendar": holiday_calendar,
    "holiday_months": holiday_months,
    "calendar_file": calendar_file,
    "features": features_plain,
    "features_labeled": features_labeled,
    "features_by_month": features_by_month,
    "holiday_fanout": holiday_fanout,
    "holiday_impact": holiday_impact,
    "holiday_products": holiday_products,
    "holiday_products_top_n": holiday_products_top_n,
    "quarterly_summary": quarterly_summary,
    "newyear_vs_christmas": newyear_vs_christmas,
    "month_labels": month_labels,
    "quarterly_scores": quarterly_scores,
    "heatmap_rows": heatmap_rows,
    "quarterly_heatmap": quarterly_heatmap,
    "quarter_by_product": quarter_by_product,
    "feature_correlation": feature_correlation,
    "correlation_matrix": correlation_matrix,
    "split_regression": split_regression,
    "split_inventory": split_inventory,
    "product_index": product_index,
    "label_index": label_index,
    "regression_vectors": regression_vectors,
    "inventory_vectors": inventory_vectors,
    "metrics_regression": metrics_regression,
    "metrics_classification": metrics_classification,
    "confusion": confusion,
    "product_mae": product_mae,
    "inventory_matches": inventory_matches,
    "match_counts": match_counts,
    "class_by_match": class_by_match,
    "forecast_explorer": forecast_explorer,
    "single_product": single_product,
    "product_list": product_list,
    "product_count": product_count,
    "month_bounds": month_bounds,
    "preview_features": preview_features,
    "description_tokens": description_tokens,
    "description_vocabulary": description_vocabulary,
    "description_term_counts": description_term_counts,
    "tfidf_vocabulary": tfidf_vocabulary,
    "tfidf_weights": tfidf_weights,
    "description_clusters": description_clusters,
    "description_centers": description_centers,
    "cluster_cost": cluster_cost,
    "tfidf_clusters": tfidf_clusters,
    "cluster_terms": cluster_terms,
    "stage_round_trip": stage_round_trip,
    "csv_stage_round_trip": csv_stage_round_trip,
    "tolerant_scan": tolerant_scan,
    "metrics_document": metrics_document,
    "stage_audit": stage_audit,
    "stage_gate": stage_gate,
    "run_log": run_log,
    "demand_forecast_rows": demand_forecast_rows,
    "stock_forecast_rows": stock_forecast_rows,
    "demand_metrics_agree": demand_metrics_agree,
    "stock_metrics_agree": stock_metrics_agree,
    "description_clusters_rows": description_clusters_rows,
    "tfidf_clusters_rows": tfidf_clusters_rows,
    "cluster_terms_rank": cluster_terms_rank,
    "demand_forecast": demand_forecast,
    "demand_metrics": demand_metrics,
    "stock_forecast": stock_forecast,
    "stock_metrics": stock_metrics,
    "demand_tuning": demand_tuning,
    "stock_tuning": stock_tuning,
    "demand_trees": demand_trees,
    "stock_trees": stock_trees,
}
