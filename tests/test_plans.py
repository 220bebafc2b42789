"""What the physical plans look like, and the jobs end to end."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks import queries
from shelfcast import schema
from shelfcast.operators import (
    clusters,
    encode,
    features,
    forest,
    holidays,
    metrics,
    rollup,
    runlog,
    text,
    treetables,
)
from shelfcast.plans import jobs
from shelfcast.session import cut_lineage
from shelfcast.sources import transactions
from shelfcast.sources.holidays import uk_bank_holidays
from shelfcast.sources.star import star_transactions

SF = "/root/testdata/sf0.001"
QUICK = forest.Tuning(trees=(3, 5), depths=(3,), parallelism=1)


def plan_of(df, run=False):
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_sales_lines_are_scanned_and_shuffled_once(spark):
    plan = plan_of(rollup.monthly_sales(queries._clean(spark, SF)), run=True)
    assert "ReusedExchange" in plan
    assert plan.count("l_returnflag") and plan.count("FileScan parquet [l_orderkey") == 1


@pytest.mark.parametrize(
    "name",
    [
        "single_product",
        "forecast_explorer",
        "quarter_by_product",
        "description_tokens",
        "description_vocabulary",
        "tfidf_vocabulary",
    ],
)
def test_queries_that_filter_products_rest_on_stored_totals(spark, name):
    plan = plan_of(queries.REGISTERED[name](spark, SF), run=True)
    assert "l_returnflag" not in plan and "shelfcast/table-" in plan


@pytest.mark.parametrize(
    "name", ["quarterly_heatmap", "heatmap_rows", "quarter_by_product", "month_labels"]
)
def test_reports_do_not_sort_their_input(spark, name):
    assert "rangepartitioning" not in plan_of(queries.REGISTERED[name](spark, SF))


@pytest.mark.parametrize("name", ["features", "holiday_fanout", "holiday_impact", "holiday_products"])
def test_calendar_is_broadcast_from_its_size(spark, name):
    plan = plan_of(queries.REGISTERED[name](spark, SF))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_windows_share_one_shuffle_and_sort(spark):
    monthly = spark.createDataFrame([], schema.MONTHLY_SALES)
    plan = plan_of(features.series_features(monthly))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Window [") == 1


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(queries.REGISTERED["product_revenue"](spark, SF))
    assert "o_orderdate" not in plan and "l_extendedprice" not in plan
    assert "PushedFilters: [IsNotNull(p_retailprice), GreaterThan(p_retailprice,0.0)" in plan


def test_large_sides_are_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        df = holidays.in_holiday_months(queries._uncleaned(spark, SF), queries._months(spark))
        plan = plan_of(df)
        assert "SortMergeJoin" in plan and "LeftSemi, BuildRight" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


ITERATIVE = {
    "demand_forecast",
    "demand_metrics",
    "demand_tuning",
    "demand_trees",
    "stock_forecast",
    "stock_metrics",
    "stock_tuning",
    "stock_trees",
    "description_clusters",
    "description_centers",
    "tfidf_clusters",
    "cluster_cost",
    "cluster_terms",
}
COMPANIONS = {
    "demand_forecast_rows",
    "stock_forecast_rows",
    "demand_metrics_agree",
    "stock_metrics_agree",
    "description_clusters_rows",
    "tfidf_clusters_rows",
    "cluster_terms_rank",
}


@pytest.mark.parametrize(
    "name", sorted(set(queries.REGISTERED) - ITERATIVE - COMPANIONS - {"stage_audit"})
)
def test_no_query_pairs_everything_with_everything(spark, name):
    plan = plan_of(queries.REGISTERED[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan and "Pandas" not in plan


# -- models --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labeled(spark):
    return cut_lineage(queries._labeled(spark, SF))


def test_demand_forecast_repeats_and_beats_last_month(labeled):
    first = forest.demand_forecast(labeled, tuning=QUICK)
    again = forest.demand_forecast(labeled.repartition(5), tuning=QUICK)
    assert first.best_parameters == again.best_parameters
    keys = ["Description", "InvoiceMonth"]
    assert (
        first.predictions.orderBy(*keys).collect() == again.predictions.orderBy(*keys).collect()
    )
    assert " in {" in first.model.bestModel.toDebugString  # splits on sets of products
    assert first.predictions.filter(F.isnan("prediction") | F.col("prediction").isNull()).count() == 0
    ours = metrics.regression_metrics(first.predictions).first()
    last = metrics.regression_metrics(labeled.withColumn("prediction", F.col("prev_month_sales")))
    assert ours.RMSE < last.first().RMSE


def test_forecast_from_the_past_only(labeled):
    past = ["prev_month_sales", "is_holiday_month", "Month", "DescriptionIndex"]
    honest = forest.demand_metrics(forest.demand_forecast(labeled, past, QUICK)).first()
    informed = forest.demand_metrics(forest.demand_forecast(labeled, tuning=QUICK)).first()
    assert informed.RMSE < honest.RMSE
    assert honest["Best Hyperparameters"].maxDepth == 3


def test_stock_forecast(labeled):
    result = forest.stock_forecast(labeled, tuning=QUICK)
    decisions = {r.predicted_label for r in result.predictions.select("predicted_label").collect()}
    assert decisions <= {"Increase", "Maintain", "Reduce"} and len(decisions) > 1
    assert forest.stock_metrics(result).first().accuracy > 0.5


def test_encoding_is_the_callers_choice(labeled):
    plain = replace(QUICK, encoding="ordinal")
    result = forest.demand_forecast(labeled, tuning=plain)
    assert not result.model.bestModel.toDebugString.count(" in {")
    assert result.predictions.count() > 0
    with pytest.raises(ValueError, match="encoding"):
        forest.demand_forecast(labeled, tuning=replace(QUICK, encoding="guess"))


@pytest.mark.parametrize("levels", [2_048, 2_049])
def test_the_index_is_nominal_at_every_size(spark, levels):
    rows = spark.range(levels).selectExpr("CAST(id AS STRING) AS Description")
    index = encode.product_index(rows)
    column = encode.with_product_index(rows, index, levels).schema["DescriptionIndex"]
    assert column.metadata["ml_attr"]["num_vals"] == levels
    assert encode.bins_for(levels) == levels and encode.bins_for(levels, "ordinal") == 32


def test_every_name_has_one_cluster(labeled):
    found = clusters.count_clusters(labeled)
    names = found.assigned.count()
    assert names == labeled.select("Description").distinct().count()
    assert found.assigned.dropDuplicates(["Description"]).count() == names
    assert found.assigned.filter(~F.col("NLP_Category").between(0, 9)).count() == 0
    again = clusters.count_clusters(labeled.repartition(3))
    assert found.assigned.exceptAll(again.assigned).count() == 0


def test_weighted_names_stand_for_repeated_rows(labeled):
    docs = text.descriptions(labeled)
    assert docs.agg(F.sum("n_rows")).first()[0] == labeled.count()


def test_cluster_terms(labeled):
    found = clusters.tfidf_clusters(labeled)
    terms = clusters.cluster_terms(found)
    assert terms.groupBy("NLP_Category").count().filter("count <> 5").count() == 0
    assert set(terms.select("term").toPandas().term) <= set(found.vocabulary)


# -- shape of the reports ------------------------------------------------------------


def test_holidays_of_the_same_months_have_equal_averages(spark, labeled):
    impact = [tuple(r) for r in holidays.holiday_impact(labeled, queries._calendar(spark)).collect()]
    values = dict(impact)
    assert values["Early May Bank Holiday"] == values["Spring Bank Holiday"]
    assert len(impact) == 10
    asked = [tuple(r) for r in queries.holiday_impact(spark, SF).collect()]
    assert dict(asked) == values
    assert [v for _, v in asked] == sorted(values.values(), reverse=True)


def test_seasonal_tables_have_few_rows_per_product(spark):
    quarterly = queries.quarterly_summary(spark, SF)
    assert quarterly.groupBy("Description").count().filter("count > 4").count() == 0
    seasonal = queries.newyear_vs_christmas(spark, SF)
    assert seasonal.filter(~F.col("Month").isin(1, 12)).count() == 0
    keys = ["Description", "Year", "Month"]
    assert seasonal.count() == seasonal.dropDuplicates(keys).count()


# -- jobs ----------------------------------------------------------------------------


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_jobs_end_to_end(spark, tmp_path, fmt):
    stages = jobs.Stages(str(tmp_path), fmt)
    tx, calendar = star_transactions(spark, SF), uk_bank_holidays(spark)
    empty = jobs.report_tables(spark, stages)
    assert all(df.count() == 0 for df in empty.values())

    assert jobs.monthly_job(tx, stages) == {"monthly_sales": 3279}
    counts = jobs.features_job(spark, stages, calendar)
    assert counts == {"features": 3130, "features_with_labels": 3130}
    jobs.holiday_impact_job(spark, stages, calendar)
    assert jobs.holiday_products_job(tx, stages, calendar)["top_holiday_products"] > 0
    assert jobs.seasonality_job(spark, stages)["quarterly_summary"] > 0
    small = treetables.TreeGrid(trees=(3, 5), depths=(3,))
    demand = jobs.demand_job(spark, stages, small)
    assert demand.best_parameters["maxDepth"] == 3
    jobs.stock_job(spark, stages, small)
    nodes = spark.read.parquet(stages.path("model_nodes"))
    assert nodes.exceptAll(demand.nodes).count() == 0 and nodes.agg(F.max("depth")).first()[0] == 3
    assert spark.read.parquet(stages.path("model_inventory_tuning")).filter("best").count() == 1
    assert jobs.clusters_job(spark, stages)["description_clusters"] == 149
    jobs.correlation_job(spark, stages)

    stored = stages.read(spark, "features_with_labels", schema.FEATURES_LABELED)
    assert stored.exceptAll(queries._labeled(spark, SF)).count() == 0
    assert len(list((tmp_path / "holiday_impact").glob("part-*"))) == 1
    report = jobs.report_tables(spark, stages)
    assert all(df.count() > 0 for df in report.values())
    assert report["quarterly_heatmap"].count() == 12
    assert report["regression_metrics"].first().RMSE > 0
    assert jobs.report_job(spark, stages)["quarterly_heatmap"] == 12
    gates = stages.read(spark, "report/gates", queries.gate.outcome_table(spark, []).schema)
    assert gates.filter("NOT passed").count() == 0 and gates.select("stage").distinct().count() == 6
    some = stages.read(spark, "predictions", schema.PREDICTIONS).first()
    month = some.InvoiceMonth
    chosen = jobs.report_tables(spark, stages, [some.Description], month, month)
    assert [r.InvoiceMonth for r in chosen["forecast_explorer"].collect()] == [month]
    assert {r.Description for r in chosen["month_labels"].collect()} <= {some.Description}


def test_reports_of_missing_stages_are_skipped_with_a_reason(spark, tmp_path, capsys):
    stages = jobs.Stages(str(tmp_path))
    stages.write(holidays.holiday_impact(queries._labeled(spark, SF), queries._calendar(spark)), "holiday_impact")
    assert set(jobs.report_job(spark, stages)) == {"holiday_impact"}
    assert "report product_mae skipped: predictions: is not empty: 1 broken" in capsys.readouterr().out
    gates = spark.read.parquet(stages.path("report/gates"))
    assert {r.stage for r in gates.filter("passed AND rule = 'is not empty'").collect()} == {"holiday_impact"}


def test_raw_lines_are_read_once_and_routed(spark, tmp_path):
    raw = tmp_path / "raw.csv"
    good = [f"{i},P{i % 3},{1 + i % 4},2.5,7,2010-0{1 + i % 9}-01 00:00:00" for i in range(900)]
    bad = ["x1,P1,many,2.5,7,2010-01-01 00:00:00", "x2,P1,1,free,7,2010-01-01 00:00:00"]
    names = ",".join(schema.TRANSACTIONS.names)
    order = ["Invoice", "Description", "Quantity", "Price", "Customer ID", "InvoiceDate"]

    def line(text):
        values = dict(zip(order, text.split(","), strict=True))
        return ",".join(values.get(n, "x") for n in schema.TRANSACTIONS.names)

    raw.write_text("\n".join([names, *map(line, good + bad)]) + "\n")
    tx = transactions.read_transactions(spark, str(raw), keep_unreadable=True)
    log = runlog.RunLog(spark, str(tmp_path / "log"), "one")
    stages = jobs.Stages(str(tmp_path / "out"))
    counts = jobs.monthly_job(tx, stages, log=log)
    assert counts == {"rejects": 2, "monthly_sales": 9}
    (entry,) = log.read().collect()
    assert (entry.rows_in, entry.rows_out, entry.rejects) == (902, 9, 2)
    assert entry.started <= entry.ended
    again = transactions.routed(tx, str(tmp_path / "routed"))
    raw.unlink()  # nothing reads the file any more
    assert (again[0].count(), again[1].count()) == (900, 2) and again[2] == {"lines": 902, "rejects": 2}


def test_a_failed_stage_leaves_no_entry(spark, tmp_path):
    log = runlog.RunLog(spark, str(tmp_path / "log"))
    with pytest.raises(ValueError), log.stage("broken"):
        raise ValueError
    with log.stage("whole") as entry:
        entry.rows_out = 3
    assert [(r.run, r.stage, r.rows_out, r.rows_in) for r in log.read().collect()] == [(log.run, "whole", 3, None)]
