"""Forests and centres as tables: against MLlib, DuckDB on the stored tables, and odd inputs."""

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks import queries
from shelfcast.operators import centers, clusters, forest, text, treetables
from shelfcast.session import cut_lineage

SF = "/root/testdata/sf0.001"
GRID = treetables.TreeGrid(trees=(4, 8), depths=(3, 6))


@pytest.fixture(scope="module")
def labeled(spark):
    return cut_lineage(queries._labeled(spark, SF))


@pytest.fixture(scope="module")
def demand(labeled):
    return treetables.demand_forecast(labeled, grid=GRID)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_fit_does_not_depend_on_partitions(labeled, demand):
    other = treetables.demand_forecast(
        labeled.repartition(7), grid=treetables.TreeGrid((4, 8), (3, 6), rows_per_partition=400)
    )
    assert rows_of(other.nodes) == rows_of(demand.nodes)
    assert rows_of(other.predictions) == rows_of(demand.predictions)


def test_smaller_forests_are_parts_of_the_larger(labeled, demand):
    few = treetables.demand_forecast(labeled, grid=treetables.TreeGrid((4,), (3,)))
    inside = demand.nodes.filter("tree < 4 AND depth < 3").select("view", "tree", "node", "feature", "threshold", "n_rows")
    assert rows_of(few.nodes.filter("depth < 3").select(*inside.columns)) == rows_of(inside)


def test_predictions_follow_from_the_stored_nodes(spark, labeled, demand, tmp_path):
    """A recursive query goes down the stored trees with the stored inputs."""
    demand.nodes.write.parquet(str(tmp_path / "nodes"))
    seen = treetables.in_views(
        labeled.withColumn("label", F.round(F.col("TotalPrice") * 10_000).cast("bigint")),
        treetables.REGRESSION_PARTS,
        GRID.train_ratio,
    )
    rows = treetables.target_means(seen, "Description", {"product_mean": F.col("label")})
    tested = rows.filter("view = 1 AND NOT grows").withColumn("InvoiceMonth", F.col("InvoiceMonth").cast("string"))
    tested.write.parquet(str(tmp_path / "rows"))
    best = demand.best_parameters
    value = " ".join(f"WHEN '{c}' THEN \"{c}\"::DOUBLE" for c in demand.inputs)
    found = duckdb.execute(f"""
        WITH RECURSIVE nodes AS (SELECT * FROM '{tmp_path}/nodes/*.parquet' WHERE view = 1 AND tree < {best["numTrees"]}),
        walk AS (
          SELECT r.*, n.tree, n.node, n.depth, n.feature, n.threshold, n.sums[1] / n.n_rows / 10000 AS value
          FROM '{tmp_path}/rows/*.parquet' r, nodes n WHERE n.node = 1
          UNION ALL
          SELECT w.* EXCLUDE (tree, node, depth, feature, threshold, value),
                 n.tree, n.node, n.depth, n.feature, n.threshold, n.sums[1] / n.n_rows / 10000
          FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = 2 * w.node
            + (CASE w.feature {value} END > w.threshold)::INTEGER
          WHERE w.feature IS NOT NULL AND w.depth < {best["maxDepth"]}),
        ends AS (SELECT *, row_number() OVER (PARTITION BY "Description", "InvoiceMonth", tree ORDER BY depth DESC) AS nth FROM walk)
        SELECT "Description", "InvoiceMonth", avg(value) FROM ends WHERE nth = 1 GROUP BY ALL""").fetchall()
    walked = {(d, m): v for d, m, v in found}
    scored = demand.predictions.collect()
    assert len(scored) == len(walked) > 100
    for row in scored:
        assert walked[row.Description, str(row.InvoiceMonth)] == pytest.approx(row.prediction, rel=1e-12)


def test_the_best_grid_point_is_the_one_with_the_best_holdout(demand):
    gap = F.col("label") / 10_000 - F.col("prediction")
    scores = {
        (r.numTrees, r.maxDepth): r.rmse
        for r in demand.holdout.groupBy("numTrees", "maxDepth").agg(F.sqrt(F.avg(gap * gap)).alias("rmse")).collect()
    }
    said = {(r.numTrees, r.maxDepth): r for r in demand.tuning.collect()}
    assert set(said) == set(scores) == set(GRID.points)
    assert all(said[p].score == pytest.approx(scores[p], abs=1e-6) for p in scores)
    best = min(scores, key=scores.get)
    assert [p for p in said if said[p].best] == [best]
    assert tuple(demand.best_parameters.values()) == best


def test_as_good_as_mllib(labeled):
    ours = forest.demand_metrics(treetables.demand_forecast(labeled)).first()
    quick = forest.Tuning(trees=(20,), depths=(10,), parallelism=1)
    theirs = forest.demand_metrics(forest.demand_forecast(labeled, tuning=quick)).first()
    assert ours.RMSE <= 1.25 * theirs.RMSE
    right = forest.stock_metrics(treetables.stock_forecast(labeled)).first()
    known = forest.stock_metrics(forest.stock_forecast(labeled, tuning=quick)).first()
    assert right.accuracy >= known.accuracy - 0.03


def test_many_products_need_no_more_bins(spark):
    """100,000 products, of which MLlib's nominal input would need as many bins."""
    wide = spark.range(200_000).select(
        F.concat(F.lit("P"), (F.col("id") % 100_000).cast("string")).alias("Description"),
        F.when(F.col("id") < 100_000, F.lit("2010-01-01")).otherwise("2010-02-01").cast("date").alias("InvoiceMonth"),
        (F.col("id") % 1000 + 1.0).alias("TotalPrice"),
        (F.col("id") % 7).alias("prev_month_sales"),
    )
    grid = treetables.TreeGrid((2,), (4,))
    found = treetables.demand_forecast(cut_lineage(wide), ["prev_month_sales", "DescriptionIndex"], grid)
    assert found.nodes.filter("feature = 'product_mean'").count() > 0
    cuts = found.nodes.filter("feature IS NOT NULL").groupBy("view", "feature").agg(F.count_distinct("threshold").alias("n"))
    assert all(r.n < treetables.BINS for r in cuts.collect())
    assert found.predictions.count() > 20_000


def test_target_means_come_from_growing_rows_only(spark):
    rows = spark.createDataFrame(
        [(0, True, "a", 10), (0, True, "a", 20), (0, False, "a", 999), (0, False, "new", 5), (1, True, "a", 7), (0, True, None, 60)],
        "view int, grows boolean, Description string, label bigint",
    )
    found = treetables.target_means(rows, "Description", {"m": F.col("label")}).collect()
    mean = 90 / 3
    expected = {(0, "a"): (30 + 10 * mean) / 12, (0, "new"): mean, (0, None): (60 + 10 * mean) / 11, (1, "a"): 7.0}
    assert all(r.m == pytest.approx(expected[r.view, r.Description]) for r in found) and len(found) == 6


def test_forests_of_odd_tables(spark, labeled):
    none = treetables.demand_forecast(labeled.limit(0), grid=GRID)
    assert none.predictions.count() == none.nodes.count() == none.tuning.count() == 0
    assert treetables.stock_forecast(labeled.limit(0), grid=GRID).predictions.count() == 0
    holes = labeled.withColumn("prev_month_sales", F.expr("IF(Month = 3, NULL, prev_month_sales)"))
    holes = holes.withColumn("TotalPrice", F.expr("IF(Month = 4, NULL, TotalPrice)")).withColumn("view", F.lit("clash"))
    found = treetables.demand_forecast(holes.unionAll(holes.limit(50)), grid=GRID)
    assert found.predictions.filter("prediction IS NULL OR month(InvoiceMonth) = 4").count() == 0
    one = labeled.withColumn("stock_decision", F.lit("Maintain"))
    assert {r.predicted_label for r in treetables.stock_forecast(one, grid=GRID).predictions.collect()} == {"Maintain"}


@given(st.integers(1, 40))
@settings(max_examples=20, deadline=None)
def test_bootstrap_weights_are_poisson(start):
    drawn = np.concatenate([treetables.bootstrap_weights(f"k{start}-{i}", 9, "s") for i in range(500)])
    assert abs(drawn.mean() - 1) < 0.1 and abs((drawn == 0).mean() - np.exp(-1)) < 0.05


# -- centres -----------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["count", "tfidf"])
def test_centers_are_a_fixed_point(labeled, kind):
    found = getattr(centers, f"{kind}_clusters")(labeled)
    other = getattr(centers, f"{kind}_clusters")(labeled.repartition(5))
    assert found.settled and rows_of(found.assigned) == rows_of(other.assigned)
    docs = text.tokens(text.descriptions(labeled)) if kind == "count" else text.phrases(text.descriptions(labeled))
    assigned = found.assigned.join(docs.select("Description", "n_rows"), "Description")
    weights = {r.NLP_Category: r.w for r in assigned.groupBy("NLP_Category").agg(F.sum("n_rows").alias("w")).collect()}
    held = {r.NLP_Category: r["weight"] for r in found.centers.collect()}
    assert {c: w for c, w in held.items() if c in weights} == weights


def test_cost_is_near_that_of_mllib(labeled):
    ours = centers.count_clusters(labeled).assigned.agg(F.sum("cost")).first()[0]
    theirs = clusters.count_clusters(labeled).model.summary.trainingCost
    assert ours <= 1.5 * theirs


def test_centers_of_odd_tables(spark, labeled):
    none = centers.count_clusters(labeled.limit(0))
    assert none.assigned.count() == none.centers.count() == centers.cluster_terms(none).count() == 0
    same = spark.createDataFrame([("a", 3, [1, 2]), ("b", 1, [1, 2]), ("c", 2, [5, 0])], "Description string, n_rows bigint, vector array<bigint>")
    found = centers.fit(same, ["x", "y"], k=10)
    groups = {r.Description: r.NLP_Category for r in found.assigned.collect()}
    assert groups["a"] == groups["b"] != groups["c"] and found.settled
    assert {(r.term, r["sum"], r["weight"]) for r in found.centers.collect()} == {("x", 4, 4), ("y", 8, 4), ("x", 10, 2), ("y", 0, 2)}
