"""Hand-made fixtures for the cases the large tables do not hold."""

from datetime import date, datetime

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from shelfcast.functions import dates, money
from shelfcast.functions import text as text_functions
from shelfcast.operators import (
    clean,
    encode,
    features,
    holidays,
    metrics,
    reports,
    rollup,
    seasonality,
    split,
    stats,
    text,
)
from shelfcast.schema import TxColumns
from shelfcast.sources.holidays import UK_BANK_HOLIDAYS, uk_bank_holidays

TX = (
    "Invoice string, Description string, Quantity int, Price double, "
    "`Customer ID` double, InvoiceDate timestamp"
)
MONTHLY = "Description string, InvoiceMonth date, TotalPrice double"


def rows(df, *order):
    return [tuple(row) for row in (df.orderBy(*order) if order else df).collect()]


def month(m, year=2010):
    return date(year, m, 1)


@pytest.fixture(scope="module")
def dirty(spark):
    day = datetime(2010, 3, 17, 9, 30)
    lines = [
        ("1", "MUG", 2, 1.25, 7.0, day),
        ("1", "MUG ", 1, 1.25, 7.0, day),
        ("C2", "MUG", -1, 1.25, 7.0, day),
        (None, "MUG", 5, 1.25, 7.0, day),
        ("3", "MUG", 0, 1.25, 7.0, day),
        ("3", "MUG", -4, 1.25, 7.0, day),
        ("3", "MUG", 4, 0.0, 7.0, day),
        ("3", "MUG", 4, -1.0, 7.0, day),
        ("3", "MUG", 4, 1.0, None, day),
        ("4", None, 3, 2.0, 7.0, day),
        ("5", "RED  BOX", 1, 0.001, 8.0, day),
        ("6", 'THE "BIG" BOX', 1, 9.99, 8.0, datetime(2010, 4, 30, 23, 59)),
        ("7", "MUG", None, 1.0, 8.0, day),
    ]
    return spark.createDataFrame(lines, TX)


def test_cleaning_keeps_sales_lines_only(dirty):
    found = rows(clean.clean_transactions(dirty).select("Invoice", "Description", "TotalPrice"))
    assert sorted(found, key=str) == sorted(
        [
            ("1", "MUG", 2.5),
            ("1", "MUG", 1.25),
            ("4", None, 6.0),
            ("5", "RED  BOX", 0.001),
            ("6", 'THE "BIG" BOX', 9.99),
        ],
        key=str,
    )


def test_words_of_any_script_are_kept(spark):
    docs = spark.createDataFrame([("CAFÉ CRÈME jar", 1)], "Description string, n_rows bigint")
    found = text.phrases(docs).first()
    assert {"café", "crème", "jar"} <= {w for v in found.asDict().values() if isinstance(v, list) for w in v}


def test_dates_are_reduced_to_day_and_month(dirty):
    last = clean.clean_transactions(dirty).filter("Invoice = '6'").first()
    assert (last.InvoiceDate, last.InvoiceMonth) == (date(2010, 4, 30), month(4))


def test_column_names_can_be_mapped(spark):
    own = TxColumns("no", "item", "n", "unit", "who", "at")
    lines = spark.createDataFrame(
        [("1", "MUG", 2, 1.5, 1, date(2010, 1, 9))],
        "no string, item string, n int, unit double, who int, at date",
    )
    only = clean.clean_transactions(lines, own).first()
    assert (only.Description, only.TotalPrice, only.InvoiceMonth) == ("MUG", 3.0, month(1))


def test_blanks_do_not_split_a_product(dirty):
    totals = rollup.monthly_totals(clean.clean_transactions(dirty))
    assert totals.filter("Description = 'MUG'").first().TotalPrice == 3.75
    assert totals.filter("Description = 'RED  BOX'").first().TotalPrice == 0.001


def test_unnamed_products_take_a_place_but_have_no_series(dirty):
    sales = clean.clean_transactions(dirty)
    assert [r.Description for r in rollup.top_products(rollup.product_revenue(sales), 2).collect()] == [
        'THE "BIG" BOX',
        None,
    ]
    assert {r.Description for r in rollup.monthly_sales(sales, 2).collect()} == {'THE "BIG" BOX'}


def test_no_limit_keeps_every_named_product(dirty):
    sales = clean.clean_transactions(dirty)
    kept = {r.Description for r in rollup.monthly_sales(sales, None).collect()}
    assert kept == {"MUG", "RED  BOX", 'THE "BIG" BOX'}


def test_ties_at_the_cut_go_by_name(spark):
    sales = spark.createDataFrame(
        [(name, month(1), price) for name, price in zip("FEDCBA", [9.0, 5.0, 5.0, 5.0, 5.0, 1.0])],
        MONTHLY,
    )
    top = rollup.top_products(rollup.product_revenue(sales), 3)
    assert [r.Description for r in top.collect()] == ["F", "B", "C"]
    assert {r.Description for r in rollup.monthly_sales(sales, 3).collect()} == {"F", "B", "C"}


def test_sums_do_not_drift(spark):
    sales = spark.range(100_000).select(
        F.lit("PIN").alias("Description"),
        F.lit(month(1)).alias("InvoiceMonth"),
        F.lit(0.1).alias("TotalPrice"),
    )
    assert rollup.monthly_totals(sales).first().TotalPrice == 10_000.0


@pytest.mark.parametrize(
    ("amounts", "mean"),
    [([0.12, 0.01], 0.07), ([1.0, 2.0, 2.0], 1.67), ([-0.12, -0.01], -0.07), ([5.0], 5.0)],
)
def test_means_round_half_up(spark, amounts, mean):
    df = spark.createDataFrame([(a,) for a in amounts], "x double")
    value = money.mean_to_cents(money.sum_units("x"), F.count("x"))
    assert df.agg(value.alias("m")).first().m == mean


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    found = df.agg(
        money.mean_to_cents(money.sum_units("x"), F.count("x")).alias("a"),
        money.mean_of_units(money.sum_units("x"), F.count("x")).alias("b"),
    ).first()
    assert (found.a, found.b) == (None, None)


def test_windows_are_positional(spark):
    monthly = spark.createDataFrame(
        [
            ("A", month(1), 10.0),
            ("A", month(2), 20.0),
            ("A", month(6), 60.0),
            ("A", month(12), 30.0),
            ("ONCE", month(3), 5.0),
        ],
        MONTHLY,
    )
    found = features.series_features(monthly)
    wanted = ["Month", "prev_month_sales", "rolling_3m_avg", "sales_delta"]
    assert rows(found.select("Description", *wanted), "Month") == [
        ("A", 2, 10.0, 15.0, 5.0),
        ("A", 6, 20.0, 30.0, 30.0),
        ("A", 12, 60.0, 110 / 3, 30.0 - 110 / 3),
    ]


def test_label_bounds_belong_to_maintain(spark):
    table = spark.createDataFrame(
        [(120.0, 100.0), (80.0, 100.0), (120.01, 100.0), (79.99, 100.0), (100.0, 100.0)],
        "TotalPrice double, rolling_3m_avg double",
    )
    labels = [r.stock_decision for r in features.label_stock_decision(table).collect()]
    assert labels == ["Maintain", "Maintain", "Increase", "Reduce", "Maintain"]
    wide = features.label_stock_decision(table, 1.5, 0.5)
    assert {r.stock_decision for r in wide.collect()} == {"Maintain"}


@pytest.fixture(scope="module")
def bad_holidays(spark):
    return spark.createDataFrame(
        [
            (2010, "May 3", "Monday", "Early May", "Bank Holiday", None),
            (2010, "May 31", "Monday", "Spring", "Bank Holiday", None),
            (2010, "Sometime", "Monday", "Unknown", "Bank Holiday", None),
            (2010, None, "Monday", "Missing", "Bank Holiday", None),
        ],
        uk_bank_holidays(spark).schema,
    )


def test_unreadable_holidays_are_dropped(bad_holidays):
    calendar = holidays.parse_calendar(bad_holidays)
    assert rows(calendar.select("Name", "DateParsed", "holiday_month"), "Name") == [
        ("Early May", date(2010, 5, 3), "2010-05"),
        ("Spring", date(2010, 5, 31), "2010-05"),
    ]
    assert holidays.holiday_months(calendar).count() == 1


def test_bundled_calendar(spark):
    calendar = holidays.parse_calendar(uk_bank_holidays(spark))
    assert calendar.count() == len(UK_BANK_HOLIDAYS) == 24
    assert holidays.holiday_months(calendar).count() == 12
    wrong_day = calendar.filter(F.date_format("DateParsed", "EEEE") != F.col("Day"))
    assert wrong_day.count() == 0


def test_months_with_two_holidays_fan_out_but_flag_once(spark, bad_holidays):
    calendar = holidays.parse_calendar(bad_holidays)
    table = spark.createDataFrame([("A", month(5), 10.0), ("A", month(6), 20.0)], MONTHLY)
    assert rows(holidays.holiday_rows(table, calendar).select("month_key", "Name"), "Name") == [
        ("2010-06", None),
        ("2010-05", "Early May"),
        ("2010-05", "Spring"),
    ]
    flagged = features.flag_holiday_months(table, holidays.holiday_months(calendar))
    assert rows(flagged.select("InvoiceMonth", "is_holiday_month"), "InvoiceMonth") == [
        (month(5), 1),
        (month(6), 0),
    ]


def test_impact_equals_grouping_the_fanned_out_rows(spark, bad_holidays):
    calendar = holidays.parse_calendar(bad_holidays.union(bad_holidays.limit(1)))
    table = spark.createDataFrame(
        [("A", month(5), 10.0), ("B", month(5), 20.01), ("A", month(6), 99.0), ("C", month(5), None)],
        MONTHLY,
    )
    grouped = (
        holidays.holiday_rows(table, calendar)
        .filter("Name IS NOT NULL")
        .groupBy("Name")
        .agg(F.round(F.avg("TotalPrice"), 2).alias("avg_sales"))
    )
    impact = holidays.holiday_impact(table, calendar)
    assert rows(impact, "Name") == rows(grouped, "Name") == [("Early May", 15.01), ("Spring", 15.01)]


def test_holiday_products_net_out_returns(dirty, bad_holidays, spark):
    months = holidays.holiday_months(
        holidays.parse_calendar(bad_holidays.withColumn("Date", F.regexp_replace("Date", "May", "Mar")))
    )
    found = holidays.holiday_products(clean.with_sales(dirty), months)
    assert found.columns == ["Description", "total_quantity", "total_sales"]
    # 2 + 1 - 1 + 5 + 0 - 4 + 4 + 4 + 4 pieces, priced 1.25, 0, -1 or 1
    best_first = reports.ranked(found, "total_sales", "Description")
    assert rows(best_first) == [(None, 3, 6.0), ("MUG", 15, 3.75), ("RED  BOX", 1, 0.001)]


def test_quarters_and_month_labels(spark):
    table = spark.createDataFrame([(m,) for m in [1, 3, 4, 9, 10, 12, None, 13]], "Month int")
    found = table.select("Month", dates.quarter_label(F.col("Month")).alias("q"))
    assert [r.q for r in found.collect()] == ["Q1", "Q1", "Q2", "Q3", "Q4", "Q4", None, None]
    labels = reports.with_month_label(table.filter("Month IN (1, 3, 12)"))
    assert [r.MonthLabel for r in labels.collect()] == ["New Year (Jan)", None, "Christmas (Dec)"]


def test_january_and_december_only(spark):
    table = features.series_features(
        spark.createDataFrame([("A", month(m), float(m)) for m in range(1, 13)], MONTHLY).unionByName(
            spark.createDataFrame([("A", month(1, 2011), 7.5)], MONTHLY)
        )
    )
    assert rows(seasonality.newyear_vs_christmas(table)) == [
        ("A", "2010", 12, 12.0),
        ("A", "2011", 1, 7.5),
    ]


def test_heatmap_has_a_column_per_quarter_even_when_empty(spark):
    quarterly = spark.createDataFrame(
        [("A", "Q1", 5.0), ("A", "Q3", 6.0), ("B", "Q1", 1.0), ("C", "Q2", 11.0)],
        "Description string, Quarter string, avg_quarter_sales double",
    )
    assert rows(reports.quarterly_heatmap(quarterly, 2), "Description") == [
        ("A", 5.0, None, 6.0, None),
        ("C", None, 11.0, None, None),
    ]
    assert rows(reports.quarter_by_product(quarterly, ["A", "Z"]), "Quarter") == [
        ("Q1", 5.0, None),
        ("Q3", 6.0, None),
    ]


def test_numbers_are_coerced_and_the_rest_dropped(spark):
    table = spark.createDataFrame([("a", "1.5"), ("b", "n/a"), ("c", None), ("d", "2e1")], "k string, v string")
    assert rows(reports.numeric_only(table, "v")) == [("a", 1.5), ("d", 20.0)]
    assert rows(table.select(dates.to_month(F.lit("2010-05-01")).alias("m"))).count((month(5),)) == 4
    assert table.select(dates.to_month(F.col("k"))).dropna().count() == 0


def test_month_range_and_product_choice(spark):
    table = spark.createDataFrame(
        [("A", month(m), 1.0 * m, 2.0 * m) for m in (1, 2, 3)] + [("B", month(1), 1.0, 1.0)],
        MONTHLY + ", prediction double",
    )
    assert reports.forecast_explorer(table, ["A"], month(2), None).count() == 2
    assert reports.forecast_explorer(table, None, None, month(1)).count() == 2
    assert reports.for_product(table, "B").count() == 1
    assert rows(reports.product_mae(table), "Description") == [("A", 2.0), ("B", 0.0)]


@pytest.fixture(scope="module")
def small_predictions(spark):
    pairs = [(1, 0), (1, 1), (0, 0), (2, 0), (2, 2)]
    return spark.createDataFrame(
        [(float(a), float(p)) for a, p in pairs], "label double, prediction double"
    )


def test_classification_metrics_match_the_evaluator(small_predictions):
    ours = metrics.classification_metrics(small_predictions, "label", "prediction", places=9).first()
    for name in ("accuracy", "f1", "weightedPrecision", "weightedRecall"):
        theirs = MulticlassClassificationEvaluator(metricName=name).evaluate(small_predictions)
        assert ours[name] == pytest.approx(theirs, abs=1e-8)
    assert (ours.accuracy, round(ours.f1, 5)) == (0.6, 0.63333)


def test_regression_metrics_match_the_evaluator(spark):
    table = spark.createDataFrame([(1.0, 3.5), (10.0, 6.0), (4.0, 4.0)], "label double, prediction double")
    ours = metrics.regression_metrics(table, "label").first()
    for name, key in (("rmse", "RMSE"), ("mae", "MAE")):
        assert ours[key] == round(RegressionEvaluator(metricName=name).evaluate(table), 2)


def test_match_labels(spark):
    table = spark.createDataFrame(
        [("Increase", "Increase"), ("Reduce", "Increase"), ("Reduce", None)],
        "stock_decision string, predicted_label string",
    )
    assert rows(reports.match_counts(table), "Match") == [("Correct", 1), ("Wrong", 2)]


def test_frequency_index_matches_the_string_indexer(spark):
    names = [f"P{i % 37:02d}" for i in range(500)] + ["P05", "P31", None]
    table = spark.createDataFrame([(n,) for n in names], "Description string")
    model = StringIndexer(inputCol="Description", outputCol="i", handleInvalid="skip").fit(table)
    index = encode.product_index(table).orderBy("DescriptionIndex").collect()
    assert [r.Description for r in index] == list(model.labels)
    assert [r.DescriptionIndex for r in index] == list(range(37))


def test_frequency_index_over_many_partitions(spark):
    table = spark.range(3000).select(F.concat(F.lit("P"), F.col("id") % 1000).alias("Description"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = encode.product_index(table)
        assert [r.Description for r in index.orderBy("DescriptionIndex").collect()] == sorted(
            f"P{i}" for i in range(1000)
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_split_depends_on_the_key_only(spark):
    table = spark.range(4000).select(
        F.concat(F.lit("P"), F.col("id") % 100).alias("Description"),
        F.add_months(F.lit(month(1)), (F.col("id") / 100).cast("int")).alias("InvoiceMonth"),
    )
    one = split.split_by_key(table.coalesce(1), split.REGRESSION_PARTS)
    many = split.split_by_key(table.repartition(7), split.REGRESSION_PARTS)
    assert one.exceptAll(many).count() == 0
    shares = {r.split: r["count"] / 4000 for r in one.groupBy("split").count().collect()}
    for name, share in split.REGRESSION_PARTS.items():
        assert shares[name] == pytest.approx(share, abs=0.03)
    parts = split.random_split(table, split.INVENTORY_PARTS)
    assert sum(part.count() for part in parts) == 4000


def test_correlation_ignores_incomplete_pairs(spark):
    table = spark.createDataFrame(
        [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (9.0, None)], "a double, b double"
    )
    found = {(r.col_a, r.col_b): r["corr"] for r in stats.feature_correlation(table, ["a", "b"], 6).collect()}
    assert found == {("a", "a"): 1.0, ("a", "b"): 1.0, ("b", "a"): 1.0, ("b", "b"): 1.0}
    matrix = stats.correlation_matrix(table, ["a", "b"])
    assert matrix.columns == ["col_a", "a", "b"] and matrix.count() == 2


@pytest.fixture(scope="module")
def documents(spark):
    names = ["SET OF THE CAKES", "set of tins", "RED  TIN", "CAKE TIN"]
    months = {"SET OF THE CAKES": 3, "set of tins": 2, "RED  TIN": 1, "CAKE TIN": 4}
    table = spark.createDataFrame(
        [(n, month(m + 1)) for n in names for m in range(months[n])] + [(None, month(1))],
        "Description string, InvoiceMonth date",
    )
    return text.descriptions(table)


def test_tokens_lose_stop_words_and_keep_empty_ones(documents):
    found = {r.Description: r.filtered for r in text.tokens(documents).collect()}
    assert found == {
        "SET OF THE CAKES": ["set", "cakes"],
        "set of tins": ["set", "tins"],
        "RED  TIN": ["red", "", "tin"],
        "CAKE TIN": ["cake", "tin"],
    }


def test_vocabulary_counts_rows(documents):
    vocab = text.vocabulary(text.tokens(documents), "filtered", size=10, min_documents=4)
    assert rows(vocab) == [("set", 5, 5), ("tin", 5, 5), ("cake", 4, 4)]


def test_phrases_have_one_or_two_words(documents):
    found = {r.Description: r.terms for r in text.phrases(documents).collect()}
    assert found["SET OF THE CAKES"] == ["set", "cakes", "set cakes"]
    assert found["RED  TIN"] == ["red", "tin", "red tin"]


def test_phrase_vectors_have_unit_length(documents):
    docs = text.phrases(documents)
    vocab = [(r.term, r.idf) for r in text.phrase_vocabulary(docs).collect()]
    for row in text.tfidf_vectors(docs, vocab, "v").collect():
        assert row.v.norm(2) == pytest.approx(1.0)


def test_plain_text(spark):
    table = spark.createDataFrame([("Ab",), (None,)], "d string")
    found = table.select(text_functions.plain_text(F.col("d")).alias("t")).collect()
    assert [r.t for r in found] == ["ab", ""]
