"""Scans and sinks on files."""

from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from shelfcast import schema
from shelfcast.operators import audit, clean, gate, rollup
from shelfcast.plans import jobs
from shelfcast.sources import tables
from shelfcast.sources.holidays import read_holidays
from shelfcast.sources.transactions import UNREADABLE, read_transactions, readable, rejects

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
PAIR = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.DoubleType())])


def test_transaction_file(spark, tmp_path):
    (tmp_path / "tx.csv").write_text(
        HEADER
        + '1,A,"THE ""BIG"" BOX",2,2010-03-17 09:30:00,1.25,13085.0,UK\n'
        + "C2,A,MUG ,-1,2010-03-17 09:30:00,1.25,13085.0,UK\n"
        + "3,A,RED  BOX,x,2010-03-17 09:30:00,1.25,13085.0,UK\n"
        + "4,A,MUG,1,2010-03-18 10:00:00,1.0,,UK\n"
    )
    tx = read_transactions(spark, str(tmp_path / "tx.csv"))
    assert tx.count() == 4
    only = clean.clean_transactions(tx).collect()
    assert [(r.Description, r.TotalPrice, r.InvoiceDate) for r in only] == [
        ('THE "BIG" BOX', 2.5, date(2010, 3, 17))
    ]


def test_unreadable_lines_are_kept_apart_and_counted(spark, tmp_path):
    (tmp_path / "tx.csv").write_text(
        HEADER
        + "1,A,MUG,2,2010-03-17 09:30:00,1.25,1,UK\n"
        + "2,A,MUG,x,2010-03-17 09:30:00,1.25,1,UK\n"
        + "3,A,MUG,1,12/1/2009 7:45,2.00,1,UK\n"
        + "4,A,MUG,1,2010-03-17 09:30:00,1.25,,UK\n"
    )
    tx = read_transactions(spark, str(tmp_path / "tx.csv"), keep_unreadable=True)
    assert [r.Invoice for r in rejects(tx).select("Invoice").collect()] == ["2", "3"]
    assert rejects(tx).filter("Invoice = '2'").first()[UNREADABLE].startswith("2,A,MUG,x,")
    assert readable(tx).select("Description").count() == 2  # a missing customer is no error
    stages = jobs.Stages(str(tmp_path / "out"))
    assert jobs.monthly_job(tx, stages) == {"rejects": 2, "monthly_sales": 1}


def test_columnar_transactions_push_the_cleaning_filters(spark, tmp_path):
    (tmp_path / "tx.csv").write_text(HEADER + "1,A,MUG,2,2010-03-17 09:30:00,1.25,13085.0,UK\n")
    read_transactions(spark, str(tmp_path / "tx.csv")).write.parquet(str(tmp_path / "tx"))
    tx = clean.clean_transactions(read_transactions(spark, str(tmp_path / "tx"), fmt="parquet"))
    plan = tx.select("TotalPrice")._jdf.queryExecution().executedPlan().toString()
    for pushed in ("GreaterThan(Quantity,0.0)", "IsNotNull(`Customer ID`)", "Not(StringStartsWith(Invoice,C))"):
        assert pushed in plan
    assert "StockCode" not in plan.split("ReadSchema")[1]
    assert tx.first().TotalPrice == 2.5


def test_fractions_and_fine_prices_are_kept(spark, tmp_path):
    (tmp_path / "tx.csv").write_text(
        HEADER
        + "1,A,MUG,2.5,2010-03-17 09:30:00,2.00,1,UK\n"
        + "2,A,NUT,1000000,2010-03-17 09:30:00,0.00004,1,UK\n"
        + "3,A,TEA,0.5,2010-03-17 09:30:00,2.00,1,UK\n"
        + "4,A,LOST,1,12/1/2009 7:45,2.00,1,UK\n"
    )
    sales = clean.clean_transactions(read_transactions(spark, str(tmp_path / "tx.csv")))
    assert rollup.monthly_totals(sales).count() == 3  # the line without a date is in no month
    found = sales.filter("InvoiceDate IS NOT NULL").collect()
    assert [(r.Description, r.Quantity, r.TotalPrice) for r in found] == [
        ("MUG", 2.5, 5.0),
        ("NUT", 1_000_000.0, 40.0),
        ("TEA", 0.5, 1.0),
    ]
    named = read_transactions(spark, str(tmp_path / "tx.csv"), timestamp_format="M/d/yyyy H:mm")
    dated = clean.clean_transactions(named).filter("InvoiceDate IS NOT NULL")
    assert [r.Description for r in dated.collect()] == ["LOST"]


def test_other_header_is_an_error(spark, tmp_path):
    (tmp_path / "tx.csv").write_text(HEADER.replace("Price", "Amount") + "1,A,B,1,2010-01-01,1,1,UK\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_transactions(spark, str(tmp_path / "tx.csv")).collect()


def test_calendar_file(spark, tmp_path):
    (tmp_path / "h.csv").write_text(
        "Year,Date,Day,Name,Type,Details\n2010,Dec 25,Saturday,Christmas Day,Bank Holiday,\n"
    )
    only = read_holidays(spark, str(tmp_path / "h.csv")).first()
    assert (only.Year, only.Date, only.Name, only.Details) == (2010, "Dec 25", "Christmas Day", None)


def test_quotes_survive_the_csv_sink(spark, tmp_path):
    names = ['PLAIN', 'COMMA, INSIDE', 'THE "BIG" BOX', '"QUOTED"']
    df = spark.createDataFrame([(n, 1.5) for n in names], PAIR)
    path = str(tmp_path / "out")
    tables.write_stage(df, path, "csv")
    assert sorted(r.k for r in tables.read_stage(spark, path, PAIR, "csv").collect()) == sorted(names)
    assert sorted(r.k for r in tables.read_tolerant(spark, path, PAIR).collect()) == sorted(names)


def test_overwrite_sort_and_single_file(spark, tmp_path):
    path = tmp_path / "out"
    df = spark.createDataFrame([(k, 1.0) for k in "dacb"], PAIR).repartition(4)
    tables.write_stage(df, str(path))
    tables.write_stage(df, str(path), "csv", ["k"], single_file=True)
    files = list(path.glob("part-*"))
    assert len(files) == 1
    assert files[0].read_text().split() == ["k,v", "a,1.0", "b,1.0", "c,1.0", "d,1.0"]
    tables.write_stage(df, str(path), sort_by=["k"])
    assert tables.read_stage(spark, str(path), PAIR).count() == 4


def test_tolerant_scan(spark, tmp_path):
    (tmp_path / "part-0.csv").write_text("k,v\na,1.5\nb,1.5,extra\nc\nd,n/a\n")
    (tmp_path / "part-1.csv").write_text("k,v\ne,2.5\n")
    found = tables.read_tolerant(spark, str(tmp_path), PAIR).orderBy("k").collect()
    assert [tuple(r) for r in found] == [("a", 1.5), ("c", None), ("d", None), ("e", 2.5)]


def test_missing_tables(spark, tmp_path):
    gone = str(tmp_path / "gone")
    empty = tables.read_tolerant(spark, gone, PAIR)
    assert empty.columns == ["k", "v"] and empty.count() == 0
    assert tables.read_or_empty(spark, gone, schema.FEATURES).schema.names == schema.FEATURES.names
    assert tables.read_metrics(spark, gone, schema.REGRESSION_METRICS).count() == 0
    with pytest.raises(AnalysisException):
        tables.read_stage(spark, gone, PAIR)


def test_metric_document(spark, tmp_path):
    path = str(tmp_path / "metrics")
    one = spark.createDataFrame([(1.25, 0.5, (20, 5))], schema.REGRESSION_METRICS)
    tables.write_metrics(one, path)
    back = tables.read_metrics(spark, path, schema.REGRESSION_METRICS).first()
    assert (back.RMSE, back.MAE, tuple(back["Best Hyperparameters"])) == (1.25, 0.5, (20, 5))


def test_header_and_column_gate(spark):
    df = spark.createDataFrame([("a", 1.0)], PAIR).toDF(" k", "v ")
    tidy = tables.tidy_header(df)
    assert tidy.columns == ["k", "v"]
    assert gate.check(tidy, "s", [gate.column("k")]).passed
    assert gate.check(tidy, "s", [gate.column("k"), gate.filled("z")]).reason == "z is filled: 1 broken"
    assert gate.check(tidy.limit(0), "s", [gate.column("k")]).reason == "is not empty: 1 broken"
    assert gate.check(tidy.limit(0), "s", [gate.column("k")], allow_empty=True).passed
    assert not gate.check(tidy, "s", [gate.of_type("v", "string"), gate.numeric("k")]).passed


@pytest.mark.parametrize("options", [{}, {"sort_by": ["k"]}, {"sort_by": ["k"], "single_file": True}])
@pytest.mark.parametrize("n", [0, 123])
def test_rows_are_counted_once(spark, tmp_path, options, n):
    df = spark.range(n).selectExpr("CAST(id AS STRING) AS k", "1.0D AS v").repartition(3)
    written = tables.write_stage(df, str(tmp_path / "out"), **options)
    assert written == n == tables.read_stage(spark, str(tmp_path / "out"), PAIR).count()
    table = audit.audit_table(spark, {"out": written})
    assert [tuple(r) for r in table.collect()] == [("out", n)]


def test_empty_table_is_written(spark, tmp_path):
    assert tables.write_stage(tables.empty_table(spark, PAIR), str(tmp_path / "none")) == 0
