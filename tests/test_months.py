"""Stages kept by month: batch after batch they equal a run over all lines."""

import os
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import clean, features, holidays, rollup
from shelfcast.plans import jobs, months
from shelfcast.sources.holidays import uk_bank_holidays

COLUMNS = (
    "Invoice string, StockCode string, Description string, Quantity int, InvoiceDate timestamp, "
    "Price double, `Customer ID` string, Country string"
)


def line(product, month, price, invoice="1"):
    when = None if month is None else f"{month}-15 10:00:00"
    return (invoice, "s", product, 1, when, float(price), "7", "UK")


def lines(spark, rows):
    text = COLUMNS.replace("InvoiceDate timestamp", "InvoiceDate string")
    return spark.createDataFrame(rows, text).withColumn("InvoiceDate", F.to_timestamp("InvoiceDate"))


@pytest.fixture(scope="module")
def calendar(spark):
    return holidays.holiday_months(holidays.parse_calendar(uk_bank_holidays(spark)))


def whole(spark, rows, calendar, n=None):
    monthly = rollup.monthly_sales(clean.clean_transactions(lines(spark, rows)), n)
    return counted(features.label_stock_decision(features.build_features(monthly, calendar)))


def counted(df):
    return Counter(map(tuple, df.select(*sorted(df.columns)).collect()))


def files(root):
    found = {}
    for folder, _, names in os.walk(root):
        if "product_" in folder:
            for name in names:
                if name.endswith(".parquet"):
                    found.setdefault(os.path.relpath(folder, root), set()).add(name)
    return found


def base():
    rows = []
    for k in range(12):
        rows += [line(p, f"2010-{k + 1:02d}", 10 * k + i + 1) for i, p in enumerate("abc") if (k + i) % 3]
    rows += [line("rare", "2010-01", 5), line("rare", "2010-03", 9), line(None, "2010-02", 3)]
    return [*rows, line("a", None, 3), line("a", "2010-05", 99, "C1")]


def test_one_more_month_writes_that_month_alone(spark, calendar, tmp_path):
    tables = months.MonthTables(str(tmp_path))
    first, more = base(), [line("a", "2011-01", 50), line("rare", "2011-01", 4), line("new", "2011-01", 6)]
    months.update(lines(spark, first), tables, "b1", calendar)
    assert counted(tables.features(spark)) == whole(spark, first, calendar)
    before = files(tmp_path)
    done = months.update(lines(spark, more), tables, "b2", calendar)
    assert set(map(tuple, done.values())) == {(date(2011, 1, 1),)}
    after = files(tmp_path)
    assert {k for k in after if before.get(k) != after[k]} == {
        f"{t}/InvoiceMonth=2011-01-01" for t in ("product_months", "product_features")
    }
    assert counted(tables.features(spark)) == whole(spark, first + more, calendar)
    assert counted(tables.features(spark, 2)) == whole(spark, first + more, calendar, 2)


def test_late_lines_rewrite_what_they_reach(spark, calendar, tmp_path):
    tables = months.MonthTables(str(tmp_path))
    late = [line("b", "2010-06", 70), line("early", "2009-11", 2)]
    months.update(lines(spark, base()), tables, "b1", calendar)
    done = months.update(lines(spark, late), tables, "b2", calendar)
    assert done["product_months"] == [date(2009, 11, 1), date(2010, 6, 1)]
    # b is active in 5, 6, 8 and 9: its own month and the two active ones after it
    assert done["product_features"] and set(done["product_features"]) <= {
        date(2010, m, 1) for m in range(6, 10)
    }
    assert counted(tables.features(spark)) == whole(spark, base() + late, calendar)
    again = months.update(lines(spark, late), tables, "b2", calendar)
    assert again["product_months"] == [] and again["product_features"] == []


def test_a_batch_run_again_replaces_its_former_lines(spark, calendar, tmp_path):
    tables = months.MonthTables(str(tmp_path))
    months.update(lines(spark, base()), tables, "b1", calendar)
    wrong = [line("a", "2011-01", 1), line("a", "2011-02", 2), line("ghost", "2010-04", 8)]
    right = [line("a", "2011-02", 20)]
    months.update(lines(spark, wrong), tables, "b2", calendar)
    assert counted(tables.features(spark)) == whole(spark, base() + wrong, calendar)
    done = months.update(lines(spark, right), tables, "b2", calendar)
    assert date(2011, 1, 1) in done["product_features"]
    assert counted(tables.features(spark)) == whole(spark, base() + right, calendar)
    months.update(lines(spark, []), tables, "b2", calendar)
    assert counted(tables.features(spark)) == whole(spark, base(), calendar)


def test_a_run_cut_off_is_repeated(spark, calendar, tmp_path, monkeypatch):
    tables = months.MonthTables(str(tmp_path))
    months.update(lines(spark, base()), tables, "b1", calendar)
    more = [line("a", "2010-07", 44), line("c", "2011-01", 5)]
    write = months._write

    for cut in ("product_features", "product_months"):

        def broken(df, path, *rest):
            if path.endswith(cut):
                raise OSError("lost")
            write(df, path, *rest)

        monkeypatch.setattr(months, "_write", broken)
        with pytest.raises(OSError):
            months.update(lines(spark, more), tables, "b2", calendar)
    monkeypatch.setattr(months, "_write", write)
    months.update(lines(spark, more), tables, "b2", calendar)
    assert counted(tables.features(spark)) == whole(spark, base() + more, calendar)


def test_the_update_job_writes_the_stages_of_a_whole_run(spark, calendar, tmp_path):
    rows = base()
    parts, full = jobs.Stages(str(tmp_path / "parts")), jobs.Stages(str(tmp_path / "full"))
    jobs.update_job(lines(spark, rows[:20]), parts, "b1", uk_bank_holidays(spark), 3)
    jobs.update_job(lines(spark, rows[20:]), parts, "b2", uk_bank_holidays(spark), 3)
    jobs.monthly_job(lines(spark, rows), full, 3)
    jobs.features_job(spark, full, uk_bank_holidays(spark))
    for name in ("monthly_sales", "features_with_labels", "features"):
        ours, theirs = (spark.read.parquet(s.path(name)) for s in (parts, full))
        assert ours.columns == theirs.columns and counted(ours) == counted(theirs)


def test_nothing_and_bad_names(spark, calendar, tmp_path):
    tables = months.MonthTables(str(tmp_path))
    done = months.update(lines(spark, [line("a", None, 1)]), tables, "b1", calendar)
    assert not any(done.values()) and tables.features(spark).count() == 0
    with pytest.raises(ValueError):
        months.update(lines(spark, []), tables, "a/b", calendar)


def test_months_are_partition_filters(spark, calendar, tmp_path):
    tables = months.MonthTables(str(tmp_path))
    months.update(lines(spark, base()), tables, "b1", calendar)
    pruned = tables.totals(spark).filter(months._among([date(2010, 5, 1)]))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(InvoiceMonth" in plan and pruned.inputFiles()
    assert {r[0] for r in pruned.select(F.input_file_name()).distinct().collect()} <= {
        f for f in pruned.inputFiles() if "2010-05-01" in f
    }
