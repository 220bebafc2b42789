"""Random series against plain Python arithmetic."""

from datetime import date
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.functions import money
from shelfcast.operators import features, rollup

RELAXED = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
CENTS = st.integers(-10_000_000, 10_000_000)


@RELAXED
@given(amounts=st.lists(CENTS, min_size=1, max_size=40))
def test_totals_and_means_are_exact(spark, amounts):
    df = spark.createDataFrame([(a / 100,) for a in amounts], "x double").repartition(3)
    found = df.agg(
        money.from_units(money.sum_units("x")).alias("total"),
        money.mean_to_cents(money.sum_units("x"), F.count("x")).alias("mean"),
    ).first()
    exact = sum(Decimal(a) for a in amounts) / 100
    mean = (exact / len(amounts)).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert found.total == float(exact)
    assert found.mean == float(mean)


SALES = st.lists(
    st.tuples(st.sampled_from("ABC"), st.integers(1, 12), st.integers(1, 100_000)),
    min_size=1,
    max_size=60,
)


@RELAXED
@given(sales=SALES, n=st.integers(1, 3))
def test_monthly_features_by_hand(spark, sales, n):
    lines = spark.createDataFrame(
        [(p, date(2010, m, 1), c / 100) for p, m, c in sales],
        "Description string, InvoiceMonth date, TotalPrice double",
    )
    totals: dict[str, dict[int, int]] = {}
    for product, month, cents in sales:
        series = totals.setdefault(product, {})
        series[month] = series.get(month, 0) + cents
    best = sorted(totals, key=lambda p: (-sum(totals[p].values()), p))[:n]
    expected = set()
    for product in best:
        months = sorted(totals[product])
        values = [totals[product][m] for m in months]
        for i in range(1, len(months)):
            window = values[max(0, i - 2) : i + 1]
            expected.add(
                (product, months[i], values[i] / 100, values[i - 1] / 100, sum(window) / (len(window) * 100))
            )
    table = features.series_features(rollup.monthly_sales(lines, n))
    wanted = ["Description", "Month", "TotalPrice", "prev_month_sales", "rolling_3m_avg"]
    assert {tuple(r) for r in table.select(*wanted).collect()} == expected
