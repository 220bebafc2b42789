"""SQL each registered query must agree with, written for DuckDB.

Money is kept in whole cents, which the test tables hold exactly. Queries without an
entry are iterative (forests, k-means); their inputs and their metrics are covered here.
"""

from __future__ import annotations

from checks import forests, kmeans
from checks.queries import CHOSEN_PRODUCTS, EXPLORED, SPOILT_EVERY, TOP_CUT
from shelfcast.operators import centers
from shelfcast.operators.clusters import CLUSTERS, TERMS_PER_CLUSTER
from shelfcast.operators.encode import INVENTORY_INPUTS, REGRESSION_INPUTS
from shelfcast.operators.rollup import TOP_PRODUCTS
from shelfcast.operators.stats import CORRELATED
from shelfcast.sources.holidays import UK_BANK_HOLIDAYS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_HOLIDAY_VALUES = ",\n    ".join(
    f"({year}, {_text(day)}, {_text(name)})" for year, day, _, name in UK_BANK_HOLIDAYS
)
_CHOSEN = ", ".join(_text(name) for name in CHOSEN_PRODUCTS)

# Named pieces in dependency order; a query lists the last piece it needs.
_PIECES = {
    "tx": """
  SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS invoice,
         trim(p_type || ' ' || p_name) AS description,
         CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l_quantity AS DOUBLE) AS quantity,
         CAST(round(p_retailprice * 100) AS BIGINT) AS price,
         CASE WHEN o_custkey % 50 <> 0 THEN o_custkey END AS customer,
         CAST(CAST(o_orderdate AS DATE) + INTERVAL 168 MONTH AS DATE) AS day
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey""",
    "lines": """
  SELECT invoice, description, quantity, quantity * price AS cents, day,
         CAST(date_trunc('month', day) AS DATE) AS month,
         invoice NOT LIKE 'C%' AND quantity > 0 AND price > 0 AND customer IS NOT NULL AS is_clean
  FROM tx""",
    "clean": "SELECT * FROM lines WHERE is_clean",
    "revenue": """
  SELECT description, CAST(sum(cents) AS BIGINT) AS cents FROM clean GROUP BY description""",
    "totals": """
  SELECT description, month, CAST(sum(cents) AS BIGINT) AS cents
  FROM clean GROUP BY description, month""",
    "monthly": f"""
  SELECT * FROM totals WHERE description IN
    (SELECT description FROM revenue ORDER BY cents DESC, description LIMIT {TOP_PRODUCTS})""",
    "holidays": f"""
  SELECT name, CAST(strptime(CAST(y AS VARCHAR) || ' ' || d, '%Y %b %d') AS DATE) AS day
  FROM (VALUES
    {_HOLIDAY_VALUES}) AS h(y, d, name)""",
    "calendar": """
  SELECT name, day, CAST(date_trunc('month', day) AS DATE) AS month FROM holidays""",
    "holiday_months": "SELECT DISTINCT month FROM calendar",
    "windowed": """
  SELECT description, month, cents,
         lag(cents) OVER (PARTITION BY description ORDER BY month) AS prev,
         CAST(sum(cents) OVER w AS BIGINT) AS cents3, count(*) OVER w AS n3
  FROM monthly
  WINDOW w AS (PARTITION BY description ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "valued": """
  SELECT description, month, cents, CAST(cents AS DOUBLE) / 100 AS sales,
         CAST(prev AS DOUBLE) / 100 AS prev,
         CAST(cents3 AS DOUBLE) / CAST(n3 * 100 AS DOUBLE) AS mean3
  FROM windowed WHERE prev IS NOT NULL""",
    "features": """
  SELECT description AS "Description", strftime(month, '%Y-%m-%d') AS "InvoiceMonth",
         sales AS "TotalPrice",
         CAST(year(month) AS INTEGER) AS "Year", CAST(month(month) AS INTEGER) AS "Month",
         prev AS prev_month_sales, mean3 AS rolling_3m_avg, sales - mean3 AS sales_delta,
         CASE WHEN month IN (SELECT month FROM holiday_months) THEN 1 ELSE 0 END AS is_holiday_month,
         month AS month_start, cents
  FROM valued""",
    "labeled": """
  SELECT *, CASE WHEN "TotalPrice" > rolling_3m_avg * 1.2::DOUBLE THEN 'Increase'
                 WHEN "TotalPrice" < rolling_3m_avg * 0.8::DOUBLE THEN 'Reduce'
                 ELSE 'Maintain' END AS stock_decision
  FROM features""",
    "baseline": """
  SELECT "Description", "InvoiceMonth", "TotalPrice", prev_month_sales AS prediction, stock_decision,
         CASE WHEN prev_month_sales > rolling_3m_avg * 1.2::DOUBLE THEN 'Increase'
              WHEN prev_month_sales < rolling_3m_avg * 0.8::DOUBLE THEN 'Reduce'
              ELSE 'Maintain' END AS predicted_label
  FROM labeled""",
    "matched": """
  SELECT *, CASE WHEN stock_decision = predicted_label THEN 'Correct' ELSE 'Wrong' END AS match
  FROM baseline""",
    "quarterly": """
  SELECT "Description", 'Q' || CAST(quarter(month_start) AS VARCHAR) AS "Quarter",
         CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS BIGINT) AS mean_cents
  FROM features GROUP BY ALL""",
    "quarter_score": """
  SELECT "Description", CAST(sum(mean_cents) AS BIGINT) AS score_cents
  FROM quarterly GROUP BY "Description\"""",
    "heatmap_keys": """
  SELECT "Description" FROM quarter_score ORDER BY score_cents DESC, "Description" LIMIT 12""",
    "seasonal": """
  SELECT "Description", CAST("Year" AS VARCHAR) AS "Year", "Month",
         CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_monthly_sales
  FROM features WHERE "Month" IN (1, 12) GROUP BY ALL""",
    "products_sold": """
  SELECT description AS "Description", sum(quantity) AS total_quantity,
         CAST(sum(cents) AS DOUBLE) / 100 AS total_sales
  FROM lines WHERE month IN (SELECT month FROM holiday_months) GROUP BY description""",
    "product_rank": """
  SELECT "Description", count(*) AS n_rows,
         row_number() OVER (ORDER BY count(*) DESC, "Description") - 1 AS "DescriptionIndex"
  FROM features GROUP BY "Description\"""",
    "confused": """
  SELECT stock_decision AS actual, predicted_label AS predicted, count(*) AS n_rows
  FROM baseline GROUP BY ALL""",
    "classes": """
  SELECT c, sum(a) AS a, sum(p) AS p, sum(tp) AS tp FROM (
    SELECT actual AS c, n_rows AS a, 0 AS p,
           CASE WHEN actual = predicted THEN n_rows ELSE 0 END AS tp FROM confused
    UNION ALL SELECT predicted, 0, n_rows, 0 FROM confused) GROUP BY c""",
    "scores": """
  SELECT round(sum(tp) / sum(a), 4) AS accuracy,
         round(sum(a * (2 * tp / (a + p))) / sum(a), 4) AS f1,
         round(sum(a * CASE WHEN p > 0 THEN tp / p ELSE 0 END) / sum(a), 4) AS "weightedPrecision",
         round(sum(tp) / sum(a), 4) AS "weightedRecall"
  FROM classes""",
    # The test vocabulary holds no stop word, so the filter has nothing to remove here;
    # it is covered by a fixture in the tests.
    "docs": """
  SELECT "Description", count(*) AS n_rows, lower("Description") AS plain
  FROM labeled GROUP BY "Description\"""",
    "tokens": """
  SELECT "Description", n_rows, unnest(string_split_regex(plain, '\\s')) AS token,
         generate_subscripts(string_split_regex(plain, '\\s'), 1) - 1 AS position
  FROM docs""",
    "vocabulary": """
  SELECT token AS term, CAST(sum(n_rows) AS BIGINT) AS occurrences,
         CAST(sum(CASE WHEN first THEN n_rows ELSE 0 END) AS BIGINT) AS documents
  FROM (SELECT *, row_number() OVER (PARTITION BY "Description", token ORDER BY position) = 1 AS first
        FROM tokens)
  GROUP BY token HAVING sum(CASE WHEN first THEN n_rows ELSE 0 END) >= 5
  ORDER BY occurrences DESC, term LIMIT 1000""",
    "words": """
  SELECT "Description", n_rows, unnest(regexp_extract_all(plain, '\\b\\w\\w+\\b')) AS word,
         generate_subscripts(regexp_extract_all(plain, '\\b\\w\\w+\\b'), 1) AS position
  FROM docs""",
    "phrases": """
  SELECT "Description", n_rows, word AS term FROM words
  UNION ALL
  SELECT a."Description", a.n_rows, a.word || ' ' || b.word
  FROM words a JOIN words b ON a."Description" = b."Description" AND b.position = a.position + 1""",
    "phrase_vocabulary": """
  SELECT term, CAST(sum(n_rows * n) AS BIGINT) AS occurrences,
         CAST(sum(n_rows) AS BIGINT) AS documents
  FROM (SELECT "Description", term, n_rows, count(*) AS n FROM phrases GROUP BY ALL)
  GROUP BY term ORDER BY occurrences DESC, term LIMIT 100""",
    "phrase_idf": """
  SELECT term, occurrences, documents,
         ln(((SELECT sum(n_rows) FROM docs) + 1) / (documents + 1)) + 1 AS idf
  FROM phrase_vocabulary""",
    "phrase_weights": """
  SELECT "Description", term, count(*) * any_value(idf) AS w
  FROM phrases JOIN phrase_idf USING (term) GROUP BY "Description", term""",
}


def _query(last: str, body: str) -> str:
    """``WITH`` every piece up to ``last``, then ``body``."""
    names = list(_PIECES)
    used = names[: names.index(last) + 1]
    return "WITH " + ",\n".join(f"{name} AS ({_PIECES[name]})" for name in used) + "\n" + body


_CLEAN_LINES = """
SELECT invoice AS "Invoice", description AS "Description", quantity AS "Quantity",
       CAST(cents AS DOUBLE) / 100 AS "TotalPrice",
       strftime(day, '%Y-%m-%d') AS "InvoiceDate", strftime(month, '%Y-%m-%d') AS "InvoiceMonth"
FROM clean"""

_MONTHLY = """
SELECT description AS "Description", strftime(month, '%Y-%m-%d') AS "InvoiceMonth",
       CAST(cents AS DOUBLE) / 100 AS "TotalPrice"
FROM """

_LABELED = 'SELECT * EXCLUDE (month_start, cents) FROM labeled'


_REGRESSION = [("train", 0.70), ("validation", 0.15), ("test", 0.15)]
_INVENTORY = [("train", 0.80), ("test", 0.20)]


def _split(
    piece: str,
    parts: list[tuple[str, float]],
    columns: str = '"Description", "InvoiceMonth"',
) -> str:
    *named, (last, _) = parts
    cases, bound = [], 0.0
    for name, share in named:
        bound = round(bound + share, 10)
        cases.append(f"WHEN position < {bound}::DOUBLE THEN '{name}'")
    return _query(
        piece,
        f"""
SELECT {columns}, CASE {' '.join(cases)} ELSE '{last}' END AS split
FROM (SELECT *, CAST(CAST('0x' || substr(md5("Description" || '|' || "InvoiceMonth"), 1, 8) AS BIGINT)
                     AS DOUBLE) / 4294967296 AS position FROM {piece})""",
    )


def _test_part(piece: str, parts: list[tuple[str, float]], body: str) -> str:
    """``body`` over ``t``, the rows of the test part."""
    return f"""WITH t AS (SELECT * FROM ({_split(piece, parts, '*')}) WHERE split = 'test')
{body}"""


def _forest(model: forests.Model, body: str) -> str:
    grown = ",\n".join(
        f"{name} AS MATERIALIZED ({piece})" for name, piece in forests.pieces(model).items()
    )
    return _query(model.source, "").rstrip() + ",\n" + grown + "\n" + body


def _clusters(last: str, entries: str, vocabulary: str, scale: int, body: str) -> str:
    steps = kmeans.pieces(entries, vocabulary, scale).items()
    taken = ",\n".join(f"{name} AS MATERIALIZED ({piece})" for name, piece in steps)
    return _query(last, "").rstrip() + ",\n" + taken + "\n" + body


def _tfidf_clusters(body: str) -> str:
    return _clusters("phrase_weights", kmeans.WEIGHTS, "phrase_idf", centers.SCALE, body)


def _count_clusters(body: str) -> str:
    return _clusters("vocabulary", kmeans.COUNTS, "vocabulary", 1, body)


def _vector(inputs: list[str]) -> str:
    columns = ", ".join(f'CAST("{name}" AS DOUBLE) AS f{i}' for i, name in enumerate(inputs))
    return _query(
        "product_rank",
        f'SELECT "Description", "InvoiceMonth", {columns} '
        'FROM features JOIN product_rank USING ("Description")',
    )


def _correlations(places: int) -> str:
    def r(a: str, b: str) -> str:
        return f'round(corr(CAST("{a}" AS DOUBLE), CAST("{b}" AS DOUBLE)), {places})'

    rows = [
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r(a, b)} AS corr FROM labeled"
        for a in CORRELATED
        for b in CORRELATED
    ]
    return _query("labeled", " UNION ALL\n".join(rows))


def _correlation_matrix() -> str:
    rows = [
        f"SELECT '{a}' AS col_a, "
        + ", ".join(
            f'round(corr(CAST("{a}" AS DOUBLE), CAST("{b}" AS DOUBLE)), 2) AS "{b}"'
            for b in CORRELATED
        )
        + " FROM labeled"
        for a in CORRELATED
    ]
    return _query("labeled", " UNION ALL\n".join(rows))


def _pivot(key: str, pivoted: str, values: list[str], source: str) -> str:
    columns = ", ".join(
        f"max(CASE WHEN \"{pivoted}\" = {_text(v)} THEN CAST(mean_cents AS DOUBLE) / 100 END) AS \"{v}\""
        for v in values
    )
    return f'SELECT "{key}", {columns} FROM {source} GROUP BY "{key}"'


_CENTERS = """
SELECT c::INTEGER AS "NLP_Category", term, s AS sum, w AS weight FROM final JOIN terms USING (j)"""

_TUNING = """
SELECT "numTrees"::INTEGER AS "numTrees", "maxDepth"::INTEGER AS "maxDepth", round(score, 4) AS score,
       b."numTrees" IS NOT NULL AS best
FROM grid LEFT JOIN best b USING ("numTrees", "maxDepth")"""

_STOCK_METRICS = """,
c AS (
  SELECT x AS c, count(*) FILTER (stock_decision = x) AS a, count(*) FILTER (predicted_label = x) AS p,
         count(*) FILTER (stock_decision = x AND predicted_label = x) AS tp
  FROM tested, (SELECT said AS x FROM label_names) GROUP BY x)
SELECT round(sum(tp) / sum(a), 4) AS accuracy, round(sum(a * (2 * tp / (a + p))) / sum(a), 4) AS f1,
       round(sum(a * CASE WHEN p > 0 THEN tp / p ELSE 0 END) / sum(a), 4) AS "weightedPrecision",
       round(sum(tp) / sum(a), 4) AS "weightedRecall"
FROM c"""


_GATES = """,
g(stage, rule, n_broken) AS (
  SELECT stage, rule, CASE
    WHEN stage = 'lacking' AND rule LIKE '%stock_decision%' THEN 1
    WHEN stage <> 'spoilt' THEN 0
    WHEN rule = 'InvoiceMonth is a month' THEN (SELECT count(*) FROM labeled WHERE "Month" = 2)
    WHEN rule LIKE 'stock_decision is%' THEN (SELECT count(*) FROM labeled WHERE stock_decision = 'Reduce')
    ELSE 0 END
  FROM (VALUES ('spoilt'), ('lacking'), ('empty')) s(stage),
       (VALUES ('has stock_decision'), ('Description is filled'), ('TotalPrice is a number'),
               ('InvoiceMonth is a month'), ('stock_decision is one of Increase, Maintain')) r(rule)
  UNION ALL SELECT 'overlong', 'avg_quarter_sales is a number', count(*) FROM quarterly WHERE "Quarter" = 'Q3'
  UNION ALL SELECT 'overlong', 'Quarter is one of Q1, Q2, Q3', 0
  UNION ALL SELECT 'missing', 'avg_quarter_sales is a number', 0
  UNION ALL SELECT 'missing', 'Quarter is one of Q1, Q2, Q3', 0
  UNION ALL SELECT stage, 'is not empty', (stage IN ('empty', 'missing'))::INTEGER
  FROM (VALUES ('spoilt'), ('lacking'), ('empty'), ('overlong'), ('missing')) s(stage))
SELECT stage, rule, n_broken::BIGINT AS n_broken, n_broken = 0 AS passed FROM g"""

_RUN_LOG = f""",
k AS (
  SELECT description, month, sum(cents) AS cents FROM clean
  WHERE CAST(invoice AS BIGINT) % {SPOILT_EVERY} <> 0 GROUP BY description, month),
m AS (
  SELECT * FROM k WHERE description IN (
    SELECT description FROM k GROUP BY description ORDER BY sum(cents) DESC, description LIMIT {TOP_PRODUCTS})),
n AS (SELECT count(*) AS kept, count(DISTINCT description) AS products FROM m),
l AS (SELECT count(*) AS lines, count(*) FILTER (
  CAST(ltrim(invoice, 'C') AS BIGINT) % {SPOILT_EVERY} = 0) AS rejects FROM tx)
SELECT run, stage, CASE stage WHEN 'monthly' THEN lines ELSE kept END::BIGINT AS rows_in,
       CASE stage WHEN 'monthly' THEN kept ELSE kept - products END::BIGINT AS rows_out,
       CASE stage WHEN 'monthly' THEN rejects END::BIGINT AS rejects
FROM n, l, (VALUES ('first'), ('second')) r(run), (VALUES ('monthly'), ('features')) s(stage)"""


def oracle_sql() -> dict[str, str]:
    heat = 'quarterly WHERE "Description" IN (SELECT "Description" FROM heatmap_keys)'
    return {
        "clean_transactions": _query("clean", _CLEAN_LINES),
        "transactions_csv_scan": _query("clean", _CLEAN_LINES),
        "transactions_rejects": _query(
            "tx",
            f"""
SELECT invoice LIKE 'C%' AS cancelled, count(*) AS n_lines FROM tx
WHERE CAST(ltrim(invoice, 'C') AS BIGINT) % {SPOILT_EVERY} = 0 GROUP BY ALL""",
        ),
        "transactions_spoilt": _query(
            "clean",
            _CLEAN_LINES + f"\nWHERE CAST(invoice AS BIGINT) % {SPOILT_EVERY} <> 0",
        ),
        "product_revenue": _query(
            "revenue",
            'SELECT description AS "Description", CAST(cents AS DOUBLE) / 100 AS "Revenue" FROM revenue',
        ),
        "top_products": _query(
            "revenue",
            'SELECT description AS "Description", CAST(cents AS DOUBLE) / 100 AS "Revenue" '
            f"FROM revenue ORDER BY cents DESC, description LIMIT {TOP_CUT}",
        ),
        "monthly_totals": _query("totals", _MONTHLY + "totals"),
        "monthly_sales": _query("monthly", _MONTHLY + "monthly"),
        "monthly_sales_all": _query("totals", _MONTHLY + "totals"),
        "monthly_sales_top": _query(
            "totals",
            _MONTHLY
            + "totals WHERE description IN (SELECT description FROM revenue "
            + f"ORDER BY cents DESC, description LIMIT {TOP_CUT})",
        ),
        "holiday_calendar": _query(
            "calendar",
            """
SELECT name AS "Name", strftime(day, '%Y-%m-%d') AS "DateParsed",
       strftime(month, '%Y-%m') AS holiday_month,
       (SELECT count(*) FROM lines WHERE lines.month = calendar.month) AS n_lines
FROM calendar""",
        ),
        "holiday_months": _query(
            "holiday_months",
            """
SELECT strftime(m.month, '%Y-%m') AS holiday_month, count(l.month) AS n_lines
FROM holiday_months m LEFT JOIN lines l ON l.month = m.month GROUP BY m.month""",
        ),
        "calendar_file": _query(
            "calendar",
            """
SELECT name AS "Name", strftime(calendar.day, '%Y-%m-%d') AS "DateParsed", count(*) AS n_lines
FROM calendar JOIN lines ON lines.month = calendar.month GROUP BY name, calendar.day""",
        ),
        "features": _query("features", "SELECT * EXCLUDE (month_start, cents) FROM features"),
        "features_labeled": _query("labeled", _LABELED),
        "features_by_month": _query("labeled", _LABELED),
        "holiday_fanout": _query(
            "features",
            """
SELECT "Description", strftime(month_start, '%Y-%m') AS month_key, "TotalPrice", name AS "Name"
FROM features LEFT JOIN calendar ON calendar.month = month_start""",
        ),
        "holiday_impact": _query(
            "features",
            """
SELECT name AS "Name",
       CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_sales
FROM features JOIN calendar ON calendar.month = month_start GROUP BY name""",
        ),
        "holiday_products": _query("products_sold", "SELECT * FROM products_sold"),
        "holiday_products_top_n": _query(
            "products_sold",
            'SELECT * FROM products_sold ORDER BY total_sales DESC, "Description" LIMIT 10',
        ),
        "quarterly_summary": _query(
            "quarterly",
            'SELECT "Description", "Quarter", CAST(mean_cents AS DOUBLE) / 100 AS avg_quarter_sales '
            "FROM quarterly",
        ),
        "newyear_vs_christmas": _query("seasonal", "SELECT * FROM seasonal"),
        "month_labels": _query(
            "seasonal",
            """SELECT *, CASE "Month" WHEN 1 THEN 'New Year (Jan)' WHEN 12 THEN 'Christmas (Dec)' END
AS "MonthLabel" FROM seasonal""",
        ),
        "quarterly_scores": _query(
            "quarter_score",
            'SELECT "Description", CAST(score_cents AS DOUBLE) / 100 AS score FROM quarter_score',
        ),
        "heatmap_rows": _query(
            "heatmap_keys",
            'SELECT "Description", "Quarter", CAST(mean_cents AS DOUBLE) / 100 AS avg_quarter_sales '
            f"FROM {heat}",
        ),
        "quarterly_heatmap": _query(
            "heatmap_keys", _pivot("Description", "Quarter", ["Q1", "Q2", "Q3", "Q4"], heat)
        ),
        "quarter_by_product": _query(
            "quarterly",
            _pivot(
                "Quarter",
                "Description",
                CHOSEN_PRODUCTS,
                f'quarterly WHERE "Description" IN ({_CHOSEN})',
            ),
        ),
        "feature_correlation": _correlations(6),
        "correlation_matrix": _correlation_matrix(),
        "split_regression": _split("features", _REGRESSION),
        "split_inventory": _split("labeled", _INVENTORY),
        "demand_forecast": _forest(
            forests.DEMAND,
            'SELECT "Description", "InvoiceMonth", "TotalPrice", prediction FROM tested',
        ),
        "demand_metrics": _forest(
            forests.DEMAND,
            """
SELECT round(sqrt(avg(("TotalPrice" - prediction) ** 2)), 2) AS "RMSE",
       round(avg(abs("TotalPrice" - prediction)), 2) AS "MAE",
       any_value("numTrees")::INTEGER AS "numTrees", any_value("maxDepth")::INTEGER AS "maxDepth"
FROM tested""",
        ),
        "demand_tuning": _forest(forests.DEMAND, _TUNING),
        "demand_trees": _forest(forests.DEMAND, forests.trees(forests.DEMAND, 1)),
        "stock_forecast": _forest(
            forests.STOCK,
            'SELECT "Description", "InvoiceMonth", stock_decision, predicted_label FROM tested',
        ),
        "stock_metrics": _forest(forests.STOCK, _STOCK_METRICS),
        "stock_tuning": _forest(forests.STOCK, _TUNING),
        "stock_trees": _forest(forests.STOCK, forests.trees(forests.STOCK, 1)),
        "demand_forecast_rows": _test_part(
            "features",
            _REGRESSION,
            'SELECT "Description", "InvoiceMonth", "TotalPrice", TRUE AS in_range FROM t',
        ),
        "stock_forecast_rows": _test_part(
            "labeled",
            _INVENTORY,
            'SELECT "Description", "InvoiceMonth", stock_decision, TRUE AS is_known FROM t',
        ),
        "demand_metrics_agree": _test_part(
            "features",
            _REGRESSION,
            "SELECT count(*) AS n_rows, TRUE AS rmse_agrees, TRUE AS mae_agrees, TRUE AS in_grid FROM t",
        ),
        "stock_metrics_agree": _test_part(
            "labeled",
            _INVENTORY,
            "SELECT count(*) AS n_rows, TRUE AS accuracy_agrees, TRUE AS recall_agrees FROM t",
        ),
        "description_clusters": _count_clusters('SELECT "Description", "NLP_Category" FROM assigned'),
        "description_centers": _count_clusters(_CENTERS),
        "tfidf_clusters": _tfidf_clusters('SELECT "Description", "NLP_Category" FROM assigned'),
        "cluster_cost": _tfidf_clusters(
            """
SELECT "NLP_Category", count(*) AS n_names, round(sum(cost), 4) AS cost
FROM assigned GROUP BY ALL"""
        ),
        "cluster_terms": _tfidf_clusters(
            f"""
SELECT c::INTEGER AS "NLP_Category", position::INTEGER AS position, term, weight FROM (
  SELECT c, term, weight, row_number() OVER (PARTITION BY c ORDER BY weight DESC, term) AS position
  FROM (SELECT c, term, round(s::DOUBLE / w::DOUBLE / {float(centers.SCALE)}::DOUBLE, 6) AS weight
        FROM final JOIN terms USING (j))) WHERE position <= {TERMS_PER_CLUSTER}"""
        ),
        "description_clusters_rows": _query(
            "features", 'SELECT DISTINCT "Description", TRUE AS is_nearest FROM features'
        ),
        "tfidf_clusters_rows": _query(
            "features", 'SELECT DISTINCT "Description", TRUE AS is_nearest FROM features'
        ),
        "cluster_terms_rank": _query(
            "features",
            f"""
SELECT CAST(c AS INTEGER) AS "NLP_Category", CAST(p AS INTEGER) AS position, TRUE AS falls
FROM range({CLUSTERS}) AS c(c), range(1, {TERMS_PER_CLUSTER + 1}) AS p(p)
WHERE (SELECT count(*) FROM features) > 0""",
        ),
        "product_index": _query("product_rank", "SELECT * FROM product_rank"),
        "label_index": _query(
            "labeled",
            """
SELECT stock_decision, count(*) AS n_rows,
       row_number() OVER (ORDER BY count(*) DESC, stock_decision) - 1 AS label
FROM labeled GROUP BY stock_decision""",
        ),
        "regression_vectors": _vector(REGRESSION_INPUTS),
        "inventory_vectors": _vector(INVENTORY_INPUTS),
        "metrics_regression": _query(
            "baseline",
            """
SELECT round(sqrt(avg(("TotalPrice" - prediction) * ("TotalPrice" - prediction))), 2) AS "RMSE",
       round(avg(abs("TotalPrice" - prediction)), 2) AS "MAE" FROM baseline""",
        ),
        "metrics_classification": _query("scores", "SELECT * FROM scores"),
        "metrics_document": _query("scores", "SELECT * FROM scores"),
        "confusion": _query("confused", "SELECT * FROM confused"),
        "product_mae": _query(
            "baseline",
            """
SELECT "Description", round(avg(abs("TotalPrice" - prediction)), 4) AS mae
FROM baseline GROUP BY "Description\"""",
        ),
        "inventory_matches": _query(
            "matched",
            'SELECT "Description", "InvoiceMonth", stock_decision, predicted_label, match FROM matched',
        ),
        "match_counts": _query(
            "matched", 'SELECT match AS "Match", count(*) AS "Count" FROM matched GROUP BY match'
        ),
        "class_by_match": _query(
            "matched", "SELECT predicted_label, match, count(*) AS n_rows FROM matched GROUP BY ALL"
        ),
        "forecast_explorer": _query(
            "baseline",
            f"""
SELECT "Description", "InvoiceMonth", "TotalPrice", prediction FROM baseline
WHERE "Description" IN ({_CHOSEN})
  AND "InvoiceMonth" BETWEEN '{EXPLORED[0]}' AND '{EXPLORED[1]}'""",
        ),
        "single_product": _query(
            "baseline",
            f'SELECT * FROM baseline WHERE "Description" = {_text(CHOSEN_PRODUCTS[0])}',
        ),
        "product_list": _query("baseline", 'SELECT DISTINCT "Description" FROM baseline'),
        "product_count": _query(
            "baseline", 'SELECT count(DISTINCT "Description") AS n_products FROM baseline'
        ),
        "month_bounds": _query(
            "baseline",
            'SELECT min("InvoiceMonth") AS first_month, max("InvoiceMonth") AS last_month FROM baseline',
        ),
        "preview_features": _query(
            "features",
            'SELECT * EXCLUDE (month_start, cents) FROM features '
            'ORDER BY "Description", "InvoiceMonth" LIMIT 5',
        ),
        "description_tokens": _query(
            "tokens",
            'SELECT "Description", n_rows, CAST(position AS INTEGER) AS position, token FROM tokens',
        ),
        "description_vocabulary": _query("vocabulary", "SELECT * FROM vocabulary"),
        "description_term_counts": _query(
            "vocabulary",
            """
SELECT t."Description", t.token AS term, CAST(v.term_index AS INTEGER) AS term_index, count(*) AS n
FROM tokens t
JOIN (SELECT term, row_number() OVER (ORDER BY occurrences DESC, term) - 1 AS term_index
      FROM vocabulary) v ON v.term = t.token
GROUP BY ALL""",
        ),
        "tfidf_vocabulary": _query(
            "phrase_idf",
            "SELECT term, occurrences, documents, round(idf, 6) AS idf FROM phrase_idf",
        ),
        "tfidf_weights": _query(
            "phrase_weights",
            """
SELECT "Description", term,
       round(w / sqrt(sum(w * w) OVER (PARTITION BY "Description")), 6) AS weight
FROM phrase_weights""",
        ),
        "stage_round_trip": _query("labeled", _LABELED),
        "csv_stage_round_trip": _query("labeled", _LABELED),
        "tolerant_scan": _query(
            "quarterly",
            'SELECT "Description", "Quarter", CAST(mean_cents AS DOUBLE) / 100 AS avg_quarter_sales '
            "FROM quarterly WHERE \"Quarter\" <> 'Q4'",
        ),
        "stage_gate": _query("quarterly", "").rstrip() + _GATES,
        "run_log": _query("clean", "").rstrip() + _RUN_LOG,
        "stage_audit": _query(
            "features",
            """
SELECT 'transactions' AS stage, count(*) AS n_rows FROM tx
UNION ALL SELECT 'clean', count(*) FROM clean
UNION ALL SELECT 'monthly_sales', count(*) FROM monthly
UNION ALL SELECT 'features', count(*) FROM features
UNION ALL SELECT 'holiday_rows', count(*)
  FROM features LEFT JOIN calendar ON calendar.month = month_start
UNION ALL SELECT 'holiday_lines', count(*)
  FROM lines WHERE month IN (SELECT month FROM holiday_months)""",
        ),
    }
