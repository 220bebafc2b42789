"""SQL that grows the forests of ``treetables`` anew, level by level, from the same rules."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, sqrt

from shelfcast.operators import treetables as t
from shelfcast.operators.encode import INVENTORY_INPUTS, REGRESSION_INPUTS
from shelfcast.operators.split import INVENTORY_PARTS, REGRESSION_PARTS

CLASSES = 3  # decisions in the test tables


@dataclass(frozen=True)
class Model:
    source: str  # piece with the rows
    label: str  # integer label
    encoded: dict[str, str]  # product columns by name: what they are means of
    inputs: list[str]
    parts: dict[str, float]
    classes: int

    @property
    def names(self) -> list[str]:
        return [i for n in self.inputs for i in (self.encoded if n == "DescriptionIndex" else [n])]


DEMAND = Model(
    "features", "cents * 100", {"product_mean": "label"}, REGRESSION_INPUTS, REGRESSION_PARTS, 1
)
STOCK = Model(
    "labeled",
    "label_place",
    {f"share_{i}": f"(label = {i})::BIGINT" for i in range(CLASSES - 1)},
    INVENTORY_INPUTS,
    INVENTORY_PARTS,
    CLASSES,
)
_KEY = "\"Description\" || '|' || \"InvoiceMonth\""


def _digits(text: str, first: int) -> str:
    return f"('0x' || substr(md5({text}), {first}, 8))::BIGINT"


def _score(side: str, classes: int) -> str:
    if classes == 1:
        return f"{side}_0::DOUBLE * {side}_0::DOUBLE / {side}_n::DOUBLE"
    squares = " + ".join(f"{side}_{c} * {side}_{c}" for c in range(classes))
    return f"({squares})::DOUBLE / {side}_n::DOUBLE"


def pieces(model: Model, grid: t.TreeGrid = t.TreeGrid()) -> dict[str, str]:
    """Named queries in dependency order: ``points``, one ``cuts_L`` and ``sums_L`` a level,
    ``held`` (hold-out predictions), ``grid`` (their scores), ``best`` and ``tested``."""
    inputs, classes, trees = model.names, model.classes, max(grid.trees)
    train, test = model.parts["train"], round(1 - model.parts["test"], 10)
    stats = ["n", *map(str, range(classes))]
    found: dict[str, str] = {}
    if model is STOCK:
        found["label_names"] = """
  SELECT stock_decision AS said, row_number() OVER (ORDER BY count(*) DESC, stock_decision) - 1 AS label_place
  FROM labeled GROUP BY stock_decision"""
    source = model.source
    if model is STOCK:
        source = "labeled JOIN label_names ON said = stock_decision"
    found["placed"] = f"""
  SELECT *, {model.label} AS label, {_KEY} AS key,
         {_digits(_KEY, 1)}::DOUBLE / 4294967296::DOUBLE AS position,
         {_digits(_KEY, 9)}::DOUBLE / 4294967296::DOUBLE AS fold
  FROM {source}"""
    found["seen"] = f"""
  SELECT 0 AS view, fold < {grid.train_ratio}::DOUBLE AS grows, * FROM placed
  WHERE position < {train}::DOUBLE
  UNION ALL SELECT 1, position < {train}::DOUBLE, * FROM placed
  WHERE position < {train}::DOUBLE OR position >= {test}::DOUBLE"""
    own = ", ".join(f"sum({v}) AS p_{k}" for k, v in model.encoded.items())
    whole = ", ".join(f"sum(p_{k}) AS a_{k}" for k in model.encoded)
    means = ", ".join(
        f"(coalesce(p_{k}, 0)::DOUBLE + {t.PRIOR_ROWS}::DOUBLE * (a_{k}::DOUBLE / a_n::DOUBLE))"
        f" / (coalesce(p_n, 0)::DOUBLE + {t.PRIOR_ROWS}::DOUBLE) AS {k}"
        for k in model.encoded
    )
    found["own"] = f"""
  SELECT view, "Description" AS product, count(*) AS p_n, {own} FROM seen WHERE grows
  GROUP BY ALL"""
    found["whole"] = f"SELECT view AS v, sum(p_n) AS a_n, {whole} FROM own GROUP BY view"
    found["encoded"] = f"""
  SELECT seen.*, {means} FROM seen
  LEFT JOIN own ON own.view = seen.view AND product = "Description"
  JOIN whole ON v = seen.view"""
    found["long"] = " UNION ALL ".join(
        f'SELECT view, grows, key, {i} AS f, "{c}"::DOUBLE AS x FROM encoded'
        for i, c in enumerate(inputs)
    )
    found["bounds"] = f"""
  SELECT DISTINCT r.view, r.f, x FROM (
    SELECT view, f, x, row_number() OVER (PARTITION BY view, f ORDER BY x) - 1 AS place,
           count(*) OVER (PARTITION BY view, f) AS n FROM long WHERE grows) r,
    range(1, {grid.bins}) k(k) WHERE place = k * n // {grid.bins}"""
    found["listed"] = (
        "SELECT view, f, list(x ORDER BY x) AS bounds FROM bounds GROUP BY view, f"
    )
    found["points"] = """
  SELECT view, grows, key, f, len(list_filter(bounds, lambda b: b < x)) AS bin
  FROM long JOIN listed USING (view, f)"""
    drawn = _digits(f"'{grid.seed}|' || key || '|' || (tree // 4)", 1).replace(
        ", 1, 8)", ", 1 + 8 * (tree % 4)::INTEGER, 8)"
    )
    bounds = " + ".join(f"(drawn >= {b})::BIGINT" for b in t.POISSON_BOUNDS)
    labels = ", ".join(
        f"w * {'label' if classes == 1 else f'(label = {c})::BIGINT'} AS y_{c}" for c in range(classes)
    )
    found["at_0"] = f"""
  SELECT view, tree, key, w AS y_n, {labels}, 1::BIGINT AS node FROM (
    SELECT view, tree, key, label, {bounds} AS w FROM (
      SELECT view, key, label, tree, {drawn} AS drawn
      FROM seen, range({trees}) r(tree) WHERE grows)) WHERE w > 0"""
    most = ceil(len(inputs) / 3) if classes == 1 else ceil(sqrt(len(inputs)))
    found["allowed"] = f"""
  SELECT tree, node, f FROM (
    SELECT tree, node, f, row_number() OVER (PARTITION BY tree, node ORDER BY
      md5('{grid.seed}|' || tree || '|' || node || '|' || f)) AS nth
    FROM range({trees}) a(tree), range(1, {2 ** max(grid.depths)}) b(node), range({len(inputs)}) c(f))
  WHERE nth <= {most}"""
    added = ", ".join(f"sum(y_{s})::BIGINT AS s_{s}" for s in stats)
    for level in range(max(grid.depths)):
        found[f"sums_{level}"] = f"""
  SELECT view, tree, node, {added} FROM at_{level} GROUP BY view, tree, node"""
        left = ", ".join(
            f"sum(s_{s}) OVER (PARTITION BY view, tree, node, f ORDER BY bin)::BIGINT AS l_{s}"
            for s in stats
        )
        right = ", ".join(f"t_{s} - l_{s} AS r_{s}" for s in stats)
        total = ", ".join(f"z.s_{s} AS t_{s}" for s in stats)
        parent = _score("t", classes)
        found[f"cuts_{level}"] = f"""
  SELECT view, tree, node, f, bin FROM (
    SELECT *, row_number() OVER (PARTITION BY view, tree, node ORDER BY score DESC, f, bin) AS nth
    FROM (
      SELECT *, {_score("l", classes)} + {_score("r", classes)} AS score, {parent} AS own
      FROM (
        SELECT *, {right} FROM (
          SELECT view, tree, node, f, bin, {left}, {", ".join(f"t_{s}" for s in stats)} FROM (
            SELECT h.*, {total} FROM (
              SELECT a.view, a.tree, a.node, p.f, p.bin, {added}
              FROM at_{level} a
              JOIN allowed USING (tree, node)
              JOIN points p ON p.view = a.view AND p.key = a.key AND p.f = allowed.f
              GROUP BY ALL) h
            JOIN sums_{level} z USING (view, tree, node) WHERE z.s_n > 1)))
      WHERE r_n > 0)
    WHERE score > own + {t.LEAST_GAIN}::DOUBLE * abs(own)) WHERE nth = 1"""
        values = ", ".join(f"y_{s}" for s in stats)
        found[f"at_{level + 1}"] = f"""
  SELECT a.view, a.tree, a.key, {values}, 2 * a.node + (p.bin > c.bin)::BIGINT AS node
  FROM at_{level} a JOIN cuts_{level} c USING (view, tree, node)
  JOIN points p ON p.view = a.view AND p.key = a.key AND p.f = c.f"""
    last = max(grid.depths)
    found[f"sums_{last}"] = f"""
  SELECT view, tree, node, {added} FROM at_{last} GROUP BY view, tree, node"""
    found["sums"] = " UNION ALL ".join(f"SELECT * FROM sums_{d}" for d in range(last + 1))
    found["cuts"] = " UNION ALL ".join(f"SELECT * FROM cuts_{d}" for d in range(last))
    # every scored row goes down every tree; its node after each number of cuts
    found["path_0"] = f"""
  SELECT view, key, tree, 1::BIGINT AS node FROM seen, range({trees}) r(tree) WHERE NOT grows"""
    for level in range(last):
        found[f"path_{level + 1}"] = f"""
  SELECT a.view, a.key, a.tree,
         CASE WHEN c.f IS NULL THEN a.node ELSE 2 * a.node + (p.bin > c.bin)::BIGINT END AS node
  FROM path_{level} a LEFT JOIN cuts_{level} c USING (view, tree, node)
  LEFT JOIN points p ON p.view = a.view AND p.key = a.key AND p.f = c.f"""
    each = []
    for number, depth in grid.points:
        sums = []
        for c in range(classes):
            share = f"s_{c}::DOUBLE / s_n::DOUBLE" + (f" / {t.MONEY}::DOUBLE" if classes == 1 else "")
            sums.append(
                f"list_reduce(list({share} ORDER BY tree), lambda a, b: a + b, 0::DOUBLE) AS v_{c}"
            )
        sums.append("count(*) AS grown")
        each.append(
            f'SELECT view, key, {number} AS "numTrees", {depth} AS "maxDepth", {", ".join(sums)} '
            f"FROM path_{depth} JOIN sums USING (view, tree, node) WHERE tree < {number} GROUP BY view, key"
        )
    found["summed"] = " UNION ALL ".join(each)
    if classes == 1:
        said = "v_0 / grown AS prediction"
    else:
        most_of = "greatest(" + ", ".join(f"v_{c}" for c in range(classes)) + ")"
        cases = " ".join(f"WHEN v_{c} = {most_of} THEN {c}" for c in range(classes))
        said = f"CASE {cases} END AS prediction"
    found["scored"] = f"SELECT *, {said} FROM summed JOIN seen USING (view, key)"
    if classes == 1:
        score = "sqrt(avg((label / 10000.0::DOUBLE - prediction) ** 2))"
    else:
        score = "avg((label = prediction)::INTEGER)"
    found["grid"] = f"""
  SELECT "numTrees", "maxDepth", round({score}, 6) AS score FROM scored WHERE view = 0
  GROUP BY ALL"""
    order = "score" if classes == 1 else "score DESC"
    found["best"] = f"""
  SELECT "numTrees", "maxDepth" FROM grid ORDER BY {order}, "numTrees", "maxDepth" LIMIT 1"""
    said = "" if classes == 1 else "(SELECT said FROM label_names WHERE label_place = prediction) AS predicted_label"
    found["tested"] = f"""
  SELECT scored.*{", " + said if said else ""} FROM scored
  JOIN best USING ("numTrees", "maxDepth") WHERE view = 1"""
    return found


def trees(model: Model, view: int, grid: t.TreeGrid = t.TreeGrid()) -> str:
    """Nodes of one forest, with the labels' sum in a regression."""
    names = ", ".join(f"'{n}'" for n in model.names)
    return f"""
SELECT s.tree::INTEGER AS tree, s.node::INTEGER AS node, [{names}][c.f + 1] AS feature,
       bounds[c.bin + 1] AS threshold, s_n AS n_rows, s_0 AS label_sum
FROM sums s LEFT JOIN cuts c USING (view, tree, node)
LEFT JOIN listed b ON b.view = s.view AND b.f = c.f
WHERE s.view = {view}"""
