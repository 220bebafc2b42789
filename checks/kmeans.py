"""SQL that takes the Lloyd steps of ``centers`` anew."""

from __future__ import annotations

from shelfcast.operators import centers
from shelfcast.operators.clusters import CLUSTERS


def pieces(entries: str, vocabulary: str, scale: int, k: int = CLUSTERS) -> dict[str, str]:
    """Named queries after those of the text: ``assigned`` and ``final`` centres.

    ``entries`` gives ``"Description", term, x`` of the integers that are not 0.
    """
    found = {"terms": f"""
  SELECT term, row_number() OVER (ORDER BY occurrences DESC, term) AS j FROM {vocabulary}"""}
    found["entries"] = f'SELECT "Description", j, x::BIGINT AS x FROM ({entries}) JOIN terms USING (term)'
    found["dense"] = """
  SELECT docs."Description", n_rows, j, coalesce(x, 0) AS x
  FROM docs CROSS JOIN terms LEFT JOIN entries USING ("Description", j)"""
    found["drawn"] = f"""
  SELECT "Description" AS name, list(x ORDER BY j) AS v,
         row_number() OVER (ORDER BY md5('{centers.SEED}|' || "Description"), "Description") AS nth
  FROM dense GROUP BY "Description" QUALIFY nth <= {centers.CANDIDATES}"""
    apart = (
        "list_sum(list_transform(list_zip(c.v, d.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    )
    found["chosen_1"] = "SELECT 0 AS c, v FROM drawn WHERE nth = 1"
    for n in range(2, k + 1):  # the point farthest from those chosen before
        found[f"chosen_{n}"] = f"""
  SELECT * FROM chosen_{n - 1} UNION ALL
  SELECT * FROM (
    SELECT {n - 1} AS c, any_value(d.v) AS v FROM drawn d, chosen_{n - 1} c
    GROUP BY name HAVING min({apart}) > 0 ORDER BY min({apart}) DESC, name LIMIT 1)"""
    found["at_0"] = f"""
  SELECT c, unnest(v)::BIGINT AS s, generate_subscripts(v, 1) AS j, 1::BIGINT AS w FROM chosen_{k}"""
    for step in range(centers.MOST_STEPS):
        found[f"near_{step}"] = _nearest(f"at_{step}")
        found[f"at_{step + 1}"] = f"""
  SELECT o.c, coalesce(n.s, o.s) AS s, o.j, coalesce(n.w, o.w) AS w FROM at_{step} o
  LEFT JOIN (
    SELECT c, j, sum(n_rows * x)::BIGINT AS s, sum(n_rows)::BIGINT AS w
    FROM near_{step} JOIN dense USING ("Description") GROUP BY c, j) n USING (c, j)"""
    found["final"] = f"SELECT * FROM at_{centers.MOST_STEPS}"
    found["nearest"] = _nearest("final")
    found["assigned"] = f"""
  SELECT n."Description", n.c::INTEGER AS "NLP_Category",
         apart * n_rows / ({float(scale)}::DOUBLE * {float(scale)}::DOUBLE) AS cost
  FROM nearest n JOIN docs USING ("Description")"""
    return found


def _nearest(at: str) -> str:
    gap = "(x::DOUBLE - s::DOUBLE / w::DOUBLE)"
    return f"""
  SELECT "Description", c, apart FROM (
    SELECT "Description", c,
           list_reduce(list({gap} * {gap} ORDER BY j), lambda a, b: a + b, 0::DOUBLE) AS apart
    FROM dense JOIN {at} USING (j) GROUP BY "Description", c)
  QUALIFY row_number() OVER (PARTITION BY "Description" ORDER BY apart, c) = 1"""


COUNTS = "SELECT \"Description\", token AS term, count(*) AS x FROM tokens GROUP BY ALL"
WEIGHTS = f"""
SELECT "Description", term,
       round(w / sqrt(sum(w * w) OVER (PARTITION BY "Description")) * {centers.SCALE}) AS x
FROM phrase_weights"""
