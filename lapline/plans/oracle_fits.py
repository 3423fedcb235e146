"""DuckDB SQL of the shared-pass fits: trees split by split, the first round of boosting, Newton's method unrolled."""

from __future__ import annotations

from lapline.plans.oracle_folds import most_even

NEWTON_STEPS = 8


def _cells(res: str) -> str:
    """Rows with their fold, cells with their counts, class weights for each held-out fold."""
    return f"""{res},
l AS (SELECT entry_id, driver AS g, team, CAST(grid_position AS DOUBLE) AS grid, CAST(dnf AS INTEGER) AS y FROM sres),
gs AS (SELECT g, count(*) AS n, count(*) FILTER (WHERE y = 0) AS n0, count(*) FILTER (WHERE y = 1) AS n1 FROM l GROUP BY 1),
{most_even("gs", "g")},
rows_ AS MATERIALIZED (SELECT l.*, fold FROM l JOIN dealt USING (g)),
cell AS MATERIALIZED (SELECT grid, team, fold, count(*) FILTER (WHERE y = 0) AS n0, count(*) FILTER (WHERE y = 1) AS n1
                      FROM rows_ GROUP BY ALL),
held AS (SELECT DISTINCT fold AS held FROM cell),
w AS MATERIALIZED (SELECT held, sum(n0 + n1) / (2.0 * sum(n0)) AS w0, sum(n0 + n1) / (2.0 * sum(n1)) AS w1
                   FROM held JOIN cell ON fold <> held GROUP BY held),
spw AS (SELECT CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE) / count(*) FILTER (WHERE y = 1) AS s FROM l),
step AS (SELECT grid, (grid + lead(grid) OVER (ORDER BY grid)) / 2 AS cut FROM (SELECT DISTINCT grid FROM cell))"""


def _grown(kind: str, depth: int) -> str:
    """CTEs split_0 ... of the nodes that split, and at_0 ... with the node of every cell under every held-out fold's tree."""
    if kind == "gini":
        stats = "n0 * w0 AS a, n1 * w1 AS b, n0 + n1 AS n"
        gain = ("2 * a * b / (a + b) - CASE WHEN la + lb > 0 THEN 2 * la * lb / (la + lb) ELSE 0 END "
                "- CASE WHEN a - la + b - lb > 0 THEN 2 * (a - la) * (b - lb) / (a - la + b - lb) ELSE 0 END")
        usable = "ln > 0 AND n - ln > 0 AND a > 0 AND b > 0"
        value = "{b} / ({a} + {b})"
    else:  # the first round: all probabilities are a half
        stats = "0.5 * n0 - 0.5 * s * n1 AS a, 0.25 * n0 + 0.25 * s * n1 AS b, n0 + n1 AS n"
        gain = "la * la / (lb + 1) + (a - la) * (a - la) / (b - lb + 1) - a * a / (b + 1)"
        usable = "lb >= 1 AND b - lb >= 1 AND gain > 1e-6"
        value = "-0.3 * {a} / ({b} + 1)"
    left, right = value.format(a="la", b="lb"), value.format(a="(a - la)", b="(b - lb)")
    out = ["at_0 AS MATERIALIZED (SELECT held, cell.*, 0 AS node, true AS live FROM cell, held)"]
    for k in range(depth):
        out.append(f"""
x_{k} AS MATERIALIZED (SELECT held, node, grid, team, {stats} FROM at_{k} JOIN w USING (held), spw WHERE live AND fold <> held),
t_{k} AS (SELECT held, node, sum(a) AS a, sum(b) AS b, sum(n) AS n FROM x_{k} GROUP BY ALL),
c_{k} AS (
  SELECT held, node, 0 AS f, grid, NULL::VARCHAR AS team, sum(sum(a)) OVER u AS la, sum(sum(b)) OVER u AS lb, sum(sum(n)) OVER u AS ln
  FROM x_{k} GROUP BY held, node, grid WINDOW u AS (PARTITION BY held, node ORDER BY grid)
  UNION ALL
  SELECT held, node, 1, NULL::DOUBLE, x.team, t.a - sum(x.a), t.b - sum(x.b), t.n - sum(x.n)
  FROM x_{k} x JOIN t_{k} t USING (held, node) WHERE x.team IS NOT NULL GROUP BY held, node, x.team, t.a, t.b, t.n),
split_{k} AS MATERIALIZED (
  SELECT held, node, f, grid, team, gain, {left} AS left_value, {right} AS right_value
  FROM (SELECT *, {gain} AS gain FROM c_{k} JOIN t_{k} USING (held, node)) WHERE {usable}
  QUALIFY row_number() OVER (PARTITION BY held, node ORDER BY round(gain, 8) DESC, f, grid, team) = 1),
at_{k + 1} AS MATERIALIZED (
  SELECT a.held, a.grid, a.team, a.fold, a.n0, a.n1,
         CASE WHEN s.held IS NULL THEN a.node
              ELSE 2 * a.node + 1 + CAST(CASE WHEN s.f = 0 THEN a.grid > s.grid ELSE coalesce(a.team = s.team, false) END AS INTEGER) END AS node,
         a.live AND s.held IS NOT NULL AS live
  FROM at_{k} a LEFT JOIN split_{k} s ON s.held = a.held AND s.node = a.node AND a.live)""")
    return ",\n".join(out)


def _splits(res: str, kind: str, depth: int) -> str:
    every = " UNION ALL ".join(f"SELECT * FROM split_{k}" for k in range(depth))
    return (f"WITH RECURSIVE {_cells(res)},\n{_grown(kind, depth)} "
            "SELECT CAST(held AS INTEGER) AS fold, CAST(node AS INTEGER) AS node, CASE f WHEN 0 THEN 'grid_position' ELSE 'team' END AS feature, "
            "round(CASE f WHEN 0 THEN cut END, 6) AS cut, s.team AS level, round(gain, 6) AS gain, round(left_value, 6) AS left_value, "
            f"round(right_value, 6) AS right_value FROM ({every}) s LEFT JOIN step ON step.grid = s.grid")


def _oof_tree(res: str, depth: int) -> str:
    """Every row's share of weighted positives in its leaf of the tree that held its fold out."""
    return (f"WITH RECURSIVE {_cells(res)},\n{_grown('gini', depth)}, "
            f"leaf AS (SELECT held, node, sum(n1 * w1) / sum(n0 * w0 + n1 * w1) AS p FROM at_{depth} JOIN w USING (held) "
            "WHERE fold <> held GROUP BY ALL) "
            "SELECT entry_id, r.fold, CAST(y AS DOUBLE) AS label, round(p, 6) AS probability, CAST(p > 0.5 AS INTEGER) AS prediction "
            f"FROM rows_ r JOIN at_{depth} a ON a.held = r.fold AND a.fold = r.fold AND a.grid = r.grid AND a.team = r.team "
            "JOIN leaf ON leaf.held = a.held AND leaf.node = a.node")


def _newton(res: str) -> str:
    """CTEs that end in b (held, grid's coefficient) and bt (held, team, coefficient).

    The hessian is diagonal but for the grid position's row, so a step needs one Schur complement.
    """
    out = [f"""{_cells(res)},
m AS MATERIALIZED (SELECT held, sum((n0 + n1) * grid) / sum(n0 + n1) AS mean,
       sqrt(sum((n0 + n1) * grid * grid) / sum(n0 + n1) - (sum((n0 + n1) * grid) / sum(n0 + n1)) ** 2) AS sd
      FROM held JOIN cell ON fold <> held GROUP BY held),
z AS MATERIALIZED (SELECT held, team, (grid - mean) / sd AS z, n0 * w0 AS n0, n1 * w1 AS n1
      FROM cell JOIN m ON fold <> held JOIN w USING (held)),
b_0 AS (SELECT held, 0.0::DOUBLE AS b FROM held),
bt_0 AS (SELECT DISTINCT held, team, 0.0::DOUBLE AS c FROM z)"""]
    for k in range(NEWTON_STEPS):
        out.append(f"""
p_{k} AS (SELECT z.*, b, c, 1 / (1 + exp(-(z * b + c))) AS p FROM z JOIN b_{k} USING (held) JOIN bt_{k} USING (held, team)),
e_{k} AS (SELECT held, team, c, b, z, n0 * p - n1 * (1 - p) AS g, (n0 + n1) * p * (1 - p) AS h FROM p_{k}),
q_{k} AS MATERIALIZED (SELECT held, team, any_value(c) AS c, any_value(b) AS b, sum(g) + any_value(c) AS gt, sum(h) + 1 AS ht, sum(h * z) AS hx,
                              sum(g * z) AS gx, sum(h * z * z) AS hxx FROM e_{k} GROUP BY held, team),
b_{k + 1} AS MATERIALIZED (SELECT held, any_value(b) AS old,
    any_value(b) - (sum(gx) + any_value(b) - sum(hx * gt / ht)) / (sum(hxx) + 1 - sum(hx * hx / ht)) AS b FROM q_{k} GROUP BY held),
bt_{k + 1} AS MATERIALIZED (SELECT held, team, c - (gt + hx * (n.b - n.old)) / ht AS c FROM q_{k} JOIN b_{k + 1} n USING (held))""")
    return ",\n".join(out)


def _oof_logistic(res: str) -> str:
    k = NEWTON_STEPS
    return (f"WITH RECURSIVE {_newton(res)}, s AS (SELECT entry_id, r.fold, y, 1 / (1 + exp(-((grid - mean) / sd * b + c))) AS p FROM rows_ r "
            f"JOIN m ON m.held = r.fold JOIN b_{k} b ON b.held = r.fold JOIN bt_{k} t ON t.held = r.fold AND t.team = r.team) "
            "SELECT entry_id, fold, CAST(y AS DOUBLE) AS label, round(p, 6) AS probability, CAST(p > 0.5 AS INTEGER) AS prediction FROM s")


def _coefficients(res: str) -> str:
    k = NEWTON_STEPS
    return (f"WITH RECURSIVE {_newton(res)} SELECT CAST(held AS INTEGER) AS fold, 'grid_position' AS feature, round(b, 6) AS coefficient FROM b_{k} "
            f"UNION ALL SELECT CAST(held AS INTEGER), 'team ' || team, round(c, 6) FROM bt_{k}")


def fits(res: str) -> dict[str, str]:
    """``res``: CTEs that define sres, the season's results."""
    return {"tree_splits": _splits(res, "gini", 2), "boosting_splits": _splits(res, "newton", 4), "oof_tree": _oof_tree(res, 4),
            "oof_logistic": _oof_logistic(res), "logistic_coefficients": _coefficients(res)}
