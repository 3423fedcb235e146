"""DuckDB SQL of the fold assignment (K1, K2): one group a step of a recursive CTE.

Both end in the CTE ``dealt`` (the columns of ``table`` and ``fold``) and need ``WITH RECURSIVE``.
"""

from __future__ import annotations

_EMPTY = "[0, 0, 0, 0, 0]::HUGEINT[]"


def _raised(loads: str, n: str) -> str:
    """The list with ``n`` more at ``to_``, the 1-based fold."""
    return f"list_transform({loads}, lambda v, i: CASE WHEN i = to_ THEN v + {n} ELSE v END)"


def fewest_rows(table: str, group: str) -> str:
    """K1: the largest group first, each to the fold with the fewest rows; ``table`` has the groups and their rows ``n``."""
    return f"""
ranked AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY n DESC, {group}) AS k FROM {table}),
walk(k, loads, to_) AS (
  SELECT 0::BIGINT, {_EMPTY}, 0::BIGINT
  UNION ALL
  SELECT k, {_raised("loads", "n")}, to_
  FROM (SELECT r.k, w.loads, r.n, list_position(w.loads, list_min(w.loads))::BIGINT AS to_
        FROM walk w JOIN ranked r ON r.k = w.k + 1)),
dealt AS MATERIALIZED (SELECT r.* EXCLUDE (k), CAST(to_ - 1 AS INTEGER) AS fold FROM ranked r JOIN walk USING (k))"""


def most_even(table: str, group: str) -> str:
    """K2 for two classes: ``table`` has the groups, their rows ``n`` and the counts ``n0`` and ``n1`` of the classes.

    With a group of counts g the sum over classes of the folds' variances
    rises by 2 h g / N^2 + g^2 / N^2 (h: what the fold holds), of which only
    the first term depends on the fold.
    """
    return f"""
ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY abs(n0 - n1) DESC, n DESC, n0 = 0, n0, {group}) AS k FROM {table}),
every AS (SELECT sum(n0)::HUGEINT AS t0, sum(n1)::HUGEINT AS t1 FROM {table}),
walk(k, h0, h1, rows_, to_) AS (
  SELECT 0::BIGINT, {_EMPTY}, {_EMPTY}, {_EMPTY}, 0::BIGINT
  UNION ALL
  SELECT k, {_raised("h0", "n0")}, {_raised("h1", "n1")}, {_raised("rows_", "n")}, to_
  FROM (SELECT *, list_min(list_transform([1, 2, 3, 4, 5], lambda i: {{
                 'rise': t1 * t1 * h0[i] * n0 + t0 * t0 * h1[i] * n1, 'rows': rows_[i], 'fold': i}})).fold::BIGINT AS to_
        FROM (SELECT r.k, w.h0, w.h1, w.rows_, r.n, r.n0, r.n1, t0, t1
              FROM walk w JOIN ranked r ON r.k = w.k + 1, every))),
dealt AS MATERIALIZED (SELECT r.* EXCLUDE (k), CAST(to_ - 1 AS INTEGER) AS fold FROM ranked r JOIN walk USING (k))"""
