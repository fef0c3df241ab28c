"""DuckDB SQL of ridge fits, for the oracles of the model queries: means and
centred products of each training set, Gauss-Jordan elimination by a recursive
table (a ridge system is positive definite, so no pivoting is needed)."""

from __future__ import annotations


def ridge_ctes(train: str, feats: list[str], label: str, alpha: float = 1.0, name: str = "fit") -> str:
    """Tables ending in ``name`` (g, w list of coefficients, b intercept), one
    row per training set g of the table ``train`` (g, features, label).  They
    go into a WITH RECURSIVE list."""
    d = len(feats)
    rows = []
    for i, f in enumerate(feats):
        cells = [f"covar_pop({f}, {h}) * count(*)" + (f" + {float(alpha)}" if h == f and alpha else "") for h in feats]
        rows.append("[" + ", ".join([*cells, f"covar_pop({f}, {label}) * count(*)"]) + "]")
    means = ", ".join(f"avg({f})" for f in feats)
    return f"""
{name}_mom AS (SELECT g, [{means}] AS mx, avg({label}) AS my, [{', '.join(rows)}] AS a FROM {train} GROUP BY g),
{name}_elim(g, k, a) AS (
  SELECT g, 1, a FROM {name}_mom UNION ALL
  SELECT g, k + 1, list_transform(a, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k])
    ELSE list_transform(r, lambda v, j: v - r[k] * a[k][j] / a[k][k]) END) FROM {name}_elim WHERE k <= {d}),
{name} AS (
  SELECT g, w, my - list_dot_product(w, mx) AS b FROM {name}_mom JOIN (
    SELECT g, list_transform(a, lambda r: r[{d + 1}]) AS w FROM {name}_elim WHERE k = {d + 1}) USING (g))"""


def predicted(feats: list[str], fit: str = "fit") -> str:
    """The prediction of a row under a fit joined to it."""
    return f"{fit}.b + list_dot_product({fit}.w, [{', '.join(f'CAST({f} AS DOUBLE)' for f in feats)}])"
