"""DuckDB twins of the fold and forecast queries: normal equations over exploded design
columns, solved by Gauss-Jordan elimination in a recursive query."""

from __future__ import annotations

from demandflow.plans.oracle import _RWT, _WT, r

_FIRST, _LO, _HI = "DATE '2000-06-25'", "DATE '2000-06-26'", "DATE '2000-11-13'"


def _base(by_region: bool) -> str:
    """CTEs: ``f`` (g, i, week, d, y, v) rows in date order with their own fold; ``k`` (g, k,
    n_train) the folds of each series up to its first empty one."""
    head = _RWT if by_region else _WT
    g = "customer_region" if by_region else "'all'"
    return f"""{head},
f AS (SELECT {g} g, order_week, CAST(date_diff('day', DATE '1970-01-01', order_week) AS DOUBLE) d, CAST(sales_qty AS DOUBLE) y,
        row_number() OVER (PARTITION BY {g} ORDER BY order_week) i,
        CASE WHEN order_week <= {_FIRST} THEN -1 ELSE CAST(ceil(date_diff('day', {_FIRST}, order_week) / 7.0) AS INTEGER) - 1 END v FROM wt),
own AS (SELECT DISTINCT g, v FROM f WHERE v >= 0),
runs AS (SELECT g, v, row_number() OVER (PARTITION BY g ORDER BY v) - 1 nth FROM own),
k AS (SELECT runs.g, runs.v k, (SELECT count(*) FROM f WHERE f.g = runs.g AND f.v < runs.v) n_train FROM runs WHERE v = nth)"""


def fold_rows_sql(by_region: bool) -> str:
    g = "f.g customer_region, " if by_region else ""
    return f"""{_base(by_region)}
SELECT {g}f.order_week, CAST(f.y AS BIGINT) sales_qty, k.k fold_id, CASE WHEN f.v = k.k THEN 'valid' ELSE 'train' END AS "role"
FROM f JOIN k ON f.g = k.g AND f.v <= k.k"""


def _solve(penalty: float, name: str = "beta", centred: bool = True) -> str:
    """CTEs from ``x`` (g, k, i, j, x, y: training rows) to ``<name>`` (g, k, j, b): coefficients of
    least squares, centred with a penalty on standardised columns, or without a constant."""
    m, s, my = ("avg(x)", "stddev_pop(x)", "avg(y)") if centred else ("0.0", "1.0", "0.0")
    keep = "WHERE s > 1e-9 * greatest(1.0, abs(m))" if centred else ""
    return f"""
{name}_m AS (SELECT g, k, j, {m} m, {s} s, {my} my FROM x GROUP BY g, k, j),
{name}_u AS (SELECT *, row_number() OVER (PARTITION BY g, k ORDER BY j) c FROM {name}_m {keep}),
{name}_z AS (SELECT x.g, x.k, x.i, u.c, (x.x - u.m) / u.s z, x.y - u.my y FROM x JOIN {name}_u u USING (g, k, j)),
{name}_c AS (SELECT a.g, a.k, a.c ca, b.c cb, avg(a.z * b.z) + CASE WHEN a.c = b.c THEN {penalty} ELSE 0 END v
             FROM {name}_z a JOIN {name}_z b ON a.g = b.g AND a.k = b.k AND a.i = b.i GROUP BY a.g, a.k, a.c, b.c),
{name}_y AS (SELECT g, k, c, avg(z * y) v FROM {name}_z GROUP BY ALL),
{name}_r AS (SELECT q.g, q.k, q.ca, list_append(list(q.v ORDER BY q.cb), any_value(h.v)) rw
             FROM {name}_c q JOIN {name}_y h ON h.g = q.g AND h.k = q.k AND h.c = q.ca GROUP BY q.g, q.k, q.ca),
{name}_g AS (
  SELECT g, k, 1 s, CAST(count(*) AS BIGINT) p, list(rw ORDER BY ca) a FROM {name}_r GROUP BY g, k
  UNION ALL
  SELECT g, k, s + 1, p, [CASE WHEN i = s THEN [w / a[s][s] FOR w IN a[s]]
      ELSE [a[i][j] - a[i][s] * a[s][j] / a[s][s] FOR j IN range(1, p + 2)] END FOR i IN range(1, p + 1)]
  FROM {name}_g WHERE s <= p),
{name} AS (SELECT u.g, u.k, u.j, t.a[u.c][t.p + 1] / u.s b, u.m, u.my FROM {name}_g t JOIN {name}_u u ON t.g = u.g AND t.k = u.k AND t.s = t.p + 1)"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def _select(by_region: bool, source: str) -> str:
    g = "f.g customer_region, " if by_region else ""
    return (f"SELECT {g}f.order_week date, {r('f.y', 'y_true')}, {r('q.p', 'y_pred')}, q.k fold_id FROM {source} q "
            f"JOIN f ON f.g = q.g AND f.i = q.i WHERE f.order_week BETWEEN {_LO} AND {_HI}")


def _linear(by_region: bool, columns: str, penalty: float) -> str:
    """``columns``: CTE ``col`` (g, k, i, j, x) for training and validation rows of every fold."""
    return _recursive(f"""{_base(by_region)},{columns},
x AS (SELECT col.g, col.k, col.i, j, x, f.y FROM col JOIN f USING (g, i) WHERE f.v < col.k),{_solve(penalty)},
q AS (SELECT col.g, col.k, col.i, any_value(beta.my) + sum(beta.b * (col.x - beta.m)) p FROM col JOIN f USING (g, i)
      JOIN beta ON beta.g = col.g AND beta.k = col.k AND beta.j = col.j WHERE f.v = col.k GROUP BY col.g, col.k, col.i)
{_select(by_region, 'q')}""")


def lookback_sql(by_region: bool, length: int) -> str:
    lags = "\nUNION ALL ".join(f"SELECT k.g, k.k, a.i, {j} j, b.y x FROM k JOIN f a ON a.g = k.g AND a.v <= k.k AND a.i > {length} "
                              f"JOIN f b ON b.g = a.g AND b.i = a.i - {j}" for j in range(1, length + 1))
    return _linear(by_region, f"\ncol AS ({lags})", 0.0)


def additive_sql(by_region: bool, days: int = 91, share: float = 0.8, yearly: int = 10, weekly: int = 3, penalty: float = 0.01) -> str:
    waves = "\nUNION ALL ".join(f"SELECT g, k, i, {1000 * n + 2 * o + c} j, {fn}(2 * pi() * {o} / {n} * d) x FROM rows0"
                               for n, orders in ((365.25, yearly), (7.0, weekly)) for o in range(1, orders + 1)
                               for c, fn in enumerate(("sin", "cos")))
    return _linear(by_region, f"""
ends AS (SELECT k.g, k.k, min(f.d) d0, max(f.d) FILTER (WHERE f.v < k.k) d1 FROM k JOIN f USING (g) GROUP BY ALL),
rows0 AS (SELECT k.g, k.k, f.i, f.d, e.d0, e.d1 FROM k JOIN f ON f.g = k.g AND f.v <= k.k JOIN ends e ON e.g = k.g AND e.k = k.k),
col AS (SELECT g, k, i, 0 j, (d - d0) / 365.25 x FROM rows0
  UNION ALL SELECT g, k, i, n j, greatest((d - d0) / 365.25 - n * {days} / 365.25, 0.0) x FROM rows0, generate_series(1, 200) s(n)
            WHERE n * {days} < {share} * (d1 - d0) + 1e-9
  UNION ALL {waves})""", penalty)


def seasonal_arma_sql(by_region: bool, s: int, short: int = 4) -> str:
    lags = [*range(1, short + 1), *[n for n in (s, s + 1) if n > short]]
    top = lags[-1]
    first = top + s + 1
    enough = first + len(lags) + 3 + s + 1
    stage1 = "\nUNION ALL ".join(f"SELECT a.g, a.k, a.t i, {n} j, b.z x, a.z y FROM zs a JOIN zs b ON b.g = a.g AND b.k = a.k AND b.t = a.t - {n} "
                                f"WHERE a.t > {top}" for n in lags)
    ahead = (f"c.phi * CASE WHEN t.t >= 1 THEN t.zl[t.t] ELSE 0 END + c.theta * CASE WHEN t.t >= 1 THEN t.es[t.t] ELSE 0 END "
             f"+ c.big * CASE WHEN t.t >= {s} THEN t.es[t.t + 1 - {s}] ELSE 0 END "
             f"+ c.theta * c.big * CASE WHEN t.t >= {s + 1} THEN t.es[t.t - {s}] ELSE 0 END")
    stage2 = _solve(0.0, "b2", centred=False).replace(" FROM x ", " FROM x2 x ")
    return _recursive(f"""{_base(by_region)},
zs AS (SELECT k.g, k.k, a.i - {s + 1} t, a.y - b.y - c.y + e.y z FROM k JOIN f a ON a.g = k.g AND a.v < k.k AND k.n_train >= {enough}
  JOIN f b ON b.g = a.g AND b.i = a.i - 1 JOIN f c ON c.g = a.g AND c.i = a.i - {s} JOIN f e ON e.g = a.g AND e.i = a.i - {s + 1}),
x AS ({stage1}),{_solve(0.0, 'b1', centred=False)},
fit1 AS (SELECT x.g, x.k, x.i t, sum(b1.b * x.x) p FROM x JOIN b1 USING (g, k, j) GROUP BY ALL),
sh AS (SELECT zs.g, zs.k, zs.t, zs.z, zs.z - fit1.p e FROM zs LEFT JOIN fit1 USING (g, k, t)),
x2 AS (SELECT a.g, a.k, a.t i, 1 j, b.z x, a.z y FROM sh a JOIN sh b ON b.g = a.g AND b.k = a.k AND b.t = a.t - 1 WHERE a.t > {first}
  UNION ALL SELECT a.g, a.k, a.t, 2, b.e, a.z FROM sh a JOIN sh b ON b.g = a.g AND b.k = a.k AND b.t = a.t - 1 WHERE a.t > {first}
  UNION ALL SELECT a.g, a.k, a.t, 3, b.e, a.z FROM sh a JOIN sh b ON b.g = a.g AND b.k = a.k AND b.t = a.t - {s} WHERE a.t > {first}),{stage2},
co AS (SELECT g, k, max(b) FILTER (WHERE j = 1) phi, max(b) FILTER (WHERE j = 2) theta, max(b) FILTER (WHERE j = 3) big FROM b2 GROUP BY ALL),
zl AS (SELECT g, k, list(z ORDER BY t) zl, CAST(count(*) AS BIGINT) n FROM zs GROUP BY ALL),
rec AS (
  SELECT g, k, CAST(0 AS BIGINT) t, zl, n, CAST([] AS DOUBLE[]) es, CAST(NULL AS DOUBLE) nxt FROM zl
  UNION ALL
  SELECT t.g, t.k, t.t + 1, t.zl, t.n, CASE WHEN t.t < t.n THEN list_append(t.es, t.zl[t.t + 1] - ({ahead})) ELSE t.es END, {ahead}
  FROM rec t JOIN co c ON c.g = t.g AND c.k = t.k WHERE t.t <= t.n),
fc AS (SELECT g, k, nxt FROM rec WHERE t = n + 1),
q AS (SELECT k.g, k.k, v.i, a.y + b.y - c.y + fc.nxt p FROM k JOIN f v ON v.g = k.g AND v.v = k.k
  LEFT JOIN fc ON fc.g = k.g AND fc.k = k.k LEFT JOIN f a ON a.g = k.g AND a.i = k.n_train
  LEFT JOIN f b ON b.g = k.g AND b.i = k.n_train + 1 - {s} LEFT JOIN f c ON c.g = k.g AND c.i = k.n_train - {s})
{_select(by_region, 'q')}""")


ORACLE: dict[str, str] = {
    "b12_real_vs_predicted": lookback_sql(False, 4),
    "j17_fold_rows_weekly": fold_rows_sql(False),
    "j17_region_fold_rows": fold_rows_sql(True),
    "b8b_lookback_backtest": lookback_sql(False, 4),
    "b8b_region_lookback_backtest": lookback_sql(True, 4),
    "b7_additive_backtest": additive_sql(False),
    "b7_region_additive_backtest": additive_sql(True),
    "b8_seasonal_ar_backtest": seasonal_arma_sql(False, 52),
    "b8_region_seasonal_arma_backtest": seasonal_arma_sql(True, 13),
}
