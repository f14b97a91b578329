"""DuckDB SQL twins of the registered queries (tables are pre-registered views).

The SQL is written independently of the Spark code: window frames, conditional
aggregates and date arithmetic in DuckDB's dialect.  Doubles are snapped to the 2**-20 grid
and -0.0 folded into 0.0, as in ``plans.common.normalize``.
"""

from __future__ import annotations

from demandflow.operators.features import LAG_COLS, LAGS, ROLL_COLS, ROLL_WINDOWS
from demandflow.operators.period import DELTA_COLS, PRICE_MEANS, WEIGHTED_COLS
from demandflow.sources.fixtures import FIXTURE_REGION_SUFFIX


def r(expr: str, alias: str) -> str:
    """Snap a double to the 2**-20 grid, as ``plans.common.normalize`` does."""
    return f"round(CAST({expr} AS DOUBLE) * 1048576.0) / 1048576.0 + 0.0 AS {alias}"


RAW_CTES = """
orders_x AS (
  SELECT CAST(o_orderkey AS VARCHAR) order_id, CAST(o_custkey AS VARCHAR) customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END order_status,
    o_orderdate order_purchase_timestamp,
    CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate + ((o_orderkey * 37) % 4000) * INTERVAL 1 MINUTE END order_approved_at,
    o_orderdate + INTERVAL 30 DAY order_estimated_delivery_date
  FROM orders),
items_x AS (
  SELECT CAST(l_orderkey AS VARCHAR) order_id, CAST(l_linenumber AS BIGINT) order_item_id,
    CAST(l_partkey AS VARCHAR) product_id, CAST(l_suppkey AS VARCHAR) seller_id,
    l_extendedprice price, l_extendedprice * l_tax freight_value, l_shipdate order_delivered_carrier_date,
    CASE WHEN l_orderkey % 89 <> 0 THEN l_shipdate + ((l_orderkey * 53) % 400) * INTERVAL 1 HOUR END order_delivered_customer_date
  FROM lineitem),
products_x AS (
  SELECT CAST(p_partkey AS VARCHAR) product_id, CASE WHEN p_partkey % 83 <> 0 THEN p_brand END product_category_name FROM part),
customers_x AS (
  SELECT CAST(c_custkey AS VARCHAR) customer_id, CAST(c_custkey AS VARCHAR) customer_unique_id, n_name customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
state_region AS (SELECT n_name state, r_name region FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
merged0 AS (
  SELECT o.*, i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value,
    i.order_delivered_carrier_date, i.order_delivered_customer_date, p.product_category_name,
    c.customer_unique_id, c.customer_state, sr.region customer_region
  FROM orders_x o JOIN items_x i ON o.order_id = i.order_id
  LEFT JOIN products_x p ON i.product_id = p.product_id
  LEFT JOIN customers_x c ON o.customer_id = c.customer_id
  LEFT JOIN state_region sr ON c.customer_state = sr.state),
merged AS (
  SELECT * FROM merged0
  WHERE order_status = 'delivered' AND product_category_name IS NOT NULL AND order_approved_at IS NOT NULL
    AND order_delivered_customer_date IS NOT NULL AND order_delivered_carrier_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY order_purchase_timestamp NULLS FIRST,
    product_id NULLS FIRST, seller_id NULLS FIRST, price NULLS FIRST, order_delivered_carrier_date NULLS FIRST,
    freight_value NULLS FIRST) = 1)"""

MERGED_COLS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
               "order_estimated_delivery_date", "order_item_id", "product_id", "seller_id", "price",
               "freight_value", "order_delivered_carrier_date", "order_delivered_customer_date",
               "product_category_name", "customer_unique_id", "customer_state", "customer_region"]


def keyed_cte(freq: str) -> str:
    key = "order_week" if freq == "W" else "order_date"
    trunc = "date_trunc('week', order_purchase_timestamp)::DATE" if freq == "W" else "CAST(order_purchase_timestamp AS DATE)"
    return f"""
d AS (
  SELECT *, {trunc} AS {key},
    floor((epoch_us(order_estimated_delivery_date) - epoch_us(order_delivered_customer_date)) / 86400000000.0) AS delivery_diff_estimated,
    floor((epoch_us(order_estimated_delivery_date) - epoch_us(order_purchase_timestamp)) / 86400000000.0) AS estimated_delivery_lead_days,
    (epoch_us(order_approved_at) - epoch_us(order_purchase_timestamp)) / 3600000000.0 AS approval_time_hours
  FROM merged)"""


def _qty(mode: str) -> str:
    return {"items": "count(order_item_id)", "orders": "count(DISTINCT order_id)", "sum": "count(*)"}[mode]


def _revenue(mode: str) -> str:
    return "CAST(sum(price) AS DOUBLE)" if mode == "sum" else f"{_qty(mode)} * avg(price)"


def price_ctes(key: str, mode: str = "items", series: str | None = None) -> str:
    sk = f"{series}, " if series else ""            # series key prefix in select / group by
    sp = f"{series}, " if series else ""            # ... and in partition by
    n = 1 if series else 0
    on = f"pv.{series} = dp.{series} AND " if series else ""
    g2 = ", ".join(str(i) for i in range(1, 3 + n))
    return f"""
pp AS (
  SELECT {sk}product_id, {key}, avg(price) price_mean, {_revenue(mode)} revenue
  FROM d WHERE product_id IS NOT NULL AND {key} IS NOT NULL GROUP BY {g2}),
pf AS (
  SELECT *, last_value(price_mean IGNORE NULLS) OVER (PARTITION BY {sp}product_id ORDER BY {key}
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) ff,
    CASE WHEN count(price_mean) OVER w4 = 4 THEN avg(price_mean) OVER w4 END price_roll4_mean
  FROM pp WINDOW w4 AS (PARTITION BY {sp}product_id ORDER BY {key} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
pg AS (
  SELECT *, ff / nullif(lag(ff, 1) OVER w, 0) - 1 price_var_w1_point,
    ff / nullif(lag(ff, 4) OVER w, 0) - 1 price_var_w4_point,
    last_value(price_roll4_mean IGNORE NULLS) OVER (PARTITION BY {sp}product_id ORDER BY {key}
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) rff
  FROM pf WINDOW w AS (PARTITION BY {sp}product_id ORDER BY {key})),
pv AS (
  SELECT *, rff / nullif(lag(rff, 4) OVER w, 0) - 1 price_var_m4_vs_prev4,
    avg(price_var_w1_point) OVER (PARTITION BY {sp}product_id ORDER BY {key} ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) price_var_w1_smooth
  FROM pg WINDOW w AS (PARTITION BY {sp}product_id ORDER BY {key})),
pcat AS (
  SELECT {('dp.' + series + ', ') if series else ''}dp.product_category_name, pv.{key}, {wavg_sql('pv.price_var_w1_point', 'pv.revenue')} price_var_w1_point_mean,
    {wavg_sql('pv.price_var_w1_smooth', 'pv.revenue')} price_var_w1_smooth_mean,
    {wavg_sql('pv.price_var_w4_point', 'pv.revenue')} price_var_w4_point_mean,
    {wavg_sql('pv.price_var_m4_vs_prev4', 'pv.revenue')} price_var_m4_vs_prev4_mean
  FROM pv JOIN (SELECT DISTINCT {sk}product_id, product_category_name, {key} FROM d) dp
    ON {on}pv.product_id = dp.product_id AND pv.{key} = dp.{key}
  WHERE dp.product_category_name IS NOT NULL
  GROUP BY {g2}),
wcat AS (
  SELECT {sk}product_category_name, {key}, {_revenue(mode)} revenue_cat
  FROM d WHERE product_category_name IS NOT NULL GROUP BY {g2}),
ptime AS (
  SELECT {('pcat.' + series + ', ') if series else ''}pcat.{key}, {', '.join(wavg_sql('pcat.' + m, 'wcat.revenue_cat') + ' ' + m for m in PRICE_MEANS)}
  FROM pcat LEFT JOIN wcat USING ({sk}product_category_name, {key}) GROUP BY {", ".join(str(i) for i in range(1, 2 + n))})"""


def wavg_sql(v: str, w: str) -> str:
    ok = f"({v} IS NOT NULL AND isfinite({v}) AND {w} IS NOT NULL AND isfinite({w}) AND {w} > 0)"
    return f"(sum(CASE WHEN {ok} THEN {v} * {w} END) / nullif(sum(CASE WHEN {ok} THEN {w} END), 0))"


def region_ctes(key: str, suffix: dict[str, str], mode: str = "items", series: str | None = None) -> str:
    sk = f"{series}, " if series else ""
    n = 1 if series else 0
    wide = []
    for metric in DELTA_COLS.values():
        for region, suf in suffix.items():
            wide.append(f"max(CASE WHEN customer_region = '{region}' THEN {metric} END) {metric}_{suf}")
    weighted = []
    for metric, out in WEIGHTED_COLS.items():
        weighted.append(f"CASE WHEN count(*) FILTER (WHERE {metric} IS NULL) = 0 AND sum(sales) > 0 "
                        f"THEN sum({metric} * sales) / sum(sales) END {out}")
    return f"""
preg AS (
  SELECT {sk}customer_region, {key}, avg(delivery_diff_estimated) delivery_diff_estimated_mean,
    avg(estimated_delivery_lead_days) est_delivery_lead_days_mean, CAST(sum(CAST(round(approval_time_hours * 3600000000.0) AS BIGINT)) AS DOUBLE) / 3600000000.0 / nullif(count(approval_time_hours), 0) approval_time_hours_mean,
    {'count(DISTINCT order_id)' if mode == 'orders' else 'count(*)'} sales
  FROM d WHERE customer_region IS NOT NULL AND {key} IS NOT NULL GROUP BY {", ".join(str(i) for i in range(1, 3 + n))}),
treg AS (SELECT {sk}{key}, {', '.join(wide + weighted)} FROM preg GROUP BY {", ".join(str(i) for i in range(1, 2 + n))}),
target AS (SELECT {sk}{key}, CAST({_qty(mode)} AS BIGINT) sales_qty FROM d WHERE {key} IS NOT NULL GROUP BY {", ".join(str(i) for i in range(1, 2 + n))})"""


def region_cols(suffix: dict[str, str]) -> list[str]:
    cols = [f"{m}_{s}" for m in DELTA_COLS.values() for s in suffix.values()]
    return cols + list(WEIGHTED_COLS.values())


def period_table_ctes(freq: str, suffix: dict[str, str] = FIXTURE_REGION_SUFFIX,
                      mode: str = "items", series: str | None = None) -> tuple[str, str, list[str]]:
    key = "order_week" if freq == "W" else "order_date"
    sk = f"{series}, " if series else ""
    ctes = (RAW_CTES + "," + keyed_cte(freq) + "," + price_ctes(key, mode, series) + ","
            + region_ctes(key, suffix, mode, series) + f""",
period AS (
  SELECT {('t.' + series + ', ') if series else ''}t.{key}, t.sales_qty, {', '.join('p.' + m for m in PRICE_MEANS)}, {', '.join('g.' + c for c in region_cols(suffix))}
  FROM target t LEFT JOIN ptime p USING ({sk}{key}) LEFT JOIN treg g USING ({sk}{key}))""")
    return ctes, key, ["sales_qty", *PRICE_MEANS, *region_cols(suffix)]


def select_rounded(cols: list[str], doubles: set[str], snap: bool = True) -> str:
    return ", ".join(r(c, c) if (c in doubles and snap) else c for c in cols)


def period_table_sql(freq: str, mode: str = "items", series: str | None = None) -> str:
    ctes, key, cols = period_table_ctes(freq, mode=mode, series=series)
    doubles = set(cols) - {"sales_qty"}
    sk = f"{series}, " if series else ""
    return f"WITH {ctes}\nSELECT {sk}{key}, {select_rounded(cols, doubles)} FROM period"


HOLIDAY_CTE = """
yrs AS (SELECT CAST(y AS INTEGER) y FROM generate_series(1900, 2100) g(y)),
easter AS (
  SELECT y, (y % 19) a, y // 100 b, y % 100 c FROM yrs),
easter2 AS (
  SELECT y, a, b, c, b // 4 dd, b % 4 e, (b + 8) // 25 f, c // 4 i, c % 4 k FROM easter),
easter3 AS (
  SELECT y, a, dd, e, i, k, b, (19 * a + b - dd - ((b - f + 1) // 3) + 15) % 30 h FROM easter2),
easter4 AS (
  SELECT y, a, h, (32 + 2 * e + 2 * i - h - k) % 7 l FROM easter3),
easter5 AS (
  SELECT y, h, l, (a + 11 * h + 22 * l) // 451 m FROM easter4),
hol AS (
  SELECT make_date(y, CAST((h + l - 7 * m + 114) // 31 AS INTEGER), CAST(((h + l - 7 * m + 114) % 31) + 1 AS INTEGER)) - INTERVAL 2 DAY AS hd FROM easter5
  UNION ALL SELECT make_date(y, 1, 1) FROM yrs UNION ALL SELECT make_date(y, 4, 21) FROM yrs
  UNION ALL SELECT make_date(y, 5, 1) FROM yrs UNION ALL SELECT make_date(y, 9, 7) FROM yrs
  UNION ALL SELECT make_date(y, 10, 12) FROM yrs UNION ALL SELECT make_date(y, 11, 2) FROM yrs
  UNION ALL SELECT make_date(y, 11, 15) FROM yrs UNION ALL SELECT make_date(y, 11, 20) FROM yrs WHERE y >= 2024
  UNION ALL SELECT make_date(y, 12, 25) FROM yrs)"""


def model_table_ctes(freq: str) -> tuple[str, str, list[str], set[str]]:
    ctes, key, cols = period_table_ctes(freq)
    lag_sql, roll_sql, feat_cols = [], [], []
    for c in LAG_COLS:
        for lag in LAGS:
            lag_sql.append(f"lag({c}, {lag}) OVER w {c}_lag{lag}")
            feat_cols.append(f"{c}_lag{lag}")
    for c in ROLL_COLS:
        for win in ROLL_WINDOWS:
            frame = f"(ORDER BY {key} ROWS BETWEEN {win} PRECEDING AND 1 PRECEDING)"
            full = f"count({c}) OVER {frame} = {win}"
            roll_sql.append(f"CASE WHEN {full} THEN avg({c}) OVER {frame} END {c}_roll{win}_mean")
            roll_sql.append(f"CASE WHEN {full} THEN stddev_samp({c}) OVER {frame} END {c}_roll{win}_std")
            feat_cols += [f"{c}_roll{win}_mean", f"{c}_roll{win}_std"]
    span = 6 if freq == "W" else 0
    t = key
    bf = f"(make_date(year({t}), 11, 30) - CAST((dayofweek(make_date(year({t}), 11, 30)) + 2) % 7 AS INTEGER))"
    cal = f"""
    year({t}) AS year, quarter({t}) AS quarter, month({t}) AS month, weekofyear({t}) AS weekofyear,
    sin(2 * pi() * (month({t}) - 1) / 12.0) month_sin, cos(2 * pi() * (month({t}) - 1) / 12.0) month_cos,
    sin(2 * pi() * (weekofyear({t}) - 1) / 52.0) week_sin, cos(2 * pi() * (weekofyear({t}) - 1) / 52.0) week_cos,
    CAST(day({t}) = 1 AS INTEGER) is_month_start, CAST({t} = last_day({t}) AS INTEGER) is_month_end,
    CAST({t} = date_trunc('quarter', {t})::DATE AS INTEGER) is_quarter_start,
    CAST({bf} BETWEEN {t} AND {t} + {span} AS INTEGER) is_black_friday_week,
    CAST({bf} + 3 BETWEEN {t} AND {t} + {span} AS INTEGER) is_cyber_monday_week,
    CAST(make_date(year({t}), 12, 25) BETWEEN {t} AND {t} + {span} AS INTEGER) is_christmas_week"""
    ctes += "," + HOLIDAY_CTE + f""",
hcount AS (
  SELECT p.{key}, count(DISTINCT hol.hd) n FROM period p LEFT JOIN hol ON hol.hd BETWEEN p.{key} AND p.{key} + INTERVAL {span} DAY
  GROUP BY 1),
model AS (
  SELECT period.*, {', '.join(lag_sql + roll_sql)}, {cal},
    CAST(hcount.n > 0 AS INTEGER) is_br_holiday_week, CAST(hcount.n AS INTEGER) n_br_holidays_week
  FROM period JOIN hcount USING ({key})
  WINDOW w AS (ORDER BY {key}))"""
    cal_cols = ["year", "quarter", "month", "weekofyear", "month_sin", "month_cos", "week_sin", "week_cos",
                "is_month_start", "is_month_end", "is_quarter_start", "is_black_friday_week",
                "is_cyber_monday_week", "is_christmas_week", "is_br_holiday_week", "n_br_holidays_week"]
    all_cols = cols + feat_cols + cal_cols
    doubles = (set(cols) - {"sales_qty"}) | set(feat_cols) | {"month_sin", "month_cos", "week_sin", "week_cos"}
    return ctes, key, all_cols, doubles


def model_table_sql(freq: str) -> str:
    ctes, key, cols, doubles = model_table_ctes(freq)
    return f"WITH {ctes}\nSELECT {key}, {select_rounded(cols, doubles)} FROM model"


def imputed_sql(freq: str, snap: bool = True) -> str:
    ctes, key, cols, doubles = model_table_ctes(freq)
    var = [c for c in cols if c.startswith(("price_var", "qty_var", "sales"))]
    import re
    regional = re.compile(r"_(n|ne|se|s|co)$")
    feats = [c for c in cols if c not in {"order_week", "order_date", "sales_qty"} and not regional.search(c)]
    exprs = []
    for c in cols:
        e = f"coalesce({c}, 0.0)" if c in var and c != "sales_qty" else c
        if c == "sales_qty":
            e = "sales_qty"
        exprs.append(f"{e} AS {c}")
    ctes += f",\nimp AS (SELECT {key}, {', '.join(exprs)} FROM model)"
    have = " OR ".join(f"{c} IS NULL" for c in feats)
    return (f"WITH {ctes}\nSELECT {key}, {select_rounded(cols, doubles, snap)}, CAST(({have}) AS INTEGER) have_nulls FROM imp")


def _merged_sql(extra_where: str = "") -> str:
    cols = ", ".join(r(c, c) if c in ("price", "freight_value") else c for c in MERGED_COLS)
    return f"WITH {RAW_CTES}\nSELECT {cols} FROM merged {extra_where}"


def _period_block_sql(freq: str, tail: str) -> str:
    ctes, key, _ = period_table_ctes(freq)
    return f"WITH {ctes}\n{tail}"


_W = "order_week"
_TIME_COLS = [f"{m}_{s}" for m in DELTA_COLS.values() for s in FIXTURE_REGION_SUFFIX.values()] + list(WEIGHTED_COLS.values())

ORACLE: dict[str, str] = {
    "a10_w6_sales_lag1_weekly": f"""WITH {RAW_CTES},
t AS (SELECT date_trunc('week', order_purchase_timestamp)::DATE order_week, CAST(count(order_item_id) AS BIGINT) sales_qty
      FROM merged GROUP BY 1)
SELECT order_week, sales_qty, lag(sales_qty, 1) OVER (ORDER BY order_week) sales_qty_lag1 FROM t""",
    "p7_merged_items": _merged_sql(),
    "p8_top_categories_state": f"""WITH {RAW_CTES},
sp AS (SELECT * FROM merged WHERE customer_state = 'NATION_11'),
top AS (SELECT product_category_name FROM sp WHERE product_category_name IS NOT NULL GROUP BY 1
        ORDER BY count(product_id) DESC, product_category_name LIMIT 7)
SELECT {', '.join(r(c, c) if c in ('price', 'freight_value') else c for c in MERGED_COLS)}
FROM sp WHERE product_category_name IN (SELECT product_category_name FROM top)""",
    "p5_customer_region": """SELECT CAST(c_custkey AS VARCHAR) customer_id, CAST(c_custkey AS VARCHAR) customer_unique_id,
  n_name customer_state, r_name region_dim,
  CASE WHEN upper(n_name) IN ('AC','AP','AM','PA','RO','RR','TO') THEN 'Norte'
       WHEN upper(n_name) IN ('AL','BA','CE','MA','PB','PE','PI','RN','SE') THEN 'Nordeste'
       WHEN upper(n_name) IN ('DF','GO','MT','MS') THEN 'Centro-Oeste'
       WHEN upper(n_name) IN ('ES','MG','RJ','SP') THEN 'Sudeste'
       WHEN upper(n_name) IN ('PR','RS','SC') THEN 'Sul' ELSE 'estado inválido' END region_fixed
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "f1_time_deltas": f"WITH {RAW_CTES}, {keyed_cte('W')}\nSELECT order_id, order_item_id, "
                      "CAST(delivery_diff_estimated AS BIGINT) delivery_diff_estimated, "
                      "CAST(estimated_delivery_lead_days AS BIGINT) estimated_delivery_lead_days, "
                      f"{r('approval_time_hours', 'approval_time_hours')} FROM d",
    "w1_price_vars_product_weekly": _period_block_sql("W", "SELECT product_id, order_week, " + ", ".join(
        r(c, c) for c in ["price_mean", "price_roll4_mean", "price_var_w1_point", "price_var_w4_point",
                          "price_var_m4_vs_prev4", "price_var_w1_smooth"]) + " FROM pv"),
    "a4_price_vars_category_weekly": _period_block_sql("W", "SELECT product_category_name, order_week, " + ", ".join(
        r(m, m) for m in PRICE_MEANS) + " FROM pcat"),
    "a5_price_vars_time_weekly": _period_block_sql("W", "SELECT order_week, " + ", ".join(
        r(m, m) for m in PRICE_MEANS) + " FROM ptime"),
    "a9_time_metrics_wide_weighted_weekly": _period_block_sql("W", "SELECT order_week, " + ", ".join(
        r(c, c) for c in _TIME_COLS) + " FROM treg"),
    "a10_sales_target_daily": _period_block_sql("D", "SELECT order_date, sales_qty FROM target"),
    "a12_period_table_weekly": period_table_sql("W"),
    "a12_period_table_daily": period_table_sql("D"),
    "f9_model_table_weekly": model_table_sql("W"),
    "f9_model_table_daily": model_table_sql("D"),
    "i5_imputed_weekly": imputed_sql("W"),
}


_WT = f"""WITH {RAW_CTES},
wt AS (SELECT date_trunc('week', order_purchase_timestamp)::DATE order_week, CAST(count(order_item_id) AS BIGINT) sales_qty
       FROM merged GROUP BY 1)"""

_METRIC_SELECT = """
  SELECT {grp} {r_rmse}, {r_mape}, {r_wape}, {r_mase}, {r_rmsse} FROM (
    SELECT {grp} sqrt(avg((y - p) * (y - p))) rmse,
      avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100 mape,
      sum(abs(y - p)) / nullif(sum(abs(y)), 0) * 100 wape,
      CASE WHEN count(*) > {s} THEN avg(abs(y - p)) / nullif(avg(abs(nv)), 0) END mase,
      CASE WHEN count(*) > {s} THEN sqrt(avg((y - p) * (y - p))) / nullif(sqrt(avg(nv * nv)), 0) END rmsse
    FROM (SELECT *, y - lag(y, {s}) OVER ({part} ORDER BY date) nv FROM preds) x {groupby})"""


def _metric_sql(s: int, grouped: bool) -> str:
    grp = "model," if grouped else ""
    return _METRIC_SELECT.format(grp=grp, s=s, part="PARTITION BY model" if grouped else "",
                                 groupby="GROUP BY model" if grouped else "",
                                 r_rmse=r("rmse", "rmse"), r_mape=r("mape", "mape"), r_wape=r("wape", "wape"),
                                 r_mase=r("mase", "mase"), r_rmsse=r("rmsse", "rmsse"))


ORACLE.update({
    "b1_rolling_folds_weekly": _WT + """,
v AS (SELECT CAST(ceil(date_diff('day', DATE '2000-06-25', order_week) / 7.0) AS INTEGER) - 1 fold_id
      FROM wt WHERE order_week > DATE '2000-06-25'),
vc AS (SELECT fold_id, count(*) n_valid FROM v GROUP BY 1),
stop AS (SELECT min(k) k FROM generate_series(0, (SELECT max(fold_id) + 1 FROM vc)) g(k)
         WHERE k NOT IN (SELECT fold_id FROM vc)),
base AS (SELECT count(*) b FROM wt WHERE order_week <= DATE '2000-06-25')
SELECT vc.fold_id, TIMESTAMP '2000-06-25' + vc.fold_id * INTERVAL 7 DAY train_end,
  TIMESTAMP '2000-06-25' + (vc.fold_id + 1) * INTERVAL 7 DAY valid_end,
  CAST((SELECT b FROM base) + coalesce((SELECT sum(n_valid) FROM vc v2 WHERE v2.fold_id < vc.fold_id), 0) AS BIGINT) n_train,
  CAST(vc.n_valid AS BIGINT) n_valid
FROM vc WHERE vc.fold_id < (SELECT k FROM stop)""",
    "b2_time_series_cv": _WT + """,
s AS (SELECT order_week, row_number() OVER (ORDER BY order_week) - 1 r, count(*) OVER () n FROM wt
      WHERE order_week <= DATE '2000-06-25'),
k AS (SELECT *, n // 4 size, n - 3 * (n // 4) ft FROM s),
a AS (SELECT *, CASE WHEN size > 0 AND r >= ft THEN CAST((r - ft) // size AS INTEGER) END split_id FROM k),
g AS (SELECT split_id, min(order_week) test_first, max(order_week) test_last, count(*) n_test, min(r) r0 FROM a
      WHERE split_id IS NOT NULL GROUP BY 1)
SELECT g.split_id, CAST(g.r0 AS BIGINT) n_train, CAST(g.n_test AS BIGINT) n_test,
  (SELECT max(order_week) FROM a WHERE a.r < g.r0) train_last, g.test_first, g.test_last FROM g""",
    "b10_compare_lag_models": _WT + """,
lg AS (SELECT order_week, sales_qty, lag(sales_qty, 1) OVER (ORDER BY order_week) l1,
       lag(sales_qty, 4) OVER (ORDER BY order_week) l4 FROM wt),
preds AS (SELECT 'lag1' model, order_week date, CAST(sales_qty AS DOUBLE) y, CAST(l1 AS DOUBLE) p FROM lg WHERE l1 IS NOT NULL
   UNION ALL SELECT 'lag4', order_week, sales_qty, l4 FROM lg WHERE l4 IS NOT NULL)""" + _metric_sql(1, True),
    "b9_metrics_seasonal4": _WT + """,
preds AS (SELECT order_week date, CAST(sales_qty AS DOUBLE) y, CAST(l1 AS DOUBLE) p FROM (
  SELECT order_week, sales_qty, lag(sales_qty, 1) OVER (ORDER BY order_week) l1 FROM wt) WHERE l1 IS NOT NULL)""" + _metric_sql(4, False),
    "w11_lookback_sequences": _WT + """
SELECT order_week, x_seq_csv, y FROM (
  SELECT order_week, array_to_string(list(sales_qty) OVER (ORDER BY order_week ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING), ',') x_seq_csv,
    count(sales_qty) OVER (ORDER BY order_week ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) c, sales_qty y FROM wt) WHERE c = 14""",
    "w12_seasonal_difference": _WT + """
SELECT order_week, sales_qty, sales_qty - lag(sales_qty, 52) OVER (ORDER BY order_week) sales_qty_sdiff52 FROM wt""",
    "w13_infer_freq": f"""WITH {RAW_CTES},
dw AS (SELECT DISTINCT date_trunc('week', order_purchase_timestamp)::DATE d FROM merged),
dd AS (SELECT DISTINCT CAST(order_purchase_timestamp AS DATE) d FROM merged),
gw2 AS (SELECT median(g) m FROM (SELECT date_diff('day', lag(d) OVER (ORDER BY d), d) g FROM dw) WHERE g IS NOT NULL),
gd2 AS (SELECT median(g) m FROM (SELECT date_diff('day', lag(d) OVER (ORDER BY d), d) g FROM dd) WHERE g IS NOT NULL)
SELECT {r('m', 'median_gap_days')}, CASE WHEN m >= 6 THEN 'W' ELSE 'D' END freq, 'order_week' time_col FROM gw2
UNION ALL SELECT {r('m', 'median_gap_days')}, CASE WHEN m >= 6 THEN 'W' ELSE 'D' END, 'order_date' FROM gd2""",
})


def rr(num: str, den: str, scale: int = 100, decimals: int = 2) -> str:
    """Exact half-even rounding of num/den*scale (integer arithmetic), as
    ``functions.stats.round_ratio_half_even``."""
    p = 10 ** decimals
    n = f"(CAST({num} AS HUGEINT) * {scale * p})"
    d = f"CAST({den} AS HUGEINT)"
    q = f"({n} // {d})"
    rem = f"({n} - {q} * {d})"
    up = f"(CASE WHEN 2 * {rem} > {d} OR (2 * {rem} = {d} AND {q} % 2 = 1) THEN 1 ELSE 0 END)"
    return f"(CAST({q} + {up} AS DOUBLE) / {float(p)})"


REVIEWS_CTE = """,
reviews_x AS (
  SELECT CAST(o_orderkey AS VARCHAR) review_id, CAST(o_orderkey AS VARCHAR) order_id,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) review_score FROM orders
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR) || 'b', CAST(o_orderkey AS VARCHAR), 6 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
  FROM orders WHERE o_orderkey % 50 = 0),
otimes AS (
  SELECT *, (epoch_us(order_approved_at) - epoch_us(order_purchase_timestamp)) / 3600000000.0 approval_time_hours,
    floor((epoch_us(order_estimated_delivery_date) - epoch_us(order_purchase_timestamp)) / 86400000000.0) prazo
  FROM orders_x)"""
EXP = f"WITH {RAW_CTES}{REVIEWS_CTE}"
RAW_TABLE_COLS = {
    "orders": ("orders_x", ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
                            "order_estimated_delivery_date"]),
    "order_items": ("items_x", ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value",
                                "order_delivered_carrier_date", "order_delivered_customer_date"]),
    "products": ("products_x", ["product_id", "product_category_name"]),
    "customers": ("customers_x", ["customer_id", "customer_unique_id", "customer_state"]),
    "order_reviews": ("reviews_x", ["review_id", "order_id", "review_score"]),
}


def _describe_sql(src: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' feature, CAST(count({c}) AS BIGINT) count, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')},
  {r(f'min({c})', 'min')}, {r(f'quantile_cont({c}, 0.25)', 'p25')}, {r(f'quantile_cont({c}, 0.5)', 'p50')},
  {r(f'quantile_cont({c}, 0.75)', 'p75')}, {r(f'max({c})', 'max')} FROM {src}""")
    return "\nUNION ALL ".join(parts)


def _summary_sql() -> str:
    ctes, key, cols = period_table_ctes("W")
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        dtype = "bigint" if c == "sales_qty" else "double"
        nn = f"count({c})"
        skew = (f"CASE WHEN {nn} > 2 THEN CASE WHEN var_pop({x}) = 0 THEN 0.0 ELSE "
                f"(avg(power({x} - mu, 3)) / power(var_pop({x}), 1.5)) * sqrt({nn} * ({nn} - 1.0)) / ({nn} - 2.0) END END")
        kurt = (f"CASE WHEN {nn} > 3 THEN CASE WHEN var_pop({x}) = 0 THEN 0.0 ELSE "
                f"({nn} - 1.0) / (({nn} - 2.0) * ({nn} - 3.0)) * (({nn} + 1.0) * (avg(power({x} - mu, 4)) / power(var_pop({x}), 2) - 3) + 6) END END")
        parts.append(f"""SELECT '{c}' feature, '{dtype}' dtype, CAST({nn} AS BIGINT) count_notnull,
  {r(rr(nn, 'count(*)', 100, 2), 'pct_notnull')}, {r(f'min({x})', 'min')}, {r(f'quantile_cont({x}, 0.25)', 'p25')},
  {r(f'quantile_cont({x}, 0.5)', 'p50')}, {r(f'quantile_cont({x}, 0.75)', 'p75')}, {r(f'max({x})', 'max')},
  {r(f'avg({x})', 'mean')}, {r(f'CASE WHEN {nn} > 1 THEN stddev_samp({x}) END', 'std')}, {r(skew, 'skew')},
  {r(kurt, 'kurtosis')}, CAST(count(DISTINCT {x}) AS BIGINT) n_unique
FROM (SELECT {c}, avg({x}) OVER () mu FROM period)""")
    return f"WITH {ctes}\n" + "\nUNION ALL ".join(parts)


def _dup_sql() -> str:
    parts = [f"SELECT '{name}' dataset, CAST(count(*) AS BIGINT) rows, CAST(count(*) - (SELECT count(*) FROM "
             f"(SELECT DISTINCT * FROM {cte})) AS BIGINT) duplicates FROM {cte}"
             for name, (cte, _) in RAW_TABLE_COLS.items()]
    return EXP + "\n" + "\nUNION ALL ".join(parts)


def _null_sql() -> str:
    parts = []
    for name, (cte, cols) in RAW_TABLE_COLS.items():
        for c in cols:
            parts.append(f"SELECT '{name}' dataset, '{c}' \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) nulls FROM {cte}")
    return EXP + "\nSELECT * FROM (" + "\nUNION ALL ".join(parts) + ") WHERE nulls > 0"


_ITEM_CHANGES = """,
freq AS (SELECT product_id FROM items_x WHERE product_id IS NOT NULL GROUP BY 1 HAVING count(order_id) >= 3),
chg AS (
  SELECT i.product_id, o.order_id, i.order_item_id, o.order_purchase_timestamp, i.price,
    (i.price / nullif(lag(i.price) OVER (PARTITION BY i.product_id ORDER BY o.order_purchase_timestamp, o.order_id, i.order_item_id, i.seller_id, i.price, i.freight_value), 0) - 1) * 100 price_pct_change
  FROM orders_x o JOIN items_x i ON o.order_id = i.order_id WHERE i.product_id IN (SELECT product_id FROM freq))"""

ORACLE.update({
    "p9_duplicate_rows": _dup_sql(),
    "p10_null_profile": _null_sql(),
    "p16_product_labels": f"WITH {RAW_CTES}\nSELECT product_id, 'produto' || CAST(dense_rank() OVER (ORDER BY product_id) AS VARCHAR) produto_n "
                          "FROM (SELECT DISTINCT product_id FROM merged)",
    "a11_price_vars_category_unweighted_weekly": _period_block_sql("W", """SELECT dp.product_category_name, pv.order_week, """ +
        ", ".join(r(f"avg(pv.{v})", f"{v}_mean") for v in ["price_var_w1_point", "price_var_w1_smooth", "price_var_w4_point", "price_var_m4_vs_prev4"]) + """
FROM pv JOIN (SELECT DISTINCT product_id, product_category_name, order_week FROM d) dp
  ON pv.product_id = dp.product_id AND pv.order_week = dp.order_week
WHERE dp.product_category_name IS NOT NULL GROUP BY 1, 2"""),
    "a13_products_per_order": EXP + f""",
per AS (SELECT o.order_id, count(DISTINCT i.product_id) n FROM orders_x o JOIN items_x i ON o.order_id = i.order_id GROUP BY 1)
SELECT CAST(count(*) AS BIGINT) groups, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) groups_multi,
  {r(rr('count(*) FILTER (WHERE n > 1)', 'count(*)', 100, 4), 'pct_multi')}, {r('avg(n)', 'mean_distinct')}, CAST(max(n) AS BIGINT) max_distinct FROM per""",
    "a14_sellers_per_product": EXP + f""",
per AS (SELECT product_id, count(DISTINCT seller_id) n FROM items_x WHERE product_id IS NOT NULL GROUP BY 1)
SELECT CAST(count(*) AS BIGINT) groups, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) groups_multi,
  {r(rr('count(*) FILTER (WHERE n > 1)', 'count(*)', 100, 4), 'pct_multi')}, {r('avg(n)', 'mean_distinct')}, CAST(max(n) AS BIGINT) max_distinct FROM per""",
    "a15_row_distinct_counts": EXP + """
SELECT 'orders_rows' metric, CAST(count(*) AS BIGINT) value FROM orders_x
UNION ALL SELECT 'orders_order_id_distinct', count(DISTINCT order_id) FROM orders_x
UNION ALL SELECT 'items_rows', count(*) FROM items_x i LEFT JOIN products_x p ON i.product_id = p.product_id
UNION ALL SELECT 'items_order_id_distinct', count(DISTINCT i.order_id) FROM items_x i LEFT JOIN products_x p ON i.product_id = p.product_id
UNION ALL SELECT 'items_order_item_id_distinct', count(DISTINCT i.order_item_id) FROM items_x i LEFT JOIN products_x p ON i.product_id = p.product_id
UNION ALL SELECT 'items_product_category_name_distinct', count(DISTINCT p.product_category_name) FROM items_x i LEFT JOIN products_x p ON i.product_id = p.product_id""",
    "a16_capped_sales_frequency": EXP + f""",
per AS (SELECT least(count(order_id), 10) n_vendas FROM items_x WHERE product_id IS NOT NULL GROUP BY product_id),
c AS (SELECT n_vendas, count(*) c FROM per GROUP BY 1)
SELECT n_vendas, {r('c * 100.0 / sum(c) OVER ()', 'frequencia')},
  {r('sum(c) OVER (ORDER BY n_vendas DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0 / sum(c) OVER ()', 'frequencia_acumulada')}
FROM c""",
    "a17_a19_sales_volume_buckets": EXP + f""",
per AS (SELECT product_id, count(order_id) n, least(count(order_id), 10) bucket FROM items_x WHERE product_id IS NOT NULL GROUP BY 1),
vol AS (SELECT bucket, sum(n) vol FROM per GROUP BY 1),
fl AS (SELECT CAST(g AS INTEGER) n_vendas_min, coalesce(vol, 0) vol FROM generate_series(1, 10) t(g) LEFT JOIN vol ON vol.bucket = g),
pct AS (SELECT n_vendas_min, {rr('vol', '(SELECT sum(vol) FROM fl)', 100, 2)} frequencia FROM fl),
sc AS (SELECT p.bucket, r.review_score FROM items_x i LEFT JOIN reviews_x r ON i.order_id = r.order_id
       LEFT JOIN per p ON i.product_id = p.product_id),
m AS (SELECT bucket, {rr('sum(review_score)', 'count(review_score)', 1, 2)} media_review_score FROM sc GROUP BY 1)
SELECT n_vendas_min, {r('frequencia', 'frequencia')},
  {r('round(sum(frequencia) OVER (ORDER BY n_vendas_min DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2)', 'frequencia_acumulada')},
  {r('m.media_review_score', 'media_review_score')}
FROM pct LEFT JOIN m ON m.bucket = pct.n_vendas_min""",
    "a18_review_multiplicity": EXP + """,
per AS (SELECT i.order_id, i.product_id, count(DISTINCT r.review_id) n_reviews FROM items_x i LEFT JOIN reviews_x r ON i.order_id = r.order_id GROUP BY 1, 2)
SELECT n_reviews, CAST(count(DISTINCT order_id) AS BIGINT) orders, CAST(count(DISTINCT product_id) AS BIGINT) products FROM per GROUP BY 1""",
    "a20_category_table": EXP + f""",
ip AS (SELECT i.order_id, i.product_id, p.product_category_name c FROM items_x i LEFT JOIN products_x p ON i.product_id = p.product_id
       WHERE p.product_category_name IS NOT NULL),
per AS (SELECT c, count(order_id) vendas, count(DISTINCT product_id) itens FROM ip GROUP BY 1),
best AS (SELECT c FROM per ORDER BY vendas DESC, c LIMIT 20),
lab AS (SELECT CASE WHEN c IN (SELECT c FROM best) THEN c ELSE 'outros' END categoria, vendas, itens FROM per),
agg AS (SELECT categoria, CAST(sum(vendas) AS BIGINT) vendas, CAST(sum(itens) AS BIGINT) itens FROM lab GROUP BY 1)
SELECT categoria, vendas, itens, {r(rr('vendas', 'itens', 1, 2), 'vendas_por_item')},
  CAST({rr('vendas', '(SELECT sum(vendas) FROM agg)', 100, 2)} AS VARCHAR) || '%' percentual_vendas FROM agg""",
    "a21_late_delivery_share": EXP + f""",
j AS (SELECT o.order_estimated_delivery_date e, i.order_delivered_carrier_date c FROM orders_x o LEFT JOIN items_x i ON o.order_id = i.order_id)
SELECT CAST(count(*) AS BIGINT) rows, CAST(count(*) FILTER (WHERE epoch_us(e) - epoch_us(c) < 0) AS BIGINT) late,
  {r(rr('count(*) FILTER (WHERE epoch_us(e) - epoch_us(c) < 0)', 'count(*)', 100, 4), 'late_pct')} FROM j""",
    "a22_describe_order_times": EXP + "\n" + _describe_sql("otimes", ["approval_time_hours", "prazo"]),
    "a23_summarize_period_table": _summary_sql(),
    "w8_item_price_changes": EXP + _ITEM_CHANGES + f"""
SELECT product_id, order_id, order_item_id, order_purchase_timestamp, {r('price', 'price')}, {r('price_pct_change', 'price_pct_change')} FROM chg""",
    "a24_nonzero_price_change_share": EXP + _ITEM_CHANGES + f"""
SELECT CAST(count(price_pct_change) AS BIGINT) changes, CAST(count(*) FILTER (WHERE price_pct_change <> 0) AS BIGINT) nonzero,
  {r(rr('count(*) FILTER (WHERE price_pct_change <> 0)', 'count(price_pct_change)', 100, 4), 'nonzero_pct')} FROM chg""",
    "a25_histogram_approval_hours": EXP + f""",
b AS (SELECT min(approval_time_hours) lo, max(approval_time_hours) hi FROM otimes),
s AS (SELECT lo, CASE WHEN hi > lo THEN hi - lo ELSE 1.0 END span FROM b),
c AS (SELECT CAST(least(floor((approval_time_hours - s.lo) * 50.0 / s.span), 49) AS INTEGER) bin, count(*) n
      FROM otimes, s WHERE approval_time_hours IS NOT NULL GROUP BY 1)
SELECT CAST(g AS INTEGER) bin, {r('s.lo + g * s.span / 50.0', 'lower')}, {r('s.lo + (g + 1) * s.span / 50.0', 'upper')},
  CAST(coalesce(c.n, 0) AS BIGINT) count
FROM generate_series(0, 49) t(g) CROSS JOIN s LEFT JOIN c ON c.bin = g""",
    "a26_box_lead_days_by_region": EXP + f""",
base AS (SELECT sr.region customer_region, CAST(o.prazo AS DOUBLE) v FROM otimes o LEFT JOIN customers_x c ON o.customer_id = c.customer_id
         LEFT JOIN state_region sr ON c.customer_state = sr.state WHERE o.prazo IS NOT NULL),
q AS (SELECT customer_region, quantile_cont(v, 0.25) q1, quantile_cont(v, 0.5) med, quantile_cont(v, 0.75) q3 FROM base GROUP BY 1)
SELECT q.customer_region, {r('q1', 'q1')}, {r('med', 'median')}, {r('q3', 'q3')}, {r('q3 - q1', 'iqr')},
  {r('min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) THEN v END)', 'whisker_low')},
  {r('max(CASE WHEN v <= q3 + 1.5 * (q3 - q1) THEN v END)', 'whisker_high')},
  CAST(count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS BIGINT) outliers, CAST(count(*) AS BIGINT) n
FROM base JOIN q ON base.customer_region = q.customer_region GROUP BY q.customer_region, q1, med, q3""",
    "w10_weekly_share": _WT + f"\nSELECT order_week, sales_qty, {r('sales_qty / sum(sales_qty) OVER ()', 'share')} FROM wt",
})


def _imputed_cols() -> tuple[list[str], dict[str, str]]:
    ctes, key, cols, doubles = model_table_ctes("W")
    cols = cols + ["have_nulls"]
    types = {c: ("DOUBLE" if c in doubles else "INT") for c in cols}
    return cols, types


def _e1_sql() -> str:
    cols, _ = _imputed_cols()
    feats = [c for c in cols if c != "sales_qty"]
    parts = [f"""SELECT '{c}' feature, {r(f'count({c}) / count(*)', 'nonnull_frac')},
  (count({c}) > 0 AND count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN (0, 1)) = 0) is_binary FROM imp"""
             for c in feats]
    body = "\nUNION ALL ".join(parts)
    return (f"WITH imp AS ({imputed_sql('W', snap=False)})\nSELECT *, (coalesce(nonnull_frac, 0) >= 0.6 AND NOT is_binary) selected "
            f"FROM ({body})")


def _selected_features_sql() -> tuple[str, list[str]]:
    cols, _ = _imputed_cols()
    return f"WITH imp AS ({imputed_sql('W', snap=False)})", [c for c in cols if c != "sales_qty"]


def _plain(expr: str, alias: str) -> str:
    return f"{expr} AS {alias}"


def _selected_pairs_sql() -> str:
    """CTEs up to ``pairs``: (feature, x, y) rows of the selected features."""
    head, feats = _selected_features_sql()
    sel = "\nUNION ALL ".join(
        f"SELECT '{c}' feature, CAST({c} AS DOUBLE) x, CAST(sales_qty AS DOUBLE) y FROM imp" for c in feats)
    prof = _e1_sql().split("\nSELECT *, ", 1)[1]
    return f"""{head},
prof AS (SELECT *, (coalesce(nonnull_frac, 0) >= 0.6 AND NOT is_binary) selected FROM ({prof.split(' FROM (', 1)[1][:-1]})),
longv AS ({sel}),
pairs AS (SELECT * FROM longv WHERE x IS NOT NULL AND y IS NOT NULL AND feature IN (SELECT feature FROM prof WHERE selected))"""


def _e2_sql(snap: bool = True) -> str:
    """The p-value by hypergeometric series: of the tail itself, whose terms are all positive, or
    of the complement where t^2 / 2 is small."""
    rs = r if snap else _plain
    front = "(nu / 2.0) * ln(q) + 0.5 * ln(r2) + lgamma((nu + 1) / 2.0) - lgamma(nu / 2.0) - lgamma(0.5)"
    tail = ("list_sum([exp(lgamma((nu + 1) / 2.0 + j) - lgamma((nu + 1) / 2.0) - lgamma(nu / 2.0 + 1 + j) + lgamma(nu / 2.0 + 1) + j * ln(q)) "
            "FOR j IN range(0, CAST(ceil(45 / r2) AS BIGINT))])")
    rest = ("list_sum([exp(lgamma((nu + 1) / 2.0 + j) - lgamma((nu + 1) / 2.0) - lgamma(1.5 + j) + lgamma(1.5) + j * ln(r2)) "
            "FOR j IN range(0, 600)])")
    return f"""{_selected_pairs_sql()},
g AS (SELECT feature, count(*) n, CASE WHEN count(*) >= 3 AND max(x) > min(x) AND max(y) > min(y)
        THEN least(1.0, greatest(-1.0, covar_samp(x, y) / (stddev_samp(x) * stddev_samp(y)))) END r FROM pairs GROUP BY 1),
h AS (SELECT feature, n, r, r * r r2, 1 - r * r q, CAST(n - 2 AS DOUBLE) nu FROM g),
p AS (SELECT feature, n, r, CASE WHEN r IS NULL THEN NULL WHEN r2 = 0 THEN 0.0 WHEN q = 0 THEN NULL
        WHEN nu * r2 <= 8 * q THEN ln(1 - exp({front}) * 2 * {rest})
        ELSE {front} - ln(nu / 2.0) + ln({tail}) END lnp FROM h)
SELECT feature, {rs('r', 'pearson_r')}, CAST(n AS BIGINT) n_used,
  {rs('CASE WHEN r IS NOT NULL THEN coalesce(exp(lnp), 0.0) END', 'pearson_pvalue')}, {rs('lnp / ln(10)', 'log10_pvalue')} FROM p"""


def _binned_mi_tail(keys: str) -> str:
    """CTEs from ``pairs`` (keys, x, y) to ``mi``: bins by the rank of the first equal value."""
    return f"""
n0 AS (SELECT *, count(*) OVER (PARTITION BY {keys}) n FROM pairs),
rk AS (SELECT {keys}, n, least(64, greatest(2, CAST(floor(sqrt(n / 5.0)) AS BIGINT))) b,
         rank() OVER (PARTITION BY {keys} ORDER BY x) - 1 rx, rank() OVER (PARTITION BY {keys} ORDER BY y) - 1 ry FROM n0),
cell AS (SELECT {keys}, n, rx * b // n bx, ry * b // n byy, count(*) c FROM rk GROUP BY ALL),
mx AS (SELECT {keys}, bx, sum(c) cx FROM cell GROUP BY ALL),
my AS (SELECT {keys}, byy, sum(c) cy FROM cell GROUP BY ALL),
mi AS (SELECT {keys}, n, CASE WHEN n >= 5 THEN greatest(0.0, sum(c / n * ln(c * CAST(n AS DOUBLE) / (cx * cy)))
           + (count(DISTINCT bx) + count(DISTINCT byy) - count(*) - 1) / (2.0 * n)) END v
       FROM cell JOIN mx USING ({keys}, bx) JOIN my USING ({keys}, byy) GROUP BY {keys}, n)"""


def _e3_binned_sql(snap: bool = True) -> str:
    snapped = _selected_pairs_sql().replace("\npairs AS (SELECT * FROM", "\npairs AS (SELECT feature, round(x * 1048576.0) / 1048576.0 x, "
                                            "round(y * 1048576.0) / 1048576.0 y FROM")
    return f"""{snapped},{_binned_mi_tail('feature')}
SELECT feature, {(r if snap else _plain)('v', 'mi')}, CAST(n AS BIGINT) n_used FROM mi"""


ITEM_FEATURES = ["freight_value", "delivery_diff_estimated", "estimated_delivery_lead_days", "approval_time_hours"]


def _e3_item_sql() -> str:
    sel = "\nUNION ALL ".join(f"SELECT customer_region, '{c}' feature, CAST({c} AS DOUBLE) x, CAST(price AS DOUBLE) y FROM d "
                              f"WHERE {c} IS NOT NULL AND price IS NOT NULL AND customer_region IS NOT NULL" for c in ITEM_FEATURES)
    return f"""WITH {RAW_CTES}, {keyed_cte('W')},
pairs AS ({sel}),{_binned_mi_tail('customer_region, feature')}
SELECT customer_region, feature, {r('v', 'mi')}, CAST(n AS BIGINT) n_used FROM mi"""


ORACLE.update({
    "e1_continuous_feature_profile": _e1_sql(),
    "e2_pearson_corr": _e2_sql(),
})


ORACLE.update({
    "b5_backtest_seasonal_naive": _WT + """,
lg AS (SELECT order_week, sales_qty, lag(sales_qty, 1) OVER (ORDER BY order_week) p,
       CASE WHEN order_week > DATE '2000-06-25' THEN CAST(ceil(date_diff('day', DATE '2000-06-25', order_week) / 7.0) AS INTEGER) - 1 END fold_id
       FROM wt),
vc AS (SELECT DISTINCT fold_id FROM lg WHERE fold_id IS NOT NULL),
stop AS (SELECT min(k) k FROM generate_series(0, (SELECT max(fold_id) + 1 FROM vc)) g(k) WHERE k NOT IN (SELECT fold_id FROM vc))
SELECT order_week date, CAST(sales_qty AS DOUBLE) y_true, CAST(p AS DOUBLE) y_pred, fold_id FROM lg
WHERE order_week BETWEEN DATE '2000-06-26' AND DATE '2000-11-13' AND fold_id < (SELECT k FROM stop)""",
})


_RWT = f"""WITH {RAW_CTES},
wt AS (SELECT customer_region, date_trunc('week', order_purchase_timestamp)::DATE order_week,
       CAST(count(order_item_id) AS BIGINT) sales_qty FROM merged WHERE customer_region IS NOT NULL GROUP BY 1, 2)"""


def _region_lags_sql() -> str:
    cols = []
    for lag in LAGS:
        cols.append(f"lag(sales_qty, {lag}) OVER w sales_qty_lag{lag}")
    for win in ROLL_WINDOWS:
        frame = f"(PARTITION BY customer_region ORDER BY order_week ROWS BETWEEN {win} PRECEDING AND 1 PRECEDING)"
        full = f"count(sales_qty) OVER {frame} = {win}"
        cols.append(r(f"CASE WHEN {full} THEN avg(sales_qty) OVER {frame} END", f"sales_qty_roll{win}_mean"))
        cols.append(r(f"CASE WHEN {full} THEN stddev_samp(sales_qty) OVER {frame} END", f"sales_qty_roll{win}_std"))
    return (_RWT + f"\nSELECT customer_region, order_week, sales_qty, {', '.join(cols)} FROM wt "
            "WINDOW w AS (PARTITION BY customer_region ORDER BY order_week)")


ORACLE.update({
    "w7_region_lags_rollings": _region_lags_sql(),
    "b9_region_lag_model_metrics": _RWT + """,
preds AS (SELECT customer_region model, order_week date, CAST(sales_qty AS DOUBLE) y, CAST(l1 AS DOUBLE) p FROM (
  SELECT customer_region, order_week, sales_qty, lag(sales_qty, 1) OVER (PARTITION BY customer_region ORDER BY order_week) l1
  FROM wt) WHERE l1 IS NOT NULL)""" + _metric_sql(1, True).replace("SELECT model,", "SELECT model AS customer_region,", 1),
    "b1_region_folds": _RWT + """,
v AS (SELECT customer_region, CAST(ceil(date_diff('day', DATE '2000-06-25', order_week) / 7.0) AS INTEGER) - 1 fold_id
      FROM wt WHERE order_week > DATE '2000-06-25'),
vc AS (SELECT customer_region, fold_id, count(*) n_valid FROM v GROUP BY 1, 2),
mx AS (SELECT customer_region, max(fold_id) m FROM vc GROUP BY 1),
stop AS (SELECT mx.customer_region, min(g.k) k FROM mx, generate_series(0, mx.m + 1) g(k)
         WHERE NOT EXISTS (SELECT 1 FROM vc WHERE vc.customer_region = mx.customer_region AND vc.fold_id = g.k)
         GROUP BY 1),
base AS (SELECT customer_region, count(*) b FROM wt WHERE order_week <= DATE '2000-06-25' GROUP BY 1)
SELECT vc.customer_region, vc.fold_id, TIMESTAMP '2000-06-25' + vc.fold_id * INTERVAL 7 DAY train_end,
  TIMESTAMP '2000-06-25' + (vc.fold_id + 1) * INTERVAL 7 DAY valid_end,
  CAST(coalesce(base.b, 0) + coalesce((SELECT sum(n_valid) FROM vc v2 WHERE v2.customer_region = vc.customer_region
       AND v2.fold_id < vc.fold_id), 0) AS BIGINT) n_train,
  CAST(vc.n_valid AS BIGINT) n_valid
FROM vc JOIN stop ON vc.customer_region = stop.customer_region LEFT JOIN base ON base.customer_region = vc.customer_region
WHERE vc.fold_id < stop.k""",
})


def _null_summary_sql() -> str:
    ctes, key, cols, doubles = model_table_ctes("W")
    before = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in [key] + cols)
    imp_cols = [key] + cols + ["have_nulls"]
    after = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in imp_cols)
    return (f"WITH m AS ({model_table_sql('W')}), i AS ({imputed_sql('W')})\n"
            f"SELECT CAST((SELECT {before} FROM m) AS BIGINT) null_cells_before, "
            f"CAST((SELECT {after} FROM i) AS BIGINT) null_cells_after, "
            f"{r(rr('(SELECT sum(have_nulls) FROM i)', '(SELECT count(*) FROM i)', 100, 4), 'have_nulls_pct')}")


ORACLE.update({
    "a12_period_table_weekly_order_weights": period_table_sql("W", mode="orders"),
    "i5_imputation_summary": _null_summary_sql(),
})


_MORE_ITEMS = f"""WITH {RAW_CTES},
many AS (SELECT * FROM items_x UNION ALL SELECT * REPLACE (price + 1 AS price) FROM items_x WHERE CAST(order_id AS BIGINT) % 50 = 0
  UNION ALL SELECT * FROM items_x WHERE CAST(order_id AS BIGINT) % 75 = 0)"""
_ITEM_COLS = ("order_id, order_item_id, product_id, seller_id, " + r("price", "price") + ", " + r("freight_value", "freight_value")
              + ", order_delivered_carrier_date, order_delivered_customer_date")
_ASIA_LAST = {**{k: v for k, v in FIXTURE_REGION_SUFFIX.items() if k != "ASIA"}, "ASIA": "asia"}

ORACLE.update({
    "s1_csv_round_trip": f"""WITH {RAW_CTES}
SELECT order_id, customer_id, order_status, order_purchase_timestamp,
  CASE WHEN CAST(order_id AS BIGINT) % 91 <> 0 THEN order_approved_at END order_approved_at, order_estimated_delivery_date FROM orders_x""",
    "s1_csv_multi_line": EXP + """
SELECT review_id, order_id, review_score, 'score ' || review_score || chr(10) || 'of "' || order_id || '", fine' AS "comment" FROM reviews_x""",
    "s3_parquet_round_trip": f"WITH {RAW_CTES}\nSELECT customer_id, customer_unique_id, customer_state FROM customers_x",
    "s6_csv_semi": "SELECT * FROM (" + ORACLE["a20_category_table"] + ") WHERE categoria LIKE 'Brand#1%'",
    "p5_state_codes": """WITH s AS (SELECT CAST(c_custkey AS VARCHAR) customer_id, upper(list_extract(
  ['ac','al','am','ap','ba','ce','df','es','go','ma','mg','ms','mt','pa','pb','pe','pi','pr','rj','rn','ro','rr','rs','sc','se','sp','to','xx'],
  c_custkey % 28 + 1)) customer_state FROM customer),
g AS (SELECT *, CASE WHEN customer_state IN ('AC','AP','AM','PA','RO','RR','TO') THEN 'Norte'
       WHEN customer_state IN ('AL','BA','CE','MA','PB','PE','PI','RN','SE') THEN 'Nordeste'
       WHEN customer_state IN ('DF','GO','MT','MS') THEN 'Centro-Oeste'
       WHEN customer_state IN ('ES','MG','RJ','SP') THEN 'Sudeste' WHEN customer_state IN ('PR','RS','SC') THEN 'Sul' END customer_region FROM s)
SELECT customer_id, customer_state, coalesce(customer_region, 'estado inválido') region_typed, customer_region FROM g""",
    "p7_removed_items": _MORE_ITEMS + """
SELECT CAST(count(*) AS BIGINT) AS "rows", CAST(count(DISTINCT (order_id, order_item_id)) AS BIGINT) kept,
  CAST(count(*) - count(DISTINCT (order_id, order_item_id)) AS BIGINT) removed FROM many""",
    "p7_deduped_items": _MORE_ITEMS + f"""
SELECT {_ITEM_COLS} FROM many QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY product_id, seller_id, price) = 1""",
    "a12_period_table_weekly_price_sums": period_table_sql("W", mode="sum"),
    "a9_regions_from_data": f"WITH {RAW_CTES},{keyed_cte('W')},{region_ctes('order_week', _ASIA_LAST)}\nSELECT order_week, "
                            + ", ".join(r(c, c) for c in region_cols(_ASIA_LAST)) + " FROM treg",
    "f8_holiday_table": f"WITH {HOLIDAY_CTE}\nSELECT CAST(hd AS DATE) AS \"date\" FROM hol WHERE year(hd) BETWEEN "
                        "(SELECT min(year(o_orderdate)) FROM orders) AND (SELECT max(year(o_orderdate)) FROM orders)",
    "j9_holiday_join": _WT + f""",{HOLIDAY_CTE},
n AS (SELECT order_week, (SELECT count(DISTINCT CAST(hd AS DATE)) FROM hol WHERE hd BETWEEN order_week AND order_week + INTERVAL 6 DAY) n FROM wt)
SELECT order_week, CAST(n > 0 AS INTEGER) is_br_holiday_week, CAST(n AS INTEGER) n_br_holidays_week FROM n""",
    "a16_capped_sales_frequency_40": ORACLE["a16_capped_sales_frequency"].replace("count(order_id), 10)", "count(order_id), 40)"),
    "a17_a19_sales_volume_buckets_40": ORACLE["a17_a19_sales_volume_buckets"].replace("count(order_id), 10)", "count(order_id), 40)").replace(
        "generate_series(1, 10)", "generate_series(1, 40)"),
    "a18_review_examples": EXP + """,
j AS (SELECT i.order_id, i.product_id, r.review_id, r.review_score FROM items_x i LEFT JOIN reviews_x r ON i.order_id = r.order_id),
per AS (SELECT order_id, product_id, count(DISTINCT review_id) n_reviews FROM j GROUP BY 1, 2)
SELECT j.*, n_reviews FROM j JOIN per USING (order_id, product_id) WHERE n_reviews = 2""",
    "e4_standardized_sales": _WT + f""",
s AS (SELECT avg(sales_qty) m, stddev_pop(sales_qty) d FROM wt WHERE order_week <= DATE '2000-06-25')
SELECT order_week, sales_qty, {r('(sales_qty - m) / d', 'sales_qty_z')} FROM wt, s""",
})

ORACLE["a12_period_table_weekly_by_state"] = period_table_sql("W", series="customer_state")


def _e3_exact_sql(snap: bool = True) -> str:
    """Brute-force KSG (k = 3) per feature: all pairs of one feature's rows (fine for an
    oracle; the Spark query never forms pairs)."""
    head, feats = _selected_features_sql()
    sel = "\nUNION ALL ".join(
        f"SELECT '{c}' feature, order_week i, CAST({c} AS DOUBLE) x, CAST(sales_qty AS DOUBLE) y FROM imp" for c in feats)
    prof = _e1_sql().split("\nSELECT *, ", 1)[1]
    return f"""{head},
prof AS (SELECT *, (coalesce(nonnull_frac, 0) >= 0.6 AND NOT is_binary) selected FROM ({prof.split(' FROM (', 1)[1][:-1]})),
longv AS ({sel}),
p AS (SELECT * FROM longv WHERE x IS NOT NULL AND y IS NOT NULL AND feature IN (SELECT feature FROM prof WHERE selected)),
st AS (SELECT feature, avg(x) mx, stddev_pop(x) sx, avg(y) my, stddev_pop(y) sy, count(*) n FROM p GROUP BY 1),
z1 AS (SELECT p.feature, p.i, CASE WHEN sx > 0 THEN (x - mx) / sx ELSE x - mx END x1,
         CASE WHEN sy > 0 THEN (y - my) / sy ELSE y - my END y1 FROM p JOIN st USING (feature)),
st2 AS (SELECT feature, stddev_pop(x1) sx1, stddev_pop(y1) sy1 FROM z1 GROUP BY 1),
z AS (SELECT feature, i, round((CASE WHEN sx1 > 0 THEN x1 / sx1 ELSE x1 END) * 1048576.0) / 1048576.0 x,
        round((CASE WHEN sy1 > 0 THEN y1 / sy1 ELSE y1 END) * 1048576.0) / 1048576.0 y
      FROM z1 JOIN st2 USING (feature)),
pr AS (SELECT a.feature, a.i, abs(a.x - b.x) dx, abs(a.y - b.y) dy FROM z a JOIN z b ON a.feature = b.feature AND a.i <> b.i),
kth AS (SELECT feature, i, d eps FROM (SELECT feature, i, greatest(dx, dy) d,
          row_number() OVER (PARTITION BY feature, i ORDER BY greatest(dx, dy)) rn FROM pr) WHERE rn = 3),
cnt AS (SELECT pr.feature, pr.i, count(*) FILTER (WHERE pr.dx <= nextafter(k.eps, 0.0)) nx,
          count(*) FILTER (WHERE pr.dy <= nextafter(k.eps, 0.0)) ny FROM pr JOIN kth k USING (feature, i) GROUP BY 1, 2),
h AS (SELECT g m, sum(1.0 / g) OVER (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) hm
      FROM generate_series(1, 20000) t(g)),
ps AS (SELECT cnt.feature, avg(coalesce(hx.hm, 0.0)) mhx, avg(coalesce(hy.hm, 0.0)) mhy FROM cnt
       LEFT JOIN h hx ON hx.m = cnt.nx LEFT JOIN h hy ON hy.m = cnt.ny GROUP BY 1),
mi AS (SELECT st.feature, st.n, CASE WHEN st.n >= 5 THEN greatest(0.0,
          (coalesce(hn.hm, 0.0) - 0.5772156649015329) + (1.5 - 0.5772156649015329)
          - (ps.mhx - 0.5772156649015329) - (ps.mhy - 0.5772156649015329)) END v
       FROM st LEFT JOIN ps USING (feature) LEFT JOIN h hn ON hn.m = st.n - 1)
SELECT feature, {(r if snap else _plain)('v', 'mi')}, CAST(n AS BIGINT) n_used FROM mi"""


ORACLE["e3_mutual_information_exact"] = _e3_exact_sql()


def _rank_sql(mi_sql: str, relevant_only: bool = False) -> str:
    label_r = ("CASE WHEN pearson_r IS NULL THEN NULL WHEN abs(pearson_r) < 0.3 THEN 'Baixo' "
               "WHEN abs(pearson_r) < 0.5 THEN 'Moderado' ELSE 'Forte' END")
    label_m = "CASE WHEN mi IS NULL THEN NULL WHEN mi < 0.3 THEN 'Baixo' WHEN mi < 0.6 THEN 'Moderado' ELSE 'Forte' END"
    where = ("WHERE NOT (pearson_label IS NOT DISTINCT FROM 'Baixo') OR NOT (mi_label IS NOT DISTINCT FROM 'Baixo')"
             if relevant_only else "")
    return f"""WITH e2 AS ({_e2_sql(snap=False)}),
e3 AS ({mi_sql}),
j AS (SELECT coalesce(e2.feature, e3.feature) feature, e2.pearson_r, e3.mi FROM e2 FULL OUTER JOIN e3 ON e2.feature = e3.feature),
mx AS (SELECT max(abs(pearson_r)) rmax, max(mi) mmax FROM j),
nz AS (SELECT feature, pearson_r, mi,
         CASE WHEN pearson_r IS NOT NULL AND (SELECT rmax FROM mx) > 0 THEN abs(pearson_r) / (SELECT rmax FROM mx) END r_norm_abs,
         CASE WHEN mi IS NOT NULL AND (SELECT mmax FROM mx) > 0 THEN mi / (SELECT mmax FROM mx) END mi_norm FROM j),
sc AS (SELECT *, (coalesce(r_norm_abs, 0) + coalesce(mi_norm, 0))
         / nullif(CAST(r_norm_abs IS NOT NULL AS INTEGER) + CAST(mi_norm IS NOT NULL AS INTEGER), 0) score,
         {label_r} pearson_label, {label_m} mi_label FROM nz)
SELECT feature, {r('pearson_r', 'pearson_r')}, {r('mi', 'mi')}, {r('r_norm_abs', 'r_norm_abs')}, {r('mi_norm', 'mi_norm')},
  {r('score', 'score')}, pearson_label, mi_label FROM sc {where}"""


ORACLE["e5_feature_rank_exact"] = _rank_sql(_e3_exact_sql(snap=False))
ORACLE["e6_relevant_features_exact"] = _rank_sql(_e3_exact_sql(snap=False), relevant_only=True)
ORACLE["e3_mutual_information_binned"] = _e3_binned_sql()
ORACLE["e3_item_mutual_information_by_region"] = _e3_item_sql()
ORACLE["e5_feature_rank"] = _rank_sql(_e3_binned_sql(snap=False))
ORACLE["e6_relevant_features"] = _rank_sql(_e3_binned_sql(snap=False), relevant_only=True)


def _schema_sql() -> str:
    counts = "\nUNION ALL ".join(f"SELECT '{c}' col, {i} pos, CAST(count({c}) AS BIGINT) non_null FROM merged"
                                 for i, c in enumerate(MERGED_COLS))
    sel = ", ".join(MERGED_COLS)
    return f"""WITH {RAW_CTES},
ty AS (SELECT column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint'
         WHEN 'DOUBLE' THEN 'double' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp'
         ELSE lower(column_type) END dtype
       FROM (DESCRIBE SELECT {sel} FROM merged)),
nn AS ({counts})
SELECT nn.col "column", nn.non_null, ty.dtype, CAST(nn.pos AS INTEGER) position FROM nn JOIN ty ON ty.column_name = nn.col"""


ORACLE["p15_schema_info"] = _schema_sql()
