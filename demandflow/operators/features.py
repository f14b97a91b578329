"""Time-series and calendar features on a period table.

Lags and rolling windows go by observed rows ("t-1" is the previous row of the series,
not the previous calendar week).  All lag and rolling columns come from one window spec,
so Spark sorts each series once.  With ``series_keys`` the window is partitioned by the
keys; without keys the table is one global series with one row per period, whose size is
bounded by the calendar, not by the input.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.functions.timecols import (black_friday, christmas, cyber_monday, cyclic,
                                           holidays_in_range)

LOG = logging.getLogger(__name__)

# Default feature columns, lags and rolling windows.
LAG_COLS = [
    "sales_qty", "price_var_w1_point_mean", "price_var_w1_smooth_mean", "price_var_m4_vs_prev4_mean",
    "approval_time_hours_weighted", "delivery_diff_estimated_weighted", "est_delivery_lead_days_weighted",
]
LAGS = [1, 2, 4, 8]
ROLL_COLS = list(LAG_COLS)
ROLL_WINDOWS = [2, 3, 4]


def detect_time_col(df: DataFrame, explicit: str | None = None) -> str:
    """``explicit`` if present, else ``order_week``, else ``order_date``."""
    if explicit is not None:
        if explicit not in df.columns:
            raise KeyError(f"time column {explicit!r} not found")
        return explicit
    for c in ("order_week", "order_date"):
        if c in df.columns:
            return c
    raise KeyError("no time column: expected 'order_week' or 'order_date'")


def _series_window(time_col: str, series_keys: Iterable[str]) -> Window:
    keys = list(series_keys)
    return (Window.partitionBy(*keys) if keys else Window).orderBy(time_col)


def lag_columns(cols: Iterable[str], lags: Iterable[int], time_col: str, series_keys: Iterable[str] = (),
                present: Iterable[str] | None = None) -> list[Column]:
    """``<col>_lag<L>`` expressions; absent columns are skipped with a warning."""
    w = _series_window(time_col, series_keys)
    present = set(present) if present is not None else None
    out = []
    for c in cols:
        if present is not None and c not in present:
            LOG.warning("lag column missing, skipped: %s", c)
            continue
        out += [F.lag(c, lag).over(w).alias(f"{c}_lag{lag}") for lag in lags]
    return out


def rolling_columns(cols: Iterable[str], windows: Iterable[int], time_col: str,
                    series_keys: Iterable[str] = (), present: Iterable[str] | None = None) -> list[Column]:
    """Mean and sample std of the ``w`` rows *before* t; null unless all ``w`` are
    non-null (causal: row t never enters its own feature)."""
    base = _series_window(time_col, series_keys)
    present = set(present) if present is not None else None
    out = []
    for c in cols:
        if present is not None and c not in present:
            LOG.warning("rolling column missing, skipped: %s", c)
            continue
        for win in windows:
            frame = base.rowsBetween(-win, -1)
            full = F.count(c).over(frame) == win
            out.append(F.when(full, F.avg(c).over(frame)).alias(f"{c}_roll{win}_mean"))
            out.append(F.when(full, F.stddev_samp(c).over(frame)).alias(f"{c}_roll{win}_std"))
    return out


def add_lags(df: DataFrame, time_col: str, cols: Iterable[str] = LAG_COLS, lags: Iterable[int] = LAGS,
             series_keys: Iterable[str] = ()) -> DataFrame:
    return df.select("*", *lag_columns(cols, lags, time_col, series_keys, df.columns))


def add_rollings(df: DataFrame, time_col: str, cols: Iterable[str] = ROLL_COLS,
                 windows: Iterable[int] = ROLL_WINDOWS, series_keys: Iterable[str] = ()) -> DataFrame:
    return df.select("*", *rolling_columns(cols, windows, time_col, series_keys, df.columns))


def add_lags_and_rollings(df: DataFrame, time_col: str, lag_cols: Iterable[str] = LAG_COLS,
                          lags: Iterable[int] = LAGS, roll_cols: Iterable[str] = ROLL_COLS,
                          windows: Iterable[int] = ROLL_WINDOWS, series_keys: Iterable[str] = ()) -> DataFrame:
    """W6 + W7 in one projection (one sort per series)."""
    return df.select("*", *lag_columns(lag_cols, lags, time_col, series_keys, df.columns),
                     *rolling_columns(roll_cols, windows, time_col, series_keys, df.columns))


def lookback_sequences(df: DataFrame, value_col: str, time_col: str, lookback: int = 14,
                       series_keys: Iterable[str] = ()) -> DataFrame:
    """X = the ``lookback`` previous values (oldest first), y = current value; rows
    without a full history are dropped."""
    frame = _series_window(time_col, series_keys).rowsBetween(-lookback, -1)
    seq = F.collect_list(value_col).over(frame)
    return df.select(*series_keys, time_col, seq.alias("x_seq"), F.col(value_col).alias("y")) \
        .where(F.size("x_seq") == lookback)


def seasonal_difference(df: DataFrame, value_col: str, time_col: str, season: int = 1,
                        series_keys: Iterable[str] = (), out_col: str | None = None) -> DataFrame:
    """y_t - y_(t-s) by rows."""
    w = _series_window(time_col, series_keys)
    return df.withColumn(out_col or f"{value_col}_sdiff{season}", F.col(value_col) - F.lag(value_col, season).over(w))


def infer_freq_frame(df: DataFrame, time_col: str) -> DataFrame:
    """W13 as a one-row frame (median_gap_days, freq): median gap between distinct dates
    >= 6 days -> 'W', else 'D' (fewer than 2 dates -> 'D').  Works on the distinct periods
    only, whose number is bounded by the calendar."""
    dates = df.select(F.col(time_col).cast("date").alias("d")).where(F.col("d").isNotNull()).distinct()
    gaps = dates.select(F.datediff("d", F.lag("d").over(Window.orderBy("d"))).alias("gap")) \
        .where(F.col("gap").isNotNull())
    median = F.percentile("gap", 0.5)
    return gaps.agg(median.alias("median_gap_days"),
                    F.when(median >= 6, "W").otherwise("D").alias("freq"))


def infer_freq(df: DataFrame, time_col: str) -> str:
    """W13 as a scalar for plan-time decisions (one small job)."""
    return infer_freq_frame(df, time_col).first()["freq"]


def calendar_columns(time_col: str, freq: str, holidays: DataFrame | None = None) -> list[Column]:
    """F3-F7 (+F8/J9 by the built-in rule when ``holidays`` is None)."""
    t = F.col(time_col).cast("date")
    year, month = F.year(t), F.month(t)
    week = F.weekofyear(t)
    m_sin, m_cos = cyclic(month, 12)
    w_sin, w_cos = cyclic(week, 52)
    end = F.date_add(t, 6) if freq == "W" else t

    def within(event: Column) -> Column:
        return ((event >= t) & (event <= end)).cast("int")

    cols = [
        year.alias("year"), F.quarter(t).alias("quarter"), month.alias("month"), week.alias("weekofyear"),
        m_sin.alias("month_sin"), m_cos.alias("month_cos"), w_sin.alias("week_sin"), w_cos.alias("week_cos"),
        (F.dayofmonth(t) == 1).cast("int").alias("is_month_start"),
        (t == F.last_day(t)).cast("int").alias("is_month_end"),
        (t == F.trunc(t, "quarter")).cast("int").alias("is_quarter_start"),
        within(black_friday(year)).alias("is_black_friday_week"),
        within(cyber_monday(year)).alias("is_cyber_monday_week"),
        within(christmas(year)).alias("is_christmas_week"),
    ]
    if holidays is None:
        n = holidays_in_range(t, end)
        cols += [(n > 0).cast("int").alias("is_br_holiday_week"), n.alias("n_br_holidays_week")]
    return cols


def holiday_counts(periods: DataFrame, time_col: str, freq: str, holidays: DataFrame) -> DataFrame:
    """J9 with a holiday table: explode each period into its days (at most 7) and equi-join
    on the day; holidays outside every period vanish in the join."""
    t = F.col(time_col).cast("date")
    end = F.date_add(t, 6) if freq == "W" else t
    days = periods.select(time_col).distinct().select(time_col, F.explode(F.sequence(t, end)).alias("__day"))
    hd = holidays.select(F.col("date").cast("date").alias("__day")).distinct()
    return days.join(hd, "__day").groupBy(time_col).agg(F.count(F.lit(1)).alias("n_br_holidays_week"))


def add_calendar_features(df: DataFrame, time_col: str, freq: str | None = None,
                          holidays: DataFrame | None = None) -> DataFrame:
    """calendar columns, retail events and national holidays in the period."""
    if time_col not in df.columns:
        raise KeyError(f"time column {time_col!r} missing")
    freq = freq or infer_freq(df, time_col)
    out = df.select("*", *calendar_columns(time_col, freq, holidays))
    if holidays is not None:
        counts = holiday_counts(df, time_col, freq, holidays)
        n = F.coalesce(F.col("n_br_holidays_week"), F.lit(0))
        out = out.join(counts, time_col, "left").withColumns({
            "is_br_holiday_week": (n > 0).cast("int"), "n_br_holidays_week": n.cast("int")})
    return out


def br_holiday_table(spark, start_year: int, end_year: int) -> DataFrame:
    """F8: national holidays for a span of years, generated from the fixed dates and
    Easter (no external library)."""
    from demandflow.functions.timecols import BR_FIXED_HOLIDAYS, GOOD_FRIDAY_NAME, easter_sunday
    years = spark.range(start_year, end_year + 1).select(F.col("id").cast("int").alias("y"))
    parts = [years.select(F.date_sub(easter_sunday(F.col("y")), 2).alias("date"),
                          F.lit(GOOD_FRIDAY_NAME).alias("name"))]
    for month, day, since, name in BR_FIXED_HOLIDAYS:
        sel = years if since is None else years.where(F.col("y") >= since)
        parts.append(sel.select(F.make_date("y", F.lit(month), F.lit(day)).alias("date"), F.lit(name).alias("name")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_features(period_table: DataFrame, time_col: str | None = None, lag_cols: Iterable[str] = LAG_COLS,
                   lags: Iterable[int] = LAGS, roll_cols: Iterable[str] = ROLL_COLS,
                   roll_windows: Iterable[int] = ROLL_WINDOWS, series_keys: Iterable[str] = (),
                   freq: str | None = None, holidays: DataFrame | None = None) -> DataFrame:
    """Model table: lags, causal rollings and calendar features."""
    tc = detect_time_col(period_table, time_col)
    if freq is None:
        freq = "W" if tc == "order_week" else ("D" if tc == "order_date" else None)
    df = add_lags_and_rollings(period_table, tc, lag_cols, lags, roll_cols, roll_windows, series_keys)
    return add_calendar_features(df, tc, freq, holidays)
