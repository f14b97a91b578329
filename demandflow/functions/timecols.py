"""F1-F8: time deltas, period keys and calendar columns as pure column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HOUR = 3_600_000_000

PERIOD_COLUMN = {"W": "order_week", "D": "order_date"}


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def micros_between(end: str | Column, start: str | Column) -> Column:
    """Exact microseconds ``end - start`` (zone independent on TIMESTAMP_NTZ)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def floor_days_between(end: str | Column, start: str | Column) -> Column:
    """Whole days of ``end - start`` floored toward minus infinity (-1 h gives -1)."""
    return F.floor(micros_between(end, start) / F.lit(float(MICROS_PER_DAY)))


def hours_between(end: str | Column, start: str | Column) -> Column:
    return micros_between(end, start) / F.lit(float(MICROS_PER_HOUR))


def period_start(ts: str | Column, freq: str = "W") -> Column:
    """Monday of the week (``W``) or the day (``D``) of a timestamp, as DATE."""
    freq = freq.upper()
    day = _c(ts).cast("date")
    if freq == "W":
        return F.trunc(day, "week")
    if freq == "D":
        return day
    raise ValueError("freq must be 'W' (weekly) or 'D' (daily)")


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """sin and cos of 2*pi*(value-1)/period."""
    angle = F.lit(2 * math.pi) * (value - F.lit(1)) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def black_friday(year: Column) -> Column:
    """last Friday of November = first Friday after 23 November."""
    return F.next_day(F.make_date(year, F.lit(11), F.lit(23)), "FRI")


def cyber_monday(year: Column) -> Column:
    return F.date_add(black_friday(year), 3)


def christmas(year: Column) -> Column:
    return F.make_date(year, F.lit(12), F.lit(25))


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday (anonymous Gregorian computus), integer arithmetic only."""
    y = year.cast("int")
    a = y % 19
    b = F.floor(y / 100).cast("int")
    c = y % 100
    d = F.floor(b / 4).cast("int")
    e = b % 4
    f = F.floor((b + 8) / 25).cast("int")
    g = F.floor((b - f + 1) / 3).cast("int")
    h = (19 * a + b - d - g + 15) % 30
    i = F.floor(c / 4).cast("int")
    k = c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = F.floor((a + 11 * h + 22 * l_) / 451).cast("int")
    month = F.floor((h + l_ - 7 * m + 114) / 31).cast("int")
    day = ((h + l_ - 7 * m + 114) % 31) + 1
    return F.make_date(y, month, day)


# National holidays of Brazil as (month, day, first year, name); Good Friday
# (Easter Sunday - 2 days) is the one movable national holiday.
BR_FIXED_HOLIDAYS = [
    (1, 1, None, "Confraternização Universal"),
    (4, 21, None, "Tiradentes"),
    (5, 1, None, "Dia do Trabalhador"),
    (9, 7, None, "Independência do Brasil"),
    (10, 12, None, "Nossa Senhora Aparecida"),
    (11, 2, None, "Finados"),
    (11, 15, None, "Proclamação da República"),
    (11, 20, 2024, "Dia Nacional de Zumbi e da Consciência Negra"),
    (12, 25, None, "Natal"),
]
GOOD_FRIDAY_NAME = "Sexta-feira Santa"


def is_br_holiday(day: Column) -> Column:
    """True when ``day`` (DATE) is a national holiday of Brazil."""
    y = F.year(day)
    hit = day == F.date_sub(easter_sunday(y), 2)
    for month, dom, since, _ in BR_FIXED_HOLIDAYS:
        cond = (F.month(day) == month) & (F.dayofmonth(day) == dom)
        if since is not None:
            cond = cond & (y >= since)
        hit = hit | cond
    return hit


def holidays_in_range(start: Column, end: Column) -> Column:
    """Number of national holidays in [start, end] (a period spans at most a few days)."""
    days = F.sequence(start, end)
    return F.size(F.filter(days, is_br_holiday))
