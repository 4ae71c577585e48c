"""Date and time features (D1-D9) as Column expressions.

Calendar rules are arithmetic on (year, month, day) integers, so invalid
dates such as 30 February never need ``make_date`` (which raises under ANSI)
and no lookup join is needed for holidays.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..core import col_of

# Days before each month on a 365-day calendar.
DAYS_IN_MONTH = [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]


def day_of_year_365(month, day) -> Column:
    """Day of year from (month, day) ignoring leap years (D4); unknown month -> NULL."""
    offsets = {}
    acc = 0
    for m, days in enumerate(DAYS_IN_MONTH, start=1):
        offsets[m] = acc
        acc += days
    m = col_of(month)
    expr = None
    for k, v in offsets.items():
        expr = F.when(m == k, F.lit(v)) if expr is None else expr.when(m == k, F.lit(v))
    return expr + col_of(day)


def cyclic(x, period: float) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*x/period."""
    a = F.lit(2 * math.pi) * col_of(x).cast("double") / F.lit(float(period))
    return F.sin(a), F.cos(a)


def infer_year(day_of_year, day_of_week, anchor: int = 2018) -> Column:
    """``anchor - ((doy - dow) mod 7)`` with floor-mod."""
    return F.lit(anchor) - F.pmod(col_of(day_of_year) - col_of(day_of_week), F.lit(7))


def weekday_sun0(year, month, day) -> Column:
    """Weekday of a (y, m, d) triple, 0 = Sunday, by Sakamoto's rule."""
    y, m, d = col_of(year), col_of(month), col_of(day)
    # Sakamoto's month offsets.
    t = [0, 3, 2, 5, 0, 3, 5, 1, 4, 6, 2, 4]
    tm = None
    for i, v in enumerate(t, start=1):
        tm = F.when(m == i, F.lit(v)) if tm is None else tm.when(m == i, F.lit(v))
    yy = y - F.when(m < 3, 1).otherwise(0)
    return F.pmod(yy + F.floor(yy / 4) - F.floor(yy / 100) + F.floor(yy / 400) + tm + d, F.lit(7))


# US federal holidays used by the flight-delay features.
FIXED_HOLIDAYS = [((1, 1), "New Year's Day"), ((7, 4), "Independence Day"),
                  ((11, 11), "Veterans Day"), ((12, 25), "Christmas Day")]
NON_HOLIDAY = "Non-Holiday"


def holiday_name(year, month, day) -> Column:
    """US holiday label of a (y, m, d) triple, ``Non-Holiday`` otherwise.

    Floating holidays: MLK Jr. Day (3rd Monday of January), Presidents' Day
    (3rd Monday of February), Memorial Day (last Monday of May), Labor Day
    (1st Monday of September), Columbus Day (2nd Monday of October),
    Thanksgiving Day (4th Thursday of November).
    """
    m, d = col_of(month), col_of(day)
    wd = weekday_sun0(year, month, day)
    monday, thursday = wd == 1, wd == 4

    def nth(n):
        return (d >= 7 * (n - 1) + 1) & (d <= 7 * n)

    expr = None
    for (fm, fd), name in FIXED_HOLIDAYS:
        cond = (m == fm) & (d == fd)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    expr = (expr
            .when((m == 1) & monday & nth(3), F.lit("MLK Jr. Day"))
            .when((m == 2) & monday & nth(3), F.lit("Presidents' Day"))
            .when((m == 5) & monday & (d >= 25) & (d <= 31), F.lit("Memorial Day"))
            .when((m == 9) & monday & nth(1), F.lit("Labor Day"))
            .when((m == 10) & monday & nth(2), F.lit("Columbus Day"))
            .when((m == 11) & thursday & nth(4), F.lit("Thanksgiving Day")))
    return expr.otherwise(F.lit(NON_HOLIDAY))


def hhmm_to_hour(t) -> Column:
    """HHMM integer -> fractional hour ``(t // 100) % 24 + (t % 100) / 60``."""
    t = col_of(t)
    return F.pmod(F.floor(t / 100), F.lit(24)) + F.pmod(t, F.lit(100)) / F.lit(60.0)


def season(month) -> Column:
    """Month -> Winter/Spring/Summer/Fall."""
    m = col_of(month)
    return (F.when((m == 12) | ((m >= 1) & (m <= 2)), F.lit("Winter"))
             .when((m >= 3) & (m <= 5), F.lit("Spring"))
             .when((m >= 6) & (m <= 8), F.lit("Summer"))
             .otherwise(F.lit("Fall")))


def is_weekend(day_of_week_mon1) -> Column:
    """1 for days 6 and 7 on a Monday=1 scale."""
    return (col_of(day_of_week_mon1) > 5).cast("int")


def elapsed_years(later, earlier) -> Column:
    """``max(later - earlier, 0)`` (D3)."""
    return F.greatest(col_of(later) - col_of(earlier), F.lit(0))
