"""Calendar features, holiday calendars and holiday distances.

The holiday calendar is generated in Spark from the span of years in the data
(``sequence`` + ``explode``); Easter uses the anonymous Gregorian algorithm in
integer arithmetic.  A calendar has one row per day, so the windows that walk
it (distance to the next / previous holiday) are bounded by the number of days
covered, not by the data volume, and the calendar is small enough to broadcast
into the panel join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import week_start

NO_HOLIDAY = "No holiday"

# Dutch holiday names (base calendar plus the commercial days).
NEW_YEAR = "Nieuwjaarsdag"
EASTER_SUNDAY = "Eerste paasdag"
EASTER_MONDAY = "Tweede paasdag"
KINGS_DAY = "Koningsdag"
QUEENS_DAY = "Koninginnedag"
LIBERATION_DAY = "Bevrijdingsdag"
ASCENSION = "Hemelvaartsdag"
WHIT_SUNDAY = "Eerste Pinksterdag"
WHIT_MONDAY = "Tweede Pinksterdag"
CHRISTMAS = "Eerste Kerstdag"
BOXING_DAY = "Tweede Kerstdag"
SINTERKLAAS = "Sinterklaas"
CHRISTMAS_EVE = "Kerstavond"
FATHERS_DAY = "Vaderdag"
MOTHERS_DAY = "Moederdag"


def calendar_features(df: DataFrame, date_col: str = "date", frequency: str = "daily") -> DataFrame:
    """Daily: day_of_week (Mon=0), day_of_month, day_of_year, month, year, month/quarter start/end flags.
    Weekly: week_of_year (ISO), year, is_week_start."""
    d = F.col(date_col)
    if frequency == "weekly":
        return df.withColumns({"week_of_year": F.weekofyear(d), "year": F.year(d),
                               "is_week_start": F.weekday(d) == 0})
    month_end = d == F.last_day(d)
    return df.withColumns({
        "day_of_week": F.weekday(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "month": F.month(d),
        "year": F.year(d),
        "is_month_start": F.dayofmonth(d) == 1,
        "is_month_end": month_end,
        "is_quarter_start": (F.dayofmonth(d) == 1) & F.month(d).isin(1, 4, 7, 10),
        "is_quarter_end": month_end & F.month(d).isin(3, 6, 9, 12),
    })


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday of ``year`` (anonymous Gregorian algorithm)."""
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
    day = (h + l_ - 7 * m + 114) % 31 + 1
    return F.make_date(y, month, day)


def _nth_sunday(year: Column, month: int, n: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    first_sunday = F.next_day(F.date_sub(first, 1), "Sun")
    return F.date_add(first_sunday, 7 * (n - 1))


def holiday_calendar(years: DataFrame, year_col: str = "year") -> DataFrame:
    """(date, holiday) for every year in ``years``; one row per date, names joined with '; '."""
    y = F.col(year_col).cast("int")
    easter = easter_sunday(y)
    royal = F.when(y >= 2014, F.when(F.weekday(F.make_date(y, F.lit(4), F.lit(27))) == 6,
                                     F.make_date(y, F.lit(4), F.lit(26)))
                   .otherwise(F.make_date(y, F.lit(4), F.lit(27)))) \
        .otherwise(F.when(F.weekday(F.make_date(y, F.lit(4), F.lit(30))) == 6, F.make_date(y, F.lit(4), F.lit(29)))
                   .otherwise(F.make_date(y, F.lit(4), F.lit(30))))
    royal_name = F.when(y >= 2014, F.lit(KINGS_DAY)).otherwise(F.lit(QUEENS_DAY))
    fixed = lambda m, dd: F.make_date(y, F.lit(m), F.lit(dd))
    entries = [
        (fixed(1, 1), F.lit(NEW_YEAR)),
        (easter, F.lit(EASTER_SUNDAY)),
        (F.date_add(easter, 1), F.lit(EASTER_MONDAY)),
        (royal, royal_name),
        (fixed(5, 5), F.lit(LIBERATION_DAY)),
        (F.date_add(easter, 39), F.lit(ASCENSION)),
        (F.date_add(easter, 49), F.lit(WHIT_SUNDAY)),
        (F.date_add(easter, 50), F.lit(WHIT_MONDAY)),
        (fixed(12, 25), F.lit(CHRISTMAS)),
        (fixed(12, 26), F.lit(BOXING_DAY)),
        (fixed(12, 5), F.lit(SINTERKLAAS)),
        (fixed(12, 24), F.lit(CHRISTMAS_EVE)),
        (_nth_sunday(y, 6, 3), F.lit(FATHERS_DAY)),
        (_nth_sunday(y, 5, 2), F.lit(MOTHERS_DAY)),
    ]
    arr = F.array(*[F.struct(dt.alias("date"), nm.alias("holiday")) for dt, nm in entries])
    rows = years.select(F.inline(arr))
    return rows.groupBy("date").agg(F.array_join(F.array_sort(F.collect_set("holiday")), "; ").alias("holiday"))


def years_of(df: DataFrame, date_col: str = "date", extra_years: int = 1) -> DataFrame:
    """Years from the first data year to the last one (+ ``extra_years``)."""
    span = df.agg(F.year(F.min(date_col)).alias("_lo"), F.year(F.max(date_col)).alias("_hi"))
    return span.select(F.explode(F.sequence("_lo", F.col("_hi") + extra_years)).alias("year"))


def holiday_features(df: DataFrame, date_col: str = "date", holidays: DataFrame | None = None,
                     horizon_days: int = 365) -> DataFrame:
    """Day calendar from 1 Jan of the first year to max(date) + horizon with
    holiday name ('No holiday'), days until the next and since the previous holiday (0 on the day)."""
    span = df.agg(F.make_date(F.year(F.min(date_col)), F.lit(1), F.lit(1)).alias("_lo"),
                  F.date_add(F.max(date_col), horizon_days).alias("_hi"))
    days = span.select(F.explode(F.sequence("_lo", "_hi")).alias("date"))
    if holidays is None:
        holidays = holiday_calendar(years_of(df, date_col, extra_years=(horizon_days // 365) + 1))
    cal = days.join(holidays, "date", "full")  # both bounded by the date span
    hdate = F.when(F.col("holiday").isNotNull(), F.col("date"))
    w_next = Window.orderBy("date").rowsBetween(0, Window.unboundedFollowing)
    w_prev = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return cal.select(
        "date",
        F.coalesce("holiday", F.lit(NO_HOLIDAY)).alias("holiday"),
        F.datediff(F.first(hdate, ignorenulls=True).over(w_next), F.col("date")).alias("time_until_next_holiday"),
        F.datediff(F.col("date"), F.last(hdate, ignorenulls=True).over(w_prev)).alias("time_after_previous_holiday"),
    )


def add_holiday_features(df: DataFrame, date_col: str = "date", holidays: DataFrame | None = None) -> DataFrame:
    """Holiday name and distances joined on the day; ``holidays`` (date, holiday) replaces the built-in calendar.

    Names of several rows of a day are joined, as in the built-in calendar.
    """
    if holidays is not None:
        holidays = holidays.filter(F.col("date").isNotNull() & F.col("holiday").isNotNull()).groupBy("date").agg(
            F.array_join(F.array_sort(F.collect_set("holiday")), "; ").alias("holiday"))
    cal = holiday_features(df, date_col, holidays).withColumnRenamed("date", date_col)
    return df.join(F.broadcast(cal), date_col, "left")


def week_has_holiday(calendar: DataFrame, date_col: str = "date") -> DataFrame:
    """Week start (Monday) -> has_holiday."""
    return calendar.groupBy(week_start(date_col).alias("week_start")).agg(
        F.bool_or(F.col("holiday") != NO_HOLIDAY).alias("has_holiday"))
