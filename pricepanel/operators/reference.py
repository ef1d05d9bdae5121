"""Reference series: CPI (clean, interpolate, carry forward, deflate) and weather.

Monthly CPI has one row per (category, month) and daily CPI one row per
(category, day): both are bounded by the calendar, so windows over a category
are small and the daily table may be broadcast into the panel join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# Dutch month names used by the statistics office tables.
DUTCH_MONTHS: dict[str, int] = {
    "januari": 1, "februari": 2, "maart": 3, "april": 4, "mei": 5, "juni": 6,
    "juli": 7, "augustus": 8, "september": 9, "oktober": 10, "november": 11, "december": 12,
}


def preprocess_cpi_periods(raw: DataFrame, period_col: str = "Perioden", value_col: str = "CPI_1") -> DataFrame:
    """Drop annual rows ('JJ'), turn '2020MM01' into the first day of that month, add date parts."""
    monthly = raw.filter(~F.col(period_col).contains("JJ")).select(
        F.to_date(F.regexp_replace(F.col(period_col), "MM", "-"), "yyyy-MM").alias("month_year"),
        F.col(value_col).cast("double").alias("cpi"))
    return cpi_date_columns(monthly)


def cpi_date_columns(df: DataFrame, month_col: str = "month_year") -> DataFrame:
    m = F.col(month_col)
    return df.withColumns({"year": F.year(m), "month": F.month(m), "days_in_month": F.dayofmonth(F.last_day(m))})


def clean_dutch_cpi(raw: DataFrame, period_col: str, value_col: str, order_col: str,
                    months: Mapping[str, int] = DUTCH_MONTHS) -> DataFrame:
    """Statistics-office text table: strip '*' from the period, drop all-digit (annual) rows,
    forward-fill missing values in table order, decimal comma -> dot, '2020 januari' -> 2020-01-01;
    unparseable periods dropped."""
    txt = F.trim(F.regexp_replace(F.col(period_col).cast("string"), r"\*", ""))
    w = Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    month_map = F.create_map(*[x for k, v in months.items() for x in (F.lit(k), F.lit(v))])
    parts = F.split(txt, " ")
    rows = (raw.withColumn("_txt", txt).filter(~F.col("_txt").rlike("^[0-9]+$"))
            .withColumn("_val", F.last(F.col(value_col), ignorenulls=True).over(w)))
    out = rows.select(
        F.make_date(parts[0].try_cast("int"), month_map[F.lower(parts[1])], F.lit(1)).alias("month_year"),
        F.regexp_replace(F.col("_val").cast("string"), ",", ".").cast("double").alias("cpi"))
    return out.dropna()


def interpolate_cpi(monthly: DataFrame, category_col: str | None = None, value_col: str = "cpi",
                    month_col: str = "month_year") -> DataFrame:
    """Monthly -> daily.  Between month i and the next month row, n days get
    ``c_i + k * (c_next - c_i) / (n - 1)`` (k = 0..n-1, the last day already equals
    the next value); the last month stays flat to its month end."""
    part = [category_col] if category_col else []
    w = Window.partitionBy(*part).orderBy(month_col)
    staged = (monthly.withColumn("_next_m", F.lead(month_col).over(w))
              .withColumn("_next_c", F.lead(value_col).over(w)))
    end = F.coalesce(F.date_sub("_next_m", 1), F.last_day(month_col))
    n = F.datediff(end, F.col(month_col)) + 1
    staged = staged.withColumn("_n", n).select(
        *part, F.col(month_col), F.col(value_col), "_next_c", "_n",
        F.posexplode(F.sequence(F.col(month_col), end)).alias("_k", "date"))
    step = F.try_divide(F.col("_next_c") - F.col(value_col), (F.col("_n") - 1).cast("double"))
    interp = (F.when(F.col("_next_c").isNull(), F.col(value_col))
              .when(F.col("_k") == F.col("_n") - 1, F.col("_next_c"))
              .otherwise(F.col(value_col) + F.col("_k") * step))
    return staged.select(*part, "date", interp.alias(value_col))


def carry_cpi_forward(monthly: DataFrame, as_of: str, category_col: str | None = None,
                      value_col: str = "cpi", month_col: str = "month_year") -> DataFrame:
    """Append months after the last month up to the month start after ``as_of`` with the last
    known non-NULL value (per category)."""
    part = [category_col] if category_col else []
    nxt = F.add_months(F.trunc(F.lit(as_of).cast("date"), "month"), 1)
    gmax = monthly.agg(F.max(month_col)).scalar()  # scalar subquery, computed once
    last = (monthly.filter(F.col(value_col).isNotNull()).groupBy(*part)
            .agg(F.max_by(value_col, month_col).alias("_last")))
    if category_col:
        cats = monthly.select(category_col).distinct()
        last = cats.join(last, category_col, "left")
    months = F.when(F.add_months(gmax, 1) <= nxt, F.sequence(F.add_months(gmax, 1), nxt, F.expr("INTERVAL 1 MONTH")))
    new = last.select(*part, F.explode(months).alias(month_col), F.col("_last").alias(value_col))  # no month, no row
    return monthly.select(*part, month_col, value_col).unionByName(new)


def filter_cpi_coverage(df: DataFrame, cpi_daily: DataFrame, date_col: str = "date") -> DataFrame:
    """Keep rows dated on or before the last CPI day."""
    return df.filter(F.col(date_col) <= cpi_daily.agg(F.max("date")).scalar())


def one_per_day(table: DataFrame, date_col: str = "date") -> DataFrame:
    """One row per day (of several the smallest whole row), so a join on the day never fans out; bounded by
    the calendar, hence broadcast."""
    rest = [c for c in table.columns if c != date_col]
    days = table.groupBy(date_col).agg(F.min(F.struct(*rest)).alias("_r"))
    return F.broadcast(days.select(date_col, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def adjust_price_base_year(df: DataFrame, cpi_daily: DataFrame, base_year: int, price_col: str = "product_selling_price",
                           date_col: str = "date", out_col: str = "adjusted_price",
                           category_col: str | None = None) -> DataFrame:
    """price * base / cpi, base = mean daily CPI of ``base_year``; rows after the CPI coverage dropped.

    With ``category_col`` (a column of both tables) CPI and base are those of the row's category.
    The daily series is written once: its last day, its base and the join read it from there.
    """
    cpi_daily = cut_lineage(cpi_daily, "cpi-daily")
    in_base = F.avg(F.when(F.year("date") == base_year, F.col("cpi")))
    covered = filter_cpi_coverage(df, cpi_daily, date_col)
    if category_col is None:
        base = cpi_daily.agg(in_base).scalar()
        joined = covered.join(one_per_day(cpi_daily.select(F.col("date").alias(date_col), "cpi"), date_col), date_col, "left")
        return joined.withColumn(out_col, F.col(price_col) * F.try_divide(base, F.col("cpi")))
    daily = cpi_daily.groupBy(category_col, F.col("date").alias(date_col)).agg(F.min("cpi").alias("cpi"))
    base = cpi_daily.groupBy(category_col).agg(in_base.alias("_base"))
    joined = covered.join(daily, [category_col, date_col], "left").join(base, category_col, "left")
    return joined.withColumn(out_col, F.col(price_col) * F.try_divide("_base", "cpi")).drop("_base")


def adjust_price_first_cpi(df: DataFrame, cpi_daily: DataFrame, price_col: str = "product_selling_price",
                           product_col: str = "product_code", date_col: str = "date",
                           out_col: str = "adjusted_price") -> DataFrame:
    """price * first_cpi / cpi, first_cpi = the product's CPI on its earliest date with a CPI.
    Without a CPI the price is copied."""
    daily = cpi_daily.select(F.col("date").alias(date_col), "cpi")
    joined = df.join(one_per_day(daily, date_col), date_col, "left")
    first = (joined.filter(F.col("cpi").isNotNull()).groupBy(product_col)
             .agg(F.min_by("cpi", date_col).alias("_first_cpi")))
    out = joined.join(first, product_col, "left")
    return out.withColumn(out_col, F.coalesce(F.col(price_col) * F.try_divide(F.col("_first_cpi"), F.col("cpi")),
                                              F.col(price_col))).drop("_first_cpi")


def scale_weather(raw: DataFrame) -> DataFrame:
    """Station columns -> named features; temperatures are in 0.1 degrees."""
    return raw.select("date", (F.col("TG") / 10).alias("mean_temp"), (F.col("TN") / 10).alias("min_temp"),
                      (F.col("TX") / 10).alias("max_temp"), F.col("RH").alias("sum_rain"),
                      F.col("DR").alias("len_rain"), F.col("SP").alias("perc_sun"))


def add_climatology(weather: DataFrame, date_col: str = "date") -> DataFrame:
    """mean_temp_over_years = mean of mean_temp over all years for the same (month, day)."""
    clim = (weather.groupBy(F.month(date_col).alias("_m"), F.dayofmonth(date_col).alias("_d"))
            .agg(F.avg("mean_temp").alias("mean_temp_over_years")))
    # at most 366 (month, day) rows
    return (weather.withColumn("_m", F.month(date_col)).withColumn("_d", F.dayofmonth(date_col))
            .join(F.broadcast(clim), ["_m", "_d"], "left").drop("_m", "_d"))


def add_weather(df: DataFrame, weather: DataFrame, date_col: str = "date") -> DataFrame:
    """panel LEFT JOIN daily weather; of several stations' rows of a day one is taken."""
    return df.join(one_per_day(weather.withColumnRenamed("date", date_col), date_col), date_col, "left")


def append_incremental(existing: DataFrame, fresh: DataFrame, date_col: str = "date") -> DataFrame:
    """High-water-mark append: rows of ``fresh`` on or after the last stored date replace stored
    rows of the same date (revised values win); the result has one row per date."""
    hw = existing.agg(F.max(date_col)).scalar()
    newer = fresh.filter(hw.isNull() | (F.col(date_col) >= hw))
    kept = existing.join(newer.select(date_col).distinct(), date_col, "left_anti")
    return kept.unionByName(newer)
