"""Right-aligned strided windows: one every ``every`` days, the last ending on the last date of the table."""

from __future__ import annotations

from collections.abc import Mapping
from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Aggregates that panes carry as partial results: (inside a pane, over the panes of a window).
_PARTIAL = {"sum": (F.sum, F.sum), "count": (F.count, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}
_FROM_VALUES = {"median", "count_distinct"}


def strided_windows(df: DataFrame, every: int, period: int, aggs: Mapping[str, tuple[str, str]], by: list[str] | str = (),
                    date_col: str = "date", last=None, after_last: bool = False) -> DataFrame:
    """One row per key and window ``(end - period, end]`` that holds a row: keys, ``date_col`` (the end), aggregates.

    Ends are ``last - k * every``; ``last`` is the table's last date unless given (a literal or a scalar column).
    ``after_last`` also gives the windows that end later and hold only the rows up to ``last``.  ``aggs`` maps a result
    column to (function, column); functions: sum, avg, count, min, max, median, count_distinct.  NULLs are left out of
    the aggregates; rows without a date take no part.

    Days are first summed up in panes of ``gcd(every, period)`` days, so a row is shuffled once as part of a pane's
    partial result, and only panes are copied into the windows they belong to.  Medians and distinct counts carry a
    pane's distinct values with their counts.
    """
    keys = [by] if isinstance(by, str) else list(by)
    unknown = {f for f, _ in aggs.values()} - {*_PARTIAL, *_FROM_VALUES, "avg"}
    if unknown or every < 1 or period < 1:
        raise ValueError(f"unknown aggregates {sorted(unknown)}" if unknown else "every and period are whole days above 0")
    dated = df.filter(F.col(date_col).isNotNull())
    end = dated.agg(F.max(date_col)).scalar() if last is None else last if not isinstance(last, str) else F.lit(last).cast("date")
    width = gcd(every, period)
    paned = dated.withColumn("_pane", F.floor(F.datediff(end, F.col(date_col)) / width))  # 0 ends on the last date

    def windowed(panes: DataFrame) -> DataFrame:
        """Each pane once per window that covers it."""
        at = F.col("_pane") * width
        first = F.floor((at - period) / every) + 1
        first = first if after_last else F.greatest(first, F.lit(0))
        final = F.floor(at / every)
        return panes.withColumn("_k", F.explode(F.when(first <= final, F.sequence(first, final)))).drop("_pane")

    parts, results = [], {}
    for name, (fn, c) in aggs.items():
        if fn == "avg":
            parts += [(f"_s_{name}", F.sum(c), F.sum), (f"_c_{name}", F.count(c), F.sum)]
            results[name] = F.try_divide(f"_s_{name}", f"_c_{name}")
        elif fn in _PARTIAL:
            inside, over = _PARTIAL[fn]
            parts.append((f"_p_{name}", inside(c), over))
            results[name] = F.col(f"_p_{name}")
    panes = paned.groupBy(*keys, "_pane").agg(F.count(F.lit(1)).alias("_rows"), *[e.alias(n) for n, e, _ in parts])
    out = windowed(panes).groupBy(*keys, "_k").agg(F.sum("_rows").alias("_rows"), *[over(n).alias(n) for n, _, over in parts])
    for c in dict.fromkeys(c for f, c in aggs.values() if f in _FROM_VALUES):
        values = paned.filter(F.col(c).isNotNull()).groupBy(*keys, "_pane", F.col(c).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        of = {n: f for n, (f, x) in aggs.items() if x == c and f in _FROM_VALUES}
        made = [(F.percentile("_v", F.lit(0.5), F.col("_n")) if f == "median" else F.count_distinct("_v")).alias(f"_p_{n}")
                for n, f in of.items()]
        got = windowed(values).groupBy(*keys, "_k").agg(*made).withColumnsRenamed({k: f"_r_{k}" for k in [*keys, "_k"]})
        out = out.join(got, [out[k].eqNullSafe(got[f"_r_{k}"]) for k in [*keys, "_k"]], "left").drop(*[f"_r_{k}" for k in [*keys, "_k"]])
        results |= {n: F.col(f"_p_{n}") if f == "median" else F.coalesce(f"_p_{n}", F.lit(0)) for n, f in of.items()}
    return out.select(*keys, F.date_sub(end, (F.col("_k") * every).cast("int")).alias(date_col),
                      *[results[n].alias(n) for n in aggs])
