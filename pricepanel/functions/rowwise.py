"""Row-wise (horizontal) competitor features as native array / conditional expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def symmetric_distance(own, other) -> Column:
    """(own - other) / mean(own, other); NULL unless the mean is > 0."""
    own, other = F.col(own) if isinstance(own, str) else own, F.col(other) if isinstance(other, str) else other
    avg = (own + other) / 2
    return F.when(avg > 0, (own - other) / avg)


def row_min(cols: Sequence[str]) -> Column:
    """Minimum skipping NULLs (``least`` needs two arguments; one column passes through)."""
    return F.col(cols[0]) if len(cols) == 1 else F.least(*[F.col(c) for c in cols])


def row_max(cols: Sequence[str]) -> Column:
    return F.col(cols[0]) if len(cols) == 1 else F.greatest(*[F.col(c) for c in cols])


def _tagged(cols: Sequence[str], names: Sequence[str], sign: int) -> Column:
    return F.filter(F.array(*[F.struct(F.col(c).alias("p"), F.lit(sign * i).alias("i"), F.lit(n).alias("n"))
                              for i, (c, n) in enumerate(zip(cols, names))]), lambda x: x["p"].isNotNull())


def cheapest_name(cols: Sequence[str], names: Sequence[str]) -> Column:
    """Name of the cheapest competitor; ties -> first in list; all NULL -> NULL."""
    return F.array_min(_tagged(cols, names, 1))["n"]


def dearest_name(cols: Sequence[str], names: Sequence[str]) -> Column:
    """Name of the most expensive competitor; ties -> first in list."""
    return F.array_max(_tagged(cols, names, -1))["n"]


def non_null(cols: Sequence[str]) -> Column:
    return F.filter(F.array(*[F.col(c) for c in cols]), lambda x: x.isNotNull())


def row_mean(cols: Sequence[str]) -> Column:
    """Mean of the non-NULL values (NULL when none)."""
    vals = non_null(cols)
    total = F.aggregate(vals, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(vals) > 0, total / F.size(vals))


def count_positive(cols: Sequence[str]) -> Column:
    return F.size(F.filter(F.array(*[F.col(c) for c in cols]), lambda x: x > 0))


def count_present(cols: Sequence[str]) -> Column:
    return F.size(non_null(cols))


def geometric_mean_positive(cols: Sequence[str]) -> Column:
    """exp(mean(ln x)) over the values > 0 (zeros and NULLs ignored)."""
    logs = F.transform(F.filter(F.array(*[F.col(c) for c in cols]), lambda x: x > 0), lambda x: F.ln(x))
    total = F.aggregate(logs, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(logs) > 0, F.exp(total / F.size(logs)))


def safe_log(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c > 0, F.ln(c))
