"""Array<double> maths as Catalyst expressions (higher-order functions, no UDF)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def vector(cols: Sequence[str]) -> Column:
    """Feature columns -> one array<double>."""
    return F.array(*[F.col(c).cast("double") for c in cols])


def lit_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)


def dot(a, b) -> Column:
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: x * y))


def sq_norm(a) -> Column:
    return _sum(F.transform(_c(a), lambda x: x * x))


def norm(a) -> Column:
    return F.sqrt(sq_norm(a))


def sq_dist(a, b) -> Column:
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)))


def dist(a, b) -> Column:
    return F.sqrt(sq_dist(a, b))


def scale(a, s) -> Column:
    s = _c(s)
    return F.transform(_c(a), lambda x: x * s)


def unit(a, norm_col) -> Column:
    """a / |a|, the zero vector stays zero. `norm_col` is a column already holding |a|."""
    n = _c(norm_col)
    return F.transform(_c(a), lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0)))
