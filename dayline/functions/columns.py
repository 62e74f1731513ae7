"""Scalar and aggregate expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Band(NamedTuple):
    """A label for ranges that start at or above ``low`` and end below ``below``."""

    label: int
    low: int | None = None
    below: int | None = None


# Age bands of the curated table, tried in this order.
AGE_BANDS = (Band(0, below=30), Band(2, low=60), Band(1, low=30, below=60))

# Colour names of the landed risk table.
RISK_COLOURS = {"giallo": "yellow", "arancione": "orange", "rosso": "red", "bianco": "white"}

# The colours from the least to the gravest.
RISK_ORDER = ["white", "yellow", "orange", "red"]

# Score of a forecast that cannot be compared, and the 95 % normal quantile.
PENALTY = 1e6
Z95 = 1.959964


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reband(c: Column | str, bands: Sequence[Band] = AGE_BANDS) -> Column:
    """Label of the first band a ``"low-high"`` or open ``"low+"`` range fits, else NULL."""
    text = F.trim(_col(c))
    low = F.rtrim(F.substring_index(text, "-", 1), F.lit("+")).try_cast("int")
    end = F.substring_index(F.substring_index(text, "-", 2), "-", -1)
    high = F.when(text.contains("-"), end).try_cast("int")
    tests = []
    for band in bands:
        # an open range has no high end, so it is never below anything
        fits = F.lit(True)
        if band.low is not None:
            fits = fits & (low >= band.low)
        if band.below is not None:
            fits = fits & (high < band.below)
        tests.append(fits)
    # all tests in one array, not a chain of branches: the ends are then parsed once per row
    first = F.array_position(F.array(*tests), True).cast("int")
    return F.get(F.array(*[F.lit(b.label) for b in bands]), first - 1)


def recode_column(c: Column | str, mapping: Mapping, default=None) -> Column:
    pairs = [F.lit(v) for item in mapping.items() for v in item]
    found = F.try_element_at(F.create_map(*pairs), _col(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def row_sum(cols: Iterable[Column | str]) -> Column:
    """Sum across columns of one row; NULL counts as nothing."""
    total = F.lit(0)
    for c in cols:
        total = total + F.coalesce(_col(c), F.lit(0))
    return total


def same_set(a: Column | str, b: Column | str) -> Column:
    """Equal as sets: order and repeats do not matter."""
    return F.array_sort(F.array_distinct(_col(a))) == F.array_sort(F.array_distinct(_col(b)))


def transform_column(c: Column | str, kind: str | None) -> Column:
    if kind is None:
        return _col(c)
    if kind == "sqrt":
        return F.sqrt(_col(c))
    raise ValueError(f"unknown transformation {kind!r}")


def back_transform(c: Column | str, kind: str | None) -> Column:
    if kind is None:
        return _col(c)
    if kind == "sqrt":
        return F.pow(_col(c), F.lit(2.0))
    raise ValueError(f"unknown transformation {kind!r}")


def _unusable(c: Column) -> Column:
    return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))


def rmse(actual: Column | str, predicted: Column | str, penalty: float = PENALTY) -> Column:
    """Aggregate: root mean squared error, or ``penalty`` if any pair cannot be compared."""
    a, p = _col(actual).cast("double"), _col(predicted).cast("double")
    broken = F.count_if(_unusable(a) | _unusable(p)) > 0
    return F.when(broken, F.lit(penalty)).otherwise(F.sqrt(F.avg((a - p) * (a - p))))


def mean_absolute_error(actual: Column | str, predicted: Column | str,
                        penalty: float = PENALTY) -> Column:
    a, p = _col(actual).cast("double"), _col(predicted).cast("double")
    broken = F.count_if(_unusable(a) | _unusable(p)) > 0
    return F.when(broken, F.lit(penalty)).otherwise(F.avg(F.abs(a - p)))


def _polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    value = F.lit(0.0)
    for c in coefficients:
        value = value * x + F.lit(c)
    return value


# Rational approximation of the normal quantile published by P. J. Acklam.
_CENTRE_NUM = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
               1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_CENTRE_DEN = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
               6.680131188771972e+01, -1.328068155288572e+01, 1.0)
_TAIL_NUM = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
             -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_TAIL_DEN = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
             3.754408661907416e+00, 1.0)
_TAIL_FROM = 0.02425


def normal_quantile(p: Column | str) -> Column:
    """Standard normal quantile of a probability strictly between 0 and 1."""
    p = _col(p)
    centred = p - 0.5
    square = centred * centred
    middle = centred * _polynomial(square, _CENTRE_NUM) / _polynomial(square, _CENTRE_DEN)

    def tail(prob: Column) -> Column:
        r = F.sqrt(-2.0 * F.log(prob))
        return _polynomial(r, _TAIL_NUM) / _polynomial(r, _TAIL_DEN)

    return (F.when(p < _TAIL_FROM, tail(p))
            .when(p > 1 - _TAIL_FROM, -tail(1 - p))
            .otherwise(middle))


def standard_error(c: Column | str) -> Column:
    """Aggregate: sample standard deviation over the root of the number of values."""
    return F.stddev_samp(_col(c)) / F.sqrt(F.count(_col(c)))


def aic(n: Column | str, rss: Column | str, n_params: Column | str) -> Column:
    """Akaike's criterion from a residual sum of squares; smaller is better, an exact fit least."""
    n = _col(n).cast("double")
    return F.when((n > 0) & (_col(rss) <= 0), F.lit(float("-inf"))) \
        .when(n > 0, n * F.log(_col(rss) / n) + 2.0 * _col(n_params))
