"""Numeric column functions that keep to floating-point rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def known(x: Column | str) -> Column:
    """NaN becomes null, so that comparisons with it are not true."""
    c = F.col(x) if isinstance(x, str) else x
    return F.when(~F.isnan(c), c)


def round_even(x: Column | str, places: int) -> Column:
    """Multiply, round half to even, divide: the rounding of array libraries."""
    c = F.col(x) if isinstance(x, str) else x
    scale = float(10**places)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def calibrated(value: Column, zero: Column, intercept: Column, slope: Column) -> Column:
    """(value - zero - intercept) / slope; a slope of zero gives null."""
    return F.try_divide(value - zero - intercept, slope)


def line_at(t: Column, t0: Column, v0: Column, t1: Column, v1: Column) -> Column:
    """The value at ``t`` of the line through (t0, v0) and (t1, v1); equal times give v0, nulls null.

    Times are numbers.  Outside [t0, t1] the line goes on.
    """
    return F.when(t1 == t0, v0).otherwise(v0 + (v1 - v0) * F.try_divide((t - t0).cast("double"), (t1 - t0).cast("double")))


def diluted(conc: Column, cal_flow: Column, zero_flow: Column) -> Column:
    """Concentration of a standard in the mixed flow."""
    return conc * F.try_divide(cal_flow, cal_flow + zero_flow)


def scaled_array(values: str | Column, factor: float) -> Column:
    """Each number of an array times a factor, as counts to counts per second."""
    return F.transform(values, lambda x: x.cast("double") * F.lit(factor))


def fitted_array(values: str | Column, size: int) -> Column:
    """An array cut or padded with nulls to ``size`` entries."""
    c = F.col(values) if isinstance(values, str) else values
    return F.concat(F.slice(c, 1, size), F.array_repeat(F.lit(None).cast("double"), F.greatest(F.lit(0), F.lit(size) - F.size(c))))
