"""Scalar expressions used by the transforms, models and metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def min_max(value: Column, low: float | None, high: float | None) -> Column:
    """``(value - low) / (high - low)``; NULL for a constant column."""
    if low is None:
        return F.lit(None).cast("double")
    return F.try_divide(value - F.lit(low), F.lit(high) - F.lit(low))


def shifted_log(value: Column, low: float | None) -> Column:
    """``ln(value - low + 1)``; NULL where the logarithm is undefined."""
    if low is None:
        return F.lit(None).cast("double")
    shifted = value - F.lit(low) + F.lit(1.0)
    return F.when(shifted > 0, F.log(shifted))


def log_min_max(value: Column, low: float | None, high: float | None) -> Column:
    """``ln(value - low + 1)`` over its own maximum; NULL where undefined."""
    if low is None:
        return F.lit(None).cast("double")
    return F.try_divide(shifted_log(value, low), shifted_log(F.lit(high), low))


def log_loss_term(p: Column, label: Column, eps: float = 1e-15) -> Column:
    """``-a ln p - (1-a) ln(1-p)`` with ``p`` clamped to ``[eps, 1-eps]``."""
    clamped = F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))
    return -label * F.log(clamped) - (F.lit(1.0) - label) * F.log(F.lit(1.0) - clamped)


def recode_label(label: Column, positive: Column, yes, no) -> Column:
    """``yes`` where ``positive`` holds for the label, else ``no`` (also for a missing label)."""
    return F.when(F.coalesce(positive, F.lit(False)), F.lit(yes)).otherwise(F.lit(no))


def fold_long(value: Column) -> Column:
    """The high 32 bits of a long xor-ed onto the low ones."""
    return value.bitwiseXOR(F.shiftrightunsigned(value, 32))


def sign_by_parity(value: Column) -> Column:
    """+1 for an odd value, -1 for an even one."""
    return F.when(value.bitwiseAND(F.lit(1)) == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
