"""Three roundings that coexist, and null-strict arithmetic. They are not interchangeable."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Context, Decimal
from functools import reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def round_15_digits(x: Column, places: int = 4) -> Column:
    """A double to 15 significant digits, then half away from zero to ``places``; minus zero becomes zero.

    15 digits move a value below 1e9 on the scale of ``places`` by less than 1e-5, so one that lies 1e-4 or more beside a
    half is rounded as it is; only the others are spelled out."""
    scaled = x * F.lit(10.0**places)
    plain = (F.abs(scaled) < 1e9) & (F.abs(scaled - F.rint(scaled)) < 0.4999)
    digits = F.format_string("%.14e", x)
    exact = F.when(F.abs(x) < 1e15, digits).try_cast("decimal(38,15)")
    spelled = F.coalesce(F.round(exact, places).cast("double"), x)
    return F.when(plain, F.rint(scaled) / F.lit(10.0**places)).otherwise(spelled) + F.lit(0.0)


def round_half_even_scaled(x: Column, places: int = 2) -> Column:
    """Half to even on the scaled double, as array libraries round."""
    return F.rint(x * F.lit(10.0**places)) / F.lit(10.0**places)


def round_half_up(x: Column, places: int) -> Column:
    """Exact decimal, half up."""
    return F.round(x, places)


#: Digits of the longest double that is written out.
WRITTEN_OUT = Context(prec=800, rounding=ROUND_HALF_UP)


def half_up_values(values: np.ndarray, places: np.ndarray | int) -> np.ndarray:
    """``round_half_up`` of doubles inside tasks, equal to Spark's to the last bit; minus zero becomes zero.

    Scaling moves a value below 1e11 by less than 1e-4, so one that lies farther beside a half is rounded as it is; only
    the others are written out, as the shortest decimal that reads back."""
    places = np.broadcast_to(places, values.shape)
    unit = 10.0**places
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.abs(values) * unit
        whole = np.floor(scaled)
        beside = np.abs(scaled - whole - 0.5)
        out = np.copysign((whole + (scaled - whole > 0.5)) / unit, values) + 0.0
    near = np.isfinite(values) & ~((scaled < 1e11) & (beside > 1e-4))
    for at in zip(*(x.tolist() for x in np.nonzero(near))):
        exact = Decimal(repr(float(values[at]))).quantize(Decimal(1).scaleb(-int(places[at])), context=WRITTEN_OUT)
        out[at] = float(exact) + 0.0
    return np.where(np.isfinite(values), out, values)


def guarded_ratio(numerator: Column, denominator: Column, scale: float = 100.0) -> Column:
    """numerator / denominator x scale; null unless both are present and the denominator is positive."""
    n, d = numerator.cast("double"), denominator.cast("double")
    return F.when(d > 0, n / d * F.lit(float(scale)))


def strict_sum(*terms: Column) -> Column:
    """The sum, null if any term is."""
    return reduce(lambda a, b: a + b, terms)


def strict_difference(a: Column, b: Column) -> Column:
    """a - b, null if either is."""
    return a - b
