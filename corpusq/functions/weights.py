"""Term weights and the rounding that keeps rankings reproducible."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: added to the ratio inside the logarithm of the TF-IDF weights.
IDF_EPSILON = 1e-9


def half_even(value: Column, places: int) -> Column:
    """Round to ``places`` digits, ties to even, on plain doubles."""
    scale = float(10**places)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def round_exact(value: Column, places: int) -> Column:
    """Round a double as the decimal number it stands for, ties to even.

    The scaled value may only look like a tie: multiplying has rounded it. Then
    the part lost in the product, worked out from the two halves of the
    value, tells on which side the true value lies.
    """
    scale = F.lit(float(10**places))
    scaled = value * scale
    wide = value * F.lit(134217729.0)  # 2**27 + 1 splits a double in halves
    high = wide - (wide - value)
    lost = (high * scale - scaled) + (value - high) * scale
    tie = scaled - F.floor(scaled) == 0.5
    whole = (
        F.when(tie & (lost > 0), F.ceil(scaled)).when(tie & (lost < 0), F.floor(scaled)).otherwise(F.rint(scaled))
    )
    return whole / scale


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; 0 where the whole is 0, null where either is null."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.try_divide(part.cast("double"), whole))


def idf(n: Column | float, df: Column) -> Column:
    """``ln(n / df)``."""
    return F.log(F.lit(n) / df)


def idf_smoothed(n: Column | float, df: Column) -> Column:
    """``ln(n / df + 1e-9)``, the TF-IDF query and document weight."""
    return F.log(F.lit(n) / df + F.lit(IDF_EPSILON))


def idf_bm25(n: Column | float, df: Column) -> Column:
    """``ln(1 + (n - df + 0.5) / (df + 0.5))``."""
    return F.log(F.lit(1.0) + (F.lit(n) - df + F.lit(0.5)) / (df + F.lit(0.5)))


def bm25_saturation(tf: Column, dl: Column, avg_dl: Column | float, k1: float, b: float) -> Column:
    """Length-normalised, saturating share of the term frequency; in a corpus of empty documents all lengths count as 0."""
    stretch = F.lit(1.0 - b) + F.lit(b) * ratio(dl, F.lit(avg_dl))
    return tf * F.lit(k1 + 1.0) / (tf + F.lit(k1) * stretch)
