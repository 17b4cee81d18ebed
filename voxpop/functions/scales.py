"""Map intensities and approval ratios (numeric side of the regional report).

The colour rendering itself is not rebuilt; these are the numbers behind it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ranges and ratio cut points of the regional report.
POSITIVE_RANGE = (0.0, 0.6)
NEGATIVE_RANGE = (0.0, 1.0)
DIFFERENCE_RANGE = (0.0, 1.0)
RATIO_BUCKETS = [(1.05, 0.8), (0.99, 0.6), (0.96, 0.4)]
RATIO_FLOOR_BUCKET = 0.2


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def intensity(value: Column | str, vmin: float, vmax: float) -> Column:
    """``1 - sqrt((v - vmin) / (vmax - vmin))``; NULL (not an error)
    when the normalised value is negative."""
    scaled = (_c(value) - F.lit(vmin)) / F.lit(vmax - vmin)
    return F.when(scaled >= 0, F.lit(1.0) - F.sqrt(scaled))


def positive_intensity(pos: Column | str) -> Column:
    return intensity(pos, *POSITIVE_RANGE)


def negative_intensity(neg: Column | str) -> Column:
    return intensity(neg, *NEGATIVE_RANGE)


def difference_intensity(pos: Column | str, neg: Column | str) -> Column:
    return intensity(_c(neg) - _c(pos), *DIFFERENCE_RANGE)


def approval_ratio(pos: Column | str, neg: Column | str, scale: Column | float) -> Column:
    """``scale * pos / neg``; NULL when ``neg`` is 0 (ANSI-safe)."""
    s = scale if isinstance(scale, Column) else F.lit(float(scale))
    return s * _c(pos) / F.nullif(_c(neg), F.lit(0.0))


def approval_bucket(ratio: Column | str) -> Column:
    """Ratio -> bucket value (cut points as in the code, not the legend)."""
    r = _c(ratio)
    expr = F.when(r.isNull(), F.lit(None).cast("double"))
    for cut, bucket in RATIO_BUCKETS:
        cond = r >= F.lit(cut)
        expr = expr.when(cond, F.lit(bucket))
    return expr.otherwise(F.lit(RATIO_FLOOR_BUCKET))
