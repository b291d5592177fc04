"""Sums of doubles that don't depend on the order in which they are added."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of a limb behind the point. A limb's sum is a long, so 2^32 rows of a group fit.
LIMB = 31


def exact_sum(x: str | Column) -> Column:
    """Sum of finite doubles as fixed-point numbers: a long before the point, and two limbs of LIMB bits behind it, each added up by
    itself. The sum is exact where all values are multiples of 2^-62, as every double of 2^-10 and more and every float of 2^-39 and
    more is; smaller parts are cut from each value, so any order gives the same bits. A sum beyond a long fails the job. Null
    without rows, as other sums."""
    x = F.col(x) if isinstance(x, str) else x
    step = float(1 << LIMB)
    whole = F.floor(x)
    first = (x - whole) * step  # exact: a double's fraction
    second = (first - F.floor(first)) * step
    hi, mid, lo = F.sum(whole.cast("long")), F.sum(F.floor(first).cast("long")), F.sum(F.floor(second).cast("long"))
    mask = F.lit((1 << LIMB) - 1)
    up = mid + F.shiftright(lo, LIMB)
    return hi + F.shiftright(up, LIMB) + (up.bitwiseAND(mask) / step + lo.bitwiseAND(mask) / step / step)
