"""Minimum-support conversion: a ratio of the baskets becomes an absolute basket count.

The three modes differ by one basket near the boundary, so each keeps plain double arithmetic:

* ``ceil``  – smallest whole number not below ``ratio * n``
* ``floor`` – ``ratio * n`` truncated
* ``ratio`` – smallest count whose ``count / n`` reaches the ratio

All of them return at least 1.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MODES = ("ceil", "floor", "ratio")


def _known(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"unknown threshold mode {mode!r}: expected one of {', '.join(MODES)}")


def absolute_support(n: int, ratio: float, mode: str = "ceil") -> int:
    """Driver-side conversion for a known number of baskets."""
    _known(mode)
    product = ratio * n
    if mode == "floor":
        return max(1, int(product))
    count = math.ceil(product)
    if mode == "ratio" and n:
        # the product carries binary noise; the division below is what decides
        while count > 1 and (count - 1) / n >= ratio:
            count -= 1
        while count / n < ratio:
            count += 1
    return max(1, count)


def absolute_support_column(n: Column, ratio: Column, mode: str) -> Column:
    """The same conversion as a column expression (``n`` > 0)."""
    _known(mode)
    n, ratio = n.cast("double"), ratio.cast("double")
    if mode == "floor":
        count = F.floor(ratio * n).cast("long")
    else:
        count = F.ceil(ratio * n).cast("long")
        if mode == "ratio":
            count = (
                F.when((count - 1) / n >= ratio, count - 1)
                .when(count / n < ratio, count + 1)
                .otherwise(count)
            )
    return F.greatest(F.lit(1).cast("long"), count)
