from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pearson(x: str, y: str) -> Column:
    """Correlation of two columns over the rows that have both.

    NULL for a constant column or a single row, where `corr` divides by zero under ANSI mode.
    """
    left, right = F.col(x), F.col(y)
    both = left.isNotNull() & right.isNotNull()
    spread = F.stddev_pop(F.when(both, left)) * F.stddev_pop(F.when(both, right))
    return F.try_divide(F.covar_pop(left, right), spread)
