from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _day(value: date | str) -> Column:
    """A malformed date raises here, whatever the session's ANSI mode."""
    return F.lit(date.fromisoformat(value) if isinstance(value, str) else value).cast("date")


def post_filter(
    subreddit: str | None = None,
    start_date: date | str | None = None,
    end_date: date | str | None = None,
) -> Column:
    """Conjunction of the given conditions; None and '' mean no condition, both dates count."""
    terms = []
    if subreddit:
        terms.append(F.col("subreddit") == F.lit(subreddit))
    if start_date:
        terms.append(F.col("date") >= _day(start_date))
    if end_date:
        terms.append(F.col("date") <= _day(end_date))
    return reduce(and_, terms, F.lit(True))
