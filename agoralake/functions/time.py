"""Zone-free time: every result is TIMESTAMP_NTZ or DATE, so the session zone never matters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_to_timestamp(seconds: Column) -> Column:
    """Seconds since 1970 to a UTC wall-clock time; values no timestamp can hold give NULL."""
    micros = F.rint(seconds * F.lit(1e6)).try_cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))


_DAY = r"^\s*\d{4}-\d{2}-\d{2}"
_OFFSET = r"^(.*[T ]\d{2}:\d{2}.*)([+-])(\d{2}):?(\d{2})\s*$"


def iso_to_timestamp(text: Column) -> Column:
    """ISO-8601 text with or without a fraction, in UTC.

    An offset in the text is taken off; text without a whole date, or that does not parse, gives NULL.
    """
    part = [F.regexp_extract(text, _OFFSET, k) for k in range(5)]
    minutes = part[3].try_cast("int") * 60 + part[4].try_cast("int")
    east = F.when(part[2] == "-", minutes).otherwise(-minutes)
    shifted = F.timestamp_add("MINUTE", east, part[1].try_cast("timestamp_ntz"))
    plain = F.when(text.rlike(_DAY), text.try_cast("timestamp_ntz"))
    return F.when(text.rlike(_OFFSET), shifted).otherwise(plain)


def run_time(run_ts: datetime | str | None = None) -> datetime:
    """The naive time a run is stamped with: the given one, else now."""
    if isinstance(run_ts, str):
        run_ts = datetime.fromisoformat(run_ts)
    return run_ts or datetime.now()


def run_partition(part: str, stamp: Column) -> Column:
    """Value of a run partition column: run_date, run_hour or run_id (to the second)."""
    if part == "run_date":
        return stamp.cast("date")
    if part == "run_hour":
        return F.lpad(F.hour(stamp).cast("string"), 2, "0")
    # date_format would take the session zone and shift times inside its DST gap.
    return F.translate(F.substring(stamp.cast("string"), 1, 19), " -:", "_")
