"""Time expressions on zone-less UTC wall-clock columns."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F

NTZ = "timestamp_ntz"


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts(value) -> Column:
    """Zone-less literal; it folds to a constant, so comparisons reach the Parquet scan."""
    if isinstance(value, Column):
        return value
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast(NTZ)


def to_datetime(value) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(value)


def trunc_ts(c, unit: str) -> Column:
    """Start of the hour, day, ISO week or month."""
    return F.date_trunc(unit, as_col(c)).cast(NTZ)


def shift_ts(c, n: int, unit: str) -> Column:
    """Add ``n`` units (negative to go back); months clamp to the month's last day."""
    return F.timestamp_add(unit.upper(), F.lit(n), as_col(c))


def business_day(c, offset_hours: int = 9, in_utc: bool = False) -> Column:
    """Start of the local business day; ``in_utc`` gives that instant back in UTC."""
    day = trunc_ts(shift_ts(c, offset_hours, "hour"), "day")
    return shift_ts(day, -offset_hours, "hour") if in_utc else day


def business_day_bounds(day, offset_hours: int = 9) -> tuple[datetime, datetime]:
    """UTC half-open bounds of one local business day."""
    start = to_datetime(day) - timedelta(hours=offset_hours)
    return start, start + timedelta(days=1)


def convert_zone(c, target: str, source: str = "UTC") -> Column:
    """Wall clock of ``source`` shown as wall clock of ``target``."""
    return F.convert_timezone(F.lit(source), F.lit(target), as_col(c).cast(NTZ))


def diff_complete(unit: str, a, b) -> Column:
    """Complete units from ``a`` to ``b`` (59 minutes are 0 hours)."""
    return F.timestamp_diff(unit.upper(), as_col(a), as_col(b))


def diff_boundaries(unit: str, a, b) -> Column:
    """Unit boundaries crossed from ``a`` to ``b`` (10:59 to 11:01 is 1 hour)."""
    return F.timestamp_diff(unit.upper(), trunc_ts(a, unit), trunc_ts(b, unit))


def epoch_to_ts(c, unit: str = "s", zero_null: bool = False) -> Column:
    """Epoch seconds or milliseconds to a timestamp; zero may mean "never happened"."""
    c = as_col(c)
    if zero_null:
        c = F.nullif(c, F.lit(0))
    made = {"s": F.timestamp_seconds, "ms": F.timestamp_millis}[unit](c)
    return made.cast(NTZ)


def parse_ts(c, fmt: str) -> Column:
    """Text in one format to a timestamp, NULL when it does not parse."""
    return F.try_to_timestamp(as_col(c), F.lit(fmt)).cast(NTZ)


def parse_ts_multi(c, formats: list[str]) -> Column:
    """First format that parses wins."""
    return F.coalesce(*[parse_ts(c, f) for f in formats])


def iso_to_ts(c) -> Column:
    """ISO text with a T separator and a Z suffix to a timestamp."""
    plain = F.replace(F.replace(as_col(c), F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit(""))
    return plain.try_cast(NTZ)


def year(c) -> Column:
    return F.year(as_col(c))


def since(run_ts, n: int, unit: str) -> Column:
    """``n`` units before the run time; the run time is an argument so that reruns agree."""
    return shift_ts(ts(run_ts), -n, unit)
