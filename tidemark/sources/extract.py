"""Extracts from an operational store.

A reader has ``rows(columns, predicates)``, ``bounds(key)`` and ``splits(key, parts, lower, upper)``. Every predicate is one partition of the
read, so Spark schedules the ranges; nothing is paged with OFFSET. A DataFrame brings its own partitions, so its ranges, which follow each
other without gaps, are read by their outer bounds: a row is tested once, however many ranges there are.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.times import to_datetime

STEP_ROWS = 10_000
FETCH_ROWS = 10_000


@dataclass(frozen=True)
class JdbcReader:
    """Reader over a JDBC table; projection, predicates and the bounds run in the store."""
    spark: SparkSession
    url: str
    table: str
    properties: dict[str, str]

    def _props(self) -> dict[str, str]:
        return {"fetchsize": str(FETCH_ROWS)} | self.properties

    def rows(self, columns: list[str], predicates: list[str] | None) -> DataFrame:
        more = {"predicates": predicates} if predicates is not None else {}
        return self.spark.read.jdbc(self.url, self.table, properties=self._props(), **more).select(*columns)

    def bounds_query(self, key: str) -> str:
        """A table expression of one row, so that the store and not the client scans the key."""
        return f"(SELECT min({key}) AS lo, max({key}) AS hi FROM {self.table}) b"

    def bounds(self, key: str) -> tuple:
        found = self.spark.read.jdbc(self.url, self.bounds_query(key), properties=self._props()).first()
        return found["lo"], found["hi"]

    def splits_query(self, key: str, parts: int, lower, upper) -> str:
        """A table expression of ``parts`` rows: the first key of each tile, so that the store ranks its index and sends no rows."""
        tiles = f"SELECT {key} AS k, ntile({parts}) OVER (ORDER BY {key}) AS tile FROM {self.table} WHERE {key} >= {lower} AND {key} < {upper}"
        return f"(SELECT min(k) AS k FROM ({tiles}) t GROUP BY tile) s"

    def splits(self, key: str, parts: int, lower, upper) -> list:
        found = self.spark.read.jdbc(self.url, self.splits_query(key, parts, lower, upper), properties=self._props())
        return [r["k"] for r in found.collect()]


@dataclass(frozen=True)
class FrameReader:
    """Reader over a DataFrame, for tables that are already in the lake."""
    df: DataFrame

    def rows(self, columns: list[str], predicates: list[str] | None) -> DataFrame:
        rows = self.df if predicates is None else self.df.filter(" OR ".join(f"({p})" for p in predicates))
        return rows.select(*columns)

    def bounds(self, key: str) -> tuple:
        found = self.df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
        return found["lo"], found["hi"]

    def splits(self, key: str, parts: int, lower, upper) -> list:
        """Approximate quantiles, each off by at most a twentieth of a range's rows; the sketches combine before the shuffle."""
        grid = F.percentile_approx(key, [i / parts for i in range(1, parts)] or [0.0], F.lit(20 * parts))
        return self.df.filter((F.col(key) >= lower) & (F.col(key) < upper)).agg(grid).first()[0] or []


def extract_table(reader, columns: list[str], mode: str = "dump", key: str | None = None, lower=None, upper=None,
                  step: int | None = None, parts: int | None = None, period: str = "hour", number: str | None = None,
                  balanced: bool = False) -> DataFrame:
    """Full dump, or the rows of [lower, upper) of an increment key.

    When both bounds are equal that single value is read. A numeric extract without bounds reads the
    key's whole range, its largest value included; a dump with a numeric key is read in such ranges as
    well, and one without is a single partition. The caller gives the ranges' width (``step``) or their
    number (``parts``), and gets it. ``balanced`` ranges (with ``parts``) hold about as many rows each instead of being
    as wide, however uneven the key; fewer ranges come back where single keys hold more rows than a range, as
    rows of one key stay together. ``number`` adds the number of the range each row was read by.
    """
    if mode == "dump" and key is None:
        return reader.rows(columns, None)
    if balanced and (mode == "timestamp" or parts is None or parts < 1):
        raise ValueError("balanced ranges need a numeric key and the number of parts")
    if mode in ("dump", "numeric"):
        low, high = _key_range(reader, key, lower, upper)
        if balanced:
            ranges = balanced_ranges(low, high, reader.splits(key, parts, low, high))
        else:
            ranges = numeric_ranges(low, high, step, parts)
        kind = "bigint"
    elif mode == "timestamp":
        ranges, kind = timestamp_ranges(lower, upper, period), "timestamp_ntz"
    else:
        raise ValueError(f"mode {mode!r} is not dump, numeric or timestamp")
    reads = [(ranges[0][0], ranges[-1][1])] if isinstance(reader, FrameReader) else ranges
    rows = reader.rows(columns, predicates(key, reads))
    if number and kind == "bigint" and not balanced:
        width = max(ranges[0][1] - ranges[0][0], 1)
        rows = rows.withColumn(number, F.expr(f"CAST((`{key}` - {ranges[0][0]}) DIV {width} AS INT)"))
    elif number:
        starts = F.lit([str(a) for a, _ in ranges]).cast(f"array<{kind}>")
        rows = rows.withColumn(number, F.size(F.filter(starts, lambda a: a <= F.col(key))) - 1)
    return rows


def _key_range(reader, key: str, lower, upper):
    if lower is not None and upper is not None:
        return lower, upper
    low, high = reader.bounds(key)
    if low is None:
        return 0, 0
    # One past the largest value, so that the half-open last range holds it.
    return (low if lower is None else lower), (high + 1 if upper is None else upper)


def numeric_ranges(lower: int, upper: int, step: int | None = None, parts: int | None = None) -> list[tuple[int, int]]:
    """Half-open ranges of a given width, or a given number of them; the last one is cut at the upper bound."""
    if lower > upper:
        raise ValueError(f"lower {lower} is above upper {upper}")
    if lower == upper:
        return [(lower, upper)]
    if parts is not None:
        step = -(-(upper - lower) // parts)
    step = step or STEP_ROWS
    return [(a, min(a + step, upper)) for a in range(lower, upper, step)]


def balanced_ranges(lower: int, upper: int, splits: list[int]) -> list[tuple[int, int]]:
    """Half-open ranges between the split keys that lie inside the bounds; together they are [lower, upper)."""
    if lower > upper:
        raise ValueError(f"lower {lower} is above upper {upper}")
    cuts = [lower, *sorted({int(s) for s in splits if lower < s < upper}), upper]
    return list(zip(cuts, cuts[1:]))


def timestamp_ranges(lower, upper, period: str = "hour") -> list[tuple[datetime, datetime]]:
    """Half-open hour or day windows, the last one cut at the upper bound."""
    lo, hi = to_datetime(lower), to_datetime(upper)
    if lo > hi:
        raise ValueError(f"lower {lo} is above upper {hi}")
    width = {"hour": timedelta(hours=1), "day": timedelta(days=1)}[period]
    out, at = [(lo, hi)] if lo == hi else [], lo
    while at < hi:
        out.append((at, min(at + width, hi)))
        at = out[-1][1]
    return out


def predicates(key: str, ranges: list[tuple]) -> list[str]:
    """One predicate for each range; equal bounds mean that single value."""
    return [f"{key} = {_text(a)}" if a == b else f"{key} >= {_text(a)} AND {key} < {_text(b)}" for a, b in ranges]


def _text(at) -> str:
    return f"'{at:%Y-%m-%d %H:%M:%S}'" if isinstance(at, datetime) else str(at)
