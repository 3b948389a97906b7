"""Data checks. Each returns one row: name, lhs, op, threshold, passed."""

from __future__ import annotations

import operator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.slots import between_half_open

OPERATORS = {"eq": operator.eq, "ge": operator.ge, "gt": operator.gt, "le": operator.le, "lt": operator.lt}


def check_linear(name: str, x1: DataFrame, op: str, threshold: float, x2: DataFrame | None = None,
                 a: float = 1, b: float = 1, null_as_zero: bool = True) -> DataFrame:
    """a * x1 + b * x2 (op) threshold, on one-row frames with one column.

    More than one row is an error; a NULL is 0, or an error when ``null_as_zero`` is off.
    """
    if op not in OPERATORS:
        raise ValueError(f"operator {op!r} is not one of {sorted(OPERATORS)}")
    spark = x1.sparkSession
    left = _number(x1, null_as_zero)
    right = _number(x2, null_as_zero) if x2 is not None else F.lit(0.0)
    row = spark.range(1).select(F.lit(name).alias("name"),
                                (left * float(a) + right * float(b)).alias("lhs"),
                                F.lit(op).alias("op"), F.lit(float(threshold)).alias("threshold"))
    return row.withColumn("passed", OPERATORS[op](F.col("lhs"), F.col("threshold")))


def _number(one_row: DataFrame, null_as_zero: bool) -> Column:
    value = one_row.scalar().cast("double")
    missing = F.lit(0.0) if null_as_zero else F.raise_error(F.lit("the check's query gave no result")).cast("double")
    return F.coalesce(value, missing)


def check_exists(name: str, df: DataFrame, pred: Column) -> DataFrame:
    return check_linear(name, df.agg(F.count_if(pred)), "gt", 0)


def check_trend(name: str, df: DataFrame, col: str, start, end, before_start, before_end,
                ratio: float = 0.9) -> DataFrame:
    """Rows of the window are at least ``ratio`` times those of the window before; one pass."""
    counts = df.agg((F.count_if(between_half_open(col, start, end))
                     - F.count_if(between_half_open(col, before_start, before_end)) * F.lit(float(ratio))))
    return check_linear(name, counts, "ge", 0)


def check_reconcile(name: str, left: DataFrame, right: DataFrame, left_value: Column,
                    right_value: Column) -> DataFrame:
    """Both stores hold the same total."""
    return check_linear(name, left.agg(left_value), "eq", 0, right.agg(right_value), 1, -1)


def check_dedup(name: str, source: DataFrame, output: DataFrame, keys: list[str]) -> DataFrame:
    """No source key is lost and no output key is duplicated: one shuffle of both, counted by key.

    A key with a NULL equals none, so such source rows count as lost.
    """
    tagged = source.select(*keys, F.lit(1).alias("__s"), F.lit(0).alias("__o")).unionByName(
        output.select(*keys, F.lit(0).alias("__s"), F.lit(1).alias("__o")))
    found = tagged.groupBy(*keys).agg(F.sum("__s").alias("__s"), F.sum("__o").alias("__o"))
    unmatched = F.lit(False)
    for k in keys:
        unmatched = unmatched | F.col(k).isNull()
    lost = F.when((F.col("__o") == 0) | unmatched, F.col("__s")).otherwise(0)
    doubled = F.when(F.col("__o") > 1, F.col("__o")).otherwise(0)
    return check_linear(name, found.agg(F.sum(lost + doubled)), "eq", 0)


def check_hours(name: str, df: DataFrame, col: str, hours: int = 24) -> DataFrame:
    """Every hour of the day is present."""
    return check_linear(name, df.agg(F.count_distinct(F.date_trunc("hour", F.col(col)))), "eq", hours)


@dataclass(frozen=True)
class Check:
    """a * x1 + b * x2 (op) threshold. Each measure is a frame and an aggregate over it."""
    name: str
    x1: tuple[DataFrame, Column]
    op: str
    threshold: float = 0
    x2: tuple[DataFrame, Column] | None = None
    a: float = 1
    b: float = 1
    null_as_zero: bool = True

    def __post_init__(self):
        if self.op not in OPERATORS:
            raise ValueError(f"operator {self.op!r} is not one of {sorted(OPERATORS)}")


def exists(name: str, df: DataFrame, pred: Column) -> Check:
    return Check(name, (df, F.count_if(pred)), "gt")


def trend(name: str, df: DataFrame, col: str, start, end, before_start, before_end, ratio: float = 0.9) -> Check:
    counts = F.count_if(between_half_open(col, start, end)) - F.count_if(between_half_open(col, before_start, before_end)) * F.lit(float(ratio))
    return Check(name, (df, counts), "ge")


def reconcile(name: str, left: DataFrame, right: DataFrame, left_value: Column, right_value: Column) -> Check:
    return Check(name, (left, left_value), "eq", 0, (right, right_value), 1, -1)


def hours(name: str, df: DataFrame, col: str, start, end, wanted: int = 24) -> Check:
    """Every hour of the window is present; the window is a condition of the aggregate, so other checks share the scan."""
    hour = F.when(between_half_open(col, start, end), F.date_trunc("hour", F.col(col)))
    return Check(name, (df, F.count_distinct(hour)), "eq", wanted)


def check_all(spark: SparkSession, checks: list[Check]) -> DataFrame:
    """The results of many checks, a row each: all measures of one source are one aggregate over one scan.

    Frames that mean the same plan are one source, so give windows and filters as conditions of the
    aggregates. Each source becomes one row of as many values as it has measures, and only these rows meet.
    A missing value is 0, or an error where ``null_as_zero`` is off. Distinct counts expand the rows of their
    source once for each such measure, before a partial aggregate.
    """
    sources: list[tuple[DataFrame, list[Column]]] = []

    def place(measure: tuple[DataFrame, Column]) -> tuple[int, int]:
        df, value = measure
        at = next((i for i, (known, _) in enumerate(sources) if known is df or known.sameSemantics(df)), len(sources))
        if at == len(sources):
            sources.append((df, []))
        sources[at][1].append(value.cast("double"))
        return at, len(sources[at][1]) - 1

    placed = [(place(c.x1), place(c.x2) if c.x2 else None) for c in checks]
    facts = [df.agg(*[v.alias(f"m{i}") for i, v in enumerate(values)]).select(F.struct("*")).scalar() for df, values in sources]
    row = spark.range(1).select(*[F.lit(f).alias(f"s{i}") for i, f in enumerate(facts)])

    def value(at: tuple[int, int] | None, check: Check) -> Column:
        if at is None:
            return F.lit(0.0)
        missing = F.lit(0.0) if check.null_as_zero else F.raise_error(F.lit(f"check {check.name}: no result")).cast("double")
        return F.coalesce(F.col(f"s{at[0]}.m{at[1]}"), missing)

    results = []
    for check, (first, second) in zip(checks, placed):
        lhs = value(first, check) * float(check.a) + value(second, check) * float(check.b)
        results.append(F.struct(F.lit(check.name).alias("name"), lhs.alias("lhs"), F.lit(check.op).alias("op"),
                                F.lit(float(check.threshold)).alias("threshold"),
                                OPERATORS[check.op](lhs, F.lit(float(check.threshold))).alias("passed")))
    return row.select(F.inline(F.array(*results)))


def guard(value, op: str, threshold) -> None:
    """Raise when the comparison holds (the opposite sense of a check)."""
    if OPERATORS[op](value, threshold):
        raise ValueError(f"{value} {op} {threshold}")


def require(checks: DataFrame) -> None:
    """Raise when any check failed; a handful of rows come to the driver."""
    failed = [r["name"] for r in checks.filter(~F.col("passed")).collect()]
    if failed:
        raise ValueError(f"failed checks: {failed}")
