"""Numbering, lag and running sums over keys that may be hot.

A plain window puts a whole key into one task. Here one aggregate counts the rows of every key; keys that
hold more than one n-th of all rows (there are fewer than n of them, n being the number of shuffle
partitions and 64 at least) are cut into ranges of the first ordering column. The ranges' bounds are
approximate quantiles of the key's own rows, so uneven or odd values don't matter; equal values share a
range, and the ranges are disjoint and ordered, so results are exact whatever the bounds. The window runs
per (key, range), and what one range needs from the earlier ones (a count, a sum, a last value) is taken
from a summary with one row per (hot key, range). Without a hot key this is the plain window, and the
input is read twice: once for the counts, once for the window. ``bucket`` may be given as any column that
never decreases along the order, and then cuts every key; ``bucket=False`` uses the plain window, for
groups known to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F
from pyspark.sql import types as T

RANGES = 64
_B, _CUT = "__bucket", "__cut"


def order_columns(order: list) -> list[Column]:
    """Names, or (name, "asc" | "desc") pairs."""
    return [_direction(*_pair(o)) for o in order]


def _pair(o) -> tuple[str, str]:
    return (o, "asc") if isinstance(o, str) else o


def _direction(name: str, way: str) -> Column:
    return F.col(name).desc() if way == "desc" else F.col(name).asc()


def _as_number(kind: T.DataType, name: str) -> Column:
    """A number that never decreases along the column's order; texts by their first seven bytes."""
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    if isinstance(kind, T.BooleanType):
        return F.col(name).cast("int").cast("double")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        head = F.substring(F.col(name).cast("binary"), 1, 7)
        return F.conv(F.rpad(F.hex(head), 14, "0"), 16, 10).cast("double")
    return F.unix_micros(F.col(name).cast("timestamp")).cast("double")


def range_count(df: DataFrame) -> int:
    """How many parts rows are dealt into where no smaller number will do: the shuffle partitions, 64 at least."""
    return max(RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def bounds_of(df: DataFrame, part: list[str], name: str) -> list[tuple]:
    """(key values, inner bounds) of every hot key: fewer than n keys, with at most RANGES bounds each.

    Without key columns the whole frame is one key. Two actions: a count of every key that combines
    before the shuffle, and, if some key is hot, a quantile sketch of the hot keys' rows only.
    """
    n, x = range_count(df), _as_number(df.schema[name].dataType, name)
    grid = F.percentile_approx(x, [i / RANGES for i in range(1, RANGES)], F.lit(20 * RANGES)).alias("__q")
    if not part:
        found = df.agg(grid).first()["__q"]
        return [((), sorted(set(found)))] if found else []
    total = Observation()
    counts = df.groupBy(*part).agg(F.count("*").alias("__n")).observe(total, F.sum("__n").alias("n"))
    largest = counts.orderBy(F.desc("__n")).limit(n).collect()
    hot = [r for r in largest if r["__n"] * n > total.get["n"]] if largest else []
    if not hot:
        return []
    hit = _marked(df, part, [(tuple(r[k] for k in part), None) for r in hot]).filter(_CUT)
    return [(tuple(r[k] for k in part), sorted(set(r["__q"] or []))) for r in hit.groupBy(*part).agg(grid).collect()]


def value_range(df: DataFrame, name: str) -> Column:
    """Number of the range a value falls into, between approximate quantiles of the column."""
    found, x = bounds_of(df, [], name), _as_number(df.schema[name].dataType, name)
    bounds = F.lit(found[0][1] if found else []).cast("array<double>")
    return F.coalesce(F.size(F.filter(bounds, lambda b: b < x)), F.lit(0))


def _marked(df: DataFrame, part: list[str], found: list[tuple]) -> DataFrame:
    """Add whether a row's key is one of ``found``, and that key's bounds."""
    if not part:
        bounds = F.lit(found[0][1]) if found and found[0][1] else F.lit(None)
        return df.withColumns({_CUT: F.lit(True), "__bounds": bounds.cast("array<double>")})
    fields = [T.StructField(f"__h{i}", df.schema[k].dataType) for i, k in enumerate(part)]
    schema = T.StructType([*fields, T.StructField("__bounds", T.ArrayType(T.DoubleType())), T.StructField(_CUT, T.BooleanType())])
    hot = df.sparkSession.createDataFrame([(*key, bounds or [], True) for key, bounds in found], schema)
    same = F.lit(True)
    for i, k in enumerate(part):
        same = same & F.col(k).eqNullSafe(F.col(f"__h{i}"))
    joined = df.join(F.broadcast(hot), same, "left").drop(*[f"__h{i}" for i in range(len(part))])
    return joined.withColumn(_CUT, F.coalesce(F.col(_CUT), F.lit(False)))


def _grouped(df: DataFrame, part: list[str], order: list, bucket, source: DataFrame | None = None) -> DataFrame | None:
    """Add the columns of a row's (key, bucket) and whether its key is cut; None for a plain window.

    ``source`` names a frame with the same keys and values that is cheaper to count. Each key column
    becomes a filled value and a NULL flag. Plain equality then treats NULL as a key, as a window does,
    and the window, the summary and the join between them share one partitioning.
    """
    name, _ = _pair(order[0])
    if bucket is False:
        return None
    rows, cut = df, F.lit(True)
    if bucket is None:
        found = bounds_of(df if source is None else source, part, name)
        if not found:
            return None
        rows, cut = _marked(df, part, found), F.col(_CUT)
        x = _as_number(df.schema[name].dataType, name)
        below = F.size(F.filter("__bounds", lambda b: b < x))
        bucket = F.when(cut & x.isNotNull(), F.greatest(below, F.lit(0))).otherwise(F.lit(0))
    keys = {f"__g{i}": _filled(df, p) for i, p in enumerate(part)}
    flags = {f"__f{i}": F.isnull(p) for i, p in enumerate(part)}
    return rows.withColumns({_CUT: cut, _B: bucket} | keys | flags).drop("__bounds")


def _filled(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    for types, value in ((T.NumericType, 0), (T.StringType, ""), (T.BooleanType, False),
                         ((T.DateType, T.TimestampType, T.TimestampNTZType), "1970-01-01")):
        if isinstance(kind, types):
            return F.coalesce(F.col(name), F.lit(value).cast(kind))
    return F.struct(name)


def _key(part: list[str]) -> list[str]:
    return [f"__{c}{i}" for i in range(len(part)) for c in "gf"]


def _group(part: list[str]) -> list[str]:
    return [*_key(part), _B]


def _attach(rows: DataFrame, summary: DataFrame, part: list[str]) -> DataFrame:
    """Add a summary's columns to the rows of its group; keys that are not cut have none."""
    return rows.join(summary, _group(part), "left")


def _by_bucket(part: list[str], order: list):
    """Summary rows of one key, in the order of their buckets."""
    return Window.partitionBy(*_key(part)).orderBy(_direction(_B, _pair(order[0])[1]))


def _before(part: list[str], order: list):
    return _by_bucket(part, order).rowsBetween(Window.unboundedPreceding, -1)


def running_sum(df: DataFrame, col: str, part: list[str], order: list, out: str,
                bucket=None) -> DataFrame:
    """Sum of all rows of the key up to and including this one."""
    return running_sums(df, col, {out: part}, order, bucket)


def running_sums(df: DataFrame, col: str, grains: dict[str, list[str]], order: list,
                 bucket=None) -> DataFrame:
    """Several running sums of one measure; ``grains`` is output name -> key columns.

    Every grain's offsets come from the input itself, so more grains do not nest.
    """
    result = df
    for out, part in grains.items():
        grouped = _grouped(df, part, order, bucket)
        if grouped is None:
            upto = Window.partitionBy(*part).orderBy(*order_columns(order)).rowsBetween(
                Window.unboundedPreceding, Window.currentRow)
            result = result.withColumn(out, F.sum(col).over(upto))
            continue
        upto = Window.partitionBy(*_group(part)).orderBy(*order_columns(order)).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        source = grouped if result is df else _grouped(result, part, order, bucket, df)
        rows = source.withColumn(out, F.sum(col).over(upto))
        totals = grouped.filter(_CUT).groupBy(*_group(part)).agg(F.sum(col).alias("__total"))
        offsets = totals.select(*_group(part), F.sum("__total").over(_before(part, order)).alias("__offset"))
        both = F.coalesce(F.col(out), F.lit(0)) + F.coalesce(F.col("__offset"), F.lit(0))
        known = F.col(out).isNotNull() | F.col("__offset").isNotNull()
        result = _attach(rows, offsets, part).withColumn(out, F.when(known, both)).drop("__offset", *_group(part), _CUT)
    return result


def add_row_number(df: DataFrame, part: list[str], order: list, out: str = "row_num",
                   bucket=None) -> DataFrame:
    return _number(df, part, order, out, bucket, F.row_number())


def add_rank(df: DataFrame, part: list[str], order: list, out: str = "rank", bucket=None) -> DataFrame:
    """Ties share a rank and leave a gap; equal order values always share a bucket."""
    return _number(df, part, order, out, bucket, F.rank())


def _number(df, part, order, out, bucket, function) -> DataFrame:
    grouped = _grouped(df, part, order, bucket)
    if grouped is None:
        return df.withColumn(out, function.over(Window.partitionBy(*part).orderBy(*order_columns(order))))
    rows = grouped.withColumn(out, function.over(Window.partitionBy(*_group(part)).orderBy(*order_columns(order))))
    counts = grouped.filter(_CUT).groupBy(*_group(part)).agg(F.count("*").alias("__n"))
    offsets = counts.select(*_group(part), F.sum("__n").over(_before(part, order)).alias("__offset"))
    total = F.col(out) + F.coalesce(F.col("__offset"), F.lit(0))
    return _attach(rows, offsets, part).withColumn(out, total.cast("bigint")).drop("__offset", *_group(part), _CUT)


def add_lag(df: DataFrame, col: str, part: list[str], order: list, out: str, bucket=None) -> DataFrame:
    """Previous row's value; the first row of a bucket takes the last one of the bucket before."""
    grouped = _grouped(df, part, order, bucket)
    if grouped is None:
        return df.withColumn(out, F.lag(col).over(Window.partitionBy(*part).orderBy(*order_columns(order))))
    window = Window.partitionBy(*_group(part)).orderBy(*order_columns(order))
    rows = grouped.withColumns({out: F.lag(col).over(window), "__n": F.row_number().over(window)})
    last = rows.filter(_CUT).groupBy(*_group(part)).agg(F.max_by(F.struct(col), "__n").alias("__last"))
    heads = last.select(*_group(part), F.lag("__last").over(_by_bucket(part, order)).alias("__head"))
    value = F.when(F.col("__n") == 1, F.col(f"__head.{col}")).otherwise(F.col(out))
    return _attach(rows, heads, part).withColumn(out, value).drop("__head", "__n", *_group(part), _CUT)


def carry_last(df: DataFrame, col: str, part: list[str], order: list, out: str, bucket=None) -> DataFrame:
    """Last value that isn't NULL, up to and including this row; a range without one takes that of the ranges before."""
    grouped = _grouped(df, part, order, bucket)
    if grouped is None:
        upto = Window.partitionBy(*part).orderBy(*order_columns(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.last(col, ignorenulls=True).over(upto))
    window = Window.partitionBy(*_group(part)).orderBy(*order_columns(order))
    rows = grouped.withColumns({out: F.last(col, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0)),
                                "__n": F.row_number().over(window)})
    at = F.when(F.col(col).isNotNull(), F.col("__n"))
    last = rows.filter(_CUT).groupBy(*_group(part)).agg(F.max_by(F.col(col), at).alias("__last"))
    heads = last.select(*_group(part), F.last("__last", ignorenulls=True).over(_before(part, order)).alias("__head"))
    return _attach(rows, heads, part).withColumn(out, F.coalesce(out, "__head")).drop("__head", "__n", *_group(part), _CUT)


def sessionize(df: DataFrame, keys: list[str], col: str, gap_seconds: int, out: str = "session_id",
               bucket=None, source: DataFrame | None = None) -> DataFrame:
    """Number sessions per key; a gap of exactly ``gap_seconds`` stays in one session.

    Whole seconds are compared. The summary has one row per hot key and time range.
    """
    def opens(previous: Column, current: Column) -> Column:
        gap = _second(current) - _second(previous)
        return F.when(previous.isNull(), 1).when(gap > gap_seconds, 1).otherwise(0)

    order = [col]
    grouped = _grouped(df, keys, order, F.lit(0) if bucket is False else bucket, source)
    if grouped is None:
        grouped = _grouped(df, keys, order, F.lit(0))
        grouped = grouped.withColumn(_CUT, F.lit(False))
    window = Window.partitionBy(*_group(keys)).orderBy(col)
    previous = F.lag(col).over(window)
    marked = grouped.withColumn("__new", F.when(previous.isNull(), 0).otherwise(opens(previous, F.col(col))))
    numbered = marked.withColumn(
        "__local", F.sum("__new").over(window.rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.filter(_CUT).groupBy(*_group(keys)).agg(
        F.min(col).alias("__first"), F.max(col).alias("__last"), F.max("__local").alias("__more"))
    heads = spans.withColumn("__head", opens(F.lag("__last").over(_by_bucket(keys, order)), F.col("__first")))
    earlier = F.sum(F.col("__more") + F.col("__head")).over(_before(keys, order))
    offsets = heads.select(*_group(keys), (F.coalesce(earlier, F.lit(0)) + F.col("__head")).alias("__offset"))
    number = F.coalesce(F.col("__offset"), F.lit(1)) + F.col("__local")
    return _attach(numbered, offsets, keys).withColumn(out, number.cast("bigint")).drop(
        "__offset", "__local", "__new", *_group(keys), _CUT)


def _second(c: Column) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.date_trunc("second", c))


def first_last_per_key(df: DataFrame, part: list[str], cols: list[str], order: list[str]) -> DataFrame:
    """First and last values of each key in a stated order, as a map-side combined aggregate."""
    values, rank = F.struct(*cols), F.struct(*order)
    ends = df.groupBy(*part).agg(F.min_by(values, rank).alias("__f"), F.max_by(values, rank).alias("__l"))
    return ends.select(*part, *[F.col(f"__f.{c}").alias(f"first_{c}") for c in cols],
                       *[F.col(f"__l.{c}").alias(f"last_{c}") for c in cols])


# Top-k: the rank filter becomes a group limit that runs before the shuffle, so a hot key sends at
# most k rows (plus ties) per task.

def top_n(df: DataFrame, part: list[str], order: list, n: int, ties: str = "drop") -> DataFrame:
    function = {"drop": F.row_number, "keep": F.rank}[ties]()
    window = Window.partitionBy(*part).orderBy(*order_columns(order))
    return df.withColumn("__r", function.over(window)).filter(F.col("__r") <= n).drop("__r")


def last_n(df: DataFrame, part: list[str], order: list[str], n: int, ties: str = "keep") -> DataFrame:
    """Newest n rows of each key; kept ties may exceed n."""
    return top_n(df, part, [(o, "desc") for o in order], n, ties)


def sample_per_group(df: DataFrame, part: list[str], id_col: str, n: int, seed: int) -> DataFrame:
    """n random rows of each group; hashing the id with the seed makes a rerun give the same rows."""
    drawn = df.withColumn("__h", F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}"))))
    return top_n(drawn, part, ["__h", id_col], n).drop("__h")
