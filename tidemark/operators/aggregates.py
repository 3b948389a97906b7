"""Aggregations. All of them combine before the shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def aggregate(df: DataFrame, keys: list, aggs: dict[str, Column]) -> DataFrame:
    cols = [c.alias(n) for n, c in aggs.items()]
    return df.groupBy(*keys).agg(*cols) if keys else df.agg(*cols)


def distinct_counts(df: DataFrame, keys: list, cols: dict[str, str], rows: str | None = None) -> DataFrame:
    """Several distinct counts and, if named, the plain count in one pass."""
    aggs = {n: F.count_distinct(c) for n, c in cols.items()}
    return aggregate(df, keys, aggs | ({rows: F.count("*")} if rows else {}))


def conditional_agg(df: DataFrame, keys: list, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Sum of a value over the rows that pass a condition, 0 for the others."""
    return aggregate(df, keys, {n: F.sum(F.when(c, v).otherwise(0)) for n, (c, v) in rules.items()})


def any_per_key(df: DataFrame, keys: list[str], cols: list[str], order: list[str] | None = None) -> DataFrame:
    """Any one value of each column; with an order, the values of the greatest row."""
    if order:
        best = df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("__b"))
        return best.select(*keys, *[F.col(f"__b.{c}").alias(c) for c in cols])
    return df.groupBy(*keys).agg(*[F.any_value(c).alias(c) for c in cols])


def item_list(df: DataFrame, keys: list[str], col: str, order: list | None = None, out: str = "item",
              position: str = "position", count: str = "n") -> DataFrame:
    """Items of each group in long form: key, position in a stated order, item, and the group's count.

    One shape for groups of any size: nothing is gathered into a cell, and a hot group is split where
    its items meet their count. A group that holds only NULLs keeps one row, without position and item
    and with count 0.
    """
    from tidemark.operators.joins import dealt_anew
    from tidemark.operators.ordered import add_row_number
    sizes = df.groupBy(*keys).agg(F.count(col).alias(count))
    items = df.filter(F.col(col).isNotNull())
    placed = add_row_number(items, keys, order or [col], "__at").select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__at").cast("bigint").alias(position), F.col(col).alias(out))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    listed = placed.join(dealt_anew(sizes.filter(F.col(count) > 0)), same).select(*keys, position, out, count)
    nothing = [F.lit(None).cast(listed.schema[c].dataType).alias(c) for c in (position, out)]
    return listed.unionByName(sizes.filter(F.col(count) == 0).select(*keys, *nothing, count))


def item_lists(df: DataFrame, keys: list[str], cols: dict[str, str], order: list, count: str = "n") -> DataFrame:
    """Several columns of whole groups in the long form of ``item_list``, in the same row order."""
    rows = df.withColumn("__row", F.struct(*[F.col(c).alias(name) for name, c in cols.items()]))
    listed = item_list(rows, keys, "__row", order, out="__row", count=count)
    return listed.select(*keys, "position", *[F.col(f"__row.{name}").alias(name) for name in cols], count)


def joined_top(df: DataFrame, keys: list[str], col: str, sep: str, out: str, count: str, n: int,
               order: list | None = None) -> DataFrame:
    """The first n items of each group as one separated text, and how many they are."""
    from tidemark.operators.ordered import add_row_number, top_n
    order = order or [col]
    best = top_n(df.filter(F.col(col).isNotNull()), keys, order, n)
    placed = add_row_number(best, keys, order, "__at", bucket=False)
    items = F.array_sort(F.collect_list(F.struct("__at", F.col(col).cast("string").alias("item"))))
    return placed.groupBy(*keys).agg(F.array_join(F.transform(items, lambda x: x["item"]), sep).alias(out), F.count("*").alias(count))


def pivot_last(df: DataFrame, keys: list[str], k: str, v: str, values: dict[str, str],
               agg=F.max) -> DataFrame:
    """One column per listed key, the same work as map-then-subscript without building a map."""
    return df.groupBy(*keys).agg(*[agg(F.when(F.col(k) == value, F.col(v))).alias(name)
                                   for name, value in values.items()])


def distinct_list(df: DataFrame, keys: list[str], col: str, out: str = "item") -> DataFrame:
    """Distinct values of each group in long form, numbered in order, with their count."""
    return item_list(df.select(*keys, col).distinct(), keys, col, out=out)


def first_distinct(df: DataFrame, keys: list[str], col: str, sep: str, out: str, n: int = 100) -> DataFrame:
    """The first n distinct values of each group, sorted and joined."""
    unique = df.select(*keys, col).distinct()
    return joined_top(unique, keys, col, sep, out, "__n", n).drop("__n")


def joined_distinct(df: DataFrame, keys: list[str], col: str, sep: str, out: str) -> DataFrame:
    """All distinct values of each group, sorted and joined; for columns of few values, such as types."""
    unique = df.filter(F.col(col).isNotNull()).select(*keys, col).distinct()
    items = F.array_sort(F.collect_list(col))
    return unique.groupBy(*keys).agg(F.array_join(F.transform(items, lambda x: x.cast("string")), sep).alias(out))


def find_duplicates(df: DataFrame, keys: list[str], out: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(out)).filter(F.col(out) > 1)


def merge_measures(sources: list[tuple[DataFrame, dict[str, Column]]], keys: list[str]) -> DataFrame:
    """Sum measures of several sources per key; a source without a measure contributes 0."""
    names = list(dict.fromkeys(n for _, m in sources for n in m))
    parts = [df.select(*keys, *[m.get(n, F.lit(0)).alias(n) for n in names]) for df, m in sources]
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    return rows.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def scalar(df: DataFrame, agg: Column, out: str = "result") -> DataFrame:
    return df.agg(agg.alias(out))


def explode_split_measure(df: DataFrame, list_col: str, item: str, measure: str, out: str) -> DataFrame:
    """One row per list item, the measure shared equally among them."""
    share = F.col(measure) / F.size(list_col)
    return df.withColumn(out, share).withColumn(item, F.explode(list_col))


def max_value(df: DataFrame, col: str, out: str = "max_value") -> DataFrame:
    """Largest value: an aggregate instead of a sort with LIMIT 1."""
    return df.agg(F.max(col).alias(out))


def sort(df: DataFrame, cols: list) -> DataFrame:
    return df.orderBy(*cols)
