"""Join shapes.

No side is forced into a broadcast: Spark broadcasts a side when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and splits hot keys of the streamed side otherwise.

Adaptive execution splits a hot key only if each side of the join has a shuffle of its own for it. An
aggregate by the join key has none: its output already lies by that key. ``dealt_anew`` gives it one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.times import as_col, shift_ts, ts
from tidemark.operators.ordered import carry_last, range_count


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    return fact.join(dim, on, how)


def join_filtered_dim(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, keep: Column,
                      values: dict[str, str], how: str = "left") -> DataFrame:
    """Join only the dimension rows that pass ``keep``; ``values`` is output name -> dimension column."""
    small = dim.filter(keep).select(F.col(dim_key).alias("__k"),
                                    *[F.col(c).alias(n) for n, c in values.items()])
    return fact.join(small, F.col(fact_key) == F.col("__k"), how).drop("__k")


def enrich(fact: DataFrame, dims: list[tuple]) -> DataFrame:
    """Left joins of several dimensions; a dimension may appear more than once, under other names.

    Each entry is (dimension, dimension key, fact key, {output name: dimension column}).
    """
    for dim, dim_key, fact_key, values in dims:
        fact = join_filtered_dim(fact, dim, fact_key, dim_key, F.lit(True), values)
    return fact


def dealt_anew(grouped: DataFrame) -> DataFrame:
    """An aggregate in balanced partitions, for the side of a join that meets rows with hot keys.

    The rows moved once more are those of the aggregate; the hot side moves once, in as many tasks as it needs.
    """
    return grouped.hint("rebalance")


def anti_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left rows without a match. Right keys are made distinct, and hot or NULL left keys are split."""
    return left.join(dealt_anew(right.select(*keys).distinct()), list(keys), "left_anti")


def semi_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left rows with a match, in the same way."""
    return left.join(dealt_anew(right.select(*keys).distinct()), list(keys), "left_semi")


def not_in(left: DataFrame, right: DataFrame, col: str, right_col: str | None = None) -> DataFrame:
    """NOT IN with SQL's NULL rules, as an ordinary anti join.

    The built-in null-aware form must broadcast the right side whatever its size; here the two facts
    it depends on (is the right side empty, does it hold a NULL) come from a one-row aggregate.
    """
    r = F.col(right_col or col)
    # One shuffle of the right side serves both: its distinct keys, NULL among them.
    keys = right.groupBy(r.alias(col)).agg(F.lit(1).alias("__one"))
    facts = keys.agg(F.struct(F.count("*").alias("rows"), F.count_if(F.col(col).isNull()).alias("nulls"))).scalar()
    rows, nulls = F.lit(facts)["rows"], F.lit(facts)["nulls"]
    keys = dealt_anew(keys.drop("__one"))
    allowed = (rows == 0) | ((nulls == 0) & F.col(col).isNotNull())
    return left.join(keys, [col], "left_anti").filter(allowed)


def full_outer_coalesce(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Chained full outer joins with merged keys; every frame holds at most one row per key."""
    return reduce(lambda a, b: a.join(b, list(keys), "full"), frames)


def cross_scalar(df: DataFrame, one_row: DataFrame, out: str) -> DataFrame:
    """Add the single value of a one-row frame to every row (a scalar subquery, not a cross join)."""
    return df.withColumn(out, one_row.scalar())


def range_join(left: DataFrame, right: DataFrame, on: list[str], residual: Column,
               how: str = "inner") -> DataFrame:
    """Equality keys decide the partitioning, the inequality is tested on the matches.

    Alias the inputs "l" and "r" in ``residual``.
    """
    l, r = left.alias("l"), right.alias("r")
    equal = reduce(lambda a, b: a & b, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in on])
    return l.join(r, equal & residual, how)


def attribute(events: DataFrame, causes: DataFrame, key: str, event_ts: str, cause_ts: str,
              within: tuple[int, str]) -> DataFrame:
    """Events that happened before ``within`` had passed since their cause; causes are unique by key."""
    c = causes.withColumnRenamed(key, "__k")
    limit = shift_ts(cause_ts, *within)
    return events.join(c, (F.col(key) == F.col("__k")) & (F.col(event_ts) < limit)).drop("__k")


def attribute_last(effects: DataFrame, causes: DataFrame, keys: list[str], effect_ts: str, cause_ts: str, values: dict[str, str],
                   within: tuple[int, str], how: str = "left") -> DataFrame:
    """Every effect with the last cause of its key at or before it; causes may repeat, and no pairs are formed.

    Causes and effects are united and each effect takes the last cause carried along its key, so work and
    rows grow with both sides' sum and a hot key is cut into time ranges. ``values`` is output name -> cause
    column; the cause counts if the effect came before ``within`` had passed since it, else the values are NULL
    (``how="left"``) or the effect goes (``"inner"``). Of causes at the same time the one with the largest
    values counts, compared in their order. NULL keys and times match nothing. Both sides name the keys alike.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how {how!r} is not left or inner")
    cause = F.struct(F.col(cause_ts).alias("at"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(values.values())])
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*keys, cause_ts]])
    c = causes.filter(known).select(*keys, F.col(cause_ts).alias("__at"), F.lit(False).alias("__effect"), cause.alias("__cause"))
    e = effects.withColumns({"__at": F.col(effect_ts), "__effect": F.lit(True)})
    both = e.unionByName(c, allowMissingColumns=True)
    found = carry_last(both, "__cause", keys, ["__at", "__effect", "__cause"], "__found").filter("__effect")
    hit = F.col(effect_ts) < shift_ts("__found.at", *within)
    out = {name: F.when(hit, F.col(f"__found.v{i}")) for i, name in enumerate(values)}
    kept = found.filter(hit) if how == "inner" else found
    return kept.select(*effects.columns, *[c.alias(name) for name, c in out.items()])


def lookback_join(causes: DataFrame, effects: DataFrame, cause_key: str, effect_key: str, cause_ts: str,
                  effect_ts: str, start, end, back: tuple[int, str], shift: tuple[int, str]) -> DataFrame:
    """Effects of the shifted window with their cause from up to ``back`` earlier.

    Both sides carry their own time bounds, so both scans prune.
    """
    upper = shift_ts(ts(end), -shift[0], shift[1])
    c = causes.filter((F.col(cause_ts) >= shift_ts(ts(start), -back[0], back[1])) & (F.col(cause_ts) < upper))
    e = effects.filter((F.col(effect_ts) >= shift_ts(ts(start), -shift[0], shift[1])) & (F.col(effect_ts) < upper))
    return c.join(e, F.col(cause_key) == F.col(effect_key))


def offset_join(fact: DataFrame, dim_hi: DataFrame, dim_lo: DataFrame, id_col: str, dim_key: str,
                values: list[str], offset: int = 10**9) -> DataFrame:
    """Ids above the offset belong to one dimension (less the offset), the others to a second one.

    Each value comes from the low dimension first, then from the high one.
    """
    lo = dim_lo.select(F.col(dim_key).alias("__lo"), *[F.col(v).alias(f"__lo_{v}") for v in values])
    hi = dim_hi.select(F.col(dim_key).alias("__hi"), *[F.col(v).alias(f"__hi_{v}") for v in values])
    i = F.col(id_col)
    keyed = fact.withColumns({"__kl": F.when(i <= offset, i), "__kh": F.when(i > offset, i - offset)})
    joined = (keyed.join(lo, F.col("__kl") == F.col("__lo"), "left")
              .join(hi, F.col("__kh") == F.col("__hi"), "left"))
    return joined.select(*fact.columns,
                         *[F.coalesce(f"__lo_{v}", f"__hi_{v}").alias(v) for v in values])


def join_blank_as_null(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys where NULL and '' are the same value."""
    marked = [f"__b{i}" for i in range(len(keys))]
    blank = {m: F.coalesce(F.col(k), F.lit("")) for m, k in zip(marked, keys)}
    l, r = left.withColumns(blank), right.withColumns(blank).drop(*keys)
    return l.join(r, marked, how).drop(*marked)


def fallback_join(fact: DataFrame, dim: DataFrame, keys: list[str], exact: str, wildcard: str) -> DataFrame:
    """Match on keys and ``exact``; facts without such a match take the dimension's wildcard rows.

    Keys compare NULL and '' as equal. Whether an exact match exists is looked up first, and a single
    join then uses either the fact's own value or the wildcard. The dimension's own column is
    returned as ``dim_<exact>``.

    Rows come once: both sides are made distinct before the join, after which its rows, of which there can be
    as many as the product of both sides' rows of a key, differ by themselves and are neither kept nor shuffled.
    A key with more than its share of that product is cut into parts: its facts are dealt over them, and each
    part has the key's dimension rows.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    blank = {m: F.coalesce(F.col(k), F.lit("")) if _is_text(dim, k) else F.col(k) for m, k in zip(names, keys)}
    d = dim.withColumns(blank).drop(*keys).withColumnRenamed(exact, f"dim_{exact}")
    fact, d = fact.distinct(), d.distinct()
    known = d.select(*names, F.col(f"dim_{exact}").alias("__x")).distinct()
    found = fact.withColumns(blank | {"__x": F.col(exact)}).join(
        known.withColumn("__hit", F.lit(True)), [*names, "__x"], "left")
    pick = F.when(F.col("__hit"), F.col("__x")).otherwise(F.lit(wildcard))
    rows = found.withColumn("__pick", pick).drop("__x", "__hit")
    out = [c for c in d.columns if c not in names]
    rows, d = _in_parts(rows, d.withColumn("__pick", F.col(f"dim_{exact}")), [*names, "__pick"], fact.columns)
    joined = rows.alias("f").join(d.alias("d"), F.col("f.__key") == F.col("d.__key"))
    return joined.select(*[F.col(f"f.{c}") for c in fact.columns], *[F.col(f"d.{c}") for c in out])


PARTS = 4


def _in_parts(left: DataFrame, right: DataFrame, keys: list[str], by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``__key`` (keys and part), dealt by it so that every task gets about as many joined rows.

    ``PARTS`` times as many parts as tasks share the joined rows. Keys with less than a part's share have one
    part; the others, fewer than there are parts, are broadcast with their number of parts. Rows of the left
    are dealt over a key's parts by a hash of the columns ``by``; rows of the right go to each of them. Rows
    with a NULL key match nothing and go. One column holds the key, as Spark drops constant ones from the
    join, deals the rows again and merges tasks by their few bytes.
    """
    n = range_count(left)
    left, right = left.dropna(subset=keys), right.dropna(subset=keys)
    counts = [df.groupBy(*keys).agg(F.count("*").cast("double").alias(c)) for df, c in ((left, "__l"), (right, "__r"))]
    load = counts[0].join(counts[1], keys).withColumn("__load", F.col("__l") * F.col("__r"))
    total = load.agg(F.sum("__load").alias("__total"))
    parts = F.ceil(F.least(F.col("__load") * PARTS * n / F.col("__total"), "__l")).cast("int")
    hot = F.broadcast(load.crossJoin(F.broadcast(total)).select(*keys, parts.alias("__parts")).filter("__parts > 1"))
    left, right = [df.join(hot, keys, "left").withColumn("__parts", F.coalesce("__parts", F.lit(1))) for df in (left, right)]
    left = left.withColumn("__part", F.pmod(F.xxhash64(*by), "__parts").cast("int"))
    right = right.withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    return tuple(df.withColumn("__key", F.struct(*keys, "__part")).repartition(n, "__key") for df in (left, right))


def _is_text(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() == "string"


def resolve_identity(df: DataFrame, identity: DataFrame, id_col: str, profile: str = "profile_id") -> DataFrame:
    """Profile of a ``kind:value`` identifier; rows without one stay, with NULL."""
    from tidemark.functions.text import split_part_or_null
    keyed = df.withColumns({"__field": F.upper(split_part_or_null(id_col, ":", 1)),
                            "__value": split_part_or_null(id_col, ":", 2)})
    ids = identity.select(F.col("field").alias("__f"), F.col("value").alias("__v"), profile)
    on = (F.col("__field") == F.col("__f")) & (F.col("__value") == F.col("__v"))
    return keyed.join(ids, on, "left").drop("__field", "__value", "__f", "__v")


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def enrich_profiles(events: DataFrame, identity: DataFrame, id_keys: list[str], columns: list[str],
                    payload: str = "payload") -> DataFrame:
    """Event batch with profile ids: identifiers from the payload, '' when missing, keyed join.

    The first identifier in ``id_keys`` that resolves gives the profile. Identity rows are
    (uid_key, uid_value, profile_id), unique by key and value.
    """
    found = []
    out = events
    for i, key in enumerate(id_keys):
        ids = identity.filter(F.col("uid_key") == key).select(
            F.col("uid_value").alias(f"__v{i}"), F.col("profile_id").alias(f"__p{i}"))
        value = F.coalesce(F.col(payload)[key], F.lit(""))
        out = out.withColumn(key, value).join(ids, F.col(key) == F.col(f"__v{i}"), "left").drop(f"__v{i}")
        found.append(F.col(f"__p{i}"))
    out = out.withColumn("profile_id", F.coalesce(*found))
    return out.select(*columns)


def bounded(c, start, end) -> Column:
    """Half-open time bounds on one side of a join."""
    return (as_col(c) >= ts(start)) & (as_col(c) < ts(end))
