"""Arrays, maps and JSON text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.times import as_col


def payload_columns(df: DataFrame, keys: dict[str, str], payload: str = "payload") -> DataFrame:
    """Columns from a text map; a missing key gives NULL. ``keys`` is key -> SQL type."""
    return df.select("*", *[F.col(payload)[k].try_cast(t).alias(k) for k, t in keys.items()])


def payload_map(values: dict[str, object]) -> Column:
    """Row values as one text map."""
    pairs = [p for k, c in values.items() for p in (F.lit(k), as_col(c).cast("string"))]
    return F.create_map(*pairs)


def json_value(c, path: str) -> Column:
    """Scalar at a JSON path such as ``$.unit.id``."""
    return F.get_json_object(as_col(c), path)


def try_json_map(c) -> Column:
    """Flat JSON object as a text map; NULL for any other text.

    A nested value makes the whole object invalid, as it does in the source engine's cast; whether a value
    is nested is told by its type, not by its text.
    """
    c = as_col(c)
    parsed = F.try_parse_json(c)
    nested = F.exists(F.map_values(F.try_variant_get(parsed, "$", "map<string,variant>")),
                      lambda v: F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"))
    ok = F.schema_of_variant(parsed).startswith("OBJECT") & ~F.coalesce(nested, F.lit(False))
    return F.when(ok, F.from_json(c, "map<string,string>"))


def is_json(c) -> Column:
    """Does the text parse as JSON?"""
    return F.try_parse_json(as_col(c)).isNotNull()


def explode_list(df: DataFrame, col: str, out: str, sep: str | None = ",") -> DataFrame:
    """One row per list item; an empty or NULL list drops the row. ``sep=None``: already an array."""
    items = F.col(col) if sep is None else F.split(F.col(col), re.escape(sep))
    return df.withColumn(out, F.explode(items))


def explode_identities(df: DataFrame, identities: dict[str, object]) -> DataFrame:
    """One row per identifier that is present: (uid_key, uid_value)."""
    pairs = F.array(*[
        F.struct(F.lit(k).alias("uid_key"), as_col(c).cast("string").alias("uid_value"))
        for k, c in identities.items()
    ])
    present = F.filter(pairs, lambda p: p["uid_value"].isNotNull() & (p["uid_value"] != ""))
    return df.select("*", F.inline(present))


def key_numbers(c, prefix: str) -> Column:
    """Suffix texts of the map keys that start with ``prefix``."""
    keys = F.filter(F.map_keys(as_col(c)), lambda k: F.startswith(k, F.lit(prefix)))
    return F.transform(keys, lambda k: F.substr(k, F.lit(len(prefix) + 1)))


def zip_lists(names, urls, sep: str = ",") -> Column:
    """Two separated lists paired by position, one struct per URL."""
    name_items, url_items = (F.split(as_col(c), re.escape(sep)) for c in (names, urls))
    return F.transform(
        url_items,
        lambda u, i: F.struct(F.get(name_items, i).alias("name"), u.alias("image_url")),
    )


def infer_json_schema(df: DataFrame, col: str) -> str:
    """DDL of the union of all objects in a JSON text column: one distributed aggregate, one row back."""
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(col))).alias("s")).first()["s"]
    ddl = found.replace("OBJECT<", "STRUCT<")
    # A field seen only as NULL, or with clashing types, stays text.
    return re.sub(r"\b(VOID|VARIANT)\b", "STRING", ddl)


def shred_json(df: DataFrame, col: str, schema: str | None = None,
               defaults: dict[str, object] | None = None) -> DataFrame:
    """Rows whose text is a JSON object, expanded to columns; absent columns get a default."""
    good = df.filter(is_json(col) & (F.substring(F.trim(F.col(col)), 1, 1) == "{"))
    schema = schema or infer_json_schema(good, col)
    others = [c for c in df.columns if c != col]
    out = good.select(*others, F.from_json(F.col(col), schema).alias("__j")).select(*others, "__j.*")
    for name, value in (defaults or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value)) if name in out.columns
                             else F.lit(value))
    return out
