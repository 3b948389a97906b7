"""Change-stream images: structs of single-field typed wrappers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import try_whole
from tidemark.functions.times import epoch_to_ts


def flatten_change_image(df: DataFrame, mapping: dict[str, tuple], image: str = "newimage",
                         keep: list[str] = ()) -> DataFrame:
    """Typed columns from an image; ``mapping`` is name -> (path, kind[, default or JSON path]).

    Kinds: a SQL type (cast), ``epoch`` (seconds to timestamp), ``try_int`` (default when it does
    not cast), ``lower`` (text in lower case), ``json`` (a scalar inside JSON text).
    """
    return df.select(*keep, *[_field(image, *spec).alias(n) for n, spec in mapping.items()])


def _field(image: str, path: str, kind: str, extra=None) -> Column:
    raw = F.col(f"{image}.{path}")
    if kind == "epoch":
        return epoch_to_ts(raw.cast("bigint"))
    if kind == "try_int":
        return F.coalesce(try_whole(raw, "int"), F.lit(extra))
    if kind == "lower":
        return F.lower(raw)
    if kind == "json":
        return F.get_json_object(raw, extra)
    return raw.cast(kind)
