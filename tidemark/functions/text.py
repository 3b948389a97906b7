"""Text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from tidemark.functions.times import as_col


def split_part_or_null(c, sep: str, i: int) -> Column:
    """The i-th part (from 1); NULL, not '', when there are fewer parts."""
    return F.try_element_at(F.split(as_col(c), re.escape(sep)), F.lit(i))


def right(c, n: int) -> Column:
    """Last n characters."""
    return F.right(as_col(c), F.lit(n))


def csv_record(*cols, sep: str = ",") -> Column:
    """One separated record; a NULL field becomes '' so that positions never shift."""
    return F.concat_ws(sep, *[F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols])


def hash_bucket(c, n: int = 100) -> Column:
    """Stable A/B bucket from CRC32."""
    return F.pmod(F.crc32(as_col(c).cast("binary")), F.lit(n)).cast("int")


def url_param(c, name: str) -> Column:
    """Decoded value of one query parameter; NULL when absent or the URL is malformed."""
    return F.try_url_decode(F.try_parse_url(as_col(c), F.lit("QUERY"), F.lit(name)))


def try_whole(c, kind: str = "bigint") -> Column:
    """Text to a whole number, NULL otherwise.

    The shape is tested first: a cast that fails raises and catches an exception for every row.
    """
    c = as_col(c)
    return F.when(c.rlike(r"^\s*[+-]?\d{1,19}\s*$"), c.try_cast(kind))
