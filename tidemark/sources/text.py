"""Row-text readers: JSON lines, regex logs, delimited files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from tidemark.functions.text import try_whole
from tidemark.functions.times import epoch_to_ts

# Reader options by preset, as the senders write them.
DELIMITED = {
    "comma": {"sep": ",", "header": "true", "escape": "\\"},
    "pipe": {"sep": "|", "header": "true", "escape": "\\"},
    "pipe_headerless": {"sep": "|", "header": "false", "escape": "\\"},
    "quoted_comma": {"sep": ",", "header": "true", "escape": '"'},
    "tab": {"sep": "\t", "header": "true", "escape": "\\"},
    "comma_headerless": {"sep": ",", "header": "false", "escape": "\\"},
}


def read_json_lines(spark: SparkSession, path, schema, on_error: str = "null") -> DataFrame:
    """JSON lines with a declared schema; a malformed row becomes NULLs or is dropped."""
    mode = {"null": "PERMISSIVE", "drop": "DROPMALFORMED"}[on_error]
    return spark.read.schema(schema).option("mode", mode).json(path)


def read_delimited(spark: SparkSession, path, schema, preset: str = "pipe", timeformat: str = "auto",
                   widths: dict[str, int] | None = None) -> DataFrame:
    """Separated text; an empty field is NULL. Gzip files are recognised by their suffix.

    Timestamps are text (``auto``) or whole epoch seconds or milliseconds (``epochsecs``,
    ``epochmillisecs``); ``widths`` cuts texts to a declared width.
    """
    options = DELIMITED[preset] | {"nullValue": "", "emptyValue": "", "multiLine": "false"}
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    epoch = timeformat in ("epochsecs", "epochmillisecs")
    times = {f.name for f in wanted.fields if epoch and isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    raw = StructType([T.StructField(f.name, T.LongType() if f.name in times else f.dataType) for f in wanted.fields])
    rows = spark.read.schema(raw).options(**options).csv(path)
    cut = {c: F.substring(c, 1, w) for c, w in (widths or {}).items()}
    return rows.withColumns(cut | {c: epoch_to_ts(F.col(c), "s" if timeformat == "epochsecs" else "ms") for c in times})


def parse_regex_log(df: DataFrame, line: str, pattern: str, names: list[str]) -> DataFrame:
    """Capture groups as columns; a line that does not match gives NULLs."""
    hit = F.col(line).rlike(pattern)
    return df.select("*", *[F.when(hit, F.regexp_extract(line, pattern, i)).alias(n)
                            for i, n in enumerate(names, start=1)])


def read_json_paths(df: DataFrame, text: str, paths: dict[str, tuple[str, str]],
                    timeformat: str = "auto") -> DataFrame:
    """Columns from JSON paths: name -> (path, type). Times are text or epoch seconds/milliseconds."""
    return df.select(*[_from_path(text, p, t, timeformat).alias(n) for n, (p, t) in paths.items()])


def _from_path(text: str, path: str, kind: str, timeformat: str) -> Column:
    raw = F.get_json_object(text, path)
    if kind.startswith("timestamp") and timeformat in ("epochsecs", "epochmillisecs"):
        return epoch_to_ts(raw.try_cast("bigint"), "s" if timeformat == "epochsecs" else "ms")
    return raw.try_cast(kind)


def load_with_rejects(df: DataFrame, schema: StructType, widths: dict[str, int] | None = None,
                      not_null: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Cast text columns to a schema: (rows that cast, rejected rows as they came).

    ``widths`` cuts text to a declared width. Bytes that are not valid UTF-8 become '?'.
    """
    good, cast = F.lit(True), []
    for f in schema.fields:
        raw = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            value = F.replace(F.make_valid_utf8(raw), F.lit("�"), F.lit("?"))
            if widths and f.name in widths:
                value = F.substring(value, 1, widths[f.name])
        else:
            plain = F.trim(raw.cast("string"))
            whole = isinstance(f.dataType, T.IntegralType)
            value = try_whole(plain, f.dataType.simpleString()) if whole else plain.try_cast(f.dataType)
            good = good & ((F.coalesce(raw.cast("string"), F.lit("")) == "") | value.isNotNull())
        if f.name in not_null:
            good = good & value.isNotNull()
        cast.append(value.alias(f.name))
    return df.filter(good).select(*cast), df.filter(~good)


def require_rejects_at_most(rejects: DataFrame, max_error: int) -> int:
    """Fail a load with more rejected rows than allowed; the scan stops once the limit is passed."""
    n = rejects.limit(max_error + 1).count()
    if n > max_error:
        raise ValueError(f"more than {max_error} rows were rejected")
    return n
