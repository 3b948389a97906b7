"""Unloads and row serialisers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

# Writer options by preset, as the receivers read them.
UNLOAD = {
    "pipe": ("csv", {"sep": "|", "quoteAll": "true", "escape": "\\", "nullValue": "", "emptyValue": ""}),
    "comma": ("csv", {"sep": ",", "header": "true", "quoteAll": "true", "escape": "\\", "nullValue": "",
                      "emptyValue": ""}),
    "single_csv": ("csv", {"sep": ",", "header": "true", "nullValue": "", "emptyValue": ""}),
    "parquet": ("parquet", {}),
}
ROWS_PER_FILE = 1_000_000
STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def unload(df: DataFrame, path: str, preset: str = "parquet", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write a query result with a preset. Files are bounded by rows; the single-file preset is a
    contract of the receiver and suits reports, not tables."""
    kind, options = UNLOAD[preset]
    rows = df.coalesce(1) if preset == "single_csv" else df
    if preset != "single_csv":
        options = options | {"maxRecordsPerFile": str(rows_per_file)}
    rows.write.format(kind).options(**options).mode("overwrite").save(path)


def write_rows(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Extracted rows as pipe-separated quoted text with one line a row, JSON lines or Parquet.

    In the text form a backslash is written as two and a line feed as backslash and n; quotes are
    doubled by the writer, which leaves backslashes alone. ``read_rows`` takes both back.
    """
    if fmt == "csv":
        text = df.select(*[_escaped(f).alias(f.name) for f in df.schema.fields])
        (text.write.mode("overwrite").option("timestampFormat", STAMP).option("timestampNTZFormat", STAMP)
         .csv(path, sep="|", header=True, quoteAll=True, escape='"'))
    elif fmt == "json":
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    else:
        df.write.mode("overwrite").parquet(path)


def read_rows(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Rows written by ``write_rows``."""
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    raw = (spark.read.schema(schema).option("timestampFormat", STAMP).option("timestampNTZFormat", STAMP)
           .csv(path, sep="|", header=True, escape='"'))
    return raw.select(*[_unescaped(f).alias(f.name) for f in schema.fields])


def _escaped(field: T.StructField):
    c = F.col(field.name)
    if not isinstance(field.dataType, T.StringType):
        return c
    doubled = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _unescaped(field: T.StructField):
    c = F.col(field.name)
    if not isinstance(field.dataType, T.StringType):
        return c
    whole = F.split(c, r"\\\\")
    return F.array_join(F.transform(whole, lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))), "\\")


def load_jdbc(rows: DataFrame, url: str, table: str, columns: list[str], properties: dict[str, str],
              chunk: int = 1000, replace_keys: list[str] = ()) -> list[str]:
    """Append rows to an operational table in chunks, or stage them for a replacement by key.

    With ``replace_keys`` the table itself is not touched: the rows go to ``<table>_staged``, and the
    statements that replace the rows of equal keys are returned, to be run by the caller in one
    transaction. A failed load therefore never leaves the table emptied.
    """
    target = f"{table}_staged" if replace_keys else table
    (rows.select(*columns).write.mode("overwrite" if replace_keys else "append")
     .option("batchsize", str(chunk)).jdbc(url, target, properties=properties))
    return replace_statements(table, target, columns, list(replace_keys)) if replace_keys else []


def replace_statements(table: str, staged: str, columns: list[str], keys: list[str]) -> list[str]:
    """Statements that replace the rows of equal keys by the staged ones."""
    same = " AND ".join(f"{staged}.{k} = {table}.{k}" for k in keys)
    names = ", ".join(columns)
    return [f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staged} WHERE {same})",
            f"INSERT INTO {table} ({names}) SELECT {names} FROM {staged}", f"DROP TABLE {staged}"]


def jdbc_rows(rows: DataFrame, columns: list[str], current: DataFrame, keys: list[str]) -> DataFrame:
    """What a table holds after ``replace_statements``: the staged rows over the current ones."""
    from tidemark.operators.merges import upsert
    return upsert(current.select(*columns), rows.select(*columns), keys)
