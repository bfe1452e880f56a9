"""File sources and sinks.

Paths go through the Hadoop FileSystem of the session, so the same code
reads and writes local folders in tests and shared storage on a cluster.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
             **options) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("header", header).options(**options).csv(path)


def read_dirty_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
                   drop_malformed: bool = True, quote: str | None = '"', escape: str = "\\",
                   multi_line: bool = False) -> DataFrame:
    """Malformed lines dropped (``DROPMALFORMED``) or kept with a
    ``_corrupt_record`` column (``PERMISSIVE``); bytes that are no UTF-8 become
    U+FFFD.  ``multi_line`` (line breaks inside quotes) reads each file in one
    task: only for files known to need it."""
    r = (spark.read.schema(schema).option("header", header).option("escape", escape)
         .option("multiLine", multi_line).option("encoding", "UTF-8"))
    r = r.option("quote", "" if quote is None else quote)
    r = r.option("mode", "DROPMALFORMED" if drop_malformed else "PERMISSIVE")
    return r.csv(path)


def read_unquoted_csv(spark: SparkSession, path: str, columns: list[tuple[str, str]], separator: str = ",") -> DataFrame:
    """S2, the retry without quoting: quotes are plain characters and a backslash takes the next character
    literally, separators too.  ``columns`` are (name, type); lines with another number of fields
    are dropped, values that do not fit their type are NULL."""
    fields = F.split("value", rf"(?<!\\){separator}")
    rows = spark.read.text(path).select(fields.alias("f")).where(F.size("f") == len(columns))
    plain = lambda i: F.regexp_replace(F.col("f")[i], r"\\(.)", "$1")
    return rows.select(*[plain(i).try_cast(kind).alias(name) for i, (name, kind) in enumerate(columns)])


def write_csv(df: DataFrame, path: str, float_digits: int | None = None, mode: str = "overwrite") -> None:
    """CSV sink with a header; doubles optionally fixed to n digits."""
    if float_digits is not None:
        df = df.select(*[F.format_string(f"%.{float_digits}f", F.col(f.name)).alias(f.name)
                         if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema.fields])
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    """Table snapshot (parquet, optionally partitioned)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def cached_source(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """Reuse the written table if it is complete, else compute, write, reuse.  A folder that a
    broken-off write has left holds no ``_SUCCESS`` and is written again."""
    if not path_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        write_parquet(compute(), path)
    return spark.read.parquet(path)


def optional_source(spark: SparkSession, path: str, reader: Callable[[str], DataFrame],
                    required: bool = False) -> DataFrame | None:
    """A missing optional source is skipped with a warning (``None``);
    a missing required one raises."""
    if path_exists(spark, path):
        return reader(path)
    if required:
        raise FileNotFoundError(path)
    warnings.warn(f"optional source missing, skipped: {path}", stacklevel=2)
    return None


def sheet_rows(spark: SparkSession, path: str, n_cols: int, key_pattern: str,
               names: list[str], total_cols: int | None = None) -> DataFrame:
    """S4 (re-aimed spreadsheet): a CSV export with banner lines above the
    header.  Lines are read as raw text columns, rows whose first field
    matches ``key_pattern`` (anchored) are kept, and the first ``len(names)``
    fields are named - the trailing column is dropped."""
    width = total_cols or n_cols + 1
    schema = ", ".join(f"_c{i} string" for i in range(width))
    raw = spark.read.schema(schema).option("header", False).csv(path)
    cols = raw.columns[:n_cols]
    kept = raw.where(F.col(cols[0]).rlike(key_pattern))
    return kept.select(*[F.col(c).alias(n) for c, n in zip(cols, names)])


def preview(df: DataFrame, order: list, n: int = 5) -> DataFrame:
    """The first n rows in an explicit order, returned (not printed)."""
    return df.orderBy(*order).limit(n)
