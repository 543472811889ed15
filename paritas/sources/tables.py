"""Inputs: a DataFrame, a catalog table name, a parquet path, SQL text (with
bound parameters), or any data source given by format and options."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import comparable


def as_dataframe(spark: SparkSession, source) -> DataFrame:
    """Accept a DataFrame, SQL text (``SELECT``/``WITH``, kept lazy), a
    ``(sql, args)`` pair (named parameters bound by ``spark.sql``, never
    spliced into the text), a data-source mapping, a (qualified) table name,
    or a parquet path/dir.

    A mapping reads any registered data source lazily::

        {"format": "jdbc", "options": {"url": ..., "dbtable": ...,
         "partitionColumn": "id", "lowerBound": 1, "upperBound": 10**9,
         "numPartitions": 512}}

    (a remote warehouse table read in parallel slices), or
    ``{"format": "csv", "path": ..., "options": {"header": "true"}}``.
    """
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, tuple) and len(source) == 2 and isinstance(source[0], str):
        return spark.sql(source[0], args=dict(source[1]))
    if isinstance(source, dict):
        reader = spark.read.format(source.get("format", "parquet"))
        if source.get("schema") is not None:
            reader = reader.schema(source["schema"])
        reader = reader.options(**{k: str(v) for k, v in (source.get("options") or {}).items()})
        return reader.load(source["path"]) if source.get("path") else reader.load()
    if not isinstance(source, str):
        raise TypeError(f"cannot read {type(source).__name__} as a table")
    if re.match(r"\s*(select|with)\b", source, re.IGNORECASE):
        return spark.sql(source)
    if "/" in source or source.endswith(".parquet"):
        return spark.read.parquet(source)
    return spark.table(source)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the generated test tables, e.g. ``read_table(spark, dir, "orders")``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def sample_rows(df: DataFrame, columns: list[str], n: int = 10000) -> DataFrame:
    """Bounded, deterministic preview: the first ``n`` rows by all columns.

    ``orderBy(...).limit(n)`` is planned as a distributed top-k
    (TakeOrderedAndProject): each task keeps n rows, never the whole table.
    """
    # maps are not orderable: they sort by their sorted entries
    order = [comparable(df[c], df.schema[c].dataType).asc_nulls_last() for c in columns]
    return df.select(*columns).orderBy(*order).limit(n)


def preview_files(spark: SparkSession, path: str, n: int = 10000,
                  columns: list[str] | None = None) -> DataFrame:
    """Bounded preview of a parquet table that does not read the table: its first ``n``
    rows by file name and place in the file.

    Row counts come from the footers, of one file after the other until ``n`` rows are
    found; only those files are read, each task keeping its first ``n`` rows."""
    whole = spark.read.parquet(path)
    taken, rows = [], 0
    for file in sorted(whole.inputFiles()):
        taken.append(file)
        rows += spark.read.parquet(file).count()
        if rows >= n:
            break
    if not taken:
        return whole.select(*(columns or whole.columns)).limit(n)
    reader = spark.read.schema(whole.schema)
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if not taken[0].endswith(f"/{name}"):  # a folder: its names may hold partition values
        reader = reader.option("basePath", path)
    df = reader.parquet(*taken)
    names = columns or df.columns
    placed = df.select(*names, F.col("_metadata.file_path").alias("__file"),
                       F.col("_metadata.row_index").alias("__row"))
    return placed.orderBy("__file", "__row").limit(n).drop("__file", "__row")
