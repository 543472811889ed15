"""Result sinks: managed tables and headered CSV folders.

Each write is one distributed job; the written row count is gathered during
the write with ``DataFrame.observe`` (no second pass).  Nested values are
turned into JSON first because CSV cannot hold them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import JSON_OPTIONS

# Fixed value: the CSV token for NULL (Hive/MySQL convention), so that a NULL
# cell and an empty string stay distinguishable in the files.
NULL_TOKEN = "\\N"


def clean_names(df: DataFrame) -> DataFrame:
    """Column names usable as table columns: parentheses dropped, spaces -> ``_``."""
    return df.toDF(*[re.sub(r"[()]", "", c).replace(" ", "_") for c in df.columns])


# The formats in which the files hold times, to the microsecond.
TIME_FORMATS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def csv_ready(df: DataFrame) -> DataFrame:
    """Arrays/maps/structs as JSON text (NULL elements and microseconds kept)."""
    return df.select(*[
        F.to_json(F.col(f.name), JSON_OPTIONS).alias(f.name) if isinstance(f.dataType, _NESTED)
        else F.col(f.name) for f in df.schema.fields])


def _observed(df: DataFrame, name: str):
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_csv(df: DataFrame, path: str, header: bool = True, single_file: bool = False,
              skip_empty: bool = False) -> int:
    """Overwrite a CSV folder (NULL written as ``\\N``, empty strings as ``""``,
    so the two stay distinguishable; ``read_csv`` gives back the same rows);
    returns rows written.
    ``single_file`` coalesces to one task - only for small results."""
    if skip_empty and df.isEmpty():
        return 0
    out, obs = _observed(csv_ready(df), "write_csv")
    if single_file:
        out = out.coalesce(1)
    (out.write.mode("overwrite").option("header", header).option("nullValue", NULL_TOKEN)
     .option("emptyValue", '""').options(**TIME_FORMATS).csv(path))
    return int(obs.get["rows"])


def read_csv(spark, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """What ``write_csv`` wrote, in its types again."""
    flat = T.StructType([T.StructField(f.name, T.StringType(), True)
                         if isinstance(f.dataType, _NESTED) else f for f in schema.fields])
    rows = (spark.read.schema(flat).option("header", header).option("nullValue", NULL_TOKEN)
            .option("emptyValue", "").options(**TIME_FORMATS).csv(path))
    return rows.select(*[
        F.from_json(F.col(f.name), f.dataType, TIME_FORMATS).alias(f.name)
        if isinstance(f.dataType, _NESTED) else F.col(f.name) for f in schema.fields])
