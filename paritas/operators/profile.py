"""Table profile: row counts, schema as rows, required-column issues, gate.

Row counts are one aggregate over both inputs.  Schema, common columns and
issues are *metadata* (read from ``DataFrame.schema`` without a job) turned
into small DataFrames with explicit schemas.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import Resolved

SCHEMA_ROWS = T.StructType([
    T.StructField("position", T.LongType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("nullable", T.BooleanType(), False),
])

ISSUE_ROWS = T.StructType([
    T.StructField("type", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("missing_columns", T.ArrayType(T.StringType()), False),
    T.StructField("severity", T.StringType(), False),
])


CATALOG_ROWS = T.StructType([
    T.StructField("position", T.LongType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("nullable", T.BooleanType(), False),
    T.StructField("default_value", T.StringType(), True),
    T.StructField("is_key", T.BooleanType(), False),
])
#: The table property that names the key columns, separated by commas.
KEY_PROPERTY = "primary_key"


def declared_type(field: T.StructField) -> str:
    """The type a column was declared with; Spark reads char(n) and varchar(n) as string
    and keeps them in the field's metadata."""
    return field.metadata.get("__CHAR_VARCHAR_TYPE_STRING") or field.dataType.simpleString()


def catalog_keys(spark: SparkSession, table: str) -> list[str]:
    """The key columns that the catalog states for a table, or none."""
    told = json.loads(spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name) AS JSON",
                                args={"name": table}).first()[0])
    names = (told.get("table_properties") or {}).get(KEY_PROPERTY, "")
    return [k.strip() for k in names.split(",") if k.strip()]


def catalog_profile(spark: SparkSession, table: str) -> DataFrame:
    """One row per column as the catalog states it, with the table's ``row_count``:
    ``position, column_name, type, nullable, default_value, is_key, row_count``."""
    df, keys = spark.table(table), {k.lower() for k in catalog_keys(spark, table)}
    rows = [(i + 1, f.name, declared_type(f), bool(f.nullable), f.metadata.get("CURRENT_DEFAULT"),
             f.name.lower() in keys) for i, f in enumerate(df.schema.fields)]
    count = df.groupBy().agg(F.count(F.lit(1)).cast("long").alias("row_count"))
    return rows_with_figures(count, rows, CATALOG_ROWS)


def row_counts(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """``side, row_count`` for both inputs from one aggregate (one row per side,
    also when a side is empty)."""
    tagged = left.select(F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionByName(
        right.select(F.lit(0).alias("__l"), F.lit(1).alias("__r")))
    one = tagged.groupBy().agg(F.coalesce(F.sum("__l"), F.lit(0)).cast("long").alias("__l"),
                               F.coalesce(F.sum("__r"), F.lit(0)).cast("long").alias("__r"))
    return one.select(F.inline(F.array(
        F.struct(F.lit(left_name).alias("side"), F.col("__l").alias("row_count")),
        F.struct(F.lit(right_name).alias("side"), F.col("__r").alias("row_count")))))


def required_issues(spark: SparkSession, rs: Resolved, left_table: str,
                    right_table: str) -> DataFrame:
    """Missing required columns (CRITICAL) and missing output columns (WARNING)."""
    ln, rn_ = rs.spec.left_name, rs.spec.right_name
    rows = []
    for kind, severity in (("required", "CRITICAL"), ("output", "WARNING")):
        label = "comparison" if kind == "required" else "output"
        for side, name, table in (("left", ln, left_table), ("right", rn_, right_table)):
            missing = rs.missing[side][kind]
            if missing:
                rows.append((f"missing_{label}_columns_{name}", table, list(missing), severity))
    return spark.createDataFrame(rows, ISSUE_ROWS)


def rows_with_figures(one_row: DataFrame, rows: list[tuple], schema: T.StructType,
                      figures: list | None = None) -> DataFrame:
    """Metadata rows that each carry figures of a one-row aggregate, built as an
    ``inline`` over that row (no join).  ``figures[i]`` lists the Columns for
    row ``i`` (default: all columns of ``one_row``)."""
    names = [f.name for f in schema.fields]
    if not rows:
        return one_row.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields],
                              *one_row.columns).filter(F.lit(False))
    structs = []
    for i, r in enumerate(rows):
        vals = [F.lit(v).cast(f.dataType).alias(n) for v, f, n in zip(r, schema.fields, names)]
        extra = [F.col(c) for c in one_row.columns] if figures is None else figures[i]
        structs.append(F.struct(*vals, *extra))
    return one_row.select(F.inline(F.array(*structs)))


def schema_profile(spark: SparkSession, df: DataFrame) -> DataFrame:
    """One row per column with the table's ``row_count`` (the profile step
    reports both): ``position, column_name, type, nullable, row_count``."""
    rows = [(i + 1, f.name, declared_type(f), bool(f.nullable))
            for i, f in enumerate(df.schema.fields)]
    count = df.groupBy().agg(F.count(F.lit(1)).cast("long").alias("row_count"))
    return rows_with_figures(count, rows, SCHEMA_ROWS)


def _side_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    c = row_counts(left, right, "l", "r")
    return c.groupBy().agg(
        F.sum(F.when(F.col("side") == "l", F.col("row_count"))).cast("long").alias("table1_rows"),
        F.sum(F.when(F.col("side") == "r", F.col("row_count"))).cast("long").alias("table2_rows"))


def common_columns_profile(left: DataFrame, right: DataFrame, rs: Resolved) -> DataFrame:
    """Common columns with both tables' row counts:
    ``position, column_name, table1_rows, table2_rows``."""
    rows = [(i + 1, c) for i, c in enumerate(rs.common)]
    return rows_with_figures(_side_counts(left, right), rows,
                             T.StructType([T.StructField("position", T.LongType()),
                                           T.StructField("column_name", T.StringType())]))


def required_issues_profile(left: DataFrame, right: DataFrame, rs: Resolved, left_table: str,
                            right_table: str) -> DataFrame:
    """``required_issues`` rows with ``table_rows``, the row count of the
    table each issue is about."""
    ln, rn_ = rs.spec.left_name, rs.spec.right_name
    rows, figs = [], []
    for kind, severity in (("required", "CRITICAL"), ("output", "WARNING")):
        label = "comparison" if kind == "required" else "output"
        for side, name, table in (("left", ln, left_table), ("right", rn_, right_table)):
            missing = rs.missing[side][kind]
            if missing:
                rows.append((f"missing_{label}_columns_{name}", table, list(missing), severity))
                figs.append([F.col("table1_rows" if side == "left" else "table2_rows")
                             .alias("table_rows")])
    counts = _side_counts(left, right)
    if not rows:  # no issue: an empty frame of the same shape
        return rows_with_figures(counts.select(F.col("table1_rows").alias("table_rows")), [],
                                 ISSUE_ROWS)
    return rows_with_figures(counts, rows, ISSUE_ROWS, figs)
