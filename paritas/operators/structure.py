"""Structure (schema) difference between two tables.

Rows: ``type, column_name, table1_value, table2_value, difference`` (the
absolute difference of the row counts, else NULL) with ``type`` in
row_count_mismatch / columns_missing_in_table2 / columns_missing_in_table1 /
column_type_mismatch.  Column rows come from schema metadata; the row-count
row comes from one aggregate over both tables.  Names are matched exactly
(case-sensitive), like the generic family of the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .profile import declared_type, row_counts

DIFF_ROWS = T.StructType([
    T.StructField("type", T.StringType(), False),
    T.StructField("column_name", T.StringType(), True),
    T.StructField("table1_value", T.StringType(), True),
    T.StructField("table2_value", T.StringType(), True),
    T.StructField("difference", T.LongType(), True),
])


def schema_differences(spark: SparkSession, left: DataFrame, right: DataFrame) -> DataFrame:
    lt = {f.name: declared_type(f) for f in left.schema.fields}
    rt = {f.name: declared_type(f) for f in right.schema.fields}
    rows = []
    rows += [("columns_missing_in_table2", c, None, None, None) for c in left.columns if c not in rt]
    rows += [("columns_missing_in_table1", c, None, None, None) for c in right.columns if c not in lt]
    rows += [("column_type_mismatch", c, lt[c], rt[c], None) for c in left.columns
             if c in rt and lt[c] != rt[c]]
    return spark.createDataFrame(rows, DIFF_ROWS)


def row_count_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """The row-count row, present only when the counts differ."""
    counts = row_counts(left, right, "t1", "t2")
    one = counts.groupBy().agg(
        F.sum(F.when(F.col("side") == "t1", F.col("row_count"))).alias("c1"),
        F.sum(F.when(F.col("side") == "t2", F.col("row_count"))).alias("c2"))
    return one.filter(F.col("c1") != F.col("c2")).select(
        F.lit("row_count_mismatch").alias("type"), F.lit(None).cast("string").alias("column_name"),
        F.col("c1").cast("string").alias("table1_value"),
        F.col("c2").cast("string").alias("table2_value"),
        F.abs(F.col("c1") - F.col("c2")).alias("difference"))


def structure_diff(spark: SparkSession, left: DataFrame, right: DataFrame) -> DataFrame:
    return row_count_difference(left, right).unionByName(schema_differences(spark, left, right))
