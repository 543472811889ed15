"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Inputs are the derived pairs of ``paritas.sources.fixtures``:
``E`` = enroll_dev / enroll_prod (member key, duplicates, NULLs),
``G`` = feed_left / feed_right (unique key, schema differences),
``B`` = line_left / line_right (composite key that repeats),
``X`` = exact_left / exact_right (the same columns in different types),
``T`` = typed_left / typed_right (equal values in types far apart),
``W`` = wide_left / wide_right (42 compared columns).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..operators import counts, cross, diff, match, profile, structure
from ..session import output_dir
from ..sources import (ENROLL_COLUMNS, ENROLL_COMPARE, ENROLL_OUTPUT, LINE_KEYS, LINE_OUTPUT,
                       WIDE_COMPARE, as_dataframe, enroll_pair, feed_pair, line_pair,
                       mixed_type_pair, preview_files, read_table, sample_rows, typed_pair,
                       wide_pair)
from ..spec import ReconSpec
from . import diagnostics, report, run
from .validate import GenericComparison, Reconciliation

ENROLL_SPEC = ReconSpec(keys=("member_id",), compare=tuple(ENROLL_COMPARE),
                        output=tuple(ENROLL_OUTPUT), left_name="dev", right_name="prod")
LINE_SPEC = ReconSpec(keys=tuple(LINE_KEYS), compare=None, output=tuple(LINE_OUTPUT),
                      left_name="left", right_name="right", pairing="cross")
EXACT_SPEC = ReconSpec(keys=("key_id",), left_name="left", right_name="right")
TYPED_SPEC = ReconSpec(keys=("order_id",), left_name="left", right_name="right")
WIDE_SPEC = ReconSpec(keys=tuple(LINE_KEYS), compare=tuple(WIDE_COMPARE), output=("c_name",),
                      left_name="left", right_name="right")
# A required list with one column absent from both sides and one absent on the right.
FEED_REQUIRED_SPEC = ReconSpec(keys=("o_orderkey",), compare=("o_totalprice",),
                               required=("o_orderkey", "o_totalprice", "left_extra", "missing_col"),
                               output=("o_orderdate", "right_extra"),
                               left_name="left", right_name="right")

Query = Callable[[SparkSession, str], DataFrame]


def enroll(spark: SparkSession, sf_dir: str, **changes) -> Reconciliation:
    dev, prod = enroll_pair(spark, sf_dir)
    spec = ENROLL_SPEC.with_(**changes) if changes else ENROLL_SPEC
    return Reconciliation(spark, dev, prod, spec, "enroll_dev", "enroll_prod")


def feed(spark: SparkSession, sf_dir: str) -> GenericComparison:
    left, right = feed_pair(spark, sf_dir)
    return GenericComparison(spark, left, right, ("o_orderkey",), "feed_left", "feed_right")


def lines(spark: SparkSession, sf_dir: str) -> Reconciliation:
    left, right = line_pair(spark, sf_dir)
    return Reconciliation(spark, left, right, LINE_SPEC, "line_left", "line_right")


def exact(spark: SparkSession, sf_dir: str, **changes) -> Reconciliation:
    left, right = mixed_type_pair(spark, sf_dir)
    return Reconciliation(spark, left, right, EXACT_SPEC.with_(**changes), "exact_left",
                          "exact_right")


def typed(spark: SparkSession, sf_dir: str, **changes) -> Reconciliation:
    left, right = typed_pair(spark, sf_dir)
    return Reconciliation(spark, left, right, TYPED_SPEC.with_(**changes), "typed_left",
                          "typed_right")


def wide(spark: SparkSession, sf_dir: str, **changes) -> Reconciliation:
    left, right = wide_pair(spark, sf_dir)
    return Reconciliation(spark, left, right, WIDE_SPEC.with_(**changes), "wide_left",
                          "wide_right")


def _longs(df: DataFrame, *cols: str) -> DataFrame:
    """Figures that may exceed 64 bits, as the longs they are at these sizes
    (a larger one fails here instead of wrapping around)."""
    return df.withColumns({c: F.col(c).cast("long") for c in cols})


def _count_difference_keys(r: Reconciliation) -> DataFrame:
    return r.count_differences.select(*r.rs.keys)


def q_sample_rows(spark, d):
    r = enroll(spark, d)
    return sample_rows(r.left, ENROLL_COLUMNS, 100)


def q_file_preview(spark, d):
    """The first rows of a table's files, in file order."""
    return preview_files(spark, f"{d}/lineitem.parquet", 1000,
                         ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"])


def _declared_table(spark, d, name: str, status: str) -> str:
    """A table of all orders with declared lengths, a default and a key."""
    path = output_dir(spark, name)
    table = f"paritas_{name}_{path.rsplit('_', 1)[-1]}"
    spark.sql(f"CREATE TABLE {table} (o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus {status} "
              "DEFAULT 'O', o_orderpriority CHAR(20), o_totalprice DOUBLE DEFAULT 0.5) USING parquet "
              "LOCATION :path TBLPROPERTIES ('primary_key' = 'o_orderkey')", args={"path": path})
    read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                          "o_orderpriority", "o_totalprice").write.insertInto(table)
    return table


def q_catalog_profile(spark, d):
    table = _declared_table(spark, d, "declared", "VARCHAR(10)")
    found = profile.catalog_profile(spark, table)
    spark.sql(f"DROP TABLE {table}")  # its files stay, and are what the result reads
    return found


def q_declared_structure_diff(spark, d):
    """varchar(10) against varchar(20) of the same rows."""
    names = [_declared_table(spark, d, "declared", f"VARCHAR({n})") for n in (10, 20)]
    left, right = (spark.table(n) for n in names)
    found = structure.structure_diff(spark, left, right.filter("o_orderkey % 7 <> 0"))
    for n in names:
        spark.sql(f"DROP TABLE {n}")
    return found


def q_table_row_counts(spark, d):
    r = enroll(spark, d)
    return profile.row_counts(r.left, r.right, "dev", "prod")


def q_table_schema(spark, d):
    return profile.schema_profile(spark, feed(spark, d).left)


def q_common_columns(spark, d):
    g = feed(spark, d)
    return profile.common_columns_profile(g.left, g.right, g.rs)


def q_required_column_issues(spark, d):
    left, right = feed_pair(spark, d)
    rs = FEED_REQUIRED_SPEC.resolve(left, right)
    issues = profile.required_issues_profile(left, right, rs, "feed_left", "feed_right")
    return issues.select("type", "table_name",
                         F.array_join("missing_columns", ", ").alias("missing_columns"), "severity",
                         "table_rows")


def q_structure_diff(spark, d):
    return feed(spark, d).structure_diff()


def q_key_ordinals(spark, d):
    r = enroll(spark, d)
    return match.numbered(r.left, r.rs, r.rs.output)


def q_left_only(spark, d):
    return enroll(spark, d).one_sided("left", distinct=False)


def q_right_only(spark, d):
    return enroll(spark, d).one_sided("right", distinct=False)


def q_left_only_distinct(spark, d):
    return enroll(spark, d).one_sided("left", distinct=True)


def q_right_only_distinct(spark, d):
    return enroll(spark, d).one_sided("right", distinct=True)


def q_key_occurrences(spark, d):
    r = enroll(spark, d)
    return counts.key_occurrences(r.left, r.right, r.rs)


def q_count_differences(spark, d):
    r = enroll(spark, d)
    return r.count_differences.orderBy(F.col("count_difference").desc(), "member_id")


def q_top_count_differences(spark, d):
    r = enroll(spark, d)
    return counts.top_count_differences(r.count_differences, r.rs, 50)


def q_duplicate_histogram(spark, d):
    r = enroll(spark, d)
    return counts.duplicate_histogram(r.left, r.right, r.rs, r.key_counts) \
        .orderBy("side", "occurrence_count")


def q_duplicate_totals(spark, d):
    r = enroll(spark, d)
    return counts.duplicate_totals(counts.duplicate_histogram(r.left, r.right, r.rs, r.key_counts),
                                   r.rs)


def q_count_difference_patterns(spark, d):
    r = enroll(spark, d)
    return counts.count_difference_patterns(r.count_differences, r.rs) \
        .orderBy(F.col("count_difference").desc(), "difference_type")


def q_count_difference_totals(spark, d):
    r = enroll(spark, d)
    return counts.count_difference_totals(r.count_differences, r.rs)


def q_changed_paired(spark, d):
    r = enroll(spark, d)
    return match.changed_pairs(r.left, r.right, r.rs, "safe")


def q_changed_sentinel(spark, d):
    r = enroll(spark, d)
    return match.changed_pairs(r.left, r.right, r.rs, "sentinel")


def q_changed_cross(spark, d):
    r = enroll(spark, d)
    return cross.changed_cross(r.left, r.right, r.rs, "safe")


def q_mismatch_cells(spark, d):
    r = enroll(spark, d)
    return diff.mismatch_cells(r.left, r.right, r.rs, "safe")


def q_mismatch_cells_cross(spark, d):
    r = enroll(spark, d)
    return cross.mismatch_cells_cross(r.left, r.right, r.rs, "safe")


def q_unmatched_ordinals(spark, d):
    r = enroll(spark, d)
    return match.unmatched_ordinals(r.left, r.right, r.rs)


def q_cross_matches(spark, d):
    r = enroll(spark, d)
    return _longs(cross.cross_matches(r.left, r.right, r.rs), "total_matches")


def q_mismatch_counts_by_column(spark, d):
    r = enroll(spark, d)
    counted = cross.cross_column_counts(r.left, r.right, r.rs, "sentinel")
    shown = _longs(counted.select("column_name", "mismatch_count"), "mismatch_count")
    return shown.orderBy(F.col("mismatch_count").desc(), "column_name")


def q_mismatch_percentages(spark, d):
    r = enroll(spark, d)
    counted = cross.cross_column_counts(r.left, r.right, r.rs, "sentinel")
    return _longs(cross.mismatch_percentages(counted), "mismatch_count", "total_matches")


def q_sample_mismatches(spark, d):
    r = enroll(spark, d)
    return diagnostics.sample_mismatches(r.left, r.right, r.rs, 10, "safe")


def q_sample_mismatches_cross(spark, d):
    return enroll(spark, d, pairing="cross").sample_mismatches(10)


def q_spot_check_outcomes(spark, d):
    """Every customer is asked for; some have no row on a side, or on both."""
    asked = read_table(spark, d, "customer")
    return enroll(spark, d).spot_check_outcomes(
        asked.select(F.col("c_custkey").alias("member_id")))


def q_spot_check(spark, d):
    r = enroll(spark, d)
    return diagnostics.spot_check(r.left, r.right, r.rs, _count_difference_keys(r))


def q_duplicate_details(spark, d):
    r = enroll(spark, d)
    return diagnostics.duplicate_details(r.left, r.right, r.rs, _count_difference_keys(r))


def q_generic_changed(spark, d):
    return feed(spark, d).changed()


def q_generic_full_diff(spark, d):
    return feed(spark, d).full_diff()


def q_generic_mismatch_long(spark, d):
    return feed(spark, d).mismatch_long()


def q_generic_mismatch_nested(spark, d):
    """The nested records with their maps as sorted entries in text."""
    r = feed(spark, d).mismatch_nested()

    def entries(c: str, value) -> Column:
        return F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(
            e["key"], F.lit("="), value(e["value"]))), "; ").alias(c)

    text = lambda v: F.coalesce(v, F.lit("NULL"))
    return r.select("table1", "table2", entries("key_values", text), entries(
        "differences", lambda v: F.concat(text(v["table1_value"]), F.lit(" / "),
                                          text(v["table2_value"]))))


def q_row_fingerprint_diff(spark, d):
    return feed(spark, d).fingerprint_diff()


def q_keyless_diff(spark, d):
    return feed(spark, d).keyless_diff()


def q_business_key_changed(spark, d):
    r = lines(spark, d)
    return cross.changed_cross(r.left, r.right, r.rs)


def q_business_mismatch_cells(spark, d):
    r = lines(spark, d)
    return cross.mismatch_cells_cross(r.left, r.right, r.rs)


def q_run_summary(spark, d):
    return enroll(spark, d).summary()


def q_run_status(spark, d):
    return enroll(spark, d).status()


def q_status_line(spark, d):
    return report.status_line(enroll(spark, d))


def q_validation_report(spark, d):
    return report.validation_report(enroll(spark, d))


def q_validation_log(spark, d):
    return feed(spark, d).validation_log(dt.datetime(2024, 5, 1, 12, 30))


def q_run_status_cross(spark, d):
    return _longs(enroll(spark, d, pairing="cross").status(with_count_differences=False),
                  "total_issues")


def q_run_status_cross_sentinel(spark, d):
    r = enroll(spark, d, pairing="cross", null_mode="sentinel")
    return _longs(r.status(with_count_differences=False), "total_issues")


def q_run_status_business(spark, d):
    return _longs(lines(spark, d).status(with_count_differences=False), "total_issues")


def q_run_status_generic(spark, d):
    return feed(spark, d).status()


def _outputs(results) -> DataFrame:
    """Every row of every result of a run, as text."""
    texts = [F.when(F.col("kind") == k, F.concat_ws("|", *[
        F.coalesce(F.col(k)[c].cast("string"), F.lit("NULL")) for c in t.names]))
        for k, t in results.kinds.items()]
    return results.frame.select("kind", F.coalesce(*texts).alias("row_text"))


def q_run_outputs(spark, d):
    return _outputs(enroll(spark, d).results())


def q_run_outputs_cross(spark, d):
    return _outputs(enroll(spark, d, pairing="cross").results())


def q_run_outputs_cross_mixed(spark, d):
    return _outputs(enroll(spark, d, pairing="cross", null_mode="mixed").results())


def q_published_run(spark, d):
    """A run written to files, counted through its manifest."""
    r = enroll(spark, d)
    folder = output_dir(spark, "run")
    run.run_validation(spark, r.left, r.right, r.spec, output=folder, left_table="enroll_dev",
                       right_table="enroll_prod")
    found = run.published(spark, folder)
    counts_ = None
    for f in found.select("result", "location", "rows").collect():  # six results
        back = spark.read.option("header", True).csv(f["location"])
        one = back.groupBy().agg(F.count(F.lit(1)).alias("rows_read")).select(
            F.lit(f["result"]).alias("result"), F.lit(f["rows"]).cast("long").alias("rows"), "rows_read")
        counts_ = one if counts_ is None else counts_.unionByName(one)
    return counts_


def q_sink_clean_names(spark, d):
    r = enroll(spark, d)
    cells = diff.mismatch_cells(r.left, r.right, r.rs, "safe")
    headed = cells.toDF(*[c.title() for c in cells.columns[:-3]], "Differing (Compared) Column",
                        "Value (Dev)", "Value (Prod)")
    return sinks.clean_names(headed)


def q_sink_table_roundtrip(spark, d):
    r = enroll(spark, d)
    path = output_dir(spark, "count_differences")
    name = "paritas_count_differences_" + path.rsplit("_", 1)[-1]
    sinks.clean_names(r.count_differences).write.mode("overwrite") \
        .option("path", path).saveAsTable(name)
    return as_dataframe(spark, f"{spark.catalog.currentDatabase()}.{name}")


def q_sink_csv_headless(spark, d):
    """Files without a header line, written by all tasks."""
    r = enroll(spark, d)
    path = output_dir(spark, "count_differences_csv")
    sinks.write_csv(r.count_differences, path, header=False)
    return sinks.read_csv(spark, path, r.count_differences.schema, header=False)


def q_views_sql_text(spark, d):
    """SQL text with a bound value over the views of a reconciliation."""
    views = enroll(spark, d).register_views()
    text = (f"SELECT mismatch_column, count(*) AS cells FROM {views['mismatches']} "
            "WHERE dev_row_number >= :least GROUP BY mismatch_column")
    return as_dataframe(spark, (text, {"least": 2}))


def q_generic_without_keys(spark, d):
    """No key named: all common columns are the key."""
    left, right = feed_pair(spark, d)
    return GenericComparison(spark, left, right, (), "feed_left", "feed_right").full_diff()


def q_sink_csv_roundtrip(spark, d):
    """One-sided rows with a time to the microsecond and a list that holds a NULL."""
    r = enroll(spark, d)
    rows = r.one_sided("left", distinct=True)
    df = rows.withColumns({
        "seen": F.col("eligibility_start_date").cast("timestamp_ntz")
        + F.make_dt_interval(secs=F.col("umi_id") % 1_000_000 / F.lit(1e6)),
        "tags": F.array(F.col("group_number"), F.lit(None), F.lit("a, b"))})
    path = output_dir(spark, "dev_only_csv")
    sinks.write_csv(df, path)
    back = sinks.read_csv(spark, path, df.schema)
    return back.withColumn("tags", F.to_json("tags", {"ignoreNullFields": "false"}))


# --- pairs of different types ------------------------------------------------
def q_key_counts_mixed_types(spark, d):
    r = exact(spark, d)
    return r.key_counts.select(F.col("key_id").cast("string").alias("key_id"), "left_count",
                               "right_count")


def _cells_text(df: DataFrame) -> DataFrame:
    return df.withColumn("key_id", F.col("key_id").cast("string"))


def q_mismatch_cells_mixed_types(spark, d):
    r = exact(spark, d)
    return _cells_text(r.mismatches).select("key_id", "mismatch_column", "left_value",
                                            "right_value")


def q_mismatch_cells_cross_mixed_types(spark, d):
    r = exact(spark, d, pairing="cross")
    return _cells_text(r.mismatches)


def q_cross_right_values_mixed_types(spark, d):
    r = exact(spark, d, pairing="cross")
    return _cells_text(cross.right_values_cross(r.left, r.right, r.rs))


def q_keyless_mixed_types(spark, d):
    r = exact(spark, d)
    cols = r.rs.common
    out = match.keyless_diff(r.left, r.right, cols, "left", "right", [r.rs.rcol(c) for c in cols])
    return out.select("side", F.col("key_id").cast("string").alias("key_id"),
                      F.col("amount").cast("string").alias("amount"), "seen")


def q_fingerprint_mixed_types(spark, d):
    r = exact(spark, d)
    return _cells_text(diff.fingerprint_diff(r.left, r.right, r.rs))


def q_run_status_mixed_types(spark, d):
    return exact(spark, d).status()


# --- other null rules, wide tables -------------------------------------------
def q_mismatch_cells_mixed(spark, d):
    r = enroll(spark, d, null_mode="mixed")
    return r.mismatches


def q_mismatch_cells_cross_mixed(spark, d):
    return enroll(spark, d, pairing="cross", null_mode="mixed").mismatches


def q_mismatch_counts_cross_mixed(spark, d):
    r = enroll(spark, d, pairing="cross", null_mode="mixed")
    return _longs(cross.cross_column_counts(r.left, r.right, r.rs), "mismatch_count",
                  "total_matches")


def q_run_status_cross_mixed(spark, d):
    r = enroll(spark, d, pairing="cross", null_mode="mixed")
    return _longs(r.status(with_count_differences=False), "total_issues")


# --- equal values in types far apart ----------------------------------------
def q_changed_sentinel_mixed_types(spark, d):
    r = typed(spark, d, null_mode="sentinel")
    return _order_text(r.mismatches).select("order_id", "mismatch_column", "left_value", "right_value")


def q_changed_mixed_mixed_types(spark, d):
    r = typed(spark, d, null_mode="mixed")
    return _order_text(r.mismatches).select("order_id", "mismatch_column", "left_value", "right_value")


def q_cross_sentinel_mixed_types(spark, d):
    return _order_text(typed(spark, d, pairing="cross", null_mode="sentinel").mismatches)


def q_cross_mixed_mixed_types(spark, d):
    return _order_text(typed(spark, d, pairing="cross", null_mode="mixed").mismatches)


def _order_text(df: DataFrame) -> DataFrame:
    return df.withColumn("order_id", F.col("order_id").cast("string"))


def q_spot_check_asked_types(spark, d):
    """Keys asked as text: numbers of a half, numbers with idle zeros and words are no keys."""
    k = F.col("o_orderkey")
    asked = read_table(spark, d, "orders").select(
        F.concat(F.when(k % 5 == 0, F.concat(F.lit("0"), k)).when(k % 7 == 0, F.concat(k, F.lit(".5")))
                 .when(k % 11 == 0, F.lit("none")).otherwise(k.cast("string"))).alias("order_id"))
    return typed(spark, d).spot_check_outcomes(asked)


def q_spot_check_wider_keys(spark, d):
    """Keys asked as decimals, some of them with a half."""
    k = F.col("o_orderkey")
    asked = read_table(spark, d, "orders").select(
        (k + F.when(k % 3 == 0, 0.5).otherwise(0).cast("decimal(2,1)")).cast("decimal(24,1)")
        .alias("order_id"))
    return _order_text(typed(spark, d).spot_check_outcomes(asked))


def q_cross_right_values(spark, d):
    r = enroll(spark, d, pairing="cross")
    return cross.right_values_cross(r.left, r.right, r.rs)


def q_wide_mismatch_cells(spark, d):
    return wide(spark, d).mismatches


def q_wide_mismatch_cells_cross(spark, d):
    return wide(spark, d, pairing="cross").mismatches


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
