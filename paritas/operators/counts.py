"""Occurrence counts per key and everything derived from them.

All of these come from one aggregate: the two sides' keys are tagged and
unioned, then ``groupBy(key)`` sums one counter per side.  The aggregate has
a map-side partial step, so a key holding a third of the table is reduced to
one row per input task before the shuffle.  Rows with a NULL key form their
own group (kept for cross pairing, excluded from the count reports).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import all_of
from ..spec import Resolved
from .match import key_columns, right_aligned


def key_counts(left: DataFrame, right: DataFrame, rs: Resolved,
               key_exprs=None) -> DataFrame:
    """``keys..., <left>_count, <right>_count`` for every key on either side."""
    ln, rn_ = rs.spec.left_name, rs.spec.right_name
    ra = right_aligned(right, rs, rs.keys)
    lk = left.select(*key_columns(left, ra, rs.keys), F.lit(1).alias("__lc"),
                     F.lit(0).alias("__rc"))
    rk = ra.select(*key_columns(ra, left, rs.keys), F.lit(0).alias("__lc"), F.lit(1).alias("__rc"))
    return lk.unionByName(rk).groupBy(*rs.keys).agg(
        F.sum("__lc").cast("long").alias(f"{ln}_count"),
        F.sum("__rc").cast("long").alias(f"{rn_}_count"))


def _non_null(df: DataFrame, rs: Resolved) -> DataFrame:
    return df.filter(all_of([F.col(k).isNotNull() for k in rs.keys]))


def key_occurrences(left: DataFrame, right: DataFrame, rs: Resolved) -> DataFrame:
    """``side, keys..., occurrence_count`` (non-null keys, per side)."""
    ln, rn_ = rs.spec.left_name, rs.spec.right_name
    kc = _non_null(key_counts(left, right, rs), rs)
    return kc.select(
        *rs.keys,
        F.inline(F.array(
            F.struct(F.lit(ln).alias("side"), F.col(f"{ln}_count").alias("occurrence_count")),
            F.struct(F.lit(rn_).alias("side"), F.col(f"{rn_}_count").alias("occurrence_count"))))
    ).filter(F.col("occurrence_count") > 0).select("side", *rs.keys, "occurrence_count")


def count_differences(left: DataFrame, right: DataFrame, rs: Resolved,
                      counts: DataFrame | None = None) -> DataFrame:
    """Keys occurring a different number of times on the two sides.

    ``keys..., <left>_count, <right>_count, count_difference, difference_type``
    with ``difference_type`` in MORE_IN_<LEFT> / MORE_IN_<RIGHT>.
    """
    ln, rn_ = rs.spec.left_name, rs.spec.right_name
    kc = _non_null(counts if counts is not None else key_counts(left, right, rs), rs)
    lc, rc = F.col(f"{ln}_count"), F.col(f"{rn_}_count")
    return kc.filter(lc != rc).select(
        *rs.keys, lc, rc,
        F.abs(lc - rc).alias("count_difference"),
        F.when(lc > rc, F.lit(f"MORE_IN_{ln.upper()}"))
        .otherwise(F.lit(f"MORE_IN_{rn_.upper()}")).alias("difference_type"))


def top_count_differences(diffs: DataFrame, rs: Resolved, n: int = 50) -> DataFrame:
    """The ``n`` largest count differences, ties broken by key (distributed top-k)."""
    return diffs.orderBy(F.col("count_difference").desc(),
                         *[F.col(k).asc_nulls_last() for k in rs.keys]).limit(n)


def duplicate_histogram(left: DataFrame, right: DataFrame, rs: Resolved,
                        counts: DataFrame | None = None) -> DataFrame:
    """Per side: how many keys occur exactly ``occurrence_count`` (> 1) times.

    ``side, occurrence_count, <key>_count, total_rows``.
    """
    ln, rn_ = rs.spec.left_name, rs.spec.right_name
    kc = _non_null(counts if counts is not None else key_counts(left, right, rs), rs)
    per_side = kc.select(F.inline(F.array(
        F.struct(F.lit(ln).alias("side"), F.col(f"{ln}_count").alias("occurrence_count")),
        F.struct(F.lit(rn_).alias("side"), F.col(f"{rn_}_count").alias("occurrence_count")))))
    key_label = f"{rs.keys[0]}_count" if len(rs.keys) == 1 else "key_count"
    return (per_side.filter(F.col("occurrence_count") > 1)
            .groupBy("side", "occurrence_count")
            .agg(F.count(F.lit(1)).alias(key_label))
            .withColumn("total_rows", F.col(key_label) * F.col("occurrence_count")))


def duplicate_totals(hist: DataFrame, rs: Resolved) -> DataFrame:
    """``side, duplicate_<key>s``: keys with more than one occurrence, 0 when none."""
    ln, rn_ = rs.spec.left_name, rs.spec.right_name
    key_label = [c for c in hist.columns if c.endswith("_count") and c != "occurrence_count"][0]
    out_label = ("duplicate_" + key_label[:-len("_count")] + "s") if len(rs.keys) == 1 \
        else "duplicate_keys"
    sums = hist.groupBy().agg(*[
        F.coalesce(F.sum(F.when(F.col("side") == s, F.col(key_label))), F.lit(0))
        .cast("long").alias(s) for s in (ln, rn_)])
    return sums.select(F.inline(F.array(
        F.struct(F.lit(ln).alias("side"), F.col(ln).alias(out_label)),
        F.struct(F.lit(rn_).alias("side"), F.col(rn_).alias(out_label)))))


def count_difference_patterns(diffs: DataFrame, rs: Resolved, digits: int = 4) -> DataFrame:
    """Count differences grouped by (size, direction): how many keys, average counts."""
    ln, rn_ = rs.spec.left_name, rs.spec.right_name
    key_label = f"{rs.keys[0]}_count" if len(rs.keys) == 1 else "key_count"
    return diffs.groupBy("count_difference", "difference_type").agg(
        F.count(F.lit(1)).alias(key_label),
        F.round(F.avg(f"{ln}_count"), digits).alias(f"avg_{ln}_count"),
        F.round(F.avg(f"{rn_}_count"), digits).alias(f"avg_{rn_}_count"))


def count_difference_totals(diffs: DataFrame, rs: Resolved) -> DataFrame:
    """``total, more_in_<left>, more_in_<right>`` in one row (0 when no differences)."""
    ln, rn_ = rs.spec.left_name, rs.spec.right_name
    t = F.col("difference_type")
    return diffs.groupBy().agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(F.when(t == f"MORE_IN_{ln.upper()}", 1)), F.lit(0)).cast("long")
        .alias(f"more_in_{ln}"),
        F.coalesce(F.sum(F.when(t == f"MORE_IN_{rn_.upper()}", 1)), F.lit(0)).cast("long")
        .alias(f"more_in_{rn_}"))
