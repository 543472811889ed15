"""Drill-down diagnostics: samples, spot checks, all occurrences of given keys,
and a row-per-metric report.

Keys to inspect are passed as a DataFrame and applied with a ``left_semi``
join before any numbering, so only the rows of those keys are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import in_common
from ..operators.cross import mismatch_cells_cross
from ..operators.diff import cells_of_pairs, explode_cells
from ..operators.match import (asked_keys, ordinal_pairs, restrict_keys, right_aligned,
                               row_differs)
from ..operators.ordinals import find_hot_keys, range_ordinals, window_ordinals
from ..spec import Resolved


def sample_mismatches(left: DataFrame, right: DataFrame, rs: Resolved, n: int = 10,
                      mode: str | None = None) -> DataFrame:
    """Cells of the first ``n`` differing ordinal pairs by key, ordinal (top-k);
    under cross pairing the first ``n`` rows of its cell report by key, column
    and the other reported columns."""
    mode = mode or rs.spec.null_mode
    if rs.spec.pairing == "cross":
        cells = mismatch_cells_cross(left, right, rs, mode)
        order = list(dict.fromkeys([*rs.keys, "mismatch_column", "left_value", *rs.output]))
        return cells.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
    pairs = ordinal_pairs(left, right, rs)
    first = pairs.filter(row_differs(pairs, rs, mode)) \
        .orderBy(*[F.col(k).asc_nulls_last() for k in rs.keys], F.col("rn")).limit(n)
    return cells_of_pairs(first, rs, mode)


def spot_check(left: DataFrame, right: DataFrame, rs: Resolved, keys_df: DataFrame) -> DataFrame:
    """Positional comparison of every occurrence of the given keys.

    Rows: ``keys, rn, type, mismatch_column, left_value, right_value`` with
    ``type`` = missing_in_<left> / missing_in_<right> (an ordinal present on one
    side only; value columns NULL) or data_differences (one row per differing cell).
    """
    ln, rn_ = rs.spec.left_name, rs.spec.right_name
    pairs = ordinal_pairs(left, right, rs, how="full_outer", keys_df=keys_df)
    # one pass over the pairs: a missing ordinal gives one row, a present pair
    # one row per differing cell
    both = F.col("__l") & F.col("__r")
    text = T.StringType()
    missing = F.array(F.struct(
        F.when(F.col("__l"), F.lit(f"missing_in_{rn_}")).otherwise(F.lit(f"missing_in_{ln}"))
        .alias("type"),
        F.lit(None).cast(text).alias("mismatch_column"),
        F.lit(None).cast(text).alias("left_value"),
        F.lit(None).cast(text).alias("right_value")))
    cells = F.transform(explode_cells(pairs, rs, "safe"), lambda x: F.struct(
        F.lit("data_differences").alias("type"), x["mismatch_column"].alias("mismatch_column"),
        x["left_value"].alias("left_value"), x["right_value"].alias("right_value")))
    return pairs.select(*rs.keys, "rn", F.inline(F.when(both, cells).otherwise(missing)))


def spot_check_outcomes(left: DataFrame, right: DataFrame, rs: Resolved,
                        keys_df: DataFrame) -> DataFrame:
    """One row for each asked key, as it was asked (keys are never narrowed to the
    tables' types): ``keys, <left>_count, <right>_count, outcome`` with outcome NOT_FOUND, ONLY_IN_<LEFT>, ONLY_IN_<RIGHT>, EQUAL (as many
    occurrences on both sides, no cell differs) or DIFFERENT."""
    ln, rn_ = rs.spec.left_name, rs.spec.right_name
    pairs = ordinal_pairs(left, right, rs, how="full_outer", keys_df=keys_df)
    differs = ~(F.col("__l") & F.col("__r")) | row_differs(pairs, rs, "safe")
    found = pairs.groupBy(*rs.keys).agg(
        F.sum(F.col("__l").cast("long")).alias("__lc"), F.sum(F.col("__r").cast("long"))
        .alias("__rc"), F.max(differs.cast("int")).alias("__d"))
    named = [f"__q{i}" for i in range(len(rs.keys))]
    asked = asked_keys(keys_df.select(*rs.keys).distinct(), rs.keys,
                       {k: found.schema[k].dataType for k in rs.keys}, named)
    found = found.withColumnsRenamed(dict(zip(rs.keys, named)))
    lc, rc = (F.coalesce(F.col(c), F.lit(0)) for c in ("__lc", "__rc"))
    return asked.join(found, named, "left").select(
        *rs.keys, lc.alias(f"{ln}_count"), rc.alias(f"{rn_}_count"),
        F.when(lc + rc == 0, F.lit("NOT_FOUND"))
        .when(rc == 0, F.lit(f"ONLY_IN_{ln.upper()}"))
        .when(lc == 0, F.lit(f"ONLY_IN_{rn_.upper()}"))
        .when(F.col("__d") == 0, F.lit("EQUAL")).otherwise(F.lit("DIFFERENT")).alias("outcome"))


def duplicate_details(left: DataFrame, right: DataFrame, rs: Resolved,
                      keys_df: DataFrame) -> DataFrame:
    """All occurrences of the given keys on both sides: ``side``, reported
    columns, ordinal ``rn`` and the key's ``occurrence_count`` on that side.

    One reading: the sides are tagged, united (in their common forms) and
    restricted by one semi-join; a key's count is its largest ordinal, a window
    on the partitioning that numbered it.  Hot keys are numbered by the range
    plan and counted by an aggregate."""
    cols = rs.carried
    ra = right_aligned(right, rs, cols)
    forms = {c: (left.schema[c].dataType, ra.schema[c].dataType) for c in cols}
    tagged = (left.select(*[in_common(left[c], *forms[c]).alias(c) for c in cols],
                          F.lit(0).alias("__side"))
              .unionByName(ra.select(*[in_common(ra[c], *reversed(forms[c])).alias(c)
                                       for c in cols], F.lit(1).alias("__side"))))
    wanted = keys_df.select(*[in_common(F.col(k), keys_df.schema[k].dataType, forms[k][1]).alias(k)
                              for k in rs.keys])
    rows = restrict_keys(tagged, wanted, rs.keys)
    hot = find_hot_keys(rows, rs.keys, ["__side"])
    part = [*rs.keys, "__side"]

    def numbered(frame: DataFrame) -> DataFrame:
        n = window_ordinals(frame, rs.keys, rs.order, "rn", ["__side"])
        return n.withColumn("occurrence_count", F.max("rn").over(Window.partitionBy(*part)))

    if hot is None:
        out = numbered(rows)
    else:
        warm = rows.join(hot, rs.keys, "left_semi")
        counts = warm.groupBy(*part).agg(F.count(F.lit(1)).alias("occurrence_count"))
        out = numbered(rows.join(hot, rs.keys, "left_anti")).unionByName(
            range_ordinals(warm, rs.keys, rs.order, "rn", ["__side"]).join(counts, part))
    side = F.when(F.col("__side") == 0, F.lit(rs.spec.left_name)).otherwise(
        F.lit(rs.spec.right_name))
    return out.select(side.alias("side"), *rs.output, "rn", "occurrence_count")
