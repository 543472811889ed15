"""The figures of a run's summary from one reading of each side.

Both sides are tagged, united and clustered by key once; row totals, one-sided
rows, differing cells and count differences are then aggregates over that
clustering, each narrowing the last (no join, no second reading).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import all_of, comparable, in_common
from ..spec import Resolved
from .cross import COUNT, PRODUCT, SIDE, TOTAL, _split, _tagged, encode
from .match import cell_differs, lcol, rcol, right_aligned, row_differs
from .ordinals import hot_keys_and_rows, is_clustered, side_ordinals, spread

FIGURES = ("left_rows", "right_rows", "only_left", "only_right", "cells", "count_differences")
_ROW = "__row__"


def _figures(per_key: DataFrame) -> DataFrame:
    """One row of ``FIGURES`` from ``m, n`` (rows of a key), ``new_l, new_r``
    (distinct rows), ``cells`` and ``matches`` (false for NULL keys)."""
    m, n, match = F.col("m"), F.col("n"), F.col("matches")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per_key.groupBy().agg(
        total(m).cast("long").alias("left_rows"), total(n).cast("long").alias("right_rows"),
        total(F.when(~match | (n == 0), F.col("new_l"))).cast("long").alias("only_left"),
        total(F.when(~match | (m == 0), F.col("new_r"))).cast("long").alias("only_right"),
        total(F.col("cells")).cast(PRODUCT).alias("cells"),
        total(F.when(match & (m != n), 1)).cast("long").alias("count_differences"))


def cross_figures(left: DataFrame, right: DataFrame, rs: Resolved) -> DataFrame:
    """Cross pairing under the safe rule.  Every row gives one entry for itself,
    one for its whole content and one for each compared cell; entries are counted
    by (key, column, value) and side, and those counts by key."""
    cold, hot, kc = _split(_tagged(left, right, rs, "safe", list(
        dict.fromkeys(rs.keys + rs.compare))), rs)
    if not is_clustered(cold, kc):
        cold = cold.repartition(*kc)

    def per_key(frame: DataFrame) -> DataFrame:
        texts = [encode(frame, c, "safe") for c in rs.compare]
        entries = [F.struct(F.lit(TOTAL).alias("c"), F.lit("").alias("v")),
                   F.struct(F.lit(_ROW).alias("c"), F.to_json(F.array(*texts)).alias("v")
                            if texts else F.lit("").alias("v")),
                   *[F.struct(F.lit(c).alias("c"), t.alias("v")) for c, t in zip(rs.compare, texts)]]
        no_null = all_of([frame[k].isNotNull() for k in rs.keys])
        rows = frame.select(*kc, SIDE, no_null.alias("matches"), F.inline(F.array(*entries)))
        m = F.sum((F.col(SIDE) == 0).cast("long")).cast(COUNT)
        n = F.sum((F.col(SIDE) == 1).cast("long")).cast(COUNT)
        counted = rows.groupBy(*kc, "matches", "c", "v").agg(m.alias("m"), n.alias("n"))
        c = F.col("c")
        of = lambda name, x: F.coalesce(F.sum(F.when(c == name, x)), F.lit(0))
        pairs = (F.col("m") * F.col("n")).cast(PRODUCT)
        equal = F.coalesce(F.sum(F.when(~c.isin(TOTAL, _ROW), pairs)), F.lit(0))
        return counted.groupBy(*kc, "matches").agg(
            of(TOTAL, F.col("m")).alias("m"), of(TOTAL, F.col("n")).alias("n"),
            of(_ROW, (F.col("m") > 0).cast("long")).alias("new_l"),
            of(_ROW, (F.col("n") > 0).cast("long")).alias("new_r"),
            (of(TOTAL, pairs) * F.lit(len(rs.compare)) - equal).cast(PRODUCT).alias("cells"))

    out = per_key(cold)
    return _figures(out if hot is None else out.unionByName(per_key(hot)))


def ordinal_figures(left: DataFrame, right: DataFrame, rs: Resolved, mode: str) -> DataFrame | None:
    """Ordinal pairing; ``None`` where the one-pass plan does not apply: hot keys,
    or an order that does not bring rows with equal compared cells together."""
    if rs.order[:len(rs.compare)] != rs.compare or not rs.compare:
        return None
    cols = list(dict.fromkeys([*rs.keys, *rs.compare, *rs.order]))
    ra = right_aligned(right, rs, cols)
    lt = {c: left.schema[c].dataType for c in cols}
    rt = {c: ra.schema[c].dataType for c in cols}
    tagged = left.select(*[in_common(left[c], lt[c], rt[c]).alias(c) for c in cols],
                         F.lit(0).alias(SIDE)).unionByName(
        ra.select(*[in_common(ra[c], rt[c], lt[c]).alias(c) for c in cols], F.lit(1).alias(SIDE)))
    no_null = all_of([tagged[k].isNotNull() for k in rs.keys])
    keyed = tagged.filter(no_null)
    hot, count = hot_keys_and_rows(keyed, rs.keys, [SIDE])
    if hot is not None:
        return None
    keyed = spread(keyed, rs.keys, count)
    types = {c: tagged.schema[c].dataType for c in cols}
    numbered = side_ordinals(keyed, rs.keys, rs.order, "rn", SIDE)
    # equal rows stand together in the order that numbered them
    content = F.struct(*[comparable(F.col(c), types[c]).alias(c) for c in rs.compare])
    same_order = Window.partitionBy(*rs.keys).orderBy(SIDE, "rn")
    before = F.lag(F.struct(F.col(SIDE).alias("s"), content.alias("r"))).over(same_order)
    new = ~F.coalesce(before.eqNullSafe(F.struct(F.col(SIDE).alias("s"), content.alias("r"))),
                      F.lit(False))
    rows = numbered.withColumn("new", new.cast("long"))
    side = F.col(SIDE)
    one = lambda s: F.first(F.when(side == s, F.struct("new", *rs.compare)),
                            ignorenulls=True)
    pairs = rows.groupBy(*rs.keys, "rn").agg(one(0).alias("a"), one(1).alias("b"))
    flat = pairs.select(*rs.keys, F.col("a").isNotNull().alias("in_l"),
                        F.col("b").isNotNull().alias("in_r"), F.col("a.new").alias("new_l"),
                        F.col("b.new").alias("new_r"),
                        *[F.col("a")[c].alias(lcol(c)) for c in rs.compare],
                        *[F.col("b")[c].alias(rcol(c)) for c in rs.compare])
    cell = "sentinel" if mode == "sentinel" else "safe"
    differing = sum((cell_differs(flat, rs, c, cell).cast("long") for c in rs.compare), F.lit(0))
    counts = F.col("in_l") & F.col("in_r")
    if mode != "safe":
        counts = counts & row_differs(flat, rs, mode)
    per_key = flat.groupBy(*rs.keys).agg(
        F.sum(F.col("in_l").cast("long")).alias("m"), F.sum(F.col("in_r").cast("long")).alias("n"),
        F.sum("new_l").alias("new_l"), F.sum("new_r").alias("new_r"),
        F.sum(F.when(counts, differing).otherwise(0)).alias("cells"), F.lit(True).alias("matches"))
    # NULL keys match nothing: their distinct rows are all one-sided
    null_rows = tagged.filter(~no_null)
    plain = null_rows.select(SIDE, *[comparable(F.col(c), types[c]).alias(c)
                                     for c in dict.fromkeys(rs.keys + rs.compare)])
    null_keys = plain.groupBy(*plain.columns).agg(F.count(F.lit(1)).alias("rows")).select(
        F.when(side == 0, F.col("rows")).otherwise(0).alias("m"),
        F.when(side == 1, F.col("rows")).otherwise(0).alias("n"),
        (side == 0).cast("long").alias("new_l"), (side == 1).cast("long").alias("new_r"),
        F.lit(0).cast("long").alias("cells"), F.lit(False).alias("matches"))
    return _figures(per_key.drop(*rs.keys).unionByName(null_keys))
