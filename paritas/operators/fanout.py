"""All results of a run from one reading of both sides.

Both sides are tagged, united and clustered by key once.  Every key then gives
its share of every result (one-sided rows, count differences, cells, unmatched
ordinals) as rows tagged with the result's name: ``kind`` and one struct column
for each result, NULL in the rows of the others.  One write partitioned by
``kind`` thus stores a whole run, and an observation of the same job counts it.

Keys above the hot-key threshold are read a second time and kept in one
reliable checkpoint, from which the distributed plans (``ordinals``,
``cross``) make the same rows.  Sides with a column pair that no type holds
exactly have no fan-out (``None``): their results are separate plans.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import all_of, comparable
from ..session import require_checkpoint_dir
from ..spec import Resolved
from . import cross
from .cross import MARKS, SIDE
from .diff import explode_cells
from .match import _union_types, lcol, rcol, right_aligned, row_differs
from .ordinals import hot_keys_and_rows, range_ordinals, spread, total_order

KIND = "kind"
LEFT_ROWS, RIGHT_ROWS = "__left_rows", "__right_rows"


@dataclass
class Results:
    """``frame``: the tagged rows; ``kinds``: each result's columns; ``rows``: the frame
    whose sums of ``LEFT_ROWS`` and ``RIGHT_ROWS`` are the totals of the sides (a part of
    ``frame``'s plan, to be observed by ``finish``); ``more``: totals read separately."""

    kinds: dict[str, T.StructType]
    rows: DataFrame
    finish: Callable[[DataFrame], DataFrame]
    more: list[DataFrame] = field(default_factory=list)

    @property
    def frame(self) -> DataFrame:
        return self.finish(self.rows)

    def of(self, frame: DataFrame, kind: str) -> DataFrame:
        """One result's rows in its own columns."""
        return frame.filter(F.col(KIND) == kind).select(f"{kind}.*")


def _struct(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(c, t, True) for c, t in columns.items()])


def _entry(kinds: dict[str, T.StructType], kind: str, value: Column) -> Column:
    return F.struct(F.lit(kind).alias(KIND), *[
        (value.cast(t) if k == kind else F.lit(None).cast(t)).alias(k) for k, t in kinds.items()])


def _some(*entries: Column) -> Column:
    """The entries that are not NULL."""
    return F.filter(F.array(*entries), lambda x: x.isNotNull())


def _no_null(rs: Resolved) -> Column:
    return all_of([F.col(k).isNotNull() for k in rs.keys])


def _kinds(rs: Resolved, keys: dict, lt: dict, rt: dict) -> dict[str, T.StructType]:
    """The results that both pairings have."""
    ln, rn_ = rs.spec.left_name, rs.spec.right_name
    own = rs.keys + rs.compare
    counts = {f"{ln}_count": T.LongType(), f"{rn_}_count": T.LongType(),
              "count_difference": T.LongType(), "difference_type": T.StringType()}
    return {"left_only": _struct({c: lt[c] for c in own}),
            "right_only": _struct({c: rt[c] for c in own}),
            "count_differences": _struct(keys | counts)}


def _count_difference(rs: Resolved, m: Column, n: Column) -> Column:
    ln, rn_ = rs.spec.left_name.upper(), rs.spec.right_name.upper()
    return F.struct(*[F.col(k) for k in rs.keys], m, n, F.abs(m - n), F.when(
        m > n, F.lit(f"MORE_IN_{ln}")).otherwise(F.lit(f"MORE_IN_{rn_}")))


def _sums(rows: DataFrame, left: Column, right: Column) -> DataFrame:
    return rows.withColumns({LEFT_ROWS: left.cast("long"), RIGHT_ROWS: right.cast("long")})


def _split_hot(tagged: DataFrame, hot: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    named = hot.toDF(*[f"__h{i}" for i in range(len(by))])
    same = all_of([tagged[c].eqNullSafe(named[f"__h{i}"]) for i, c in enumerate(by)])
    return tagged.join(named, same, "left_anti"), tagged.join(named, same, "left_semi")


def ordinal_results(left: DataFrame, right: DataFrame, rs: Resolved,
                    mode: str | None = None) -> Results | None:
    """Ordinal pairing: ``left_only, right_only, count_differences, mismatches,
    unmatched_ordinals``."""
    mode = mode or rs.spec.null_mode
    cols = rs.carried
    types = _union_types(left, right, rs, cols)
    if types is None:
        return None
    ra = right_aligned(right, rs, cols)
    lt = {c: left.schema[c].dataType for c in cols}
    rt = {c: ra.schema[c].dataType for c in cols}
    tagged = left.select(*[F.col(c).cast(types[c]).alias(c) for c in cols], F.lit(0).alias(SIDE)) \
        .unionByName(ra.select(*[F.col(c).cast(types[c]).alias(c) for c in cols],
                               F.lit(1).alias(SIDE)))
    # NULL keys match nothing: their rows are spread by content, which still
    # brings equal rows together
    hashed = [F.to_json(F.array_sort(F.map_entries(c))) if isinstance(types[c], T.MapType)
              else F.col(c) for c in rs.keys + rs.compare]
    tagged = tagged.withColumn("__s", F.when(_no_null(rs), F.lit(0).cast("long"))
                               .otherwise(F.xxhash64(*hashed)))
    part = [*rs.keys, "__s"]
    ln, rn_ = rs.spec.left_name, rs.spec.right_name
    keys = {k: types[k] for k in rs.keys}
    text, long = T.StringType(), T.LongType()
    kinds = _kinds(rs, keys, lt, rt) | {
        "mismatches": _struct(keys | {c: lt[c] for c in rs.output if c not in rs.keys} | {
            f"{ln}_row_number": long, f"{rn_}_row_number": long, "mismatch_column": text,
            "left_value": text, "right_value": text}),
        "unmatched_ordinals": _struct(keys | {"rn": long, "type": text})}

    def content() -> Column:
        return F.struct(*[comparable(F.col(c), types[c]).alias(c) for c in rs.compare]) \
            if rs.compare else F.lit(0)

    def numbered(rows: DataFrame) -> DataFrame:
        side = F.col(SIDE)
        w = Window.partitionBy(*part).orderBy(
            side.asc(), *total_order(rows, [*part, SIDE], rs.order))
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        m = F.sum(F.when(side == 0, 1).otherwise(0)).over(whole)
        n = F.sum(F.when(side == 1, 1).otherwise(0)).over(whole)
        if rs.order[:len(rs.compare)] == rs.compare:  # equal rows stand together
            here = F.struct(side.alias("s"), content().alias("r"))
            new = ~F.coalesce(F.lag(here).over(w).eqNullSafe(here), F.lit(False))
        else:
            new = F.row_number().over(
                Window.partitionBy(*part, SIDE, content()).orderBy(F.lit(0))) == 1
        rn = F.row_number().over(w) - F.when(side == 1, m).otherwise(0)
        return rows.select("*", m.alias("__m"), n.alias("__n"),
                           rn.cast("long").alias("rn"), new.alias("__new"))

    def paired(rows: DataFrame) -> DataFrame:
        nonkey = [c for c in cols if c not in rs.keys]
        one = lambda s: F.first(F.when(F.col(SIDE) == s, F.struct("__new", *nonkey)),
                                ignorenulls=True)
        g = rows.groupBy(*part, "rn", "__m", "__n").agg(one(0).alias("__a"), one(1).alias("__b"))
        has_l, has_r = F.col("__a").isNotNull(), F.col("__b").isNotNull()
        flat = g.select(
            *rs.keys, "rn", "__m", "__n", has_l.alias("__l"), has_r.alias("__r"),
            F.col("__a")["__new"].alias("__new_l"), F.col("__b")["__new"].alias("__new_r"),
            *[F.when(has_l, F.col(k)).cast(lt[k]).alias(lcol(k)) for k in rs.keys],
            *[F.col("__a")[c].cast(lt[c]).alias(lcol(c)) for c in nonkey],
            *[F.when(has_r, F.col(k)).cast(rt[k]).alias(rcol(k)) for k in rs.keys],
            *[F.col("__b")[c].cast(rt[c]).alias(rcol(c)) for c in nonkey])
        return _sums(flat, F.col("__l"), F.col("__r"))

    def entries(flat: DataFrame) -> DataFrame:
        m, n, rn, match = F.col("__m"), F.col("__n"), F.col("rn"), _no_null(rs)
        in_l, in_r = F.col("__l"), F.col("__r")
        own = rs.keys + rs.compare
        single = _some(
            F.when(in_l & F.col("__new_l") & (~match | (n == 0)), _entry(
                kinds, "left_only", F.struct(*[F.col(lcol(c)) for c in own]))),
            F.when(in_r & F.col("__new_r") & (~match | (m == 0)), _entry(
                kinds, "right_only", F.struct(*[F.col(rcol(c)) for c in own]))),
            F.when(match & (rn == 1) & (m != n), _entry(
                kinds, "count_differences", _count_difference(rs, m, n))),
            F.when(match & ~(in_l & in_r), _entry(kinds, "unmatched_ordinals", F.struct(
                *rs.keys, "rn", F.when(in_l, F.lit(f"missing_in_{rn_}"))
                .otherwise(F.lit(f"missing_in_{ln}"))))))
        picked = match & in_l & in_r
        if mode != "safe":
            picked = picked & row_differs(flat, rs, mode)
        reported = [*rs.keys, *[lcol(c) for c in rs.output if c not in rs.keys]]
        cells = F.transform(explode_cells(flat, rs, mode), lambda x: _entry(
            kinds, "mismatches", F.struct(*reported, rn, rn, x["mismatch_column"], x["left_value"],
                                          x["right_value"])))
        return flat.select(F.inline(F.concat(single, F.when(picked, cells).otherwise(
            F.array().cast(T.ArrayType(_entry_type(kinds)))))))

    hot, count = hot_keys_and_rows(tagged, part, [SIDE])
    if hot is None:
        return Results(kinds, paired(numbered(spread(tagged, part, count))), entries)
    cold, _ = _split_hot(tagged.filter(_no_null(rs)), hot, part)
    _, warm = _split_hot(tagged.filter(_no_null(rs)), hot, part)
    # numbered once, in a checkpoint; rows with a NULL key are only made distinct
    rows = range_ordinals(warm, part, rs.order, "rn", [SIDE])
    side = F.col(SIDE)
    counts = rows.groupBy(*part).agg(F.sum(F.when(side == 0, 1).otherwise(0)).alias("__m"),
                                     F.sum(F.when(side == 1, 1).otherwise(0)).alias("__n"))
    rows = rows.join(counts, part).withColumn("__new", F.lit(False))
    lone = rows.filter(F.when(side == 0, F.col("__n")).otherwise(F.col("__m")) == 0)
    null_rows = tagged.filter(~_no_null(rs))
    single = _one_sided(lone.select(SIDE, *rs.keys, *rs.compare).unionByName(
        null_rows.select(SIDE, *rs.keys, *rs.compare)), rs, kinds, types)
    more = [part_.groupBy().agg(
        F.coalesce(F.sum((side == 0).cast("long")), F.lit(0)).alias(LEFT_ROWS),
        F.coalesce(F.sum((side == 1).cast("long")), F.lit(0)).alias(RIGHT_ROWS))
        for part_ in (rows, null_rows)]
    warm_entries = entries(paired(rows))
    return Results(kinds, paired(numbered(spread(cold, part, count))),
                   lambda flat: entries(flat).unionByName(warm_entries).unionByName(single), more)


def _entry_type(kinds: dict[str, T.StructType]) -> T.StructType:
    return T.StructType([T.StructField(KIND, T.StringType(), False),
                         *[T.StructField(k, t, True) for k, t in kinds.items()]])


def _one_sided(rows: DataFrame, rs: Resolved, kinds: dict, types: dict) -> DataFrame:
    """Distinct one-sided rows (``SIDE``, keys and compared columns) as entries."""
    own = rs.keys + rs.compare
    maps = {c for c in own if isinstance(types[c], T.MapType)}
    by = [comparable(F.col(c), types[c]).alias(f"__g{i}") for i, c in enumerate(own)]
    one = rows.groupBy(SIDE, *by).agg(*[F.first(c).alias(c) for c in own]) if maps else rows.distinct()
    value = F.struct(*[F.col(c) for c in own])
    return one.select(F.inline(_some(
        F.when(F.col(SIDE) == 0, _entry(kinds, "left_only", value)),
        F.when(F.col(SIDE) == 1, _entry(kinds, "right_only", value)))))


def cross_results(left: DataFrame, right: DataFrame, rs: Resolved, mode: str | None = None,
                  count_differences: bool = False) -> Results | None:
    """Cross pairing: ``left_only, right_only, mismatches`` and, if asked for,
    ``count_differences``."""
    mode = mode or rs.spec.null_mode
    own = rs.keys + rs.compare
    cols = list(dict.fromkeys(rs.keys + rs.output + rs.compare))
    types = _union_types(left, right, rs, own)
    if types is None or any(isinstance(left.schema[c].dataType, T.MapType) for c in cols):
        return None
    lt = {c: left.schema[c].dataType for c in cols}
    rt = {c: right.schema[rs.rcol(c)].dataType for c in own}
    kinds = _kinds(rs, {k: types[k] for k in rs.keys}, lt, rt)
    if not count_differences:
        del kinds["count_differences"]
    text, long = T.StringType(), T.LongType()
    reported = {c: types.get(c, lt[c]) for c in rs.output}
    kinds["mismatches"] = _struct(reported | {
        "mismatch_column": text, "left_value": text, "left_rows": long, "right_rows": long,
        "differing_partners": long})
    mixed = mode == "mixed"
    values = cross.own_types(left, rs)
    cold, hot, kc = cross._split(cross._tagged(left, right, rs, mode, cols), rs)
    side, match = F.col(SIDE), _no_null(rs)

    # rows whose keys match by plain equality: the sentinel rule puts others beside them
    w = Window.partitionBy(*kc)
    per_key = [F.sum(F.when((side == s) & match, 1).otherwise(0)).over(w).alias(f"__p{s}")
               for s in (0, 1)]
    rows = cross.clustered(cold, kc, rs, cross._cell_mode(mode)).select("*", *per_key)
    g = cross._grouped(rows, kc, rs, ["__m", "__n", "__p0", "__p1", cross.VARY])
    by = list(dict.fromkeys([*kc, SIDE, *own]))
    first = F.lit(True) if set(rs.output) <= set(own) else F.row_number().over(
        Window.partitionBy(*by).orderBy(F.lit(0))) == 1
    once = F.row_number().over(Window.partitionBy(*kc).orderBy(match.desc())) == 1
    g = g.select("*", first.alias("__first"), *[once.alias("__once")] * count_differences)
    g = _sums(g, F.when(side == 0, F.col("__k")).otherwise(0),
              F.when(side == 1, F.col("__k")).otherwise(0))
    keep = list(dict.fromkeys([*kc, *rs.output]))
    plain = {k: t for k, t in kinds.items() if k != "mismatches"}
    cell_fields = ["column_name", "left_value", "__v", *MARKS * mixed]

    def entry(kind: str, value: Column | None, x: Column | None) -> Column:
        return F.struct(
            F.lit(kind).alias(KIND),
            *[(x[f] if x is not None else F.lit(None).cast(
                "boolean" if f == MARKS[1] else "string")).alias(f) for f in cell_fields],
            *[(value.cast(t) if k == kind else F.lit(None).cast(t)).alias(k)
              for k, t in plain.items()])

    def finish(g: DataFrame) -> DataFrame:
        value = F.struct(*[F.col(c) for c in own])
        m, n = F.col("__p0"), F.col("__p1")
        single = [F.when((side == 0) & F.col("__first") & (~match | (n == 0)),
                         entry("left_only", value, None)),
                  F.when((side == 1) & F.col("__first") & (~match | (m == 0)),
                         entry("right_only", value, None))]
        if count_differences:
            single.append(F.when(F.col("__once") & match & (m != n), entry(
                "count_differences", _count_difference(rs, m, n), None)))
        cells = F.transform(
            cross._cells(g, rs, mode, left_values=True, own=values, marks=mixed, varied=True),
            lambda x: entry("mismatches", None, x))
        both = (F.col("__m") > 0) & (F.col("__n") > 0)
        st = g.select(*keep, SIDE, "__n", "__k", F.inline(F.concat(
            _some(*single), F.filter(cells, lambda x: both))))
        diff = F.col("__n") - cross._partners([*kc, "column_name", "__v"])
        if mixed:
            diff = diff - F.coalesce(F.when(F.col(MARKS[0]).isNotNull(), cross._partners(
                [*kc, "column_name", *MARKS])), F.lit(0))
        out = st.withColumn("__d", diff).filter(
            (F.col(KIND) != "mismatches") | ((side == 0) & (F.col("__d") > 0)))
        if mixed or not set(rs.compare) <= set(rs.output):
            out = out.groupBy(*keep, KIND, "column_name", "left_value", "__n", "__d", *plain).agg(
                F.sum("__k").alias("__k"))
        cell = F.struct(*rs.output, "column_name", "left_value", "__k", "__n", "__d")
        return out.select(KIND, *plain, F.when(F.col(KIND) == "mismatches", cell)
                          .cast(kinds["mismatches"]).alias("mismatches"))

    if hot is None:
        return Results(kinds, g, finish)
    require_checkpoint_dir(hot.sparkSession)
    hot = hot.checkpoint(eager=True)
    h, hk = cross._encoded(hot, rs, mode)
    reports = cross._cell_rows_hot(h, hk, rs, mode, values)
    warm = reports.select(F.inline(F.array(_entry(kinds, "mismatches", F.struct(*reports.columns)))))
    counts = h.groupBy(*hk).agg(*[F.sum(F.when((side == s) & match, 1).otherwise(0))
                                  .alias(f"__p{s}") for s in (0, 1)])
    rows_ = h.join(counts, hk)
    lone = rows_.filter(~match | (F.when(side == 0, F.col("__p1")).otherwise(F.col("__p0")) == 0))
    warm = warm.unionByName(_one_sided(lone.select(SIDE, *own), rs, kinds, types))
    if count_differences:
        one = h.filter(match).groupBy(*hk).agg(*[F.first(k).alias(k) for k in rs.keys])
        m, n = F.col("__p0"), F.col("__p1")
        warm = warm.unionByName(one.join(counts, hk).filter(m != n).select(F.inline(F.array(
            _entry(kinds, "count_differences", _count_difference(rs, m, n))))))
    more = [hot.groupBy().agg(F.sum((side == 0).cast("long")).alias(LEFT_ROWS),
                              F.sum((side == 1).cast("long")).alias(RIGHT_ROWS))]
    return Results(kinds, g, lambda x: finish(x).unionByName(warm), more)
