"""Matching two sides on a key: one-sided rows, ordinal pairs, full-outer classification.

Conventions for the *pair frame* returned by ``ordinal_pairs``:
``keys`` (left spelling), ``rn``, then ``__l_<c>`` / ``__r_<c>`` for every
reported column and the presence flags ``__l`` / ``__r``.  All joins are
equi-joins (hash / sort-merge / broadcast chosen by Catalyst and AQE); none is
a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import all_of, any_of, comparable, differs, exact_type, in_common
from ..spec import Resolved
from .ordinals import with_ordinals

L, R = "__l_", "__r_"


def lcol(c: str) -> str:
    return L + c


def rcol(c: str) -> str:
    return R + c


def right_aligned(right: DataFrame, rs: Resolved, cols: list[str]) -> DataFrame:
    """Right side projected to ``cols`` under the left side's spelling."""
    return right.select(*[right[rs.rcol(c)].alias(c) for c in cols])


def key_not_null(df: DataFrame, keys: list[str]) -> Column:
    return all_of([df[k].isNotNull() for k in keys])


def one_sided(left: DataFrame, right: DataFrame, rs: Resolved, side: str = "left",
              cols: list[str] | None = None, distinct: bool = False) -> DataFrame:
    """Rows of one side whose key has no equal key on the other side.

    Plain equality, so a NULL key never matches and every NULL-key row is
    reported exactly once.  Written as ``left_anti`` (Catalyst does not turn
    an outer join + IS NULL into an anti join).
    """
    cols = cols or rs.keys + rs.compare
    if side == "left":
        this, other = left.select(*cols), right_aligned(right, rs, rs.keys)
    else:
        this, other = right_aligned(right, rs, cols), left.select(*rs.keys)
    other = other.filter(key_not_null(other, rs.keys))
    # a NULL key never matches: those rows are one-sided by definition and skip
    # the join (shuffled by key they would all meet in one partition).  Nothing
    # stands between the shuffles and the join, so AQE can split a hot key.
    has_key = key_not_null(this, rs.keys)
    keyed, keyless = this.filter(has_key), this.filter(~has_key)
    cond = all_of(_same_keys(keyed, rs.keys, other, rs.keys))
    out = keyed.join(other, cond, "left_anti")
    if distinct:
        return distinct_rows(out).unionByName(distinct_rows(keyless))
    return out.unionByName(keyless)


def _same_keys(a: DataFrame, a_keys: list[str], b: DataFrame, b_keys: list[str]) -> list[Column]:
    """Equality of two frames' keys in their common exact form."""
    out = []
    for x, y in zip(a_keys, b_keys):
        s, t = a.schema[x].dataType, b.schema[y].dataType
        out.append(in_common(a[x], s, t) == in_common(b[y], t, s))
    return out


def distinct_rows(df: DataFrame) -> DataFrame:
    """``distinct()``, also for frames with map columns (which set operations
    reject): the same aggregate written as a group-by over every column."""
    if not any(isinstance(f.dataType, T.MapType) for f in df.schema.fields):
        return df.distinct()
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n")).drop("__n")


def restrict_keys(df: DataFrame, keys_df: DataFrame, keys: list[str],
                  df_keys: list[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose key (``df_keys``, default ``keys``) is one of the
    ``keys`` rows of ``keys_df`` (a semi-join).  NULL keys never match: they are
    dropped before the shuffle instead of all meeting in one partition.  Key
    types that cannot be compared directly are matched through text."""
    df_keys = df_keys or keys
    named = [f"__q{i}" for i in range(len(keys))]
    wanted = keys_df.select(*[F.col(k).alias(q) for k, q in zip(keys, named)])
    return df.filter(key_not_null(df, df_keys)).join(
        wanted, all_of(_same_keys(df, df_keys, wanted, named)), "left_semi")


def asked_keys(keys_df: DataFrame, keys: list[str], types: dict[str, T.DataType],
               names: list[str]) -> DataFrame:
    """``keys_df`` with its keys also in a table's ``types`` under ``names``: NULL, which
    matches nothing, where the table's type does not hold the asked value exactly
    (2.5 asked of whole numbers, a text that is no number)."""
    def exactly(k: str) -> Column:
        source, target = keys_df.schema[k].dataType, types[k]
        if source == target:
            return F.col(k)
        there = F.col(k).try_cast(target)
        return F.when(in_common(there, target, source) == in_common(F.col(k), source, target), there)

    return keys_df.select("*", *[exactly(k).alias(n) for k, n in zip(keys, names)])


def numbered(df: DataFrame, rs: Resolved, cols: list[str], rn: str = "rn") -> DataFrame:
    """Non-null-key rows of one side (already aligned to left spelling) with ``rn``."""
    base = df.filter(key_not_null(df, rs.keys)).select(*cols)
    return with_ordinals(base, rs.keys, rs.order, rn)


def key_columns(df: DataFrame, other: DataFrame, keys: list[str]) -> list[Column]:
    """``df``'s key columns in the type shared with ``other`` (same names), for
    unions of both sides' keys: text when no type holds both exactly."""
    return [in_common(df[k], df.schema[k].dataType, other.schema[k].dataType).alias(k)
            for k in keys]


def _union_types(left: DataFrame, right: DataFrame, rs: Resolved, cols: list[str]):
    """Per column: the type that holds both sides exactly (values survive the
    way there and back), or ``None`` when some column pair has none."""
    lt = {f.name: f.dataType for f in left.schema.fields}
    rt = {f.name: f.dataType for f in right.schema.fields}
    out = {c: exact_type(lt[c], rt[rs.rcol(c)]) for c in cols}
    return None if None in out.values() else out


def _unpaired(df: DataFrame, rs: Resolved, cols: list[str], types: dict, side: str) -> DataFrame:
    """NULL-key rows of one side in pair-frame shape (never paired)."""
    mine, other = (lcol, rcol) if side == "l" else (rcol, lcol)
    base = df.filter(~key_not_null(df, rs.keys))
    return base.select(
        *[F.col(k).cast(types[k]).alias(k) for k in rs.keys], F.lit(None).cast("long").alias("rn"),
        *[F.col(c).cast(types[c]).alias(mine(c)) for c in cols],
        *[F.lit(None).cast(types[c]).alias(other(c)) for c in cols],
        F.lit(side == "l").alias("__l"), F.lit(side == "r").alias("__r"))


def ordinal_pairs(left: DataFrame, right: DataFrame, rs: Resolved, how: str = "inner",
                  null_keys: bool = False, keys_df: DataFrame | None = None) -> DataFrame:
    """Pair the i-th occurrence of a key on the left with the i-th on the right.

    ``how="full_outer"`` also yields unmatched ordinals (one flag false); with
    ``null_keys`` the NULL-key rows of both sides are added as unmatched rows
    (``rn`` NULL) - a NULL key never equals anything.

    Plan (one exchange for both sides): tag each side, union, hash-partition
    by key, number occurrences per (key, side) with a window, then group by
    (key, rn) and pick each side's row.  Both the window and the aggregate are
    satisfied by the hash-by-key partitioning, so neither adds a shuffle.  Hot
    keys are numbered by the range plan of ``ordinals`` instead.  Columns of
    types that one type holds exactly are widened for the union and narrowed
    back afterwards; other type differences use ``ordinal_pairs_join``.

    ``keys_df`` restricts the pairing to those keys with one semi-join of the
    tagged union; its hash-by-key output then serves the window and the
    aggregate, so no further exchange is added.
    """
    cols = rs.carried
    types = _union_types(left, right, rs, cols)
    if types is None:
        if keys_df is not None:
            left = restrict_keys(left, keys_df, rs.keys)
            right = restrict_keys(right, keys_df, rs.keys, [rs.rcol(k) for k in rs.keys])
        return ordinal_pairs_join(left, right, rs, how, null_keys)
    lt = {f.name: f.dataType for f in left.schema.fields}
    rt = {c: right.schema[rs.rcol(c)].dataType for c in cols}
    ra = right_aligned(right, rs, cols)

    def side_rows(df, tag):
        return df.filter(key_not_null(df, rs.keys)).select(
            *[F.col(c).cast(types[c]).alias(c) for c in cols], F.lit(tag).alias("__side"))

    tagged = side_rows(left, 0).unionByName(side_rows(ra, 1))
    if keys_df is not None:
        named = [f"__q{i}" for i in range(len(rs.keys))]
        wanted = asked_keys(keys_df, rs.keys, types, named).select(
            *[F.col(n).alias(k) for n, k in zip(named, rs.keys)])
        tagged = tagged.join(wanted.filter(key_not_null(wanted, rs.keys)), on=rs.keys,
                             how="left_semi")
    num = with_ordinals(tagged, rs.keys, rs.order, "rn", group=["__side"],
                        cold_partitioned=keys_df is None)
    nonkey = [c for c in cols if c not in rs.keys]
    side = F.col("__side")
    grouped = num.groupBy(*rs.keys, "rn").agg(
        F.first(F.when(side == 0, F.struct(*nonkey)), ignorenulls=True).alias("__ls"),
        F.first(F.when(side == 1, F.struct(*nonkey)), ignorenulls=True).alias("__rs"))
    has_l, has_r = F.col("__ls").isNotNull(), F.col("__rs").isNotNull()
    pairs = grouped.select(
        *rs.keys, "rn",
        *[F.when(has_l, F.col(k)).cast(lt[k]).alias(lcol(k)) for k in rs.keys],
        *[F.col("__ls")[c].cast(lt[c]).alias(lcol(c)) for c in nonkey],
        *[F.when(has_r, F.col(k)).cast(rt[k]).alias(rcol(k)) for k in rs.keys],
        *[F.col("__rs")[c].cast(rt[c]).alias(rcol(c)) for c in nonkey],
        has_l.alias("__l"), has_r.alias("__r"))
    if how == "inner":
        return pairs.filter(F.col("__l") & F.col("__r"))
    if null_keys:
        ptypes = {c: types[c] for c in cols}
        extra = (_unpaired(left, rs, cols, ptypes, "l")
                 .unionByName(_unpaired(ra, rs, cols, ptypes, "r")))
        pairs = pairs.unionByName(extra.select(*[F.col(c).cast(pairs.schema[c].dataType)
                                                 .alias(c) for c in pairs.columns]))
    return pairs


def ordinal_pairs_join(left: DataFrame, right: DataFrame, rs: Resolved,
                       how: str = "inner", null_keys: bool = False) -> DataFrame:
    """Ordinal pairing as number-each-side + equi-join on ``(key, rn)``."""
    cols = rs.carried
    ra = right_aligned(right, rs, cols)
    lnum = numbered(left, rs, cols)
    rnum = numbered(ra, rs, cols)
    # each side is numbered in its own types; keys are joined in their common form
    def key(df: DataFrame, other: DataFrame, k: str) -> Column:
        return in_common(df[k], df.schema[k].dataType, other.schema[k].dataType).alias(k)

    ls = lnum.select(*[key(lnum, rnum, k) for k in rs.keys], "rn",
                     *[F.col(c).alias(lcol(c)) for c in cols], F.lit(True).alias("__l"))
    rsd = rnum.select(*[key(rnum, lnum, k) for k in rs.keys], "rn",
                      *[F.col(c).alias(rcol(c)) for c in cols], F.lit(True).alias("__r"))
    pairs = ls.join(rsd, on=[*rs.keys, "rn"], how=how)
    if how != "inner":
        pairs = pairs.withColumn("__l", F.coalesce("__l", F.lit(False))) \
                     .withColumn("__r", F.coalesce("__r", F.lit(False)))
        if null_keys:
            lt = {c: pairs.schema[lcol(c)].dataType for c in cols}
            rt = {c: pairs.schema[rcol(c)].dataType for c in cols}
            lnull = left.filter(~key_not_null(left, rs.keys)).select(
                *[F.col(k).cast(pairs.schema[k].dataType) for k in rs.keys],
                F.lit(None).cast("long").alias("rn"),
                *[F.col(c).alias(lcol(c)) for c in cols],
                *[F.lit(None).cast(rt[c]).alias(rcol(c)) for c in cols],
                F.lit(True).alias("__l"), F.lit(False).alias("__r"))
            rnull = ra.filter(~key_not_null(ra, rs.keys)).select(
                *[F.col(k).cast(pairs.schema[k].dataType) for k in rs.keys],
                F.lit(None).cast("long").alias("rn"),
                *[F.lit(None).cast(lt[c]).alias(lcol(c)) for c in cols],
                *[F.col(c).alias(rcol(c)) for c in cols],
                F.lit(False).alias("__l"), F.lit(True).alias("__r"))
            pairs = pairs.unionByName(lnull).unionByName(rnull)
    return pairs


def cell_differs(pairs: DataFrame, rs: Resolved, c: str, mode: str) -> Column:
    lt = _dtype(pairs, lcol(c))
    rt = _dtype(pairs, rcol(c))
    return differs(F.col(lcol(c)), F.col(rcol(c)), mode, lt, rt)


def row_differs(pairs: DataFrame, rs: Resolved, mode: str) -> Column:
    row_mode = "sentinel" if mode in ("sentinel", "mixed") else "safe"
    return any_of([cell_differs(pairs, rs, c, row_mode) for c in rs.compare])


def _dtype(df: DataFrame, name: str):
    return df.schema[name].dataType


def changed_pairs(left: DataFrame, right: DataFrame, rs: Resolved,
                  mode: str | None = None) -> DataFrame:
    """Ordinal pairs with at least one differing compare cell, side-prefixed.

    Columns: reported columns (left values), ``rn``, then
    ``<left>_<c>`` / ``<right>_<c>`` for each compare column.
    """
    mode = mode or rs.spec.null_mode
    pairs = ordinal_pairs(left, right, rs)
    ln, rn_ = rs.spec.left_name, rs.spec.right_name
    return pairs.filter(row_differs(pairs, rs, mode)).select(
        *[F.col(k) for k in rs.keys],
        *[F.col(lcol(c)).alias(c) for c in rs.output if c not in rs.keys],
        F.col("rn"),
        *[x for c in rs.compare for x in (F.col(lcol(c)).alias(f"{ln}_{c}"),
                                          F.col(rcol(c)).alias(f"{rn_}_{c}"))])


def unmatched_ordinals(left: DataFrame, right: DataFrame, rs: Resolved) -> DataFrame:
    """Occurrences that have no partner with the same ordinal on the other side."""
    return unmatched_of_pairs(ordinal_pairs(left, right, rs, how="full_outer"), rs)


def unmatched_of_pairs(pairs: DataFrame, rs: Resolved) -> DataFrame:
    """``unmatched_ordinals`` from an (outer) ordinal pair frame."""
    ln, rn_ = rs.spec.left_name, rs.spec.right_name
    return pairs.filter(~(F.col("__l") & F.col("__r"))).select(
        *rs.keys, "rn",
        F.when(F.col("__l"), F.lit(f"missing_in_{rn_}")).otherwise(F.lit(f"missing_in_{ln}"))
        .alias("type"))


def generic_pairs(left: DataFrame, right: DataFrame, rs: Resolved) -> DataFrame:
    """Pair frame for the generic (unique-key) family: ordinal pairing, full
    outer, NULL-key rows kept as one-sided.  For a unique key this is exactly
    the full outer join on the key; a key that repeats is paired by occurrence
    instead of multiplying into m x n rows."""
    return ordinal_pairs(left, right, rs, how="full_outer", null_keys=True)


def full_outer_classified(left: DataFrame, right: DataFrame, rs: Resolved,
                          mode: str = "safe", frame: DataFrame | None = None) -> DataFrame:
    """Every differing key once with ``status`` CHANGED / LEFT_ONLY / RIGHT_ONLY
    (unchanged keys dropped).  Presence is tracked with explicit flags, not by
    testing a key column for NULL.  ``frame``: ready ``generic_pairs`` rows
    (a superset of the differing ones)."""
    j = frame if frame is not None else generic_pairs(left, right, rs)
    changed = any_of([cell_differs(j, rs, c, mode) for c in rs.compare])
    status = (F.when(F.col("__l") & F.col("__r") & changed, F.lit("CHANGED"))
              .when(F.col("__l") & ~F.col("__r"), F.lit("LEFT_ONLY"))
              .when(~F.col("__l") & F.col("__r"), F.lit("RIGHT_ONLY")))
    return j.withColumn("status", status).filter(F.col("status").isNotNull())


def matched_changed(left: DataFrame, right: DataFrame, rs: Resolved, mode: str = "safe",
                    left_prefix: str = "t1_", right_prefix: str = "t2_") -> DataFrame:
    """Matched rows where any compare cell differs (typed, null-safe)."""
    j = ordinal_pairs(left, right, rs, how="inner")
    return j.filter(any_of([cell_differs(j, rs, c, mode) for c in rs.compare])).select(
        *rs.keys,
        *[F.col(lcol(c)).alias(left_prefix + c) for c in rs.compare],
        *[F.col(rcol(c)).alias(right_prefix + c) for c in rs.compare])


_REPEAT_CHUNK = 4096


def keyless_diff(left: DataFrame, right: DataFrame, cols: list[str],
                 left_name: str = "left", right_name: str = "right",
                 right_cols: list[str] | None = None) -> DataFrame:
    """Multiset difference both ways over ``cols`` (``EXCEPT ALL`` each way),
    tagged by side.

    One aggregate instead of two ``exceptAll``: the sides are tagged, unioned
    and grouped by every column (NULLs group together) with a row count per
    side, so both inputs are shuffled once; identical rows combine map-side.
    A row occurring ``d`` more times on one side is emitted ``d`` times by
    nested explodes of at most ``_REPEAT_CHUNK`` elements; a surplus above
    ``_REPEAT_CHUNK ** 2`` rows is first cut into blocks of that size, spread
    over tasks, so neither a generated array nor one task's output grows
    with ``d``.
    """
    right_cols = right_cols or cols
    lt = {c: left.schema[c].dataType for c in cols}
    rt = {c: right.schema[rc].dataType for c, rc in zip(cols, right_cols)}
    l = left.select(*[in_common(left[c], lt[c], rt[c]).alias(c) for c in cols],
                    F.lit(1).alias("__nl"), F.lit(0).alias("__nr"))
    r = right.select(*[in_common(right[rc], rt[c], lt[c]).alias(c)
                       for c, rc in zip(cols, right_cols)],
                     F.lit(0).alias("__nl"), F.lit(1).alias("__nr"))
    ltypes = {c: l.schema[c].dataType for c in cols}
    # maps cannot be grouped: group by their sorted entries and carry one of
    # the (equal) maps
    maps = [c for c in cols if isinstance(ltypes[c], T.MapType)]
    u = l.unionByName(r)
    u = u.select(*u.columns, *[comparable(F.col(c), ltypes[c]).alias(f"__m_{c}") for c in maps])
    group = [f"__m_{c}" if c in maps else c for c in cols]
    g = u.groupBy(*group).agg(
        (F.sum("__nl") - F.sum("__nr")).cast("long").alias("__d"),
        *[F.first(c).alias(c) for c in maps]).filter(F.col("__d") != 0).select(*cols, "__d")
    d = F.abs(F.col("__d"))
    k = _REPEAT_CHUNK
    block = F.lit(k * k).cast("long")
    side = F.when(F.col("__d") > 0, F.lit(left_name)).otherwise(F.lit(right_name)).alias("side")
    # surpluses of at most one block (k * k rows) are emitted where they are
    small = _repeat(g.filter(d <= block).select(side, *cols, d.alias("__n")), cols, k)
    # larger ones: one row per block, spread over tasks before emission, so a
    # row repeated a third of the table long is not emitted by one task
    blocks = g.filter(d > block).select(
        side, *cols, d.alias("__t"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((d - 1) / block).cast("long")))
        .alias("__b")).repartition("side", "__b")
    big = _repeat(blocks.select("side", *cols, F.least(block, F.col("__t") - F.col("__b") * block)
                                .alias("__n")), cols, k)
    return small.unionByName(big)


def _repeat(df: DataFrame, cols: list[str], k: int) -> DataFrame:
    """``side, cols`` repeated ``__n`` (at most k * k) times by two explodes of
    at most ``k`` elements each."""
    kk = F.lit(k).cast("long")
    chunks = df.select("side", *cols, "__n", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / kk).cast("long"))).alias("__c"))
    size = F.least(kk, F.col("__n") - F.col("__c") * kk)
    return chunks.select("side", *cols, F.explode(F.sequence(F.lit(1).cast("long"), size))
                         .alias("__i")).drop("__i")
