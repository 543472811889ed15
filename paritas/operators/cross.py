"""Cross pairing (every left occurrence of a key with every right occurrence)
computed from value frequencies, never by materialising the m x n pairs.

For a key k with m_k left and n_k right rows, and a compare column c:

    pairs(k)                 = m_k * n_k
    pairs equal on c (k)     = sum over values v of  m_{k,c,v} * n_{k,c,v}
    pairs differing on c (k) = pairs(k) - pairs equal on c (k)

so every cross-pairing figure the reference reports (total matches,
mismatched cells per column, differing pairs) comes from *aggregated*
frequency tables.  A hot key costs one frequency row per distinct value, not
m_k * n_k output rows.  Row-level reports keep the left rows and carry, for
each, how many right partners differ (``differing_partners``) instead of
listing the partners.

Plan: both sides are tagged, united and clustered by key once (a window by
key; inputs bucketed by the key are not shuffled).  The same window tells, for
each compared column, whether the key's rows hold more than one value: where
they do not, no pair differs and the column gives no cells for that key.  Only
the others are stacked, and a window by (key, column, value) on the same
clustering counts each value's partners, so nothing is shuffled again.  Keys
above the hot-key threshold (``ordinals``) would make a window's partition one
task; their rows take frequency tables instead: aggregates with a map-side
partial step and salted lookups of the counts.

Keys match null-safely (NULL with NULL), as the reference's sentinel key
join does; under ``null_mode="sentinel"`` keys and values are compared as
``coalesce(cast(x as string), 'NULL')``.

Under ``null_mode="mixed"`` keys match and pairs are picked by the sentinel
rule and the cells of the picked pairs compared null-safely.  By inclusion and
exclusion, the partners that differ on c are all that differ null-safely on c
less those among them whose *whole row* of sentinel texts is the same (those
pairs are not picked).  Equal sentinel texts of different values are NULL and
the text 'NULL' alone, so the second count is that of the partners with the
same row texts and the other one of these two on c: one more frequency table,
by (key, row texts, column), of the few cells that are NULL or 'NULL'.

For the lookups of hot keys, keys and values are encoded as a null flag plus
a non-null value (keys keep their type, with a typed default standing in for
NULL; values become lossless text), so each join is a plain equi-join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (SENTINEL, all_of, in_common, lossless_text, own_text,
                         sentinel_text, struct_array)
from ..spec import Resolved
from .ordinals import hot_keys_and_rows, hot_rows_setting, spread

TOTAL = "__total__"
#: Products of row counts: two counts of 18 digits always fit.
COUNT, PRODUCT = "decimal(18,0)", "decimal(38,0)"
#: Copies of a hot key's value counts, so that its rows are looked up by many tasks.
SALTS = 16
#: Rows of a key (both sides) that windows over its stacked cells hold in one task,
#: and sampled rows by which a key of so many is found.
WINDOW_ROWS, WINDOW_SAMPLE = 50_000, 400
#: Compared columns of a wide table, and rows of a key (both sides) whose cells are
#: compared with each other there (a bit of an int for each row).
WIDE_COLUMNS, FEW_ROWS = 16, 12


def _mode(rs: Resolved, mode: str | None) -> str:
    return mode or rs.spec.null_mode


def _cell_mode(mode: str) -> str:
    return "sentinel" if mode == "sentinel" else "safe"


def _row_mode(mode: str) -> str:
    """The rule by which keys match and rows are picked."""
    return "safe" if mode == "safe" else "sentinel"


def encode(df: DataFrame, c: str, mode: str) -> Column:
    """Non-null comparison text of a cell: equal texts <=> equal cells under the mode
    (the ``mixed`` rule compares cells null-safely)."""
    if mode == "sentinel":
        return sentinel_text(df[c], df.schema[c].dataType)
    return F.when(df[c].isNull(), F.lit("n")).otherwise(
        F.concat(F.lit("v"), lossless_text(df[c], df.schema[c].dataType)))


def _typed_default(dtype: T.DataType):
    if isinstance(dtype, (T.NumericType,)):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.DateType):
        return F.lit(dt.date(1970, 1, 1))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.lit(dt.datetime(1970, 1, 1)).cast(dtype)
    return None


def encode_key(df: DataFrame, k: str, mode: str, name: str) -> list[Column]:
    """A key as non-null columns: (null flag, value or typed default); keys of
    types without a default, and sentinel-mode keys, become one text column."""
    dflt = _typed_default(df.schema[k].dataType)
    if mode == "sentinel" or dflt is None:
        return [encode(df, k, mode).alias(name)]
    return [df[k].isNull().alias(name + "n"), F.coalesce(df[k], dflt).alias(name)]


def _with_keys(df: DataFrame, rs: Resolved, mode: str) -> list[Column]:
    return [c for i, k in enumerate(rs.keys) for c in encode_key(df, k, _row_mode(mode), f"__k{i}")]


def _kcols_of(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("__k")]


SIDE = "__side"


def _raw_keys(frame: DataFrame, rs: Resolved, mode: str) -> bool:
    """Whether rows can be clustered by the keys as they are: grouping puts NULLs together."""
    return _row_mode(mode) == "safe" and all(
        _typed_default(frame.schema[k].dataType) is not None for k in rs.keys)


def _tagged(left: DataFrame, right: DataFrame, rs: Resolved, mode: str,
            cols: list[str]) -> DataFrame:
    """Both sides in one frame: ``cols`` under the left names in their common form
    (columns only the left reports are NULL on the right), ``__side`` (0 left,
    1 right), and encoded keys ``__k*`` where the keys themselves cannot be grouped."""
    shared = set(rs.keys + rs.compare)
    # compared columns in their common exact form, so no value is narrowed;
    # reported-only columns keep the left type
    lt = {c: left.schema[c].dataType for c in cols}
    rt = {c: right.schema[rs.rcol(c)].dataType if c in shared else lt[c] for c in cols}
    la = left.select(*[in_common(left[c], lt[c], rt[c]).alias(c) for c in cols])
    ra = right.select(*[(in_common(right[rs.rcol(c)], rt[c], lt[c]) if c in shared
                         else F.lit(None).cast(lt[c])).alias(c) for c in cols])

    def tag(df: DataFrame, side: int) -> DataFrame:
        keys = [] if _raw_keys(df, rs, mode) else _with_keys(df, rs, mode)
        return df.select(*keys, *cols, F.lit(side).alias(SIDE))

    return tag(la, 0).unionByName(tag(ra, 1))


def _split(t: DataFrame, rs: Resolved) -> tuple[DataFrame, DataFrame | None, list[str]]:
    """``(cold, hot, kc)``: the rows of keys that a window may hold, those of the
    others (None when there are none), and the columns that rows are clustered by."""
    kc = _kcols_of(t) or rs.keys
    most = min(hot_rows_setting(t.sparkSession, None), WINDOW_ROWS)
    hot, rows = hot_keys_and_rows(t, kc, hot_rows=most, sample_rows=WINDOW_SAMPLE)
    if hot is None:
        return spread(t, kc, rows), None, kc
    named = hot.toDF(*[f"__h{i}" for i in range(len(kc))])
    same = all_of([t[k].eqNullSafe(named[f"__h{i}"]) for i, k in enumerate(kc)])
    return spread(t.join(named, same, "left_anti"), kc, rows), t.join(named, same, "left_semi"), kc


def _encoded(hot: DataFrame, rs: Resolved, mode: str) -> tuple[DataFrame, list[str]]:
    """``hot`` with encoded keys, for its lookups."""
    if not _kcols_of(hot):
        hot = hot.select(*_with_keys(hot, rs, mode), *hot.columns)
    return hot, _kcols_of(hot)


def _varies(frame: DataFrame, c: str, mode: str, w) -> Column:
    """Whether the key's rows hold more than one value of a column under the mode."""
    dtype = frame.schema[c].dataType
    nested = isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
    if nested or (mode == "sentinel" and isinstance(dtype, T.StringType)):
        text = encode(frame, c, mode)
        return F.min(text).over(w) != F.max(text).over(w)
    known = F.count(frame[c]).over(w)
    return F.coalesce(F.min(frame[c]).over(w) != F.max(frame[c]).over(w), F.lit(False)) | (
        (known > 0) & (known < F.count(F.lit(1)).over(w)))


#: For each compared column whether the key's rows hold more than one value: one array,
#: as the optimizer's constraints grow steeply with the number of such columns.
VARY = "__y"


def _any_varies() -> Column:
    return F.exists(F.col(VARY), lambda x: x)


def clustered(frame: DataFrame, kc: list[str], rs: Resolved, mode: str) -> DataFrame:
    """``frame`` with its key's rows on each side (``__m``, ``__n``) and, for each
    compared column, whether they hold more than one value; one clustering by key."""
    w, side = Window.partitionBy(*kc), F.col(SIDE)
    return frame.select("*", F.sum(F.when(side == 0, 1).otherwise(0)).over(w).alias("__m"),
                        F.sum(F.when(side == 1, 1).otherwise(0)).over(w).alias("__n"),
                        F.array(*[_varies(frame, c, mode, w) for c in rs.compare])
                        .cast("array<boolean>").alias(VARY))


def _paired(frame: DataFrame, kc: list[str], rs: Resolved, mode: str) -> DataFrame:
    """``clustered`` rows of keys that both sides have."""
    return clustered(frame, kc, rs, mode).filter((F.col("__m") > 0) & (F.col("__n") > 0))


def _sides(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    return frame.filter(F.col(SIDE) == 0), frame.filter(F.col(SIDE) == 1)


#: Of cells that are NULL or the text 'NULL': the row's sentinel texts, and which of the two.
MARKS = ["__t", "__o"]


def _marks(frame: DataFrame, rs: Resolved, c: str, other: bool | None) -> list[Column]:
    """``MARKS`` of a cell, NULL for all others; ``other`` names the opposite one of
    the two, so that a left cell's marks equal those of its opposites on the right."""
    if not isinstance(frame.schema[c].dataType, T.StringType):
        return [F.lit(None).cast("string").alias(MARKS[0]),
                F.lit(None).cast("boolean").alias(MARKS[1])]
    texts = F.to_json(F.array(*[encode(frame, x, "sentinel") for x in rs.compare]))
    null = frame[c].isNull()
    alike = null | (frame[c] == SENTINEL)
    opposite = frame[SIDE] == 1 if other is None else F.lit(other)
    return [F.when(alike, texts).alias(MARKS[0]),
            F.when(alike, null != opposite).alias(MARKS[1])]


def _cells(frame: DataFrame, rs: Resolved, mode: str, left_values: bool = False,
           own: dict[str, T.DataType] | None = None, marks: bool = False,
           other: bool | None = None, varied: bool = False) -> Column:
    """An array of ``(column_name, [left_value,] __v[, MARKS])``, an element for each
    compared column (those that vary within the key, with ``varied``); values as text
    of their ``own`` types.  ``other``: see ``_marks`` (None: true of right rows)."""
    cells = []
    for i, c in enumerate(rs.compare):
        form = frame.schema[c].dataType
        parts = [F.lit(c).alias("column_name")]
        if left_values:
            parts.append(own_text(frame[c], form, (own or {}).get(c, form)).alias("left_value"))
        parts.append(encode(frame, c, mode).alias("__v"))
        if marks:
            parts += _marks(frame, rs, c, other)
        if varied:
            parts.append(F.col(VARY)[i].alias("__on"))
        cells.append(F.struct(*parts))
    element = ("struct<column_name:string," + "left_value:string," * left_values + "__v:string"
               + ",__t:string,__o:boolean" * marks + ",__on:boolean" * varied + ">")
    out = struct_array(cells, element)
    return F.filter(out, lambda x: x["__on"]) if varied else out


def _stack(frame: DataFrame, rs: Resolved, mode: str, **how) -> list[Column]:
    """Generator columns of ``_cells``."""
    return [F.inline(_cells(frame, rs, mode, **how))]


def _unpicked(frame: DataFrame, kc: list[str], rs: Resolved) -> DataFrame:
    """``kc, column_name, MARKS, __side`` of the cells that may differ in a pair that
    the sentinel rule does not pick; right cells under their opposites' marks."""
    lrows, rrows = _sides(frame)
    both = [part.select(*kc, SIDE, *_stack(part, rs, "safe", marks=True, other=right))
            for part, right in ((lrows, False), (rrows, True))]
    return both[0].unionByName(both[1]).filter(F.col(MARKS[0]).isNotNull()).drop("__v")


def _side_counts() -> tuple[Column, Column]:
    side = F.col(SIDE)
    return (F.sum(F.when(side == 0, 1).otherwise(0)).cast(COUNT),
            F.sum(F.when(side == 1, 1).otherwise(0)).cast(COUNT))


def _count_parts(frame: DataFrame, kc: list[str], rs: Resolved, mode: str) -> DataFrame:
    """``column_name, __x`` of clustered rows: all pairs of a key (as TOTAL), and the
    pairs of a left cell's value with the partners that hold another."""
    m, n = _side_counts()
    mixed = mode == "mixed"
    kind = lambda k, c, v: F.struct(k.alias("__e"), c.alias("__c"), v.alias("__v"))
    rows = _paired(frame, kc, rs, _cell_mode(mode))
    cells = F.transform(_cells(rows, rs, mode, marks=mixed, varied=True),
                        lambda x: kind(F.lit("cell"), x["column_name"], x["__v"]))
    entries = [F.array(kind(F.lit("all"), F.lit(TOTAL), F.lit(""))), cells]
    if mixed:  # the pairs that are not picked
        marked = F.filter(_cells(rows, rs, mode, marks=True, varied=True),
                          lambda x: x[MARKS[0]].isNotNull())
        entries.append(F.transform(marked, lambda x: kind(
            F.lit("unpicked"), x["column_name"], F.concat(x[MARKS[1]].cast("string"), x[MARKS[0]]))))
    counted = (rows.select(*kc, SIDE, "__n", F.inline(F.concat(*entries)))
               .groupBy(*kc, "__n", "__e", "__c", "__v").agg(m.alias("__mv"), n.alias("__nv")))
    k, left, right = F.col("__e"), F.col("__mv"), F.col("__nv")
    x = (F.when(k == "all", left * right).when(k == "unpicked", -(left * right))
         .otherwise(left * (F.col("__n").cast(COUNT) - right)))
    return counted.select(F.col("__c").alias("column_name"), x.cast(PRODUCT).alias("__x"))


def _count_parts_hot(frame: DataFrame, kc: list[str], rs: Resolved, mode: str) -> DataFrame:
    """``_count_parts`` by frequency tables: each column's pairs less the equal ones."""
    m, n = _side_counts()
    pairs = frame.groupBy(*kc).agg((m * n).cast(PRODUCT).alias("__x")).select(
        F.explode(F.array(*[F.lit(c) for c in [TOTAL, *rs.compare]])).alias("column_name"), "__x")
    equal = frame.select(*kc, SIDE, *_stack(frame, rs, mode)) \
        .groupBy(*kc, "column_name", "__v").agg((-(m * n)).cast(PRODUCT).alias("__x"))
    parts = pairs.unionByName(equal.select("column_name", "__x"))
    if mode == "mixed":
        unpicked = _unpicked(frame, kc, rs).groupBy(*kc, "column_name", *MARKS)
        parts = parts.unionByName(unpicked.agg((-(m * n)).cast(PRODUCT).alias("__x"))
                                  .select("column_name", "__x"))
    return parts


def cross_column_counts(left: DataFrame, right: DataFrame, rs: Resolved,
                        mode: str | None = None) -> DataFrame:
    """``column_name, mismatch_count, total_matches`` under cross pairing; figures
    are ``decimal(38,0)``, since two hot keys' row counts multiply beyond 64 bits."""
    mode = _mode(rs, mode)
    cold, hot, kc = _split(_tagged(left, right, rs, mode, rs.keys + rs.compare), rs)
    parts = _count_parts(cold, kc, rs, mode)
    if hot is not None:
        parts = parts.unionByName(_count_parts_hot(*_encoded(hot, rs, mode), rs, mode))
    cn = F.col("column_name")
    total = lambda c: F.coalesce(F.sum(F.when(cn == c, F.col("__x"))), F.lit(0)).cast(PRODUCT)
    one = parts.groupBy().agg(total(TOTAL).alias("total_matches"),
                              *[total(c).alias(f"__x{i}") for i, c in enumerate(rs.compare)])
    return one.select(
        F.inline(struct_array([F.struct(F.lit(c).alias("column_name"),
                                        F.col(f"__x{i}").alias("mismatch_count"))
                               for i, c in enumerate(rs.compare)],
                              f"struct<column_name:string,mismatch_count:{PRODUCT}>")),
        "total_matches")


def cross_matches(left: DataFrame, right: DataFrame, rs: Resolved,
                  mode: str | None = None) -> DataFrame:
    """``total_matches``: number of cross pairs (sum of m_k * n_k); one
    aggregate with a map-side partial step, so hot keys need no special plan."""
    mode = _mode(rs, mode)
    t = _tagged(left, right, rs, mode, rs.keys)
    m, n = _side_counts()
    per_key = t.groupBy(*(_kcols_of(t) or rs.keys)).agg((m * n).cast(PRODUCT).alias("__pairs"))
    return per_key.groupBy().agg(
        F.coalesce(F.sum("__pairs"), F.lit(0)).cast(PRODUCT).alias("total_matches"))


def mismatch_percentages(col_counts: DataFrame, digits: int = 2) -> DataFrame:
    """Share of cross pairs that differ per column, 0 when nothing matched."""
    pct = F.coalesce(F.try_divide(F.col("mismatch_count").cast("double") * 100,
                                  F.col("total_matches").cast("double")), F.lit(0.0))
    return col_counts.select("column_name", "mismatch_count", "total_matches",
                             F.round(pct, digits).alias("percentage"))


def _with_same(left_part: DataFrame, right_counts: DataFrame, match_cols: list[str],
               salted: bool) -> DataFrame:
    """Attach ``__same`` = right rows whose ``match_cols`` equal the left part's
    (a left equi-join).  The counts come out of an aggregate, so AQE does not
    split this join: the rows are salted and the counts copied."""
    if salted:
        plain = [c for c in left_part.columns
                 if not isinstance(left_part.schema[c].dataType, T.MapType)]
        left_part = left_part.withColumn(
            "__salt", F.pmod(F.xxhash64(*plain), F.lit(SALTS)).cast("int"))
        right_counts = right_counts.withColumn(
            "__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        match_cols = [*match_cols, "__salt"]
    j = left_part.join(right_counts, on=match_cols, how="left")
    return j.withColumn("__same", F.coalesce(F.col("__n"), F.lit(0))).drop("__n", "__salt")


def _with_right_rows(left_groups: DataFrame, rrows: DataFrame, kc: list[str],
                     salted: bool) -> DataFrame:
    """Left groups whose key the right side has, with its ``right_rows``."""
    rk = rrows.groupBy(*kc).agg(F.count(F.lit(1)).alias("__n"))
    j = _with_same(left_groups, rk, kc, salted)
    return j.filter(F.col("__same") > 0).withColumnRenamed("__same", "right_rows")


def _left_groups(lrows: DataFrame, rrows: DataFrame, kc: list[str], rs: Resolved,
                 salted: bool) -> DataFrame:
    """Distinct left rows (reported and compared columns) with ``left_rows`` and
    their key's ``right_rows``."""
    cols = list(dict.fromkeys(rs.output + rs.compare))
    lg = lrows.groupBy(*kc, *cols).agg(F.count(F.lit(1)).alias("left_rows"))
    return _with_right_rows(lg, rrows, kc, salted)


def _regrouped(groups: DataFrame, kc: list[str], rs: Resolved, more: list[str]) -> DataFrame:
    """Groups by the reported columns and ``more``: compared columns that are not
    reported told rows apart until here."""
    if set(rs.compare) <= set(rs.output):
        return groups.select(*kc, *rs.output, *more, "right_rows", "left_rows")
    return groups.groupBy(*kc, *rs.output, *more, "right_rows").agg(
        F.sum("left_rows").alias("left_rows"))


def _grouped(rows: DataFrame, kc: list[str], rs: Resolved, more: list[str]) -> DataFrame:
    """Distinct rows of each side (``__k`` of them) with ``more``, constant in a key."""
    cols = list(dict.fromkeys([*kc, *rs.output, *rs.compare]))
    return rows.groupBy(*cols, SIDE, *more).agg(F.count(F.lit(1)).alias("__k"))


def _partners(by: list[str]) -> Column:
    """Right rows that agree in ``by``."""
    return F.coalesce(F.sum(F.when(F.col(SIDE) == 1, F.col("__k"))).over(
        Window.partitionBy(*by)), F.lit(0))


def _changed_rows(frame: DataFrame, kc: list[str], rs: Resolved, mode: str) -> DataFrame:
    mode = _row_mode(mode)
    rows = _paired(frame, kc, rs, mode)
    rows = rows.filter(_any_varies())
    g = _grouped(rows, kc, rs, ["__n"])
    tcols = [f"__t{i}" for i in range(len(rs.compare))]
    g = g.select("*", *[encode(g, c, mode).alias(t) for c, t in zip(rs.compare, tcols)])
    out = g.withColumn("__d", F.col("__n") - _partners([*kc, *tcols])).filter(
        (F.col(SIDE) == 0) & (F.col("__d") > 0))
    if not set(rs.compare) <= set(rs.output):
        by = list(dict.fromkeys([*kc, *rs.output, *tcols, "__n", "__d"]))
        out = out.groupBy(*by).agg(F.sum("__k").alias("__k"))
    return out.select(*rs.output, F.col("__k").alias("left_rows"), F.col("__n").alias("right_rows"),
                      F.col("__d").cast("long").alias("differing_partners"))


def _changed_rows_hot(frame: DataFrame, kc: list[str], rs: Resolved, mode: str) -> DataFrame:
    mode = _row_mode(mode)
    tcols = [f"__t{i}" for i in range(len(rs.compare))]
    lrows, rrows = _sides(frame)
    lg = _left_groups(lrows, rrows, kc, rs, True)
    lt = lg.select(*lg.columns, *[encode(lg, c, mode).alias(t) for c, t in zip(rs.compare, tcols)])
    rt = rrows.select(*kc, *[encode(rrows, c, mode).alias(t) for c, t in zip(rs.compare, tcols)]) \
        .groupBy(*kc, *tcols).agg(F.count(F.lit(1)).alias("__n"))
    j = _with_same(_regrouped(lt, kc, rs, tcols), rt, [*kc, *tcols], True)
    diff = (F.col("right_rows") - F.col("__same")).cast("long")
    return j.select(*rs.output, "left_rows", "right_rows", diff.alias("differing_partners")) \
        .filter(F.col("differing_partners") > 0)


def changed_cross(left: DataFrame, right: DataFrame, rs: Resolved,
                  mode: str | None = None) -> DataFrame:
    """Left rows (distinct, with multiplicity ``left_rows``) that differ from at
    least one cross partner: ``right_rows`` partners in total, of which
    ``differing_partners`` differ in some compare column."""
    mode = _mode(rs, mode)
    cols = list(dict.fromkeys(rs.keys + rs.output + rs.compare))
    cold, hot, kc = _split(_tagged(left, right, rs, mode, cols), rs)
    out = _changed_rows(cold, kc, rs, mode)
    return out if hot is None else out.unionByName(
        _changed_rows_hot(*_encoded(hot, rs, mode), rs, mode))


def _differing(kc: list[str], mixed: bool) -> Column:
    """Right rows that differ from a stacked cell of the left."""
    diff = F.col("__n") - _partners([*kc, "column_name", "__v"])
    if mixed:
        unpicked = F.when(F.col(MARKS[0]).isNotNull(), _partners([*kc, "column_name", *MARKS]))
        diff = diff - F.coalesce(unpicked, F.lit(0))
    return diff


def cells_of_clustered(rows: DataFrame, kc: list[str], rs: Resolved, mode: str,
                       own: dict[str, T.DataType]) -> DataFrame:
    """The cell report of ``clustered`` rows (of keys that both sides have); columns
    that hold one value in a key are left out before rows become cells."""
    mixed = mode == "mixed"
    rows = rows.filter(_any_varies())
    g = _grouped(rows, kc, rs, ["__n", VARY])
    keep = list(dict.fromkeys([*kc, *rs.output]))
    st = g.select(*keep, SIDE, "__n", "__k", *_stack(
        g, rs, mode, left_values=True, own=own, marks=mixed, varied=True)).drop("__on")
    # a cell row carries the keys, the declared output and one value, so its
    # width does not grow with the number of compared columns
    out = st.withColumn("__d", _differing(kc, mixed)).filter((F.col(SIDE) == 0) & (F.col("__d") > 0))
    if mixed or not set(rs.compare) <= set(rs.output):
        # one row again for all that only unreported columns told apart
        out = out.groupBy(*keep, "column_name", "left_value", "__n", "__d").agg(
            F.sum("__k").alias("__k"))
    return out.select(*rs.output, F.col("column_name").alias("mismatch_column"), "left_value",
                      F.col("__k").alias("left_rows"), F.col("__n").alias("right_rows"),
                      F.col("__d").cast("long").alias("differing_partners"))


def _few_rows(frame: DataFrame, kc: list[str], rs: Resolved, mode: str) -> int:
    """Rows (both sides) of a key up to which its rows are compared with each other
    instead of being stacked, 0 for none: under the safe rule, in wide tables, of types
    that grouping gives back as they are."""
    plain = (T.IntegralType, T.DecimalType, T.StringType, T.BooleanType, T.DateType,
             T.TimestampType, T.TimestampNTZType)
    types = {c: frame.schema[c].dataType for c in rs.output + rs.compare}
    able = (mode == "safe" and kc == rs.keys and len(rs.compare) >= WIDE_COLUMNS
            and all(isinstance(types[c], plain) for c in rs.output)
            and all(isinstance(types[c], (*plain, T.FractionalType)) for c in rs.compare))
    return FEW_ROWS if able else 0


def _whole_key(keys: list[str]):
    """A window over all rows of a key, left ones first: a frame of its own, so that
    windows by row number and by key share a sort."""
    return Window.partitionBy(*keys).orderBy(SIDE).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)


def _packed(frame: DataFrame, rs: Resolved) -> tuple[DataFrame, dict[str, str]]:
    """Tagged rows as keys, ``__row`` (all other columns under short names, which are
    returned too) and their key's rows on each side: sorted as one value, wide rows cost half."""
    held = [c for c in dict.fromkeys(rs.output + rs.compare) if c not in rs.keys]
    at = {c: f"c{i}" for i, c in enumerate(held)}
    rows = frame.select(*rs.keys, SIDE, F.struct(*[F.col(c).alias(at[c]) for c in held]).alias("__row"))
    count = lambda s: F.sum(F.when(F.col(SIDE) == s, 1).otherwise(0)).over(_whole_key(rs.keys))
    return rows.select("*", count(0).alias("__m"), count(1).alias("__n")).filter(
        "__m > 0 and __n > 0"), at


def _cells_of_few(rows: DataFrame, at: dict[str, str], rs: Resolved, own: dict[str, T.DataType],
                  few: int) -> DataFrame:
    """The cell report of ``_packed`` rows, of keys of at most ``few`` rows, under the safe
    rule.  Each compared cell of a left row has a bit for each of its key's rows (left ones
    first), set where they are equal; left and right rows, and rows that are reported alike,
    are further bits, so no cell is sorted or grouped."""
    whole, types = _whole_key(rs.keys), rows.schema["__row"].dataType
    told = [c for c in rs.output if c not in rs.keys]
    rows = rows.withColumns({c: F.col(c).cast("int") for c in ("__m", "__n")})
    rows = rows.select("*", F.row_number().over(
        Window.partitionBy(*rs.keys).orderBy(SIDE)).alias("__i"),
        *[F.nth_value("__row", j + 1).over(whole).alias(f"__s{j}") for j in range(few)])

    def equal(columns: list[str]) -> Column:
        """A bit for each row of the key that equals this one in the columns."""
        return F.expr(" | ".join("shiftleft(cast({} as int), {})".format(" and ".join(
            [f"__s{j}.{at[c]} <=> __row.{at[c]}" for c in columns] or ["true"]), j) for j in range(few)))

    # texts and bits as arrays: code that names each column would be too long to be compiled
    # where the cells are given out
    left = rows.filter(F.col(SIDE) == 0).select(
        *rs.keys, *[F.col("__row")[at[c]].alias(c) for c in told], F.col("__n").cast("long").alias("__n"),
        F.expr("shiftleft(1, __m + __n) - shiftleft(1, __m)").alias("__right"),
        equal(told).bitwiseAND(F.expr("shiftleft(1, __m) - 1")).alias("__alike"),
        F.expr("shiftleft(1, __i - 1) - 1").alias("__before"),
        F.array(*[equal([c]) for c in rs.compare]).alias("__equal"),
        F.array(*[own_text(F.col("__row")[at[c]], types[at[c]].dataType, own[c]) for c in rs.compare]).alias("__texts"))
    cells = left.select("*", F.explode(F.array(*[F.lit(i) for i in range(len(rs.compare))])).alias("__c"))
    # of left rows that are reported alike the first one gives the cell
    cells = cells.filter("__right & ~__equal[__c] != 0 and __alike & __equal[__c] & __before = 0")
    return cells.select(
        *rs.output, F.array(*[F.lit(c) for c in rs.compare])[F.col("__c")].alias("mismatch_column"),
        F.col("__texts")[F.col("__c")].alias("left_value"),
        F.expr("cast(bit_count(__alike & __equal[__c]) as long)").alias("left_rows"),
        F.col("__n").alias("right_rows"),
        F.expr("cast(bit_count(__right & ~__equal[__c]) as long)").alias("differing_partners"))


def _most_rows(frame: DataFrame, kc: list[str]) -> int:
    """Rows of the largest key, counted in full by a job that reads the keys alone."""
    return frame.groupBy(*kc).count().agg(F.max("count")).first()[0] or 0  # one row


def _cell_rows(frame: DataFrame, kc: list[str], rs: Resolved, mode: str,
               own: dict[str, T.DataType]) -> DataFrame:
    few = _few_rows(frame, kc, rs, mode)
    if not few:
        return cells_of_clustered(_paired(frame, kc, rs, _cell_mode(mode)), kc, rs, mode, own)
    rows, at = _packed(frame, rs)
    if _most_rows(frame, kc) <= few:
        # rows that came since must not be left out
        held = F.when(F.expr(f"__m + __n <= {few}"), F.lit(True)).otherwise(
            F.raise_error(F.lit("a side changed while it was read")).cast("boolean"))
        return _cells_of_few(rows.filter(held), at, rs, own, few)
    many = rows.filter(f"__m + __n > {few}").select(
        *rs.keys, SIDE, *[F.col("__row")[n].alias(c) for c, n in at.items()])
    return _cells_of_few(rows.filter(f"__m + __n <= {few}"), at, rs, own, few).unionByName(
        cells_of_clustered(_paired(many, kc, rs, mode), kc, rs, mode, own))


def _cell_rows_hot(frame: DataFrame, kc: list[str], rs: Resolved, mode: str,
                   own: dict[str, T.DataType]) -> DataFrame:
    mixed = mode == "mixed"
    cell = ["column_name", "left_value", "__v"] + MARKS * mixed
    lrows, rrows = _sides(frame)
    lg = _left_groups(lrows, rrows, kc, rs, True)
    st = lg.select(*kc, *rs.output, "right_rows", "left_rows",
                   *_stack(lg, rs, mode, left_values=True, own=own, marks=mixed, other=False))
    rv = rrows.select(*kc, *_stack(rrows, rs, mode)) \
        .groupBy(*kc, "column_name", "__v").agg(F.count(F.lit(1)).alias("__n"))
    j = _with_same(_regrouped(st, kc, rs, cell), rv, [*kc, "column_name", "__v"], True)
    diff = F.col("right_rows") - F.col("__same")
    if mixed:
        j = j.withColumn("__differ", diff).drop("__same").filter(F.col("__differ") > 0)
        unpicked = _unpicked(rrows, kc, rs).groupBy(*kc, "column_name", *MARKS) \
            .agg(F.count(F.lit(1)).alias("__n"))
        j = _with_same(j, unpicked, [*kc, "column_name", *MARKS], True)
        diff = F.col("__differ") - F.col("__same")
    out = j.select(*rs.output, F.col("column_name").alias("mismatch_column"), "left_value",
                   "left_rows", "right_rows", diff.cast("long").alias("differing_partners")) \
        .filter(F.col("differing_partners") > 0)
    if not mixed:
        return out
    return out.groupBy(*[c for c in out.columns if c != "left_rows"]).agg(
        F.sum("left_rows").alias("left_rows")).select(*out.columns)


def own_types(df: DataFrame, rs: Resolved, right: bool = False) -> dict[str, T.DataType]:
    return {c: df.schema[rs.rcol(c) if right else c].dataType for c in rs.compare}


def mismatch_cells_cross(left: DataFrame, right: DataFrame, rs: Resolved,
                         mode: str | None = None) -> DataFrame:
    """Per distinct left row and compare column: how many cross partners hold a
    different value.  ``left_rows * differing_partners`` summed over all rows
    equals the reference's count of mismatched cells under cross pairing."""
    mode = _mode(rs, mode)
    cols = list(dict.fromkeys(rs.keys + rs.output + rs.compare))
    cold, hot, kc = _split(_tagged(left, right, rs, mode, cols), rs)
    own = own_types(left, rs)
    out = _cell_rows(cold, kc, rs, mode, own)
    return out if hot is None else out.unionByName(
        _cell_rows_hot(*_encoded(hot, rs, mode), rs, mode, own))


def cross_cell_total(cells: DataFrame) -> DataFrame:
    """Total mismatched cells under cross pairing from ``mismatch_cells_cross``."""
    return cells.groupBy().agg(F.coalesce(F.sum(cell_pairs()), F.lit(0)).cast(PRODUCT)
                               .alias("mismatched_cells"))


def cell_pairs() -> Column:
    """Mismatched cells that a row of ``mismatch_cells_cross`` stands for."""
    return F.col("left_rows").cast(COUNT) * F.col("differing_partners").cast(COUNT)


def _right_values(frame: DataFrame, kc: list[str], rs: Resolved, mode: str,
                  own: dict[str, T.DataType]) -> DataFrame:
    """The right side's cells of each key and column in which a left cell has partners
    that differ, on the clustering that counts those; the right side in the left's
    place: its values, with the keys as reported."""
    mixed = mode == "mixed"
    rows = _paired(frame, kc, rs, _cell_mode(mode))
    rows = rows.filter(_any_varies())
    by = list(dict.fromkeys([*kc, *rs.keys]))
    g = rows.groupBy(*dict.fromkeys([*by, *rs.compare]), SIDE, "__n", VARY).agg(
        F.count(F.lit(1)).alias("__k"))
    st = g.select(*by, SIDE, "__n", "__k", *_stack(
        g, rs, mode, left_values=True, own=own, marks=mixed, varied=True)).drop("__on")
    diff = _differing(kc, mixed)
    st = st.withColumn("__d", (F.col(SIDE) == 0) & (diff > 0))
    differs = F.max("__d").over(Window.partitionBy(*kc, "column_name"))
    return _reported(_right_counts(
        st.withColumn("__d", differs).filter((F.col(SIDE) == 1) & F.col("__d")), kc, rs, F.sum("__k")), rs)


def _right_counts(cells: DataFrame, kc: list[str], rs: Resolved, count: Column) -> DataFrame:
    """One row for each key, column and value of the right side's stacked cells."""
    return cells.groupBy(*kc, "column_name", "__v").agg(
        *[F.first(k).alias(f"__r{i}") for i, k in enumerate(rs.keys)],
        F.first("left_value").alias("right_value"), count.alias("right_rows"))


def _reported(counted: DataFrame, rs: Resolved) -> DataFrame:
    return counted.select(*[F.col(f"__r{i}").alias(k) for i, k in enumerate(rs.keys)],
                          F.col("column_name").alias("mismatch_column"), "right_value", "right_rows")


def _right_values_hot(frame: DataFrame, kc: list[str], rs: Resolved, mode: str,
                      own: dict[str, T.DataType], left_own: dict[str, T.DataType]) -> DataFrame:
    cells = _cell_rows_hot(frame, kc, rs, mode, left_own)
    named = cells.select(*_with_keys(cells, rs, mode),
                         F.col("mismatch_column").alias("column_name")).distinct()
    rrows = frame.filter(F.col(SIDE) == 1)
    values = _right_counts(rrows.select(*kc, *rs.keys, *_stack(
        rrows, rs, mode, left_values=True, own=own)), kc, rs, F.count(F.lit(1)))
    return _reported(values.join(named, [*kc, "column_name"], "left_semi"), rs)


def right_values_cross(left: DataFrame, right: DataFrame, rs: Resolved,
                       mode: str | None = None) -> DataFrame:
    """The other side of the cells: for each key and column that differs, every
    value the right side holds and in how many rows (``keys, mismatch_column,
    right_value, right_rows``), linear in the right side instead of in pairs."""
    mode = _mode(rs, mode)
    cols = list(dict.fromkeys(rs.keys + rs.output + rs.compare))
    cold, hot, kc = _split(_tagged(left, right, rs, mode, cols), rs)
    own = own_types(right, rs, right=True)
    out = _right_values(cold, kc, rs, mode, own)
    return out if hot is None else out.unionByName(_right_values_hot(
        *_encoded(hot, rs, mode), rs, mode, own, own_types(left, rs)))
