"""From matched rows to reported differences.

``mismatch_cells`` turns each differing pair into one row per differing cell
with a single ``filter(array(struct...))`` + ``inline`` projection: no
per-row Python, no union of one query per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (all_of, any_of, cell_text, common_type, differs, fingerprint, in_common,
                         struct_array)
from ..spec import Resolved
from .match import (cell_differs, generic_pairs, lcol, ordinal_pairs, rcol, right_aligned,
                    row_differs)


def _cell_mode(mode: str) -> str:
    return "sentinel" if mode == "sentinel" else "safe"


def explode_cells(pairs: DataFrame, rs: Resolved, mode: str, column_label: str = "mismatch_column",
                  left_label: str = "left_value", right_label: str = "right_value"):
    """The Column expression producing one struct per differing compare cell."""
    cm = _cell_mode(mode)
    structs = [
        F.struct(F.lit(c).alias(column_label),
                 cell_text(F.col(lcol(c)), pairs.schema[lcol(c)].dataType).alias(left_label),
                 cell_text(F.col(rcol(c)), pairs.schema[rcol(c)].dataType).alias(right_label),
                 cell_differs(pairs, rs, c, cm).alias("__d"))
        for c in rs.compare]
    element = (f"struct<{column_label}:string,{left_label}:string,{right_label}:string,"
               "__d:boolean>")
    return F.filter(struct_array(structs, element), lambda x: x["__d"])


def mismatch_cells(left: DataFrame, right: DataFrame, rs: Resolved,
                   mode: str | None = None) -> DataFrame:
    """One row per differing cell of ordinal pairs (flagship report).

    Columns: reported columns (left values), ``<left>_row_number``,
    ``<right>_row_number``, ``mismatch_column``, ``left_value``, ``right_value``.
    """
    mode = mode or rs.spec.null_mode
    pairs = ordinal_pairs(left, right, rs)
    return cells_of_pairs(pairs, rs, mode)


def cells_of_pairs(pairs: DataFrame, rs: Resolved, mode: str) -> DataFrame:
    ln, rn_ = rs.spec.left_name, rs.spec.right_name
    rows = pairs.filter(row_differs(pairs, rs, mode)) if mode != "safe" else pairs
    return rows.select(
        *[F.col(k) for k in rs.keys],
        *[F.col(lcol(c)).alias(c) for c in rs.output if c not in rs.keys],
        F.col("rn").alias(f"{ln}_row_number"), F.col("rn").alias(f"{rn_}_row_number"),
        F.inline(explode_cells(pairs, rs, mode)),
    ).drop("__d")


def generic_frame(left: DataFrame, right: DataFrame, rs: Resolved) -> DataFrame:
    """Matched rows with any differing common column, plus every one-sided row
    (all its columns then differ from the missing side)."""
    j = generic_pairs(left, right, rs)
    non_key = [c for c in rs.common if c not in rs.keys]
    changed = any_of([cell_differs(j, rs, c, "safe") for c in non_key])
    return j.filter(~(F.col("__l") & F.col("__r")) | changed)


def _key_values_text(rs: Resolved, j: DataFrame):
    parts = [F.concat(F.lit(f"{k}="), F.coalesce(
        F.coalesce(cell_text(F.col(lcol(k)), j.schema[lcol(k)].dataType),
                   cell_text(F.col(rcol(k)), j.schema[rcol(k)].dataType)), F.lit("NULL")))
        for k in rs.keys]
    return F.concat_ws(", ", *parts)


def _key_first_non_null(rs: Resolved, j: DataFrame, k: str):
    return F.coalesce(cell_text(F.col(lcol(k)), j.schema[lcol(k)].dataType),
                      cell_text(F.col(rcol(k)), j.schema[rcol(k)].dataType))


def mismatch_long(left: DataFrame, right: DataFrame, rs: Resolved,
                  table1: str, table2: str, frame: DataFrame | None = None) -> DataFrame:
    """Long report ``table1, table2, key_columns, key_values, column, table1_value,
    table2_value``: one row per differing common column per changed or one-sided row.
    ``frame`` is a ready ``generic_frame`` (e.g. materialised for several reports)."""
    j = frame if frame is not None else generic_frame(left, right, rs)
    structs = [
        F.struct(F.lit(c).alias("column"),
                 cell_text(F.col(lcol(c)), j.schema[lcol(c)].dataType).alias("table1_value"),
                 cell_text(F.col(rcol(c)), j.schema[rcol(c)].dataType).alias("table2_value"),
                 cell_differs(j, rs, c, "safe").alias("__d"))
        for c in rs.common]
    return j.select(
        F.lit(table1).alias("table1"), F.lit(table2).alias("table2"),
        F.lit(", ".join(rs.keys)).alias("key_columns"),
        _key_values_text(rs, j).alias("key_values"),
        F.inline(F.filter(F.array(*structs), lambda x: x["__d"])),
    ).drop("__d")


def mismatch_nested(left: DataFrame, right: DataFrame, rs: Resolved,
                    table1: str, table2: str, frame: DataFrame | None = None) -> DataFrame:
    """Nested record per differing row: ``key_values`` map (first non-null side)
    and ``differences`` map column -> {table1_value, table2_value}."""
    j = frame if frame is not None else generic_frame(left, right, rs)
    key_map = F.map_from_arrays(F.array(*[F.lit(k) for k in rs.keys]),
                                F.array(*[_key_first_non_null(rs, j, k) for k in rs.keys]))
    entries = [F.struct(F.lit(c).alias("key"),
                        F.struct(cell_text(F.col(lcol(c)), j.schema[lcol(c)].dataType)
                                 .alias("table1_value"),
                                 cell_text(F.col(rcol(c)), j.schema[rcol(c)].dataType)
                                 .alias("table2_value")).alias("value"),
                        cell_differs(j, rs, c, "safe").alias("__d"))
               for c in rs.common]
    kept = F.transform(F.filter(F.array(*entries), lambda x: x["__d"]),
                       lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value")))
    return j.select(key_map.alias("key_values"), F.map_from_entries(kept).alias("differences"),
                    F.lit(table1).alias("table1"), F.lit(table2).alias("table2"))


#: Ranges of key hashes whose digests are compared first, and ranges in each of those.
DIGEST_RANGES, FINER = 4096, 4096


def _digested(df: DataFrame, other: DataFrame, rs: Resolved, side: int) -> DataFrame:
    """``__range, __fine, __hash, __side`` of the rows of ``df`` (left spelling) with a
    key: the range of the key's hash, the finer one in it, and a hash of the row."""
    def form(c: str):
        return in_common(df[c], df.schema[c].dataType, other.schema[c].dataType)

    types = {c: common_type(df.schema[c].dataType, other.schema[c].dataType)
             for c in rs.keys + rs.compare}
    key = fingerprint([form(k) for k in rs.keys], [types[k] for k in rs.keys])
    row = fingerprint([form(c) for c in rs.compare], [types[c] for c in rs.compare])
    return df.filter(all_of([df[k].isNotNull() for k in rs.keys])).select(
        F.pmod(key, F.lit(DIGEST_RANGES)).alias("__range"),
        F.pmod(F.shiftright(key, 20), F.lit(FINER)).alias("__fine"),
        F.xxhash64(key, row).alias("__hash"), F.lit(side).alias("__side"))


def _unequal(rows: DataFrame, by: list[str]) -> DataFrame:
    """The ranges whose digests (count, sum and xor of row hashes) differ between the sides."""
    low = F.col("__hash").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned(F.col("__hash"), 32)
    one = lambda s, f, c: f(F.when(F.col("__side") == s, c))
    parts = [(F.sum, F.lit(1)), (F.sum, low), (F.sum, high), (F.bit_xor, F.col("__hash"))]
    sides = [F.struct(*[F.coalesce(one(s, f, c), F.lit(0)).alias(f"d{i}")
                        for i, (f, c) in enumerate(parts)]) for s in (0, 1)]
    g = rows.groupBy(*by).agg(sides[0].alias("__a"), sides[1].alias("__b"))
    return g.filter(F.col("__a") != F.col("__b")).select(*by)


def differing_ranges(left: DataFrame, right: DataFrame, rs: Resolved) -> DataFrame:
    """``__range, __fine`` of the keys among which rows differ, by a tree of digests:
    a hash of each row at the scan, sums of hashes by range of keys on both sides, and
    the same by finer ranges within those that differ.  The shuffles carry digests."""
    ra = right_aligned(right, rs, rs.keys + rs.compare)
    la = left.select(*rs.keys, *rs.compare)
    rows = _digested(la, ra, rs, 0).unionByName(_digested(ra, la, rs, 1))
    first = _unequal(rows, ["__range"])  # at most DIGEST_RANGES rows
    return _unequal(rows.join(F.broadcast(first), "__range", "left_semi"), ["__range", "__fine"])


def _in_ranges(df: DataFrame, other: DataFrame, rs: Resolved, ranges: DataFrame) -> DataFrame:
    """Rows of ``df`` (left spelling) whose key lies in one of the ranges."""
    types = [common_type(df.schema[k].dataType, other.schema[k].dataType) for k in rs.keys]
    key = fingerprint([in_common(df[k], df.schema[k].dataType, other.schema[k].dataType)
                       for k in rs.keys], types)
    marked = df.select("*", F.pmod(key, F.lit(DIGEST_RANGES)).alias("__range"),
                       F.pmod(F.shiftright(key, 20), F.lit(FINER)).alias("__fine"))
    return marked.join(ranges, ["__range", "__fine"], "left_semi").drop("__range", "__fine")


def fingerprint_diff(left: DataFrame, right: DataFrame, rs: Resolved) -> DataFrame:
    """Keys of matched rows whose whole-row fingerprints (compare columns) differ.

    Only rows of key ranges whose digests differ are paired.  (Where occurrences are
    ordered by other than the compared columns first, equal sets of rows may be paired
    unequal; then all rows are.)"""
    if rs.order[:len(rs.compare)] == rs.compare:
        ranges = differing_ranges(left, right, rs)
        ra = right_aligned(right, rs, rs.common)
        left, right = (_in_ranges(left.select(*rs.common), ra, rs, ranges),
                       _in_ranges(ra, left, rs, ranges))
        rs = rs.spec.resolve(left, right)
    j = ordinal_pairs(left, right, rs, how="inner")
    # both sides hashed in the column's common form (no narrowing or failing cast)
    lt = [j.schema[lcol(c)].dataType for c in rs.compare]
    rt = [j.schema[rcol(c)].dataType for c in rs.compare]
    forms = j.select(*rs.keys,
                     *[in_common(F.col(lcol(c)), a, b).alias(lcol(c))
                       for c, a, b in zip(rs.compare, lt, rt)],
                     *[in_common(F.col(rcol(c)), b, a).alias(rcol(c))
                       for c, a, b in zip(rs.compare, lt, rt)])
    fl, fr = (fingerprint([F.col(side(c)) for c in rs.compare],
                          [forms.schema[side(c)].dataType for c in rs.compare])
              for side in (lcol, rcol))
    return forms.filter(fl != fr).select(*rs.keys)


__all__ = ["cells_of_pairs", "explode_cells", "fingerprint_diff", "generic_frame",
           "mismatch_cells",
           "mismatch_long", "mismatch_nested", "differs"]
