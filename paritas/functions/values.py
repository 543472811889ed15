"""Column expressions for comparing and rendering cell values.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen; no Python UDF is involved.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value shared with the reports: the text that stands for NULL under the
# sentinel rule.
SENTINEL = "NULL"

# Nested values as JSON keep NULL fields and microseconds.
JSON_OPTIONS = {"ignoreNullFields": "false",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_FLOATING = (T.FloatType, T.DoubleType)
_INSTANTS = (T.DateType, T.TimestampNTZType, T.TimestampType)


def exact_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds every value of both types exactly, or ``None``.

    ``None`` between numeric types (a 64-bit integer or decimal against a
    floating type, decimals that need more than 38 digits) means that values
    are compared through ``number_text``; between other types, through
    ``cell_text``."""
    if a == b:
        return a
    ints = [_DIGITS.get(type(t)) for t in (a, b)]
    if all(ints):
        return a if ints[0] >= ints[1] else b
    if isinstance(a, _FLOATING) and isinstance(b, _FLOATING):
        return T.DoubleType()
    if any(isinstance(t, _FLOATING) for t in (a, b)):
        small = (T.ByteType, T.ShortType, T.IntegerType)
        return T.DoubleType() if isinstance(a, small) or isinstance(b, small) else None
    parts = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType)
             else (n, 0) if n else None for t, n in zip((a, b), ints)]
    if all(parts):
        whole, scale = (max(x) for x in zip(*parts))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if isinstance(a, _INSTANTS) and isinstance(b, _INSTANTS):
        return a if _INSTANTS.index(type(a)) > _INSTANTS.index(type(b)) else b
    return None


def in_common(c: Column, source: T.DataType, other: T.DataType) -> Column:
    """``c`` (of type ``source``) in the form in which it is compared with a
    value of type ``other``: equal forms if and only if equal values, and
    never a cast that can fail or round."""
    target = exact_type(source, other)
    if target is not None:
        return c if source == target else c.cast(target)
    if isinstance(source, T.NumericType) and isinstance(other, T.NumericType):
        return number_text(c)
    return cell_text(c, source)


def number_text(c: Column) -> Column:
    """A number in plain decimal notation without an exponent or idle zeros.

    Floating values take their shortest text that reads back as the same value,
    so the double 0.1 equals the decimal 0.1 and no two doubles look alike."""
    s = c.cast("string")
    plain = F.regexp_replace(F.regexp_replace(s, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    plain = F.regexp_replace(plain, "^-0$", "0")
    return F.when(s.rlike("E-?[0-9]+$"), _written_out(s)).otherwise(plain)


def _written_out(s: Column) -> Column:
    """Text like ``-1.25E-7`` without its exponent.  The parts are bound by
    ``transform`` so that the expression stays small."""
    def part(i: int) -> Column:
        return F.regexp_extract(s, r"^(-?)([0-9]+)\.?([0-9]*?)0*E(-?[0-9]+)$", i)

    parts = F.array(F.struct(
        part(1).alias("sign"), F.concat(part(2), part(3)).alias("digits"),
        (F.length(part(2)) + part(4).try_cast("int")).alias("point")))

    def joined(x: Column) -> Column:
        digits, point = x["digits"], x["point"]
        return F.concat(x["sign"], F.when(
            point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)).when(
            point >= F.length(digits), F.rpad(digits, point, "0")).otherwise(
            F.concat(digits.substr(F.lit(1), point), F.lit("."),
                     digits.substr(point + 1, F.length(digits)))))

    out = F.transform(parts, joined)[0]
    # 0E-18 and the like
    return F.when(s.rlike("^-?[0.]+E"), F.lit("0")).otherwise(
        F.regexp_replace(F.regexp_replace(out, r"(\.[0-9]*?)0+$", "$1"), r"\.$", ""))


def comparable(c: Column, dtype: T.DataType | None) -> Column:
    """A form of ``c`` that supports ``<=>``: maps become sorted entry arrays."""
    if isinstance(dtype, T.MapType):
        return F.array_sort(F.map_entries(c))
    return c


def cell_text(c: Column, dtype: T.DataType | None) -> Column:
    """A value as text: different values never look alike.

    Floating values are written out plainly with at least one decimal
    (``388246.03``, ``477955.0``, ``0.00000000001``), nested ones as JSON with
    NULL fields and microseconds, maps as their sorted entries."""
    if isinstance(dtype, _FLOATING):
        plain = number_text(c)
        return F.when(plain.rlike("^-?[0-9]+$"), F.concat(plain, F.lit(".0"))).otherwise(plain)
    if isinstance(dtype, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(c)), JSON_OPTIONS)
    if isinstance(dtype, (T.ArrayType, T.StructType)):
        return F.to_json(c, JSON_OPTIONS)
    return c.cast("string")


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type of the forms that ``in_common`` gives."""
    return exact_type(a, b) or T.StringType()


def lossless_text(c: Column, dtype: T.DataType | None) -> Column:
    """Text for comparing: equal texts if and only if equal values."""
    if isinstance(dtype, _FLOATING):
        return F.when(c == 0, F.lit(0.0).cast(dtype)).otherwise(c).cast("string")
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return cell_text(c, dtype)
    return c.cast("string")


def sentinel_text(c: Column, dtype: T.DataType | None = None) -> Column:
    """The stringified comparison value: NULL becomes the text 'NULL', and no
    other two different values look alike."""
    return F.coalesce(lossless_text(c, dtype), F.lit(SENTINEL))


def own_text(c: Column, form: T.DataType, own: T.DataType) -> Column:
    """``cell_text`` of a value of type ``own`` from its form (of type ``form``)
    in a comparison with another type."""
    nested = isinstance(own, (T.ArrayType, T.MapType, T.StructType))
    if form == own or (nested and isinstance(form, T.StringType)):
        return cell_text(c, form)
    return cell_text(c.try_cast(own), own)  # the other side's values may not fit


def differs(left: Column, right: Column, mode: str,
            ltype: T.DataType | None = None, rtype: T.DataType | None = None) -> Column:
    """True when two cells differ under a null rule (never NULL itself); cells of
    different types are compared in their common form under every rule."""
    if mode == "sentinel":
        if ltype is None or rtype is None:
            return sentinel_text(left) != sentinel_text(right)
        form = common_type(ltype, rtype)
        return sentinel_text(in_common(left, ltype, rtype), form) != sentinel_text(
            in_common(right, rtype, ltype), form)
    if ltype is not None and rtype is not None and ltype != rtype:
        return ~in_common(left, ltype, rtype).eqNullSafe(in_common(right, rtype, ltype))
    return ~comparable(left, ltype).eqNullSafe(comparable(right, rtype))


def struct_array(structs: list[Column], element_ddl: str) -> Column:
    """``array(*structs)``, typed as ``array<element_ddl>`` also when empty (an
    empty ``array()`` has element type void, which ``inline`` and field access
    reject - e.g. a comparison with no compare columns)."""
    if structs:
        return F.array(*structs)
    return F.array().cast(f"array<{element_ddl}>")


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def fingerprint(cols: list[Column], dtypes: list[T.DataType | None]) -> Column:
    """64-bit row fingerprint that does not confuse NULL with any value.

    ``xxhash64`` skips NULL inputs, so ('a', NULL) and (NULL, 'a') would hash
    alike; each value is therefore hashed as its sentinel text together with a
    null bitmap.
    """
    texts = [F.coalesce(cell_text(c, t), F.lit(SENTINEL)) for c, t in zip(cols, dtypes)]
    bitmap = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols]) \
        if cols else F.lit("")
    return F.xxhash64(bitmap, *texts)
