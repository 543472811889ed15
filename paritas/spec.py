"""Reconciliation specification: which columns are keys, compared, reported.

A ``ReconSpec`` is pure configuration.  ``resolve(left, right)`` turns it
into a ``Resolved`` object that knows the actual column spellings on both
sides, the common columns and the required-column issues.  Resolution only
reads DataFrame schemas (metadata); it never triggers a Spark job.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

PAIRINGS = ("ordinal", "cross")
NULL_MODES = ("safe", "sentinel", "mixed")


@dataclass(frozen=True)
class ReconSpec:
    """What to compare.

    keys        match columns (composite allowed)
    compare     columns whose values are diffed; ``None`` = all common non-key columns
    output      extra columns reported from the left side next to each difference
    order       ordering of occurrences inside a key for ordinal pairing;
                ``None`` = compare columns, then output columns (a total order
                over the reported row, so ties cannot pick random partners)
    left_name / right_name   side labels used in column prefixes and reports
    pairing     "ordinal": i-th occurrence of a key on the left is paired with
                the i-th on the right; "cross": every left occurrence with every
                right occurrence (reported through counts, never materialised)
    null_mode   "safe": NULL equals NULL only; "sentinel": values compared as
                ``coalesce(cast(x as string), 'NULL')``; "mixed": rows selected by
                the sentinel rule, cells reported by the safe rule
    required    columns that must exist on both sides (missing -> CRITICAL);
                ``None`` = keys + compare
    case_sensitive   match column names by exact spelling
    """

    keys: tuple[str, ...]
    compare: tuple[str, ...] | None = None
    output: tuple[str, ...] = ()
    order: tuple[str, ...] | None = None
    left_name: str = "dev"
    right_name: str = "prod"
    pairing: str = "ordinal"
    null_mode: str = "safe"
    required: tuple[str, ...] | None = None
    case_sensitive: bool = False

    def __post_init__(self):
        for name in ("keys", "compare", "output", "order", "required"):
            value = getattr(self, name)
            if isinstance(value, str):
                value = tuple(v.strip() for v in value.split(",") if v.strip())
            elif value is not None:
                value = tuple(value)
            object.__setattr__(self, name, value)
        if self.pairing not in PAIRINGS:
            raise ValueError(f"pairing must be one of {PAIRINGS}, got {self.pairing!r}")
        if self.null_mode not in NULL_MODES:
            raise ValueError(f"null_mode must be one of {NULL_MODES}, got {self.null_mode!r}")
        if self.left_name == self.right_name:
            raise ValueError("left_name and right_name must differ")

    def with_(self, **changes) -> "ReconSpec":
        values = {f: getattr(self, f) for f in self.__dataclass_fields__}
        values.update(changes)
        return ReconSpec(**values)

    def resolve(self, left: DataFrame, right: DataFrame) -> "Resolved":
        return Resolved.build(self, left, right)


class ColumnResolutionError(ValueError):
    """Raised when keys cannot be resolved (instead of silently comparing nothing)."""


def _norm(name: str, case_sensitive: bool) -> str:
    return name if case_sensitive else name.upper()


@dataclass
class Resolved:
    spec: ReconSpec
    left_columns: list[str]
    right_columns: list[str]
    common: list[str]                 # left spelling, left order
    right_of: dict[str, str]          # left spelling -> right spelling
    keys: list[str]
    compare: list[str]
    output: list[str]                 # reported columns: keys, then the declared output
    order: list[str]
    left_types: dict[str, str] = field(default_factory=dict)
    right_types: dict[str, str] = field(default_factory=dict)
    missing: dict[str, dict[str, list[str]]] = field(default_factory=dict)

    @staticmethod
    def build(spec: ReconSpec, left: DataFrame, right: DataFrame) -> "Resolved":
        cs = spec.case_sensitive
        lcols = list(left.columns)
        rcols = list(right.columns)
        lmap = {_norm(c, cs): c for c in lcols}
        rmap = {_norm(c, cs): c for c in rcols}
        common = [c for c in lcols if _norm(c, cs) in rmap]
        right_of = {c: rmap[_norm(c, cs)] for c in common}

        def pick(names):
            return [lmap[_norm(n, cs)] for n in names if _norm(n, cs) in lmap and _norm(n, cs) in rmap]

        keys = pick(spec.keys) if spec.keys else list(common)
        if not keys:
            raise ColumnResolutionError(
                f"none of the key columns {list(spec.keys)} exist on both sides")
        if spec.compare is None:
            compare = [c for c in common if c not in keys]
        else:
            compare = [c for c in pick(spec.compare) if c not in keys]
        declared = [c for c in pick(spec.output) if c not in keys]
        output = keys + declared
        order = pick(spec.order) if spec.order is not None else (
            compare + [c for c in declared if c not in compare])

        required = list(spec.required) if spec.required is not None else list(spec.keys) + list(spec.compare or [])
        missing: dict[str, dict[str, list[str]]] = {}
        for side, m in (("left", lmap), ("right", rmap)):
            missing[side] = {
                "required": [n for n in required if _norm(n, cs) not in m],
                # a column that is required too is an issue once
                "output": [n for n in spec.output if _norm(n, cs) not in m
                           and _norm(n, cs) not in {_norm(r, cs) for r in required}],
            }
        ltypes = {f.name: f.dataType.simpleString() for f in left.schema.fields}
        rtypes = {f.name: f.dataType.simpleString() for f in right.schema.fields}
        return Resolved(spec, lcols, rcols, common, right_of, keys, compare, output, order,
                        ltypes, rtypes, missing)

    @property
    def carried(self) -> list[str]:
        """Every column a pairing needs: reported, compared, ordered by."""
        return list(dict.fromkeys([*self.output, *self.compare, *self.order]))

    @property
    def critical(self) -> bool:
        return any(self.missing[s]["required"] for s in ("left", "right"))

    def rcol(self, name: str) -> str:
        return self.right_of[name]
