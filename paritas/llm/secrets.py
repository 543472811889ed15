"""Secret scans by one deterministic automaton for all rules.

The rules' regular expressions become one nondeterministic automaton over
bytes; subset construction and minimisation turn it into transition arrays.
One pass over a text's bytes gives, for each position, the rules of which a
match ends there. Bytes on which every state goes back to the start part the
text into regions that no match crosses; a region with a hit is read again by
the hit rule's own anchored automaton, which gives the leftmost, longest
matches without overlaps.

Of the three base kinds ``assign``, ``access`` and ``hex``, matches too short
are dropped. Beyond those, the operator reports matches that begin inside a
dropped one, and the kinds ``github``, ``slack`` and ``key``.

Edge cases: a null or empty text has no spans. Text of any length is scanned
whole, in slices of whole texts. Repeated rows get the same result each, and
extra columns stay as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as sre
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import byte_buffer, slices

# --- fixed values: the rules -------------------------------------------------
_ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
_VALUE = r"[A-Za-z0-9+/_.=-]"


@dataclass(frozen=True)
class Rule:
    """``spot`` goes into the combined automaton and is found wherever ``match``
    may count; ``match`` gives the spans, of which those that do not begin with
    ``least`` are dropped. (Counted repeats of overlapping classes multiply
    states, so only the shortest ones stand in ``spot``.)"""

    kind: str
    spot: str
    match: str
    least: str


BASE = (
    Rule("assign", _ASSIGN + _VALUE + "{6}", _ASSIGN + _VALUE + "+", _ASSIGN + _VALUE + "{6}"),
    Rule("access", "AKIA[A-Z0-9]", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{16}"),
    Rule("hex", "[0-9a-f]{24}", "[0-9a-f]+", "[0-9a-f]{24}"),
)
MORE = (
    Rule("github", "gh[opsu]_[A-Za-z0-9]", "gh[opsu]_[A-Za-z0-9]+", "gh[opsu]_[A-Za-z0-9]{36}"),
    Rule("slack", "xox[abp]-[0-9A-Za-z-]", "xox[abp]-[0-9A-Za-z-]+", "xox[abp]-[0-9A-Za-z-]{10}"),
    Rule("key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----BEGIN [A-Z ]*PRIVATE KEY-----",
         "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE
# --- end of fixed values -----------------------------------------------------

#: A byte that UTF-8 never has; it parts texts and no rule may take it.
_PART = 0xFF
#: Bytes a lane has about.
_LANE = 256


class _Nfa:
    """Thompson's construction over the syntax tree that Python's own parser gives."""

    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.steps: list[list[tuple[np.ndarray, int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.steps.append([])
        return len(self.free) - 1

    def add(self, tree, at: int, fold: bool) -> int:
        for op, value in tree:
            at = self._one(op, value, at, fold)
        return at

    def _take(self, some: np.ndarray, at: int, fold: bool) -> int:
        if fold:
            for low in range(97, 123):
                some[low] = some[low - 32] = some[low] | some[low - 32]
        to = self.state()
        self.steps[at].append((some, to))
        return to

    def _one(self, op, value, at: int, fold: bool) -> int:
        if op is sre.LITERAL:
            if value > 0x7F:
                raise ValueError("rules are ASCII")
            some = np.zeros(256, bool)
            some[value] = True
            return self._take(some, at, fold)
        if op is sre.IN:
            some = np.zeros(256, bool)
            for kind, x in value:
                if kind is sre.LITERAL and x <= 0x7F:
                    some[x] = True
                elif kind is sre.RANGE and x[1] <= 0x7F:
                    some[x[0]:x[1] + 1] = True
                else:
                    raise ValueError(f"not in rules: {kind}")
            return self._take(some, at, fold)
        if op is sre.SUBPATTERN:
            return self.add(value[3], at, fold or bool(value[1] & re.IGNORECASE))
        if op is sre.BRANCH:
            end = self.state()
            for branch in value[1]:
                begin = self.state()
                self.free[at].append(begin)
                self.free[self.add(branch, begin, fold)].append(end)
            return end
        if op is sre.MAX_REPEAT:
            least, most, tree = value
            for _ in range(least):
                at = self.add(tree, at, fold)
            if most is sre.MAXREPEAT:
                loop = self.state()
                self.free[at].append(loop)
                self.free[self.add(tree, loop, fold)].append(loop)
                return loop
            for _ in range(most - least):
                end = self.add(tree, at, fold)
                self.free[at].append(end)
                at = end
            return at
        raise ValueError(f"not in rules: {op}")


@dataclass
class Automaton:
    """next: state x byte class -> state; found: bit r of a state's number is
    set where a match of rule r ends; state 0 is the start."""

    next: np.ndarray
    found: np.ndarray
    kind: np.ndarray  # byte -> class
    dead: int = -1

    @property
    def parting(self) -> np.ndarray:
        """Bytes on which every state goes back to the start."""
        return (self.next == 0).all(0)[self.kind]


def compiled(patterns: tuple[str, ...], anywhere: bool) -> Automaton:
    """The minimal automaton of all patterns; ``anywhere``: matches may begin at
    any byte, else only at the first one."""
    nfa = _Nfa()
    root = nfa.state()
    accept: dict[int, int] = {}
    for r, p in enumerate(patterns):
        begin = nfa.state()
        nfa.free[root].append(begin)
        accept[nfa.add(_parser.parse(p), begin, False)] = 1 << r
    signs = np.array([some for s in nfa.steps for some, _ in s]).T  # byte x step
    _, first, kind = np.unique(signs, axis=0, return_index=True, return_inverse=True)

    @lru_cache(maxsize=None)
    def closure(state: int) -> frozenset[int]:
        seen, todo = {state}, [state]
        while todo:
            for t in nfa.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    start = closure(root)
    number, order, table = {start: 0}, [start], []
    for states in order:  # grows while it is read
        row = []
        for b in first:
            to = set(start) if anywhere else set()
            for s in states:
                for some, t in nfa.steps[s]:
                    if some[b]:
                        to |= closure(t)
            to = frozenset(to)
            if to not in number:
                number[to] = len(order)
                order.append(to)
            row.append(number[to])
        table.append(row)
    table = np.array(table)
    found = np.array([sum({accept[s] for s in states if s in accept}) for states in order])
    # states are equal as long as they accept alike and go to equal states
    block = np.unique(found, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1]
        if finer.max() == block.max():
            break
        block = finer
    block = _numbered_from(block)
    one = np.unique(block, return_index=True)[1]
    dead = number.get(frozenset(), None)
    return Automaton(block[table[one]].astype(np.int32), found[one], kind.reshape(-1),
                     -1 if dead is None else int(block[dead]))


def _numbered_from(block: np.ndarray) -> np.ndarray:
    """The same blocks with that of the first state as number 0."""
    name = np.arange(block.max() + 1)
    name[[0, block[0]]] = name[[block[0], 0]]
    return name[block]


class Scanner:
    """Scans runs of texts for all rules; compiled once and sent to the tasks."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        self.spot = compiled(tuple(r.spot for r in rules), anywhere=True)
        self.parting = self.spot.parting
        self.match = [compiled((r.match,), anywhere=False) for r in rules]
        self.least = [compiled((r.least,), anywhere=False) for r in rules]

    def hits(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions where matches end and their rules' bits. ``data`` begins with
        a parting byte. Lanes begin behind such bytes and advance in step."""
        cut = np.flatnonzero(self.parting[data])
        begin = np.unique(cut[np.searchsorted(cut, np.arange(0, cut[-1] + 1, _LANE))]) + 1
        length = np.diff(np.append(begin, len(data)))
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        kinds = int(self.spot.kind.max()) + 1
        step = (self.spot.next * kinds).ravel()  # states as offsets into this array
        hit = np.zeros(len(step), self.spot.found.dtype)
        hit[::kinds] = self.spot.found
        kind = self.spot.kind[data].astype(np.int32)
        state = np.zeros(len(begin), np.int32)
        live = np.searchsorted(-length, -np.arange(1, int(length[0]) + 1), side="right")
        places, bits = [], []
        for t, n in enumerate(live.tolist()):
            at = begin[:n] + t
            state = step[state[:n] + kind[at]]
            found = hit[state]
            if found.any():
                some = np.flatnonzero(found)
                places.append(at[some])
                bits.append(found[some])
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(places), np.concatenate(bits)

    @staticmethod
    def _longest(a: Automaton, data: bytes, at: int) -> int:
        """End of the longest match that begins at ``at``, or -1."""
        state, end = 0, -1
        for i in range(at, len(data)):
            state = a.next[state, a.kind[data[i]]]
            if state == a.dead:
                break
            if a.found[state]:
                end = i + 1
        return end

    def _in_region(self, r: int, data: bytes) -> tuple[list, list]:
        """Spans of rule r: those kept, and those that begin inside a dropped one."""
        kept, inside = [], []
        first = self.match[r].next[0, self.match[r].kind] != self.match[r].dead
        at = 0
        while at < len(data):
            end = self._longest(self.match[r], data, at) if first[data[at]] else -1
            if end < 0:
                at += 1
            elif self._longest(self.least[r], data, at) >= 0:
                kept.append((at, end))
                at = end
            else:
                low = at + 1
                while low < end:
                    if first[data[low]] and self._longest(self.least[r], data, low) >= 0:
                        inside.append((low, self._longest(self.match[r], data, low)))
                        low = inside[-1][1]
                    else:
                        low += 1
                at = end
        return kept, inside

    def spans(self, texts: pa.Array) -> list[list[tuple[str, int, int, bool]]]:
        """For each text (kind, start, end, of base) in code points, by start and rule."""
        buf, offsets = byte_buffer(texts)
        out: list[list] = [[] for _ in range(len(texts))]
        data = np.full(len(buf) + len(texts) + 1, _PART, np.uint8)
        own = np.arange(len(texts))
        data[np.arange(len(buf)) + 1 + np.repeat(own, np.diff(offsets))] = buf
        at, bits = self.hits(data)
        if not len(at):
            return out
        cut = np.flatnonzero(self.parting[data])
        cut = np.append(cut, len(data))
        region = np.searchsorted(cut, at) - 1  # hits lie between two parting bytes
        begins = offsets + np.arange(len(texts) + 1) + 1
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        for r, rule in enumerate(self.rules):
            for x in np.unique(region[(bits >> r) & 1 == 1]).tolist():
                low, high = int(cut[x]) + 1, int(cut[x + 1])
                d = int(np.searchsorted(begins, low, side="right")) - 1
                kept, inside = self._in_region(r, data[low:high].tobytes())
                base = r < len(BASE) and rule == BASE[r]
                out[d] += [(s + low, r, e + low, base) for s, e in kept]
                out[d] += [(s + low, r, e + low, False) for s, e in inside]
        for d, found in enumerate(out):
            zero = lead[begins[d]]
            out[d] = [(self.rules[r].kind, int(lead[s] - zero), int(lead[e] - zero), base)
                      for s, r, e, base in sorted(found)]
        return out


def _joined(spans: list) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _ in spans)


_FOUND = ("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
          "redacted string")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, redact: bool = False,
         into: str = "secrets") -> DataFrame:
    """``docs`` with a struct column ``into``: counts of the base kinds, the
    SHA-256 of their spans, all spans and, if asked for, the text with each span
    replaced by its kind in brackets."""
    scanner = Scanner(rules)

    @F.arrow_udf(_FOUND)
    def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            rows = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans",
                                    "redacted")}
            for b in slices(pa.RecordBatch.from_arrays([column.fill_null("")], ["text"])):
                for i, spans in enumerate(scanner.spans(b.column(0))):
                    base = [x for x in spans if x[3]]
                    for kind in ("assign", "access", "hex"):
                        rows[f"n_{kind}"].append(sum(x[0] == kind for x in base))
                    rows["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                    rows["spans"].append(_joined(spans))
                    rows["redacted"].append(
                        _redacted(b.column(0)[i].as_py(), spans) if redact and spans else None)
            yield pa.RecordBatch.from_pydict(rows, pa.schema(
                [(k, pa.int64() if k[:2] == "n_" else pa.string()) for k in rows])).to_struct_array()

    return docs.withColumn(into, found(F.col("text")))


def _redacted(text: str, spans: list) -> str:
    out, at = [], 0
    for kind, start, end, _ in spans:
        if end <= at:
            continue
        if start >= at:  # else it goes on where the last one ended
            out += [text[at:start], f"[{kind}]"]
        at = end
    return "".join(out) + text[at:]
