"""Conversation structure repair by rank-convergence parallel Viterbi.

A conversation is repaired by the cheapest edits of its rows that give role
initials ``(s?(ua)+)?``: Keep, Rerole to user or assistant, Delete (required
for blank rows and duplicates) and Insert of an empty row. The automaton of
that form has four states, so the least cost to finish from each state is a
vector of four numbers, and a row turns the vector after it into the one
before it. Vectors that differ by a constant lead to the same edits.

Rows are sorted over all tasks and cut into chunks, so that one conversation
may span any number of tasks. All chunks run backward at once, each from the
speculative vector of a conversation that ends with it. Then fix-up passes
rerun the chunks whose successor begins with another vector than they assumed,
each only until its new vector and its stored one differ by a constant, and
end when no chunk is left. Stitched together, the vectors drive a forward
trace that takes, of the edits on a cheapest path, the first in ASCII order.
Rows that must be deleted add the same to all states; they are in no chunk.

Chunks, vectors and traces hold positions and row kinds. Texts are moved twice:
by the sort and to the one task that hashes a conversation's repaired text,
which is one stream of SHA-256 and so sequential by its definition; it holds a
row at a time (and the conversation's audit).

Order and edge cases: rows of a conversation go by turn (nulls first), then by
role, then by the SHA-256 of their text; rows equal in all of these are the same.
Null ``conv_id`` values form one conversation, returned under null. Null roles
and texts are one space, and nulls are one space in the damage rule's key. An
empty role has no initial, so its row cannot be kept. ``gaps`` beyond 63 bits
are the largest long. An empty table gives an empty result. Extra columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paritas.llm.common import saved

#: A chunk spans this many positions (as a power of two).
CHUNK_BITS = 12
REROLE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5

#: The six ASCII white-space characters.
BLANK = " \t\n\x0b\x0c\r"

# States: 0 nothing yet, 1 after the system row, 2 after a user row, 3 after an assistant row.
_KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: Where a row of the one role that may come next leads (inserted or reroled).
_NEXT = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
_ENDS = (0, 3)
_FAR = 1 << 20

Vector = tuple[int, int, int, int]


def _closed(v: list[int]) -> Vector:
    """With insertions: at most two lead from any state to any that can be reached."""
    for _ in range(3):
        v = [min(x, INSERT + v[_NEXT[s]]) for s, x in enumerate(v)]
    return tuple(v)


END: Vector = _closed([0 if s in _ENDS else _FAR for s in range(4)])


def _kept(kind: str, state: int, after: Vector) -> tuple[int, int, int]:
    """(cost, state, least cost on from there) of keeping the row; far if it cannot be."""
    to = _KEEP.get(kind[0], {}).get(state)
    cost = CUT_SHORT * (kind[1] == "t")
    return (cost, to, cost + after[to]) if to is not None else (_FAR, state, _FAR)


@lru_cache(maxsize=1 << 14)
def _before(after: Vector, kind: str) -> Vector:
    """The least costs before a row, from those after it (kind: initial, then t if cut short)."""
    rerole = REROLE + CUT_SHORT * (kind[1] == "t")
    return _closed([min(DELETE + after[s], _kept(kind, s, after)[2], rerole + after[_NEXT[s]])
                    for s in range(4)])


@lru_cache(maxsize=1 << 14)
def normal(v: Vector) -> Vector:
    least = min(v)
    return tuple(x - least for x in v)


@lru_cache(maxsize=1 << 16)
def _edit(after: Vector, kind: str, state: int) -> tuple[str, int, int]:
    """(letters, new state, cost) of the first cheapest edits up to and with this row."""
    before, letters, spent = _before(after, kind), "", 0
    while True:
        left = before[state]
        cost, to, total = _kept(kind, state, after)
        if DELETE + after[state] == left:
            return letters + "D", state, spent + DELETE
        if INSERT + before[_NEXT[state]] == left:
            letters, state, spent = letters + "I", _NEXT[state], spent + INSERT
        elif total == left:
            return letters + "K", to, spent + cost
        else:
            return (letters + "R", _NEXT[state],
                    spent + REROLE + CUT_SHORT * (kind[1] == "t"))


def _tail(state: int) -> str:
    """The insertions that end a conversation in this state."""
    out = ""
    while state not in _ENDS:
        out, state = out + "I", _NEXT[state]
    return out


def backward(kinds: list[str], after: Vector, known: list[Vector] | None = None) -> list[Vector]:
    """The vector before each row, from the one after the last, up to constants.

    With ``known`` vectors, only until one is met: before it they hold."""
    out = list(known) if known else [END] * len(kinds)
    for i in range(len(kinds) - 1, -1, -1):
        after = normal(_before(after, kinds[i]))
        if known and out[i] == after:
            break
        out[i] = after
    return out


def forward(kinds: list[str], vectors: list[Vector], after: Vector, state: int,
            ) -> tuple[list[str], list[int], int]:
    """Each row's letters and state after it, and the last state."""
    letters, states = [], []
    for i, kind in enumerate(kinds):
        some, state, _ = _edit(vectors[i + 1] if i + 1 < len(kinds) else after, kind, state)
        letters.append(some)
        states.append(state)
    return letters, states, state


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage rule; dropped rows stay as ``dropped``."""
    kind = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn"))) % 20
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = (F.when(kind == 1, "").when(kind == 2, F.regexp_replace(_text("text"), "[.!?]", ""))
            .otherwise(_text("text")))
    return (conversations.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                 F.when(kind == 4, "user").otherwise(_text("role")).alias("role"),
                                 text.alias("text"), (kind == 0).alias("dropped"),
                                 F.explode(copies).alias("copy")).drop("copy"))


def undamaged(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the form of ``damaged``."""
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                _text("role").alias("role"), _text("text").alias("text"),
                                F.lit(False).alias("dropped"))


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows with ``pos``, which ascends with conversation and order, and their faults' parts."""
    end = F.rtrim(F.col("text"), F.lit(BLANK))
    rows = rows.select("*", F.unhex(F.sha2("text", 256)).alias("digest"),
                       (end == "").alias("blank"),
                       (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut_short"),
                       F.monotonically_increasing_id().alias("tie"))
    # the tie spreads rows that are equal in everything
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "digest", "tie"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    return saved(rows.withColumn("pos", F.monotonically_increasing_id()), "conversation-rows")


_VECTORS = pa.list_(pa.int32())
_CHUNK = [("conv_id", pa.int64()), ("id", pa.int64()), ("next", pa.int64()),
          ("alone", pa.bool_()), ("pos", pa.list_(pa.int64())), ("kind", pa.list_(pa.string())),
          ("vectors", _VECTORS), ("first", pa.string()), ("assumed", pa.string())]
_CHUNK_SQL = ("conv_id long, id long, next long, alone boolean, pos array<long>, "
              "kind array<string>, vectors array<int>, first string, assumed string")


def _said(v: Vector) -> str:
    return ",".join(map(str, v))


def _heard(text: str) -> Vector:
    return tuple(map(int, text.split(",")))


def _unfolded(flat: list[int]) -> list[Vector]:
    return [tuple(flat[i:i + 4]) for i in range(0, len(flat), 4)]


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks (of a stale vector, or of none) run backward from the vector ``assumed``."""
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            known = _unfolded(r["vectors"]) if r["vectors"] else None
            vectors = backward(r["kind"], _heard(r["assumed"]), known)
            r["vectors"] = [x for v in vectors for x in v]
            r["first"] = _said(vectors[0])
        yield pa.RecordBatch.from_pylist(rows, pa.schema(_CHUNK))


def _chunks(live: DataFrame, bits: int) -> DataFrame:
    """Chunks with the vector before each row; fix-up passes run until all agree."""
    chunks = (live.groupBy("conv_id", F.shiftright("pos", bits).alias("chunk"))
              .agg(F.sort_array(F.collect_list(F.struct("pos", "kind"))).alias("rows"))
              .select("conv_id", F.col("rows")[0].pos.alias("id"), F.col("rows.pos").alias("pos"),
                      F.col("rows.kind").alias("kind")))
    chunks = saved(chunks, "chunks")
    own = Window.partitionBy("conv_id")
    links = chunks.select("conv_id", "id").select(
        "id", F.lead("id").over(own.orderBy("id")).alias("next"),
        (F.count(F.lit(1)).over(own) == 1).alias("alone"))
    start = chunks.join(links, "id").select(
        "conv_id", "id", "next", "alone", "pos", "kind", F.array().cast("array<int>").alias("vectors"),
        F.lit("").alias("first"), F.lit(_said(normal(END))).alias("assumed"))
    now = saved(start.mapInArrow(_run, _CHUNK_SQL), "vectors")
    alone, now = now.where("alone"), now.where("NOT alone")
    while True:
        heads = now.select(F.col("id").alias("next"), F.col("first").alias("actual"))
        stale = saved(now.select("id", "next", "assumed").join(heads, "next")
                      .where("assumed <> actual").select("id", "actual"), "stale")
        if stale.isEmpty():
            return alone.union(now)
        marked = now.join(stale, "id", "left")
        again = marked.where("actual IS NOT NULL").withColumn("assumed", F.col("actual"))
        again = again.select(*now.columns).mapInArrow(_run, _CHUNK_SQL)
        now = saved(marked.where("actual IS NULL").select(*now.columns).union(again), "vectors")


def _after(r: dict) -> tuple[list[str], list[Vector], Vector]:
    return r["kind"], _unfolded(r["vectors"]), _heard(r["assumed"])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, id, exits): the state a chunk is left in, for each it may be entered in."""
    for batch in batches:
        rows = batch.to_pylist()
        out = [{"conv_id": r["conv_id"], "id": r["id"],
                "exits": [forward(*_after(r), s)[2] for s in range(4)]} for r in rows]
        yield pa.RecordBatch.from_pylist(out, pa.schema(
            [("conv_id", pa.int64()), ("id", pa.int64()), ("exits", _VECTORS)]))


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, state) from exits sorted by conversation and chunk: a walk along each conversation."""
    last, state = object(), 0
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["conv_id"] != last:
                last, state = r["conv_id"], 0
            out.append({"id": r["id"], "state": state})
            state = r["exits"][state]
        yield pa.RecordBatch.from_pylist(out, pa.schema(
            [("id", pa.int64()), ("state", pa.int32())]))


def _trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, pos, letters, state, tail) for each row of the chunks."""
    kind = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("letters", pa.string()),
                      ("state", pa.int32()), ("tail", pa.string())])
    for batch in batches:
        for r in batch.to_pylist():
            letters, states, last = forward(*_after(r), r["state"])
            tail: list[str | None] = [None] * len(letters)
            if r["next"] is None:
                tail[-1] = _tail(last)
            yield pa.RecordBatch.from_arrays([
                pa.array([r["conv_id"]] * len(letters), pa.int64()), pa.array(r["pos"], pa.int64()),
                pa.array(letters), pa.array(states, pa.int32()), pa.array(tail, pa.string())],
                schema=kind)


def edits(live: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """(conv_id, pos, letters, state, tail) for each row of (conv_id, pos, kind)."""
    chunks = _chunks(live, bits)
    exits = (chunks.where("NOT alone").mapInArrow(_exits, "conv_id long, id long, exits array<int>")
             .repartition("conv_id").sortWithinPartitions("conv_id", "id"))
    entries = exits.mapInArrow(_entries, "id long, state int")
    told = chunks.join(entries, "id", "left").withColumn("state", F.coalesce("state", F.lit(0)))
    return told.mapInArrow(_trace, "conv_id long, pos long, letters string, state int, tail string")


class _Conversation:
    """What is returned of one conversation, taken up row by row in its order."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.tail = conv_id, ""
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.low = self.high = self.initial = None
        self.turns = 0
        self.state = 0
        self.hash, self.said = hashlib.sha256(), False

    def say(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.said else "") + role + ":" + text).encode())
        self.said = True

    def insert(self, letters: str) -> None:
        for _ in letters:
            self.state = _NEXT[self.state]
            self.say(_ROLE[self.state], "")
            self.cost += INSERT

    def take(self, row: dict, edit: dict | None) -> None:
        if row["turn"] is not None:
            self.turns += row["turn"] != self.high
            self.low = row["turn"] if self.low is None else self.low
            self.high = row["turn"]
        initial = row["role"][:1]
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        if edit is None:
            self.blank += row["blank"]
            self.duplicate += not row["blank"]
            self.audit.append("D")
            self.cost += DELETE
            return
        self.truncated += row["cut_short"]
        letters = edit["letters"]
        self.audit.append(letters)
        self.insert(letters[:-1])
        self.state, what = edit["state"], letters[-1]
        if what == "D":
            self.cost += DELETE
        else:
            self.cost += CUT_SHORT * row["cut_short"] + REROLE * (what == "R")
            self.say(row["role"] if what == "K" else _ROLE[self.state], row["text"])
        self.tail = edit["tail"] or ""

    def row(self) -> dict:
        self.audit.append(self.tail)
        self.insert(self.tail)
        gaps = 0 if self.low is None else min(2**63 - 1, self.high - self.low + 1 - self.turns)
        return {"conv_id": self.conv_id, "gaps": gaps, "blank": self.blank,
                "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
                "cost": self.cost, "audit": "".join(self.audit),
                "repaired_sha256": self.hash.hexdigest()}


_OUT = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in (
    "gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
    ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each conversation, from rows and edits sorted by conversation and position."""
    now: _Conversation | None = None
    edit = None
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if now is None or r["conv_id"] != now.conv_id:
                if now is not None:
                    out.append(now.row())
                now = _Conversation(r["conv_id"])
            if r["letters"] is not None:
                edit = r
            elif not r["dropped"]:
                now.take(r, edit if edit is not None and edit["pos"] == r["pos"] else None)
        yield pa.RecordBatch.from_pylist(out, _OUT)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.row()], _OUT)


def repair(rows: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id, turn, role, text, dropped)."""
    rows = _sorted(rows.withColumn("conv_id", F.col("conv_id").cast("long")))
    # the first of equal rows is the only one that is no duplicate
    initial = F.substring("role", 1, 1)
    kind = F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("-"),
                    F.when(F.col("cut_short"), "t").otherwise("-"))
    live = (rows.where("NOT dropped AND NOT blank").groupBy("conv_id", "role", "digest")
            .agg(F.min("pos").alias("pos"), F.first(kind).alias("kind"))
            .select("conv_id", "pos", "kind"))
    found = edits(live, bits).select(
        "conv_id", "pos", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"), F.lit(False).alias("dropped"),
        F.lit(False).alias("blank"), F.lit(False).alias("cut_short"), "letters", "state", "tail")
    plain = rows.select(
        "conv_id", "pos", "turn", "role", F.when(~F.col("dropped") & ~F.col("blank"), F.col("text"))
        .alias("text"), "dropped", "blank", "cut_short", F.lit(None).cast("string").alias("letters"),
        F.lit(None).cast("int").alias("state"), F.lit(None).cast("string").alias("tail"))
    both = found.union(plain).repartition("conv_id").sortWithinPartitions(
        "conv_id", "pos", F.desc_nulls_last("letters"))
    return both.mapInArrow(_told, "conv_id long, gaps long, blank long, duplicate long, "
                                  "truncated long, illegal long, cost long, audit string, "
                                  "repaired_sha256 string")
