"""Token files coded by a range asymmetric numeral system with static tables.

Spark range-partitions the documents by ``doc_id``; each task writes one file
of its documents in ascending order. A file is a row of segments. A segment
has one frequency table, counted over all its tokens and shared by its blocks;
a block holds whole documents and is coded on its own by interleaved lanes
(token i belongs to lane i modulo their number, all lanes advance together).
Each block stands behind a checkpoint in the file's index (place, documents,
tokens, checksum), so any block can be decoded alone, given its segment's
table. Files go to the shared folder under a name of their own for each
attempt, and the table of segments, which Spark commits, says which count: a
lost executor's files are left out.

File: the magic, segments, the index, the index's length (8 bytes) and magic.
All numbers are little-endian; tables and blocks carry their CRC-32.

Edge cases: a null or empty text is its end id alone; a null ``doc_id`` comes
first and stays null; repeated ids follow each other, ordered by a hash of
their texts. An empty table gives no rows. Extra columns are not read. A text
longer than a block makes a block of its own.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paritas.llm.common import documents, new_folder, saved, slices
from paritas.llm.tokens import TOKEN_SLICE, word_tokens

MAGIC = b"TOKRANS1"
LANES = 1024
#: Tokens a block and a segment hold about.
BLOCK_TOKENS, SEGMENT_TOKENS = 1 << 18, 1 << 22
#: Tasks that read files at most; each takes its segments one after another.
MOST_TASKS = 20_000
#: States stay in [2**31, 2**63); a lane gives or takes 32 bits at a time.
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


class Table:
    """Frequencies of a segment's symbols, scaled to a power of two."""

    def __init__(self, symbols: np.ndarray, scaled: np.ndarray, bits: int) -> None:
        self.symbols, self.scaled, self.bits = symbols, scaled, bits
        self.first = np.cumsum(scaled) - scaled

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        count = np.bincount(ids)
        symbols = np.flatnonzero(count)
        count = count[symbols]
        bits = max(16, len(symbols).bit_length() + 2)
        if bits > 28:
            raise ValueError("too many different tokens for one table")
        scaled = np.maximum(1, count * (1 << bits) // count.sum())
        order = np.argsort(-scaled, kind="stable")
        over = int(scaled.sum()) - (1 << bits)
        while over:  # the most frequent symbols take up the difference
            some = order[:max(1, len(order) // 4)]
            step = np.minimum(-(-abs(over) // len(some)), scaled[some] - 1 if over > 0 else 1 << bits)
            step = np.minimum(step, np.maximum(0, abs(over) - (np.cumsum(step) - step)))
            if not step.any():
                some = order
                step = np.minimum(scaled - 1, 1)[order]
                step = np.minimum(step, np.maximum(0, abs(over) - (np.cumsum(step) - step)))
            scaled[some] -= step if over > 0 else -step
            over = int(scaled.sum()) - (1 << bits)
        return cls(symbols.astype(np.uint32), scaled.astype(np.uint64), bits)

    def stored(self) -> bytes:
        steps = np.diff(self.symbols, prepend=np.uint32(0)).astype("<u4")
        body = zlib.compress(steps.tobytes() + self.scaled.astype("<u4").tobytes(), 6)
        return np.array([self.bits, len(self.symbols), zlib.crc32(body)], "<u4").tobytes() + body

    @classmethod
    def read(cls, data: bytes) -> Table:
        bits, n, crc = np.frombuffer(data[:12], "<u4").tolist()
        if zlib.crc32(data[12:]) != crc:
            raise ValueError("a frequency table is damaged")
        both = np.frombuffer(zlib.decompress(data[12:]), "<u4").reshape(2, n)
        return cls(np.cumsum(both[0], dtype=np.uint32), both[1].astype(np.uint64), bits)


def encode(ids: np.ndarray, table: Table) -> bytes:
    """The lanes' last states, then the words in the order in which decoding takes them."""
    place = np.searchsorted(table.symbols, ids) if len(table.symbols) < 1 << 16 and (
        len(ids) < 1 << 12) else _places(table.symbols)[ids]
    each, before = table.scaled[place], table.first[place]
    bits = np.uint64(table.bits)
    full = (_LOW >> bits) << _WORD
    most = each * full
    state = np.full(LANES, _LOW, np.uint64)
    words = []
    for at in range((len(ids) - 1) // LANES * LANES, -1, -LANES):
        f, c = each[at:at + LANES], before[at:at + LANES]
        x = state[:len(f)]
        out = x >= most[at:at + LANES]
        if out.any():
            words.append(x[out].astype("<u4"))
            x = np.where(out, x >> _WORD, x)
        whole = x // f
        state[:len(f)] = (whole << bits) + (x - whole * f) + c
    words.reverse()
    return state.astype("<u8").tobytes() + b"".join(w.tobytes() for w in words)


def _places(symbols: np.ndarray) -> np.ndarray:
    out = np.zeros(int(symbols[-1]) + 1, np.int32)
    out[symbols] = np.arange(len(symbols))
    return out


def decode(data: memoryview, n: int, table: Table) -> np.ndarray:
    """n tokens from what ``encode`` gave."""
    state = np.frombuffer(data[:8 * LANES], "<u8").astype(np.uint64)
    words = np.frombuffer(data[8 * LANES:], "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(table.symbols), dtype=np.int32), table.scaled.astype(np.int64))
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    out = np.empty(n, np.uint32)
    taken = 0
    for at in range(0, n, LANES):
        x = state[:min(LANES, n - at)]
        slot = x & mask
        s = owner[slot]
        out[at:at + LANES] = s
        x = table.scaled[s] * (x >> bits) + slot - table.first[s]
        low = np.flatnonzero(x < _LOW)
        if len(low):
            x[low] = x[low] << _WORD | words[taken:taken + len(low)]
            taken += len(low)
        state[:len(x)] = x
    if taken != len(words) or (state != _LOW).any():
        raise ValueError("a block does not end as it began")
    return table.symbols[out]


class _Writer:
    """One file; ``rows`` describes its segments."""

    def __init__(self, folder: str, part: int) -> None:
        self.files, base = fs.FileSystem.from_uri(folder)
        self.files.create_dir(base, recursive=True)
        self.path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.tok"
        self.out = self.files.open_output_stream(f"{base}/{self.path.rpartition('/')[2]}",
                                                 compression=None)
        self.out.write(MAGIC)
        self.at, self.tokens = len(MAGIC), 0
        self.rows: list[dict] = []
        self.index: list[dict] = []

    def segment(self, keys: np.ndarray, missing: np.ndarray, size: np.ndarray,
                ids: np.ndarray) -> None:
        table = Table.of(ids)
        stored = table.stored()
        begin = self.at
        self.out.write(stored)
        self.at += len(stored)
        ends = np.cumsum(size)
        first, blocks = 0, []
        while first < len(size):
            done = int(ends[first] - size[first])
            last = max(first + 1, int(np.searchsorted(ends, done + BLOCK_TOKENS, side="right")))
            n = int(ends[last - 1]) - done
            body = (keys[first:last].astype("<i8").tobytes()
                    + missing[first:last].astype("u1").tobytes()
                    + size[first:last].astype("<u4").tobytes()
                    + encode(ids[done:done + n], table))
            blocks.append({"at": self.at - begin, "bytes": len(body), "documents": last - first,
                           "tokens": n, "crc32": zlib.crc32(body)})
            self.out.write(body)
            self.at += len(body)
            first = last
        entry = {"at": begin, "table": len(stored), "tokens": len(ids), "blocks": blocks}
        self.index.append(entry)
        self.rows.append({"path": self.path, "segment": len(self.index) - 1, "at": begin,
                          "bytes": self.at - begin, "before": self.tokens, "tokens": len(ids)})
        self.tokens += len(ids)

    def close(self) -> None:
        index = json.dumps(self.index).encode()
        self.out.write(index + np.array([len(index)], "<u8").tobytes() + MAGIC)
        self.out.close()


_SEGMENTS = ("part int, path string, segment int, at long, bytes long, before long, tokens long")


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Writes the files; returns the table of their segments, which it saves too."""

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder, writer, held, n = None, None, [], 0

        def flush() -> None:
            writer.segment(*(np.concatenate(x) for x in zip(*held)))
            held.clear()

        for batch in batches:
            for b in slices(batch, most=TOKEN_SLICE):
                encoder = encoder or word_tokens(tokenizer)
                writer = writer or _Writer(folder, part)
                ids, at = encoder.encode(b.column("text"), end_id)
                key = b.column("doc_id")
                held.append((np.asarray(key.fill_null(0)), np.asarray(key.is_null()), np.diff(at),
                             ids))
                n += len(ids)
                if n >= SEGMENT_TOKENS:
                    flush()
                    n = 0
        if writer:
            if held:
                flush()
            writer.close()
            yield pa.RecordBatch.from_pylist([{"part": part, **r} for r in writer.rows], pa.schema([
                ("part", pa.int32()), ("path", pa.string()), ("segment", pa.int32()),
                ("at", pa.int64()), ("bytes", pa.int64()), ("before", pa.int64()),
                ("tokens", pa.int64())]))

    ordered = documents(docs).withColumn("_tie", F.xxhash64("text"))
    ordered = (ordered.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
               .drop("_tie"))
    return saved(ordered.mapInArrow(files, _SEGMENTS), "token-segments")


def read(segments: DataFrame, with_ids: bool = False) -> DataFrame:
    """A row for each document: doc_id, start, n_tokens, ids_crc32 (and its ids)."""
    # one row for each file here: sums of the files before
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = segments.groupBy("part").agg(F.sum("tokens").alias("n"))
    totals = totals.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    todo = segments.join(totals, "part").select(
        "path", "at", "bytes", "segment", (F.col("ahead") + F.col("before")).alias("start"))
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
              ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int64()))] * with_ids

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, path = fs.FileSystem.from_uri(row["path"])
                with files.open_input_file(path) as f:
                    blocks = _index(f)[row["segment"]]
                    data = memoryview(f.read_at(row["bytes"], row["at"]))
                table = Table.read(bytes(data[:blocks["table"]]))
                start = row["start"]
                for b in blocks["blocks"]:
                    body = data[b["at"]:b["at"] + b["bytes"]]
                    if zlib.crc32(body) != b["crc32"]:
                        raise ValueError(f"{path}: the block at {row['at'] + b['at']} is damaged")
                    n = b["documents"]
                    keys = np.frombuffer(body[:8 * n], "<i8")
                    missing = np.frombuffer(body[8 * n:9 * n], "u1").astype(bool)
                    size = np.frombuffer(body[9 * n:13 * n], "<u4").astype(np.int64)
                    ids = decode(body[13 * n:], b["tokens"], table)
                    ends = np.cumsum(size)
                    raw = memoryview(ids.astype("<u4").tobytes())
                    crc = [zlib.crc32(raw[4 * (e - s):4 * e])
                           for e, s in zip(ends.tolist(), size.tolist())]
                    out = [pa.array(keys, mask=missing), pa.array(start + ends - size),
                           pa.array(size), pa.array(crc, pa.int64())]
                    if with_ids:
                        out.append(pa.ListArray.from_arrays(
                            pa.array(np.append(0, ends).astype(np.int32)),
                            pa.array(ids.astype(np.int64))))
                    yield pa.RecordBatch.from_arrays(out, schema=pa.schema(fields))
                    start += b["tokens"]

    names = "doc_id long, start long, n_tokens long, ids_crc32 long"
    # few rows, each of much work: a stated number of tasks, which Spark does not merge
    tasks = max(1, min(MOST_TASKS, segments.count()))
    return todo.repartition(tasks, "path", "segment").mapInArrow(
        decoded, names + ", ids array<long>" * with_ids)


def _index(f) -> list[dict]:
    tail = f.read_at(16, f.size() - 16)
    if tail[8:] != MAGIC:
        raise ValueError("not a whole token file")
    n = int(np.frombuffer(tail[:8], "<u8")[0])
    return json.loads(f.read_at(n, f.size() - 16 - n))


def round_trip(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Writes the token files and returns what reading them back gives."""
    folder = new_folder(docs.sparkSession, "tokens")
    return read(write(docs, folder, tokenizer, end_id))
