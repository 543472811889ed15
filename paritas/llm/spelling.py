"""Spelling variants: near words found by reduced-alphabet generation.

Letters are hashed to a few symbols (their number modulo the alphabet's size),
so that a word has a short neighbourhood: all symbol strings one insertion,
deletion or replacement away. Words one edit apart have reduced words at most
one edit apart, so the neighbourhoods of the reduced vocabulary, joined with
the reduced vocabulary, hold every pair; the pairs of words behind them are
verified on the original strings. The relation has two sides and either finds
it: of each neighbourhood the members are kept that are shorter than the word
or do not sort after it.

Where too many words share two neighbouring reduced words, these words are
reduced again to a larger alphabet, at last to one symbol a letter, where each
reduced word is a word. So no group of words is ever paired in full.

Reduced words travel as 64-bit numbers; unequal ones with equal numbers only
cost a check.

Edge cases: null and empty texts have no words; a null ``doc_id`` counts as
empty text in the fault rule. Repeated rows count as often as they occur. Very
long texts are read in slices, very long words are words. Among near words of
equal count the first in code-point order is the form. An empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from paritas.llm.common import LOWER, byte_buffer, documents, saved, slices

LEAST_LETTERS, LEAST_COUNT = 6, 5
#: A form occurs this many times as often as its variant.
TIMES = 5
#: Of the runs, those with crc32(doc_id:run) divisible by this lose a letter.
FAULT_EVERY = 199
#: Symbols of the reduced alphabets, tried in this order; the last has one for each letter.
ALPHABETS = (8, 24, 90)
#: Pairs of words that two neighbouring reduced words may stand for; beyond it the next
#: alphabet parts them.
CROWD = 1024

#: The letters of words after lowering: a-z, U+00C0 to U+00FF.
LETTERS = "".join(map(chr, [*range(97, 123), *range(0xC0, 0x100)]))
_SLICE = 4 << 20
_BASE = 0x9E3779B97F4A7C15
_CELLS = 1 << 20  # letters of a block of words whose neighbours are made at once

_ASCII = np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True
_CRC = np.zeros(256, np.uint32)
for _i in range(256):
    _c = _i
    for _ in range(8):
        _c = (_c >> 1) ^ (0xEDB88320 if _c & 1 else 0)
    _CRC[_i] = _c


def _in_runs(buf: np.ndarray, before: int = 0) -> np.ndarray:
    """Which bytes belong to a letter; U+00C0 to U+00FF are 0xC3 and one byte more."""
    lead = buf == 0xC3
    out = _ASCII[buf] | lead
    out[1:] |= lead[:-1]
    if before == 0xC3 and len(out):
        out[0] = True
    return out


def _cuts(buf: np.ndarray, most: int) -> list[int]:
    """Where to cut a long text into slices of about ``most`` bytes, outside runs."""
    out = [0]
    while len(buf) - out[-1] > most:
        at = out[-1] + most
        while at < len(buf):  # the first byte from here on that is in no run
            free = np.flatnonzero(~_in_runs(buf[at:at + 65536], int(buf[at - 1])))
            if len(free):
                at += int(free[0])
                break
            at += 65536
        if at >= len(buf):
            break
        out.append(at)
    return [*out, len(buf)]


def _crc32(buf: np.ndarray, start: np.ndarray, size: np.ndarray, state: np.ndarray) -> np.ndarray:
    """crc32 of each range of ``buf``, each going on from a state of its own."""
    order = np.argsort(-size, kind="stable")
    begin, left, now = start[order], size[order], state[order] ^ np.uint32(0xFFFFFFFF)
    long = int(np.searchsorted(-left, -64, side="right"))  # the few longer ones one by one
    for i in range(long):
        a = int(begin[i])
        now[i] = zlib.crc32(buf[a:a + int(left[i])], int(now[i] ^ 0xFFFFFFFF)) ^ 0xFFFFFFFF
    begin, left, rest = begin[long:], left[long:], now[long:]
    for j in range(int(left[0]) if len(left) else 0):
        k = int(np.searchsorted(-left, -j, side="left"))  # those longer than j
        rest[:k] = _CRC[(rest[:k] ^ buf[begin[:k] + j]) & 255] ^ (rest[:k] >> np.uint32(8))
    out = np.empty_like(now)
    out[order] = now ^ np.uint32(0xFFFFFFFF)
    return out


def _words(buf: np.ndarray, offsets: np.ndarray, ids: list, least: int,
           every: int) -> tuple[pa.Array, list[str]]:
    """The lower-cased runs of a slice without a fault, and those with one, mended by it."""
    run = _in_runs(buf)
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    begins, ends = edge.copy(), edge
    begins[1:] |= ~run
    ends[:-1] |= ~run
    start = np.flatnonzero(run & begins[:-1])
    end = np.flatnonzero(run & ends[1:]) + 1
    letters = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    keep = letters[end] - letters[start] >= least
    start, end = start[keep], end[keep]
    low = LOWER[buf]
    doc = np.searchsorted(offsets, start, side="right") - 1
    states = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    crc = _crc32(low, start, end - start, states[doc])
    fault = crc % every == 0
    mended = []
    for s, e, h in zip(start[fault].tolist(), end[fault].tolist(), crc[fault].tolist()):
        word = low[s:e].tobytes().decode()
        at = h % len(word)
        if len(word) > least:
            mended.append(word[:at] + word[at + 1:])
    start, end = start[~fault], end[~fault]
    inside = np.zeros(len(buf) + 1, np.int8)
    inside[start] += 1
    inside[end] -= 1
    own = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
    bounds = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    whole = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(bounds),
                                             pa.py_buffer(low[own]))
    return whole, mended


def vocabulary(docs: DataFrame, least_letters: int = LEAST_LETTERS,
               least_count: int = LEAST_COUNT, every: int = FAULT_EVERY) -> DataFrame:
    """(word, n) of all words with ``least_letters`` letters that occur ``least_count`` times."""
    kind = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, most=_SLICE):
                buf, offsets = byte_buffer(b.column("text"))
                ids = b.column("doc_id").to_pylist()
                cuts = [0, len(buf)] if b.num_rows > 1 else _cuts(buf, _SLICE)
                for low, high in zip(cuts, cuts[1:]):
                    at = offsets if b.num_rows > 1 else np.array([0, high - low])
                    whole, mended = _words(buf[low:high], at, ids, least_letters, every)
                    found = pc.value_counts(pa.concat_arrays(
                        [whole, pa.array(mended, pa.large_string())]))
                    yield pa.RecordBatch.from_arrays(
                        [found.field(0).cast(pa.string()), found.field(1)], schema=kind)

    return (documents(docs).mapInArrow(counts, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def _matrices(reduced: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal length at a time: their numbers, and a matrix of symbols (from 1 on)."""
    buf, offsets = byte_buffer(reduced)
    size = np.diff(offsets)
    for n in np.unique(size).tolist():
        rows = np.flatnonzero(size == n)
        step = max(1, _CELLS // max(n, 1))
        for i in range(0, len(rows), step):
            some = rows[i:i + step]
            yield some, buf[offsets[some][:, None] + np.arange(n)].astype(np.uint64) - np.uint64(32)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)[::-1]


def _own(codes: np.ndarray) -> np.ndarray:
    return (codes * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


@F.arrow_udf(LongType())
def _number(reduced: pa.Array) -> pa.Array:
    out = np.zeros(len(reduced), np.uint64)
    for rows, codes in _matrices(reduced):
        out[rows] = _own(codes)
    return pa.array(out.view(np.int64))


def neighbours(codes: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, number) for each row's own reduced word, its deletions, and its
    replacements that do not sort after it; in blocks."""
    n = codes.shape[1]
    power = _powers(n)
    terms = codes * power
    own = terms.sum(axis=1, dtype=np.uint64)
    yield np.arange(len(codes)), own
    # without letter i: what stands before moves one place
    ahead = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    after = own[:, None] - ahead - terms
    shorter = ahead * np.uint64(pow(_BASE, -1, 1 << 64)) + after
    new = np.ones(codes.shape, bool)
    new[:, 1:] = codes[:, 1:] != codes[:, :-1]  # of equal letters in a row any may go
    row, at = np.nonzero(new)
    yield row, shorter[row, at]
    for s in range(1, symbols + 1):
        other = own[:, None] + (np.uint64(s) - codes) * power
        row, at = np.nonzero((codes != s) & (other <= own[:, None]))
        yield row, other[row, at]


def near_pairs(words: DataFrame, alphabets: tuple[int, ...] = ALPHABETS,
               crowd: int = CROWD) -> DataFrame:
    """(a, b, n_a, n_b) for all words a < b one edit apart."""
    symbols, more = alphabets[0], alphabets[1:]
    image = "".join(chr(33 + i % symbols) for i in range(len(LETTERS)))
    keyed = words.select("word", "n", F.translate("word", LETTERS, image).alias("reduced"))
    keyed = saved(keyed.withColumn("key", _number("reduced")), "reduced")
    groups = keyed.groupBy("reduced", "key").agg(F.count(F.lit(1)).alias("size"))
    kind = pa.schema([("key", pa.int64()), ("owner", pa.int64()), ("owner_size", pa.int64())])

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, size = np.asarray(b.column("key")), np.asarray(b.column("size"))
            for rows, codes in _matrices(b.column("reduced")):
                for row, number in neighbours(codes, symbols):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(number.view(np.int64)), pa.array(own[rows[row]]),
                        pa.array(size[rows[row]])], schema=kind)

    # the vocabulary grows with the corpus: never broadcast
    met = (groups.mapInArrow(around, "key long, owner long, owner_size long")
           .join(groups.select("key", "size").hint("merge"), "key"))
    met = saved(met, "near-reduced")
    crowded = (F.col("owner_size") * F.col("size") > crowd) if more else F.lit(False)
    one = keyed.select(F.col("key").alias("owner"), F.col("word").alias("x"), F.col("n").alias("n_x"))
    two = keyed.select("key", F.col("word").alias("y"), F.col("n").alias("n_y"))
    first = F.col("x") < F.col("y")
    found = (met.where(~crowded).select("owner", "key").distinct()
             .join(one.hint("merge"), "owner").join(two.hint("merge"), "key")
             .where((F.col("owner") != F.col("key")) | first)
             .where(F.levenshtein("x", "y", 1) == 1)
             .select(F.when(first, F.col("x")).otherwise(F.col("y")).alias("a"),
                     F.when(first, F.col("y")).otherwise(F.col("x")).alias("b"),
                     F.when(first, F.col("n_x")).otherwise(F.col("n_y")).alias("n_a"),
                     F.when(first, F.col("n_y")).otherwise(F.col("n_x")).alias("n_b")))
    if more:
        hot = met.where(crowded)
        hot = hot.select("owner").union(hot.select("key")).distinct().withColumnRenamed("owner", "key")
        again = saved(keyed.join(hot.hint("merge"), "key", "left_semi").select("word", "n"), "crowded")
        if not again.isEmpty():
            found = found.union(near_pairs(again, more, crowd))
    return found.dropDuplicates(["a", "b"])


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): every pointer doubles until none moves. A
    form occurs ``TIMES`` times as often as its word, so chains are short and end."""
    now = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = saved(now.join(step.hint("merge"), "root", "left"), "roots")
        now = step.select("word", F.coalesce("further", "root").alias("root"))
        if step.where(F.col("further").isNotNull()).isEmpty():
            return now


def variants(docs: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of ``vocabulary(docs)``."""
    words = saved(vocabulary(docs), "words")
    pairs = saved(near_pairs(words), "near-words")
    both = pairs.union(pairs.select("b", "a", "n_b", "n_a"))
    # the largest n first, then the first in code-point order
    best = both.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("near"))).alias("best"))
    known = words.join(best.hint("merge"), "word", "left")
    good = -F.col("best.less") >= times * F.col("n")
    known = saved(known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, F.col("best.near")).alias("form"),
        F.when(good, -F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(known.where(F.col("form").isNotNull()))
    return known.join(roots.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
