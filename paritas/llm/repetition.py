"""Quality rules on repetition, from a suffix array over each text's words.

Words become numbers; prefix doubling ranks all suffixes by their first 1, 2,
4, 8, ... words. Suffixes that share no 8 words with another one need no more
order and drop out (most do after three rounds); the others are doubled on
until all ranks differ. The longest common prefixes of neighbours in that
order, found by descending through the kept ranks, bound the intervals of
maximal repeated substrings: a suffix repeats as many words as the larger
prefix it shares with its two neighbours. The union of those spans is the
repeated part of the text.

The verdict keeps a text with at least 20 words, a repeated part of at most 30
per cent of its words and no single repeat of 50 words or more that is over 10
per cent of them.

Edge cases: a null or empty text has no words and fails. A text of any length
is taken whole (numbers held at once: 4 bytes a word for each doubling round).
Repeated rows get the same result each; extra columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import free_name, slices, word_hashes, words

#: Words of the windows that count as repeated.
WINDOW = 8
#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_WHITE = " \t\n\v\f\r"


@dataclass(frozen=True)
class Limits:
    least_words: int = 20
    #: Per cent of the words that repeated windows may cover.
    most_repeated: int = 30
    #: A single repeat of so many words may have so many per cent of them.
    long_repeat: int = 50
    longest_repeat: int = 10


def repeated(number: np.ndarray, doc: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each word the length of the longest substring that begins there and
    occurs elsewhere in the same text, or 0 where that is under ``window`` words.

    number: a number for each word; doc: its text (ascending). ``window`` is a
    power of two."""
    n = len(number)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    # ranks by one word; texts share none, so no prefix reaches across texts
    order = np.lexsort((number, doc))
    new = np.ones(n, bool)
    new[1:] = (number[order][1:] != number[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    rank = np.empty(n, np.int32)
    rank[order] = np.cumsum(new)
    last = np.searchsorted(doc, doc, side="right")  # where the word's text ends
    levels, step = [rank], 1
    while step < window:
        levels.append(_doubled(levels[-1], np.arange(n), step, last))
        step *= 2
    # only suffixes whose first words occur twice go on
    count = np.bincount(levels[-1])
    at = np.flatnonzero(count[levels[-1]] > 1)
    at = at[at + window <= last[at]]
    if not len(at):
        return out
    sizes = [2**i for i in range(len(levels))]
    open_ = at
    while len(open_):
        rank = _doubled(levels[-1], open_, step, last)
        levels.append(rank)
        step *= 2
        sizes.append(step)
        count = np.bincount(rank[open_])
        open_ = open_[count[rank[open_]] > 1]
    order = at[np.lexsort((levels[-1][at], levels[WINDOW.bit_length() - 1][at]))]
    shared = _common_prefix(order[:-1], order[1:], levels, sizes, last)
    longest = np.zeros(len(order), np.int64)
    longest[:-1] = shared
    longest[1:] = np.maximum(longest[1:], shared)
    out[order] = np.where(longest >= window, longest, 0)
    return out


def _doubled(rank: np.ndarray, at: np.ndarray, step: int, last: np.ndarray) -> np.ndarray:
    """Ranks by twice as many words at the suffixes ``at``. Other suffixes keep
    their old rank: theirs are already unlike all others'."""
    follow = at + step
    second = np.where(follow < last[at], rank[np.minimum(follow, len(rank) - 1)], 0)
    first = rank[at].astype(np.int64)
    key = first << 32 | second
    order = np.argsort(key, kind="stable")
    sorted_key, sorted_first = key[order], first[order]
    new = np.ones(len(at), bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    group = np.ones(len(at), bool)
    group[1:] = sorted_first[1:] != sorted_first[:-1]
    # ranks stay spread out, so that those of one old rank go between it and the next
    place = np.arange(len(at))
    start = np.maximum.accumulate(np.where(group, place, 0))
    within = np.maximum.accumulate(np.where(new, place, 0)) - start
    out = rank.copy()
    if len(at) == len(rank):
        out[at[order]] = np.maximum.accumulate(np.where(new, place, 0)) + 1
    else:
        out[at[order]] = sorted_first + within
    return out


def _common_prefix(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray], sizes: list[int],
                   last: np.ndarray) -> np.ndarray:
    """Words that the suffixes a and b share, by descending through the ranks."""
    done = np.zeros(len(a), np.int64)
    for rank, size in zip(reversed(levels), reversed(sizes)):
        i, j = a + done, b + done
        inside = (i + size <= last[a]) & (j + size <= last[b])
        top = len(rank) - 1
        done += size * (inside & (rank[np.minimum(i, top)] == rank[np.minimum(j, top)]))
    return done


def _covered(longest: np.ndarray) -> np.ndarray:
    """True for words inside any repeat (longest: by where it begins)."""
    n = len(longest)
    reach = np.maximum.accumulate(np.where(longest > 0, np.arange(n) + longest, 0))
    return reach > np.arange(n)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(_WHITE)]
    return len(lines) - len(set(lines))


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text."""
    w = words(texts)
    first = w.first
    lead = (w.buf & 0xC0) != 0x80
    seen = np.concatenate([[0], np.cumsum(lead)])
    chars = seen[w.end] - seen[w.start]
    longest = repeated(word_hashes(w), w.doc)
    top = np.zeros(len(texts), np.int64)
    np.maximum.at(top, w.doc, longest)
    return {
        "n_words": np.diff(first),
        "word_chars": _sums(chars, first),
        "n_symbols": _sums(_SYMBOL[w.buf], w.offsets),
        "n_dup_lines": np.array([_repeated_lines(x) for x in texts.to_pylist()], np.int64),
        "n_repeat_words": _sums(_covered(longest), first),
        "longest_repeat": top,
    }


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "longest_repeat")


def judge(docs: DataFrame, limits: Limits = Limits(), into: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``into``: the measures, ``base_failed`` and ``kept``."""

    @F.arrow_udf(", ".join(f"{k} long" for k in _MEASURES))
    def counted(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.schema([(k, pa.int64()) for k in _MEASURES])
        for column in texts:
            parts = [measures(b.column(0)) for b in slices(
                pa.RecordBatch.from_arrays([column.fill_null("")], ["text"]))]
            yield pa.RecordBatch.from_pydict(
                {k: np.concatenate([p[k] for p in parts] or [np.zeros(0, np.int64)])
                 for k in _MEASURES}, kind).to_struct_array()

    name = free_name(docs, "measured")
    m = {k: F.col(name)[k] for k in _MEASURES}
    failed = (m["n_words"] < limits.least_words) | (
        100 * m["n_repeat_words"] > limits.most_repeated * m["n_words"])
    long = (m["longest_repeat"] >= limits.long_repeat) & (
        100 * m["longest_repeat"] > limits.longest_repeat * m["n_words"])
    kept = ~failed & ~long
    measured = docs.withColumn(name, counted(F.col("text")))
    return measured.withColumn(into, F.struct(
        *[m[k].alias(k) for k in _MEASURES], failed.alias("base_failed"), kept.alias("kept"),
    )).drop(name)
