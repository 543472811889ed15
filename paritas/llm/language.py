"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of three letters in
a row binds (multiplies) them, the first shifted by two places and the second
by one, so that order counts. A text's vector bundles (adds) those of all its
runs of three; a language's prototype bundles the texts of that language. A
text gets the language whose prototype has the largest cosine with it.

Words are runs of letters, lower-cased, with an edge mark on both sides; all
other characters only part words.

Edge cases: a null text, an empty one or one without a letter gets ``und`` and
score 0. Rows whose ``lang`` or ``doc_id`` is null are not learned from. With
nothing to learn from, every row gets ``und``. Ties go to the language first
in alphabetical order. Repeated rows are each learned from and each returned;
extra columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import code_points, slices

DIMENSION = 1024
SEED = 20240501
#: A language's prototype is held by the driver and each task; more are refused.
MOST_LANGUAGES = 2000
#: Runs of three letters bundled by one matrix product, texts in one, and bytes of
#: texts taken at once.
_RUNS, _TEXTS, _BYTES = 4096, 512, 1 << 20
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 where it is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


@lru_cache(maxsize=4096)  # 4 MB
def _letter_vector(code: int, dimension: int) -> np.ndarray:
    rng = np.random.default_rng([SEED, code])
    return (rng.integers(0, 2, dimension, dtype=np.int8) * 2 - 1).astype(np.int8)


def _run_vectors(runs: np.ndarray, dimension: int) -> np.ndarray:
    """One row for each run (three letter codes)."""
    letters, at = np.unique(runs, return_inverse=True)
    at = at.reshape(runs.shape)
    base = np.stack([_letter_vector(int(c), dimension) for c in letters])
    return (np.roll(base, 2, 1)[at[:, 0]] * np.roll(base, 1, 1)[at[:, 1]]
            * base[at[:, 2]]).astype(np.float32)


def bundles(texts: pa.Array, group: np.ndarray, groups: int, dimension: int) -> np.ndarray:
    """A bundled vector for each group of texts (group: each text's number)."""
    out = np.zeros((groups, dimension), np.float64)
    points, begin = code_points(texts)
    if not len(points):
        return out
    # two marks before each text keep runs of three within it
    n = len(points) + 2 * len(texts) + 2
    seq = np.zeros(n, np.uint32)
    seq[np.arange(len(points)) + 2 * (np.repeat(np.arange(len(texts)), np.diff(begin)) + 1)] = (
        _letters()[points])
    text = np.repeat(np.arange(len(texts) + 1),
                     np.append(np.diff(begin) + 2, 2))
    keep = np.ones(n, bool)
    keep[1:] = (seq[1:] != 0) | (seq[:-1] != 0)  # one mark between words
    seq, text = seq[keep], text[keep]
    if len(seq) < 3:
        return out
    present = np.unique(seq)
    code = np.searchsorted(present, seq).astype(np.int64)
    a = len(present)
    run = (code[:-2] * a + code[1:-1]) * a + code[2:]
    keep = seq[1:-1] != 0  # the middle one is a letter
    run, owner = run[keep], group[np.minimum(text[1:-1][keep], len(texts) - 1)]
    if a <= 160:
        kinds = np.flatnonzero(np.bincount(run, minlength=1))
        place = np.zeros(a**3, np.int32)
        place[kinds] = np.arange(len(kinds))
        run = place[run]
    else:
        kinds, run = np.unique(run, return_inverse=True)
    codes = present[np.stack([kinds // (a * a), kinds // a % a, kinds % a], 1)]
    for low in range(0, len(kinds), _RUNS):
        high = min(low + _RUNS, len(kinds))
        vectors = _run_vectors(codes[low:high], dimension)
        inside = slice(None) if high - low == len(kinds) else (run >= low) & (run < high)
        r, g = run[inside] - low, owner[inside]
        for first in range(0, groups, _TEXTS):
            last = min(first + _TEXTS, groups)
            part = slice(None) if last - first == groups else (g >= first) & (g < last)
            count = np.bincount((g[part] - first) * (high - low) + r[part],
                                minlength=(last - first) * (high - low))
            out[first:last] += count.reshape(last - first, high - low).astype(np.float32) @ vectors
    return out


@dataclass
class Profiles:
    languages: list[str]
    prototypes: np.ndarray  # one row for each language
    dimension: int


def learn(docs: DataFrame, learned_from: Column, dimension: int = DIMENSION) -> Profiles:
    """Prototypes from all rows with a language for which ``learned_from`` holds.

    Tasks bundle their rows by language; Spark adds the parts up, so the driver
    gets ``dimension`` numbers a language, whatever the corpus holds."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for b in slices(batch, most=_BYTES):
                coded = b.column("lang").dictionary_encode()
                names = coded.dictionary.to_pylist()
                got = bundles(b.column("text"), np.asarray(coded.indices), len(names), dimension)
                for name, v in zip(names, got):
                    total[name] = total.get(name, 0) + np.rint(v).astype(np.int64)
        yield pa.RecordBatch.from_pydict(
            {"lang": list(total), "part": [v.tolist() for v in total.values()]},
            pa.schema([("lang", pa.string()), ("part", pa.list_(pa.int64()))]))

    rows = (docs.where(learned_from & F.col("text").isNotNull() & F.col("lang").isNotNull())
            .select("text", "lang")
            .mapInArrow(parts, "lang string, part array<bigint>")
            .select("lang", F.posexplode("part").alias("place", "value"))
            .groupBy("lang", "place").agg(F.sum("value").alias("value"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value")))
                                 .alias("sums"))
            .orderBy("lang").limit(MOST_LANGUAGES + 1).collect())
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} values of lang to learn")
    sums = np.array([[x["value"] for x in r["sums"]] for r in rows], np.float64)
    return Profiles([r["lang"] for r in rows], sums.reshape(len(rows), dimension), dimension)


def predict(docs: DataFrame, profiles: Profiles, into: str = "language") -> DataFrame:
    """``docs`` with a struct column ``into`` (lang_pred, score)."""
    size = np.linalg.norm(profiles.prototypes, axis=1, keepdims=True)
    unit = profiles.prototypes / np.where(size > 0, size, 1)
    names, dimension = profiles.languages, profiles.dimension
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("lang_pred string, score double")
    def best(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            out = []
            rows = pa.RecordBatch.from_arrays([column.fill_null("")], ["text"])
            for b in slices(rows, most=_BYTES):
                vectors = bundles(b.column(0), np.arange(b.num_rows), b.num_rows, dimension)
                length = np.linalg.norm(vectors, axis=1)
                for v, n in zip(vectors, length):
                    if not n or not names:
                        out.append({"lang_pred": UNDETERMINED, "score": 0.0})
                        continue
                    cosine = unit @ (v / n)
                    i = int(cosine.argmax())
                    out.append({"lang_pred": names[i],
                                "score": float(min(1.0, max(0.0, cosine[i])))})
            yield pa.array(out, kind)

    return docs.withColumn(into, best(F.col("text")))
