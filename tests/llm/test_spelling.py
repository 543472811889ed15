"""Spelling variants against a plain version and SQL."""

import collections
import re
import zlib

import numpy as np
import pytest
from tests.oracle_check import compare, duck

from paritas.llm import queries, spelling
from paritas.llm.common import byte_buffer

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, every=199, least=6, count=5, times=5):
    n = collections.Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= least:
                n[w] += 1
    n = {w: c for w, c in n.items() if c >= count}
    letters = {c for w in n for c in w}
    near = {}
    for w in n:
        cut = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        near[w] = {x for a, b in cut for x in (
            [a + b[1:]] if b else []) + [a + c + b for c in letters] + (
            [a + c + b[1:] for c in letters] if b else []) if x in n and x != w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= times * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_query_against_plain_version_and_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = rows_of(queries.op13_spelling_variants(spark, SF))
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert got == want and len(got) > 500
    done = compare(spark, duck(SF), "op13", queries.QUERIES["op13_spelling_variants"],
                   queries.ORACLE["op13_spelling_variants"], SF)
    assert done["values"]


@pytest.mark.parametrize("crowd", [0, 3])
def test_crowded_words_meet_in_larger_alphabets(spark, crowd):
    words = ["aaaaaaaa", "aaaaaaai", "aaaaaaaq", "iaaaaaaa", "aaaaaaa", "iiiiiiii", "aiaiaiai",
             "qqqqqqqq", "aaaaaaaaa", "aaabaaaa", "résumés", "resumés", "resumes", "bbbbbb"]
    df = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long")
    got = {(r.a, r.b) for r in spelling.near_pairs(df, crowd=crowd).collect()}
    assert got == {(r.a, r.b) for r in spelling.near_pairs(df).collect()}

    def apart(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b))
        a, b = sorted((a, b), key=len)
        return 1 if len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b))) else 2

    assert got == {(a, b) for a in words for b in words if a < b and apart(a, b) == 1}


def test_edges(spark, odd, empty):
    got = rows_of(spelling.variants(odd))
    assert got == plain([(r.doc_id, r.text) for r in odd.collect()])
    assert rows_of(spelling.variants(empty)) == []


def test_chains_and_ties(spark):
    text = " ".join(["letters"] * 150 + ["lettars"] * 25 + ["lattars"] * 5 + ["Lettera"] * 25
                    + ["lettersé"] * 5 + ["outside"] * 6)
    docs = spark.createDataFrame([(i, text) for i in (3, 3, None)], "doc_id long, text string")
    got = rows_of(spelling.variants(docs))
    assert got == plain([(r.doc_id, r.text) for r in docs.collect()])
    by = {r[0]: r for r in got}
    assert by["lattars"][1:3] == ("lettars", "letters") and by["outside"][1:3] == (None, "outside")


def test_long_texts_are_cut_outside_words():
    text = ("é" * 700 + " " + "word, " * 300 + "x" * 2000 + ".") * 3
    buf = np.frombuffer(text.encode(), np.uint8)
    cuts = spelling._cuts(buf, 512)
    parts = [buf[a:b].tobytes().decode() for a, b in zip(cuts, cuts[1:])]
    assert len(parts) > 5 and "".join(parts) == text
    runs = [w for p in parts for w in re.findall("[A-Za-zÀ-ÿ]+", p)]
    assert runs == re.findall("[A-Za-zÀ-ÿ]+", text)


def test_slices_do_not_change_the_words(spark, ):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40).coalesce(1)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted((r[0], r[3]) for r in plain(rows))
    assert rows_of(spelling.vocabulary(docs)) == want


def test_crc_matches_zlib():
    import pyarrow as pa

    some = ["", "a", "abc" * 40, "é", "x" * 200, "hello"]
    buf, at = byte_buffer(pa.array(some))
    first = np.array([zlib.crc32(f"{i}:".encode()) for i in range(len(some))], np.uint32)
    got = spelling._crc32(buf, at[:-1], np.diff(at), first)
    assert got.tolist() == [zlib.crc32(f"{i}:{s}".encode()) for i, s in enumerate(some)]
