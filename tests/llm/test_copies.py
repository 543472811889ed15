"""Near-duplicate groups, components, repeated passages and the pipeline."""

import math
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tests.llm.conftest import TEXTS

from paritas.llm import forest, graph, near, paragraphs, queries

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def runs(text, k):
    w = word_list(text)
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) or (
        frozenset([tuple(w)]) if w else frozenset())


class Groups(dict):
    def root(self, a):
        while self.setdefault(a, a) != a:
            a = self[a]
        return a

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)


def plain_groups(docs, k):
    """Exact: documents that share one of their rarest runs are compared."""
    sets = {d: runs(t, k) for d, t in docs}
    count = Counter(g for s in sets.values() for g in s)
    held, out = defaultdict(list), Groups()
    for d in sorted(sets):
        s = sorted(sets[d], key=lambda g: (count[g], g))
        seen = set()
        for g in s[:len(s) - math.ceil(.8 * len(s)) + 1] if s else ():
            seen.update(held[g])
            held[g].append(d)
        for e in seen:
            both = len(sets[d] & sets[e])
            if 100 * both >= 80 * (len(sets[d]) + len(sets[e]) - both):
                out.join(d, e)
    return sets, {d: out.root(d) for d in sets}


def check_groups(rows, docs, k):
    sets, group = plain_groups(docs, k)
    assert len(rows) == len(docs)
    for r in rows:
        assert r.n_shingles == len(sets[r.doc_id]) and r.component_id == group[r.doc_id], r
        assert r.kept == (r.doc_id == r.component_id)


def test_forest_query(spark):
    docs = [tuple(r) for r in
            spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check_groups(queries.op2_lsh_forest(spark, SF).collect(), docs, 2)


def test_forest_chains_and_families(spark):
    """Chains of copies of copies, a large family, near misses, short texts."""
    random.seed(11)
    vocabulary = [f"w{i}" for i in range(300)]
    docs, n = [], 0

    def put(words):
        nonlocal n
        docs.append((n * 7 % 5003, " ".join(words)))
        n += 1

    for _ in range(10):
        w = random.choices(vocabulary, k=60)
        for _ in range(8):  # each a copy of the last one
            put(w)
            w = list(w)
            w[random.randrange(60)] = random.choice(vocabulary)
    w = random.choices(vocabulary, k=80)
    for _ in range(200):
        v = list(w)
        for _ in range(random.randint(0, 6)):
            v[random.randrange(80)] = random.choice(vocabulary)
        put(v)
    for _ in range(40):
        put(random.choices(vocabulary[:4], k=random.randint(0, 4)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    check_groups(forest.groups(frame).collect(), docs, 2)
    # groups in many runs and blocks give the same
    check_groups(forest.groups(frame, run_rows=7, block_rows=20).collect(), docs, 2)


def test_keys_of_long_texts():
    """Unlike texts of 300,000 shingles have unlike keys in every tree."""
    random_hashes = np.random.default_rng(3).integers(0, 2**64, 4 * 300_000, dtype=np.uint64)
    signature = near.signatures(random_hashes, np.repeat(np.arange(4), 300_000), 4, 160)
    keys = near.packed(signature.reshape(4, 40, 4))
    assert all(len(set(keys[:, i].tolist())) == 4 for i in range(40))


def test_large_regions_are_one_group():
    """All rows of a region above the limit are linked, wherever batches are cut."""
    rng = np.random.default_rng(4)
    sizes = [3, 4, 5, 8, 1, 9, 30, 2]
    high = np.repeat(np.arange(len(sizes)), sizes)
    n = len(high)
    s1, s2 = rng.integers(-2**63, 2**63 - 1, (2, n))  # nobody's sketch is near another's
    rows = pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (np.zeros(n, np.int32), high, rng.permutation(n), s1, s2)],
        ["tree", "high", "id", "s1", "s2"])
    ident = rows.column("id").to_pylist()
    for cut in (1, 2, 4, 7, n):
        batches = [rows.slice(i, cut) for i in range(0, n, cut)]
        group, edges = Groups(), 0
        for e in near._candidates(iter(batches), 10, 4):
            for a, b in zip(*(c.to_pylist() for c in e.columns)):
                group.join(a, b)
                edges += 1
        for h, size in enumerate(sizes):
            roots = {group.root(ident[i]) for i in range(n) if high[i] == h}
            assert len(roots) == (1 if size > 4 else size), (cut, h)
        assert edges == sum(s - 1 for s in sizes if s > 4)


def test_forest_long_texts_in_large_regions(spark):
    """A pair of long near copies is found among unlike long texts, regions of three rows."""
    rng = np.random.default_rng(5)
    docs = []
    for i in range(8):
        docs.append((i, rng.integers(0, 10**9, 250_000)))
    near_copy = docs[0][1].copy()
    near_copy[::50] = -1
    docs.append((8, near_copy))
    frame = spark.createDataFrame([(i, " ".join(map(str, w.tolist()))) for i, w in docs],
                                  "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in forest.groups(frame, region=3).collect()}
    assert got == {**{i: i for i in range(8)}, 8: 0}


def test_forest_edges(odd, empty):
    rows = forest.groups(odd, k=5).collect()
    assert len(rows) == len(TEXTS)
    by = {r.doc_id: r for r in rows}
    assert by[5].component_id == 1 and not by[5].kept and by[1].kept
    assert by[2].n_shingles == by[3].n_shingles == by[4].n_shingles == 0 and by[3].kept
    assert by[None].component_id is None and by[None].kept and by[7].n_shingles == 1
    assert forest.groups(empty).count() == 0


def test_components(spark):
    random.seed(12)
    edges = [(i, i + 1) for i in range(60)] + [(500, i) for i in range(501, 600)]
    edges += [(random.randint(1000, 1400), random.randint(1000, 1400)) for _ in range(250)]
    random.shuffle(edges)
    want = Groups()
    for a, b in edges:
        want.join(a, b)
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == {
        x: want.root(x) for e in edges if e[0] != e[1] for x in e}
    assert len(got) == len({r.id for r in got})


# --- paragraphs -------------------------------------------------------------
def test_passages_query(spark):
    docs = {r.doc_id: word_list(r.text)
            for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}

    def sharing(n):
        held = defaultdict(set)
        for d, w in docs.items():
            for i in range(len(w) - n + 1):
                held[tuple(w[i:i + n])].add(d)
        return {d for v in held.values() if len(v) > 1 for d in v}

    got = {r.doc_id for r in queries.op1_paragraph_dedup(spark, SF).collect()}
    near = {d for d, g in plain_groups([(d, " ".join(w)) for d, w in docs.items()], 5)[1].items()
            if g != d}
    assert sharing(51) <= got <= sharing(24) | near | {
        g for g in plain_groups([(d, " ".join(w)) for d, w in docs.items()], 5)[1].values()}


def test_passages_inside_text(spark):
    random.seed(13)
    fresh = lambda n: [f"f{random.randrange(10**9)}" for _ in range(n)]
    passage, line = fresh(51), fresh(100)
    near = list(line)
    near[50] = "other"
    docs = [(i, " ".join(fresh(random.randint(0, 90)) + passage + fresh(random.randint(0, 90))))
            for i in range(20)]
    docs += [(100, " ".join(fresh(9)) + "\n" + " ".join(line)), (101, " ".join(near) + "\nend"),
             (102, " ".join(fresh(500)))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    spans = paragraphs.repeats(frame)
    rows = spans.collect()
    assert {r.doc_id for r in rows} == {*range(20), 100, 101}
    text = dict(docs)
    for r in rows:
        inside = set(text[r.doc_id][r.start:r.end].split())
        assert inside <= set(passage if r.doc_id < 20 else [*line, "other"])
    # at a passage's ends the text around it may set a paragraph that only some copies have
    assert {(r.doc_id, r.first_doc_id) for r in rows if not r.kept} >= {
        *((i, 0) for i in range(1, 20)), (101, 100)}
    assert {r.doc_id for r in rows if not r.kept} == {*range(1, 20), 101}
    rest = {r.doc_id: r.text for r in paragraphs.without_repeats(frame, spans).collect()}
    assert rest[102] == text[102] and rest[0] == text[0] and rest[101].strip() == "end"
    assert len(rest[5]) < len(text[5])


def test_short_lines(spark):
    """Lines of 24 words and more are found as equal and as near copies."""
    random.seed(14)
    fresh = lambda n: [f"g{random.randrange(10**9)}" for _ in range(n)]
    docs, n = [], 0
    for size in (24, 26, 30, 40, 49):
        for edited in (False, True):
            line = fresh(size)
            other = [*line[:-1], "other"] if edited else line
            docs.append((n, " ".join(fresh(30)) + "\n" + " ".join(line)))
            docs.append((n + 1, " ".join(other) + "\n" + " ".join(fresh(30))))
            n += 2
    rows = paragraphs.repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    whole = {(r.doc_id, r.first_doc_id) for r in rows if not r.kept and r.start == 0
             and r.end == docs[r.doc_id][1].index("\n")}
    assert whole == {(i + 1, i) for i in range(0, n, 2)}


def test_passages_edges(odd, empty):
    rows = paragraphs.repeats(odd).collect()
    assert all(r.doc_id is not None for r in rows) and not {7, 9} & {r.doc_id for r in rows}
    assert paragraphs.repeats(empty).count() == 0


# --- pipeline ---------------------------------------------------------------
def test_pipeline_stages(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == odd.columns, name
        assert {r.language for r in after.collect()} <= {"own"}
        docs = after
    text = {r.doc_id: r.text for r in docs.collect()}
    assert not {2, 3, 4, 5} & set(text) and {1, 7, 8, None} <= set(text)
    assert "abcdef0123456789" not in text[None]
    nothing = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, SF)
    assert nothing.count() == 0


def test_pipeline_against_plain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [" ".join(r.text.lower().split())
             for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    all_ = [(r.doc_id, r.text) for r in docs.collect()]
    some = [(d, t) for d, t in all_ if any(c.isalpha() for c in t)]
    _, group = plain_groups(some, 5)
    want = {d for d, t in some if group[d] == d
            and not any(x in " ".join(t.lower().split()) for x in items)}
    got = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in got.select("doc_id").distinct().collect()} == want
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
