"""Conversation repair against a plain search over edits, and SQL."""

import hashlib
import random
import zlib

import pytest
from tests.oracle_check import compare, duck

from paritas.llm import queries, repair

SF = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\x0c\r"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
           "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (kind != 0) * (2 if kind == 3 else 1)
    return out


def plain(conv, rows):
    """The definition, by a search over (cost, audit) of all ways through the rows."""
    rows = sorted((r for r in rows if r[0] == conv), key=lambda r: (
        r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.strip(WHITE)
        faults.append("b" if not body else "d" if (role, text) in seen else
                      "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    word = {"user": "u", "assistant": "a"}

    def legal(so_far, initial):
        last = so_far[-1:]
        return initial in {"": "su", "s": "u", "u": "a", "a": "u"}[last]

    def inserted(ways):  # initials -> (cost, audit, lines); up to three insertions
        ways, new = dict(ways), dict(ways)
        for _ in range(3):
            more = {}
            for (had, last), (cost, audit, lines) in new.items():
                for role, i in word.items():
                    if legal(last, i):
                        more[had + 1, i] = min(more.get((had + 1, i), (10**9,)),
                                               (cost + 5, audit + "I", [*lines, role + ":"]))
            new = more
            for k, v in more.items():
                ways[k] = min(ways.get(k, (10**9,)), v)
        best = {}
        for (_, last), v in ways.items():
            best[0, last] = min(best.get((0, last), (10**9,)), v)
        return best

    ways = {(0, ""): (0, "", [])}
    for (_, _, role, text), fault in zip(rows, faults):
        new = {}

        def offer(last, way):
            new[0, last] = min(new.get((0, last), (10**9,)), way)

        for (_, last), (cost, audit, lines) in inserted(ways).items():
            offer(last, (cost + 2, audit + "D", lines))
            if fault in ("b", "d"):
                continue
            more = 5 * (fault == "t")
            if role[:1] and legal(last, role[:1]):
                offer(role[:1], (cost + more, audit + "K", [*lines, f"{role}:{text}"]))
            for r, i in word.items():
                if legal(last, i):
                    offer(i, (cost + more + 1, audit + "R", [*lines, f"{r}:{text}"]))
        ways = new
    cost, audit, lines = min(v for (_, last), v in inserted(ways).items() if last in ("", "a"))
    return (conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def wanted(rows):
    bad = damage(rows)
    convs = {r[0] for r in rows}
    return {c: plain(c, bad) for c in convs}


def result(df):
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect()}
    assert df.count() == len(got)
    return got


def test_query_against_plain_search_and_sql(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert result(queries.op11_viterbi_repair(spark, SF)) == wanted(rows)
    done = compare(spark, duck(SF), "op11", queries.QUERIES["op11_viterbi_repair"],
                   queries.ORACLE["op11_viterbi_repair"], SF)
    assert done["values"]


def some_rows(seed, convs, turns):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut short", "", "  ", "So. ", "é文.", None] + [
        f"row {i}." for i in range(40)]
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, turns)):
            rows.append((c, rng.choice([t, t, t, 2 * t, None]),
                         rng.choice(["user", "assistant", "user", "assistant", "system", "", None,
                                     "umpire", "tool"]), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("bits", [0, 2, 12])
def test_any_chunks_give_the_same(spark, bits):
    rows = some_rows(7, 40, 25) + [(None, 1, "assistant", "Null id."), (None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(repair.repair(repair.damaged(df), bits)) == wanted(rows)


def test_long_stretches_need_fix_ups(spark):
    """One conversation over many tasks: rows cut short carry a vector on unchanged."""
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant"]) if 30 < t < 60 or t % 50 == 0 else "assistant",
             f"no stop {t}" if 100 < t < 500 else f"Row {t}.") for t in range(600)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert result(repair.repair(repair.damaged(df), 3)) == wanted(rows)


def test_undamaged_rows(spark):
    df = spark.createDataFrame([(1, 0, "system", "S."), (1, 1, "user", "U."), (1, 2, "user", "V."),
                                (2, 0, "user", "Only.")], SCHEMA)
    got = result(repair.repair(repair.undamaged(df)))
    assert got[1][-2] == "KDKI" and got[1][6] == 7 or got[1][-2] == "KKR"
    assert got[2][6:8] == (2, "D")


def test_fix_up_stops_where_vectors_agree():
    kinds = ["u-", "a-"] * 50
    known = repair.backward(kinds, repair.normal(repair.END))
    other = (0, 9, 4, 4)
    assert repair.backward(kinds, other, known) == repair.backward(kinds, other)
    assert repair.backward(kinds, other)[:90] == known[:90]


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair(repair.damaged(empty)).count() == 0
    rows = [(i, None, "user", "x" * 100_000 + ".") for i in range(30)] + [
        (5, None, "user", "x" * 100_000 + ".")] * 3 + [(40, -2**62, "user", "Far."),
                                                       (40, 2**62, "assistant", "Off.")]
    df = spark.createDataFrame(rows, SCHEMA)
    more = df.selectExpr("*", "'x' AS text_", "1 AS pos", "'y' AS digest", "true AS blank",
                         "0 AS tie", "'z' AS kind")
    assert result(repair.repair(repair.damaged(more))) == wanted(rows)
