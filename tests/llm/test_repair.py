"""Conversation repair against trying every edit, over the table and over made-up conversations."""

import random
from collections import defaultdict

import duckdb
import pytest

from lodestrata.llm import queries as Q
from lodestrata.llm import repair
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string"
SAID = ["Yes.", "No!", "cut off", "", " ", None, "a?\n ", "Ünd .", "x.y"]
SHOWN = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def made(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None])
            rows.append((conv, rng.choice([turn, turn, turn + 1, None]), role, rng.choice(SAID)))
    return rows


def want(rows):
    convs, out = defaultdict(list), {r[0]: (0, 0, 0, 0, 0, 0, "", brute.sha("")) for r in rows}
    for r in brute.damaged(rows):
        convs[r[0]].append(r)
    return out | {c: brute.repaired(x) for c, x in convs.items()}


def got(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in SHOWN) for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_repairs(spark, seed):
    rows = made(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(repair.repairs_digest(df.selectExpr("*", "1 AS cost", "'own' AS audit", "2 AS place", "'own' AS kind"))) == want(rows)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    sql = {r[0]: r[1:] for r in con.execute(f"SELECT conv_id, {', '.join(SHOWN)} FROM ({Q.ORACLES['op13_conversation_repair']})").fetchall()}
    assert sql == want(rows)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(Q.op13_conversation_repair(spark, sf)) == want(rows)


def test_empty_tables_and_lost_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repairs_digest(empty).collect() == []
    assert repair.repaired_turns(empty, repair.audits(repair.signatures(empty))).collect() == []
    lost = next(c for c in range(1000) if not brute.damaged([(c, 0, "user", "x.")]))
    assert got(repair.repairs_digest(spark.createDataFrame([(lost, 0, "user", "x.")], SCHEMA))) == want([(lost, 0, "user", "x.")])


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Again."), (1, 2, "assistant", "Well"), (2, 0, "assistant", "So."), (2, 1, "assistant", "So."), (3, 5, "tool", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    judged = repair.audits(repair.signatures(df))
    edits = repair.repaired_turns(df, judged).orderBy("conv_id", "step").collect()
    assert {r.conv_id: r.audit for r in judged.collect()} == {1: "KRD", 2: "DD", 3: "D"}
    assert [(r.conv_id, r.edit, r.role, r.text) for r in edits if r.edit != "D"] == [(1, "K", "user", "Hi."), (1, "R", "assistant", "Again.")]
    assert [r.step for r in edits if r.conv_id == 1] == [0, 1, 2]


def test_shared_suffixes_are_entered_once():
    rng = random.Random(3)
    found = sorted({"".join(rng.choice("xsuaoUA") for _ in range(rng.randint(0, 6))) for _ in range(3000)}, key=lambda s: s[::-1])
    automaton = repair.SuffixAutomaton()
    best = {s: automaton.best(s) for s in found}
    assert automaton.computed == len({s[i:] for s in found for i in range(len(s))})
    fresh = {s: repair.SuffixAutomaton().best(s) for s in found}
    assert best == fresh


def test_long_conversation(spark):
    """Five thousand turns and a long text in one conversation, beside many short ones with one signature."""
    rows = [(1, i, "user" if i % 3 else "assistant", f"turn {i}.") for i in range(5000)] + [(1, 5000, "assistant", "long " * 200_000 + ".")]
    rows += [(c, t, role, "Same.") for c in range(2, 400) for t, role in ((0, "user"), (1, "assistant"))]
    out = got(repair.repairs_digest(spark.createDataFrame(rows, SCHEMA)))
    assert len(out) == 399 and len(out[1][6]) >= 4500
    assert {c: v for c, v in out.items() if c != 1} == {c: v for c, v in want([r for r in rows if r[0] != 1]).items()}
