"""Repair of conversations: the agenda against dynamic programming, the operator against a plain computation."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from precinct.llm import conversations as c
from precinct.llm import queries
from oracle import assert_same

ROWS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def plain_repair(signs):
    """(cost, audit) by relaxing the states row by row, insertions included."""

    def relax(into, state, value):
        if state not in into or value < into[state]:
            into[state] = value

    def inserted(now):
        for _ in range(3):
            for state, (cost, audit) in list(now.items()):
                for initial in "ua":
                    after = c.FOLLOWS.get((state, initial))
                    if after is not None:
                        relax(now, after, (cost + 5, audit + "I"))
        return now

    now = {c.START: (0, "")}
    for sign in signs:
        then = {}
        for state, (cost, audit) in inserted(now).items():
            relax(then, state, (cost + 2, audit + "D"))
            if sign == c.FORCED:
                continue
            more = 5 if sign.isupper() else 0
            for letter, initial, by in (("K", sign.lower(), 0), ("R", "u", 1), ("R", "a", 1)):
                after = c.FOLLOWS.get((state, initial))
                if after is not None:
                    relax(then, after, (cost + more + by, audit + letter))
        now = then
    now = inserted(now)
    return min(now[s] for s in (c.START, c.ANSWERED) if s in now)


def plain_report(rows):
    """conv_id -> (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) of (conv_id, turn, role, text, copies)."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, role or (" " if role is None else ""), " " if text is None else text, n) for k, t, role, text, n in rows if k == conv]
        own = [(t, role, text) for t, role, text, n in own for _ in range(n)]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, signs, faults, illegal = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}, 0
        for i, (_, role, text) in enumerate(own):
            found = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            signs += c.row_sign(role, fault in ("blank", "duplicate"), fault == "truncated")
            illegal += i > 0 and own[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        cost, audit = plain_repair(signs)
        lines = c.repaired(audit, [(role, text) for _, role, text in own])
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest)
    return out


def found_report(df):
    rows = c.digests(c.repair_conversations(df)).collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[1:]) for r in rows}


def test_agenda_finds_the_lightest_repair():
    for length in range(5):
        for signs in map("".join, itertools.product("suaxSUAX-", repeat=length)):
            assert c.repair(signs) == plain_repair(signs), signs


def test_joined_blocks_give_the_same_repair():
    rng = random.Random(4)
    for _ in range(200):
        signs = "".join(rng.choice("suaxSUAX--uaua") for _ in range(rng.randint(0, 50)))
        cuts = sorted(rng.randint(0, len(signs)) for _ in range(3))
        parts = [signs[a:b] for a, b in zip([0, *cuts], [*cuts, len(signs)])]
        (costs, ranks), through = c.joined_tables([c.block_table(p) for p in parts])
        cost, _, end = min((costs[q] + 5 * c.CLOSING[q], ranks[q], q) for q in range(4) if costs[q] >= 0)
        audits = [c.lightest(p, a, whole=False)[(len(p), b)][1] for p, (a, b) in zip(parts, c.path(through, 0, end))]
        assert (cost, "".join(audits) + "I" * c.CLOSING[end]) == plain_repair(signs)


def test_audits_of_equal_cost_are_never_prefixes():
    """What the order of the audits relies on: equal costs from state to state never give a beginning of the other."""
    for signs in map("".join, itertools.product("suxU-", repeat=4)):
        found = c._block_audits(signs)
        for a, b in itertools.combinations([f for f in found if f[0] >= 0], 2):
            assert a[0] != b[0] or a[1] == b[1] or not (a[1].startswith(b[1]) or b[1].startswith(a[1]))


def random_rows(rng, conversations, most):
    texts = ["Hi.", "Well?", "cut off", "", " \t", "So!", "é .", "a.\x0b", " ", None]
    rows = []
    for conv in conversations:
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "umpire"])
            text = rng.choice(texts) if rng.random() < 0.5 else f"{rng.random()}."
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 2]), role, text, rng.choice([1, 1, 1, 1, 0, 2, 3])))
    return rows


@pytest.mark.parametrize("block,fan", [(256, 64), (2, 2), (1, 3)])
def test_equals_the_plain_computation(spark, monkeypatch, block, fan):
    monkeypatch.setattr(c, "BLOCK_ROWS", block)
    monkeypatch.setattr(c, "FAN", fan)
    rows = random_rows(random.Random(block), [*range(40), None], 7) + random_rows(random.Random(2), [77], 120)
    rows += [(500, 1, "user", "lost", 0), (501, None, "user", "a.", 2)]
    df = spark.createDataFrame(rows, T.StructType([*ROWS.fields, T.StructField("copies", T.IntegerType())])).repartition(3)
    df = df.selectExpr("*", "'x' AS digest", "1 AS kind", "2 AS piece", "'z' AS audit")
    assert found_report(df) == plain_report(rows)


def test_one_conversation_over_all_tasks(spark, monkeypatch):
    """Most rows in one conversation, many of them equal: it is cut over tasks and still repaired as one."""
    monkeypatch.setattr(c, "BLOCK_ROWS", 16)
    monkeypatch.setattr(c, "FAN", 4)
    rng = random.Random(9)
    rows = [(1, i // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["Same.", f"{i}.", "cut", ""]), 1) for i in range(1500)]
    rows += [(1, 3, "user", "Copy.", 400)] + random_rows(rng, range(2, 20), 5)
    df = spark.createDataFrame(rows, T.StructType([*ROWS.fields, T.StructField("copies", T.IntegerType())])).repartition(4)
    pieces = c.repair_conversations(df)
    assert pieces.filter("conv_id = 1").count() > 60
    assert found_report(df) == plain_report(rows)


def test_pieces_hold_the_repaired_turns(spark):
    rows = [(1, 0, "system", "Be nice.", 1), (1, 1, "user", "Hi.", 1), (1, 2, "user", "Hi.", 1)]
    rows += [(1, 3, "user", "Yes.", 1), (2, 0, "assistant", "No.", 1)]
    df = spark.createDataFrame(rows, T.StructType([*ROWS.fields, T.StructField("copies", T.IntegerType())]))
    found = {}
    for row in c.repair_conversations(df).orderBy("conv_id", "piece").collect():
        found[row["conv_id"]] = found.get(row["conv_id"], []) + [tuple(t) for t in row["turns"]]
    assert found == {1: [("system", "Be nice."), ("user", "Hi."), ("assistant", "Yes.")], 2: []}


def test_no_rows(spark):
    df = spark.createDataFrame([], ROWS).withColumn("copies", F.lit(1))
    assert found_report(df) == {}


def test_damage(spark):
    rows = [(i, i % 9, "assistant", "One. Two!") for i in range(200)] + [(None, None, None, None)]
    found = {(r[0], r[1]): r[2:] for r in map(tuple, c.damaged(spark.createDataFrame(rows, ROWS)).collect())}
    for conv, turn, _, _ in rows[:-1]:
        draw = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        role, text, copies = found[(conv, turn)]
        assert role == ("user" if draw == 4 else "assistant")
        assert text == {1: "", 2: "One Two"}.get(draw, "One. Two!")
        assert copies == {0: 0, 3: 2}.get(draw, 1)
    assert zlib.crc32(b" : ") % 20 == 19 and found[(None, None)] == (" ", " ", 1)


def test_query_equals_its_sql(spark, folder):
    assert_same(queries.QUERIES["op12_conversation_repair"](spark, folder), queries.ORACLE["op12_conversation_repair"], folder)
