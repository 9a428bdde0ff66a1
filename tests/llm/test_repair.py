"""Conversation repair against a brute-force search, in one part and across parts."""

import functools
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from fairstream.llm import repair
from fairstream.llm import queries as llm
from fairstream.sources.tables import read_table
from tests.conftest import SF_SMALL

ROW = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                    T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                    T.StructField("pos", T.StringType()), T.StructField("audit", T.StringType())])
SPACE = " \t\n\x0b\x0c\r"
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        d = zlib.crc32(key.encode()) % 20
        kept = out.setdefault(conv, [])
        if d == 1:
            text = ""
        if d == 2:
            text = re.sub("[.!?]", "", text)
        if d == 4:
            role = "user"
        kept.extend([(turn, role, text)] * (0 if d == 0 else 2 if d == 3 else 1))
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def brute(rows):
    """The contract's row of one conversation, by a search over whole audits."""
    kinds, seen = [], set()
    for _, role, text in rows:
        body = text.strip(SPACE)
        kinds.append("blank" if not body else "duplicate" if (role, text) in seen
                     else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    @functools.lru_cache(None)
    def best(i, q, inserts):
        found = []
        if i == len(rows) and q in (0, 3):
            found.append((0, ""))
        to = next((v for (a, c), v in STEP.items() if a == q and c in "ua"), None)
        if inserts < 3:
            cost, rest = best(i, to, inserts + 1)
            found.append((cost + 5, "I" + rest))
        if i < len(rows):
            cost, rest = best(i + 1, q, 0)
            found.append((cost + 2, "D" + rest))
            if kinds[i] not in ("blank", "duplicate"):
                late = 5 * (kinds[i] == "truncated")
                if (q, rows[i][1][:1]) in STEP:
                    cost, rest = best(i + 1, STEP[q, rows[i][1][:1]], 0)
                    found.append((cost + late, "K" + rest))
                cost, rest = best(i + 1, to, 0)
                found.append((cost + 1 + late, "R" + rest))
        return min(found, default=(10 ** 9, ""))
    for i in range(len(rows), 0, -1):           # from the end, so that no call goes deep
        for q in range(4):
            best(i, q, 0)
    cost, audit = best(0, 0, 0)
    out, i, q = [], 0, 0
    for letter in audit:
        given = "user" if q in (0, 1, 3) else "assistant"
        if letter == "I":
            out.append((given, ""))
        elif letter != "D":
            out.append((given if letter == "R" else rows[i][1], rows[i][2]))
        if letter != "D":
            q = STEP[q, out[-1][0][:1]]
        i += letter != "I"
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    turns = [t for t, _, _ in rows if t is not None]
    marks = [r[:1] for _, r, _ in rows]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            "blank": kinds.count("blank"), "duplicate": kinds.count("duplicate"),
            "truncated": kinds.count("truncated"),
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(marks, marks[1:])),
            "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()}


def check(result, rows):
    want = damaged(rows)
    got = result.collect()
    assert len(got) == len(want) and {r["conv_id"] for r in got} == set(want)
    for r in got:
        assert r.asDict() == {"conv_id": r["conv_id"]} | brute(want[r["conv_id"]])


def made(seed, conversations, most):
    rnd = random.Random(seed)
    rows = []
    for c in [None, *range(conversations)]:
        for turn in range(rnd.randint(1, most)):
            role = rnd.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            text = rnd.choice(["ok.", "ok", " \t", "", None, "why?\n", "no!", "é.", "w" * 9000 + "."])
            rows.append((c, rnd.choice([turn, turn, turn, 3, None]), role, text))
    return rows


@pytest.mark.parametrize("parts", [None, 1, 13])
def test_repair_equals_brute_force(spark, parts):
    rows = made(5, 150, 9)
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], ROW)
    check(repair.digest(repair.repair(repair.damage(frame), parts)), rows)


def test_conversation_longer_than_its_parts(spark):
    rows = [(c, t, r, x) for c, (_, t, r, x) in
            zip([7] * 900 + [8] * 20, made(6, 400, 9)[:920])]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], ROW)
    repaired = repair.repair(repair.damage(frame), 11)
    assert repaired.count() > 800
    check(repair.digest(repaired), rows)


def test_empty_table_and_lost_conversation(spark):
    none = spark.createDataFrame([], ROW)
    assert repair.digest(repair.repair(repair.damage(none))).count() == 0
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(lost, 0, "user", "ok.", "x", "y")], ROW)
    r = repair.digest(repair.repair(repair.damage(frame))).first()
    assert (r["conv_id"], r["cost"], r["audit"], r["gaps"]) == (lost, 0, "", 0)
    assert r["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_repaired_turns_alternate(spark):
    frame = spark.createDataFrame([(*r, "x", "y") for r in made(9, 60, 8)], ROW)
    by_conv = {}
    for r in repair.repair(frame, 5).orderBy("pos").collect():
        by_conv.setdefault(r["conv_id"], []).extend(t["role"][:1] for t in r["turns"])
    assert by_conv and all(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in by_conv.values())


def test_query(spark):
    rows = [tuple(r) for r in read_table(spark, SF_SMALL, "conversations").select(
        "conv_id", "turn", "role", "text").collect()]
    check(llm.op11_conversation_repair(spark, SF_SMALL), rows)
