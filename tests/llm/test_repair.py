"""Conversation repair against a search forwards over whole strings of edits, in one piece and over many small chunks."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from dexflow.llm import repair

TURNS = "conv_id long, turn long, role string, text string"
WHITE = re.compile(r"[^\x20\x09-\x0D]")


def damage(data):
    out = []
    for conv, turn, role, text in data:
        word = lambda x: " " if x is None else str(x)
        case = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20
        role, text = word(role), word(text)
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        role = "user" if case == 4 else role
        out += [(conv, turn, role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
    return out


def brute(rows):
    """The report of one conversation: of all strings of edits the cheapest, and of those the least."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    turns = [r[1] for r in rows if r[1] is not None]
    faults, seen = [], set()
    for _, _, role, text in rows:
        shown = WHITE.findall(text)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    best = {"": (0, "", ())}  # by the role initials given so far, as far as they matter

    def short(form):
        return form[-1:] if form not in ("", "s") else form

    def add(table, form, cost, audit, out):
        if re.fullmatch("(s?(ua)*u?)?", form) and ((cost, audit, out) < table.get(short(form), (10 ** 9,))):
            table[short(form)] = (cost, audit, out)

    def form_of(key):
        return {"": "", "s": "s", "u": "u", "a": "ua"}[key]

    def inserted(table):
        for _ in range(2):
            for key, (cost, audit, out) in list(table.items()):
                for role in ("user", "assistant"):
                    add(table, form_of(key) + role[0], cost + 3, audit + "I", (*out, f"{role}:"))
        return table

    for (_, _, role, text), fault in zip(rows, faults):
        after = {}
        for key, (cost, audit, out) in inserted(best).items():
            if (cost + 4, audit + "D", out) < after.get(key, (10 ** 9,)):
                after[key] = (cost + 4, audit + "D", out)
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault == "truncated" else 0
            if role[:1] in tuple("sua"):
                add(after, form_of(key) + role[0], cost + extra, audit + "K", (*out, f"{role}:{text}"))
            for new in ("user", "assistant"):
                add(after, form_of(key) + new[0], cost + extra + 3, audit + "R", (*out, f"{new}:{text}"))
        best = after
    cost, audit, out = min(v for k, v in inserted(best).items() if k in ("", "a"))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in map("".join, zip([x or "-" for x in initials], [x or "-" for x in initials[1:]]))),
            cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def want(data):
    damaged = damage(data)
    return sorted(((c, *brute([r for r in damaged if r[0] == c])) for c in {r[0] for r in data}), key=repr)


def made(seed, sizes):
    rng, data = random.Random(seed), []
    for conv, n in enumerate(sizes):
        for i in range(n):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "User", None])
            text = rng.choice(["Yes.", "No!  \t", "cut off", "Why?\n", "", " \x0b", "é.", None, f"t{rng.randrange(99)}.", f"t{rng.randrange(99)}"])
            data.append((conv, rng.choice([i, i, i + 3, None if rng.random() < 0.2 else 1, -i]), role, text))
    return data


@pytest.mark.parametrize("rows", [3, repair.ROWS])
def test_repair_equals_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(repair, "ROWS", rows)
    data = made(rows, [1, 1, 2, 3, 4, 5, 6, 8, 12, 40, 60, 7, 9, 1, 2])
    data += [(None, 1, "user", "Who?"), (None, None, "assistant", "Me."), (50, 4, None, None), (51, 0, "user", "x" * 200_000 + "."),
             (52, 1, "user", "Again."), (52, 1, "user", "Again."), (52, 1, "assistant", "Again.")]
    # Runs over which two cost vectors stay apart: only rows that must go, and cut off rows of one role.
    data += [(60, i, "user", "Same.") for i in range(20)] + [(60, 30, "assistant", "Done.")]
    data += [(61, i, "user", f"cut {i}") for i in range(20)] + [(61, 30, "assistant", "Done.")]
    data += [(62, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(50)]
    df = spark.createDataFrame(data, TURNS).withColumn("code", F.lit("other")).repartition(5)
    pieces = repair.repair_conversations(repair.damaged(df))
    got = sorted((tuple(r) for r in repair.report(pieces).collect()), key=repr)
    assert got == want(data)


def test_first_faults_and_ties(spark):
    data = [(1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "user", " "), (1, 4, "assistant", "and"), (2, 5, "assistant", "No.")]
    df = spark.createDataFrame(data, TURNS)
    got = {r["conv_id"]: r for r in repair.report(repair.repair_conversations(df)).collect()}
    assert (got[1]["blank"], got[1]["duplicate"], got[1]["truncated"], got[1]["audit"], got[1]["cost"]) == (1, 1, 1, "KDDK", 11)
    assert (got[2]["audit"], got[2]["cost"]) == ("IK", 3)  # D would cost 4


def test_dropped_and_empty(spark):
    df = spark.createDataFrame([(1, 1, "user", "Hi.", 0), (2, None, "user", "Hi.", 2)], TURNS + ", times int")
    empty = hashlib.sha256(b"").hexdigest()
    got = sorted(tuple(r) for r in repair.report(repair.repair_conversations(df)).collect())
    assert got[0] == (1, 0, 0, 0, 0, 0, 0, "", empty)
    assert got[1][:7] == (2, 0, 0, 1, 0, 1, 7)
    assert repair.report(repair.repair_conversations(repair.damaged(df.limit(0)))).count() == 0


def test_fix_up_stops_where_vectors_differ_by_a_constant():
    kinds = [repair.USER, repair.ASSISTANT] * 10
    front, _ = repair.backward(kinds, (0, 0, 0, 0))
    exact, _ = repair.backward(kinds, repair.FINAL)
    assert repair.fixed_up(kinds, front, (0, 0, 0, 0), repair.FINAL) == exact
