"""Conversation structure repair: the cheapest edits by a Viterbi search that runs over the chunks of a conversation in parallel.

Rows are sorted over the cluster by conversation and turn and packed into chunks of
bounded size, so a conversation of any length is many rows of many tasks. A chunk's backward
pass depends on the rest of the conversation only through the cost vector at its end. It
starts from a speculative vector; fix-up passes run a chunk again from its successor's vector until
old and new vectors differ by a constant only, which normalised vectors show as equality, and end
when no chunk changes. The stitched costs then drive the trace, which always takes the least letter
that keeps the cost.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

#: Rows and bytes of text of a chunk, at most (a longer text is a chunk of its own).
ROWS, BYTES = 4096, 4 << 20
#: Characters of a text that deal rows of equal conversation, turn and role over tasks.
PREFIX = 64
WHITE = " \t\n\x0b\x0c\r"

#: A row's code: the class of its role, and its fault. A row that was dropped only names its conversation.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
BLANK, TRUNCATED, DUPLICATE, DROPPED = 4, 8, 16, 255
#: Roles given so far: none, a system turn, a user turn last, an assistant turn last.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
#: The state that a kept row of a class leads to from each state; None where the form forbids it.
KEPT = ((AFTER_SYSTEM, None, None, None), (AFTER_USER, AFTER_USER, None, AFTER_USER), (None, None, AFTER_ASSISTANT, None), (None,) * 4)
#: The state that the only turn that may be written there leads to from each state, and that turn's role.
TURN, ROLE = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER), ("", "", "user", "assistant")
#: Costs of the edits, and of a truncated row that is not deleted.
DELETE, INSERT, REROLE, CUT_OFF = 4, 3, 3, 3
#: Costs from each state when no row is left.
FINAL = (0, 2 * INSERT, INSERT, 0)
#: Kinds of rows: class, plus 4 if truncated; blank and duplicate ones must go.
MUST_GO = 8

Costs = tuple[int, int, int, int]


@cache
def before(after: Costs, kind: int) -> tuple[Costs, int]:
    """Least costs from each state in front of a row, less the least of them, and that least; ``after`` are those behind it."""
    if kind == MUST_GO:
        return after, DELETE
    extra = CUT_OFF * (kind >> 2)
    took = [min([DELETE + after[s], REROLE + extra + after[TURN[s]], *(extra + after[to] for to in (KEPT[kind & 3][s],) if to is not None)])
            for s in range(4)]
    costs = [min(took[s], INSERT + took[TURN[s]], 2 * INSERT + took[TURN[TURN[s]]]) for s in range(4)]
    return tuple(c - min(costs) for c in costs), min(costs)


@cache
def edits(after: Costs, kind: int, state: int) -> tuple[str, int, int]:
    """The edits at a row from ``state``: the least letters that keep the least cost, the state behind the row, their cost."""
    costs, least = before(after, kind)
    letters, spent = "", 0
    while True:
        here = costs[state] + least
        if DELETE + after[state] == here:
            return letters + "D", state, spent + DELETE
        if INSERT + costs[TURN[state]] + least == here:
            letters, state, spent = letters + "I", TURN[state], spent + INSERT
            continue
        extra, to = CUT_OFF * (kind >> 2), KEPT[kind & 3][state]
        if to is not None and extra + after[to] == here:
            return letters + "K", to, spent + extra
        return letters + "R", TURN[state], spent + REROLE + extra


def kinds_of(codes: bytes) -> list[int]:
    """The kinds of the rows that are there."""
    return [MUST_GO if c & (BLANK | DUPLICATE) else c & 3 | (c & TRUNCATED) >> 1 for c in codes if c != DROPPED]


def backward(kinds: list[int], after: Costs) -> tuple[Costs, list[Costs]]:
    """The vector in front of all rows, and the vectors behind each."""
    seen = []
    for kind in reversed(kinds):
        seen.append(after)
        after, _ = before(after, kind)
    return after, seen[::-1]


def fixed_up(kinds: list[int], left: Costs, old: Costs, new: Costs) -> Costs:
    """The vector in front of the rows when the one behind them is ``new``; it was ``left`` when that was ``old``."""
    for kind in reversed(kinds):
        if old == new:  # equal but for a constant: so is all in front
            return left
        old, new = before(old, kind)[0], before(new, kind)[0]
    return new


def sorted_rows(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, times, code, same`` in the order of conversations and turns, spread over tasks.

    Null roles and texts are one space. ``code`` has the class of the role and the faults of
    the row alone, ``same`` is equal for rows of equal role and text.
    """
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    times = F.col("times").cast("int") if "times" in turns.columns else F.lit(1)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        space("role").alias("role"), space("text").alias("text"), times.alias("times"))
    initial: Column = F.substring("role", 1, 1)
    role = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    bare = F.rtrim("text", F.lit(WHITE))
    fault = F.when(bare == "", BLANK).when(F.substring(bare, -1, 1).isin(".", "!", "?"), 0).otherwise(TRUNCATED)
    rows = rows.withColumns({"code": F.when(F.col("times") < 1, DROPPED).otherwise(role + fault).cast("int"),
                             "same": F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text")))})
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    return rows.repartitionByRange(*order, F.substring("text", 1, PREFIX)).sortWithinPartitions(*order, "text")


CHUNK = ("conv_id long, g long, whole boolean, codes binary, same binary, last_turn long, min_turn long, turns long, "
         "rows array<struct<role: string, text: string>>")
CHUNK_ARROW = pa.schema([("conv_id", pa.int64()), ("g", pa.int64()), ("whole", pa.bool_()), ("codes", pa.binary()), ("same", pa.binary()),
                         *[(c, pa.int64()) for c in ("last_turn", "min_turn", "turns")],
                         ("rows", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])


def mark_duplicates(codes: bytearray, same: list[bytes], seen: set[bytes]) -> None:
    """Set the fault of the rows whose ``same`` is in ``seen``, and add theirs; a blank row stays blank."""
    for i, x in enumerate(same):
        if codes[i] != DROPPED:
            if x in seen and not codes[i] & BLANK:
                codes[i] = codes[i] & 3 | DUPLICATE
            seen.add(x)


def one_chunk(rows: pa.Table) -> dict:
    """A chunk of the rows of one conversation."""
    times = rows.column("times").to_numpy()
    rows = rows.take(pa.array(np.repeat(np.arange(len(times)), np.maximum(times, 1))))
    codes, same = bytearray(rows.column("code").to_numpy().astype(np.uint8).tobytes()), rows.column("same").to_pylist()
    mark_duplicates(codes, same, set())
    turns = [t for t, c in zip(rows.column("turn").to_pylist(), codes) if c != DROPPED]
    known = [t for t in turns if t is not None]
    pairs = pa.StructArray.from_arrays([rows.column(c).combine_chunks() for c in ("role", "text")], names=["role", "text"])
    return {"conv_id": rows.column("conv_id")[0].as_py(), "codes": bytes(codes), "same": b"".join(same), "min_turn": known[0] if known else None,
            "last_turn": turns[-1] if turns else None, "turns": len(set(known)), "rows": pairs}


def chunks(turns: DataFrame) -> DataFrame:
    """``CHUNK`` rows; ``g`` grows in the order of the rows, ``whole`` says that a chunk is surely all of its conversation."""

    def cut(batches):
        part, made = TaskContext.get().partitionId(), 0
        # Rows that wait for more of their conversation, the conversation of the last chunk, whether this is the first one of the task.
        held, cut_conv, start = None, None, True

        def batch_of(found):
            nonlocal made
            values = pa.concat_arrays([c["rows"] for c in found])
            rows = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *[len(c["rows"]) for c in found]]), pa.int32()), values)
            ids = pa.array([(part << 33) + made + i for i in range(len(found))], pa.int64())
            made += len(found)
            columns = {"g": ids, "rows": rows}
            return pa.record_batch([columns[f.name] if f.name in columns else pa.array([c[f.name] for c in found], f.type) for f in CHUNK_ARROW],
                                   schema=CHUNK_ARROW)

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            conv = table.column("conv_id")
            ids, null = pc.fill_null(conv, 0).to_numpy(), pc.is_null(conv).to_numpy()
            ends = [*(np.flatnonzero((ids[1:] != ids[:-1]) | (null[1:] != null[:-1])) + 1), len(ids)]
            size = np.concatenate([[0], np.cumsum(pc.binary_length(table.column("text")).to_numpy())])
            found, s, held = [], 0, None
            for end in ends:
                begin = s
                new = cut_conv != (conv[begin].as_py(),)
                while s < end:
                    e = max(s + 1, min(end, s + ROWS, int(np.searchsorted(size, size[s] + BYTES, "right")) - 1))
                    if e == len(ids) and e - s < ROWS and size[e] - size[s] < BYTES:
                        held = table.slice(s, e - s)
                    else:
                        found.append(one_chunk(table.slice(s, e - s)) | {"whole": new and not start and s == begin and e == end < len(ids)})
                        cut_conv = (conv[begin].as_py(),)
                    s = e
                start = start and end == len(ids)
            if found:
                yield batch_of(found)
        if held is not None:
            yield batch_of([one_chunk(held.combine_chunks()) | {"whole": False}])

    return sorted_rows(turns).mapInArrow(cut, CHUNK)


def with_late_duplicates(opened: DataFrame) -> DataFrame:
    """``conv_id, g, codes, moves`` of the chunks ``opened``, where rows seen in an earlier chunk of the conversation are duplicates too.

    ``moves`` says that some row need not go.
    """
    several = opened.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv_id").alias("c"))

    def split(batches):
        for batch in batches:
            g, out = batch.column("g").to_pylist(), []
            for k, same in enumerate(batch.column("same").to_pylist()):
                out += [(batch.column("conv_id")[k].as_py(), g[k], x) for x in {same[i:i + 16] for i in range(0, len(same), 16)}]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else ([], [], []), (pa.int64(), pa.int64(), pa.binary()))],
                                  names=["conv_id", "g", "x"])

    marks = opened.join(several, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi").select("conv_id", "g", "same").mapInArrow(
        split, "conv_id long, g long, x binary")
    first = F.min("g").over(Window.partitionBy("conv_id", "x"))  # at most one row of a chunk in each group
    late = (marks.withColumn("first", first).where("first < g").groupBy("g").agg(F.collect_set("x").alias("late"))
            .withColumnRenamed("g", "late_g"))  # at most the rows of a chunk

    def mark(batches):
        for batch in batches:
            out = []
            for codes, same, late in zip(*(batch.column(c).to_pylist() for c in ("codes", "same", "late"))):
                codes = bytearray(codes)
                if late:
                    mark_duplicates(codes, [same[i:i + 16] for i in range(0, len(same), 16)], set(late))
                out.append(bytes(codes))
            moves = pa.array([any(k != MUST_GO for k in kinds_of(c)) for c in out], pa.bool_())
            yield pa.record_batch([batch.column("conv_id"), batch.column("g"), pa.array(out, pa.binary()), moves], names=["conv_id", "g", "codes", "moves"])

    joined = opened.select("conv_id", "g", "codes", "same").join(late, F.col("g") == F.col("late_g"), "left")
    return joined.select("conv_id", "g", "codes", "same", "late").mapInArrow(
        mark, "conv_id long, g long, codes binary, moves boolean")


VECTOR = pa.list_(pa.int32())


def converged(opened: DataFrame) -> DataFrame:
    """``conv_id, g, codes, after`` and ``leads_to`` (the state behind a chunk for each state in front of it) of the chunks ``opened`` (conv_id, g, codes, moves).

    Rows that must go leave the differences between costs as they are, so chunks without
    other rows are passed over. The fix-up passes are as many as the longest row of chunks over which
    two vectors stay apart, mostly one or two; however many there are, the result is exact.
    """
    going = "conv_id long, g long, next long, codes binary, after array<int>, front array<int>, changed boolean"

    def run(batches):
        for batch in batches:
            after, front, changed = [], [], []
            old = batch.column("front").to_pylist()
            for codes, has, had, was, due in zip(*(batch.column(c).to_pylist() for c in ("codes", "next", "after")), old, batch.column("due").to_pylist()):
                kinds = kinds_of(codes)
                if was is None:
                    had = tuple(had)
                    was = backward(kinds, had)[0]
                    changed.append(has is not None)
                elif due is None or due == had:
                    changed.append(False)
                else:
                    front_now, had = fixed_up(kinds, tuple(was), tuple(had), tuple(due)), due
                    changed.append(front_now != tuple(was))
                    was = front_now
                after.append(list(had))
                front.append(list(was))
            yield pa.record_batch([*(batch.column(c) for c in ("conv_id", "g", "next", "codes")), pa.array(after, VECTOR), pa.array(front, VECTOR),
                                   pa.array(changed, pa.bool_())], names=["conv_id", "g", "next", "codes", "after", "front", "changed"])

    vector = lambda x: F.array(*[F.lit(v) for v in x])
    follows = F.lead("g").over(Window.partitionBy("conv_id").orderBy("g"))  # over chunks, not rows
    some = opened.where("moves").drop("moves").withColumn("next", follows)
    some = some.withColumns({"after": F.when(F.col("next").isNull(), vector(FINAL)).otherwise(vector([0] * 4)),
                             "front": F.lit(None).cast("array<int>"), "due": F.lit(None).cast("array<int>")})
    now = saved(some.mapInArrow(run, going), "repair-vectors")
    while now.where("changed").limit(1).count():
        behind = now.select(F.col("g").alias("behind"), F.col("front").alias("due"))
        again = now.drop("changed").join(behind, F.col("next") == F.col("behind"), "left").drop("behind")
        now = saved(again.mapInArrow(run, going), "repair-vectors")

    def exits(batches):
        for batch in batches:
            out = []
            for codes, after in zip(batch.column("codes").to_pylist(), batch.column("after").to_pylist()):
                kinds = kinds_of(codes)
                _, vectors = backward(kinds, tuple(after))
                states = list(range(4))
                for kind, v in zip(kinds, vectors):
                    states = [edits(v, kind, s)[1] for s in states]
                out.append(states)
            yield pa.record_batch([*(batch.column(c) for c in ("conv_id", "g", "codes", "after")), pa.array(out, VECTOR)],
                                  names=["conv_id", "g", "codes", "after", "leads_to"])

    empty = opened.where("not moves").select("conv_id", "g", "codes", vector(FINAL).alias("after"),
                                                            vector(range(4)).alias("leads_to"))
    return now.select("conv_id", "g", "codes", "after").mapInArrow(
        exits, "conv_id long, g long, codes binary, after array<int>, leads_to array<int>").unionByName(empty)


def entered(states: DataFrame) -> DataFrame:
    """``states`` without leads_to, with the state in front of each chunk (``entry``) and whether it is the last of its conversation (``last``)."""
    followed = Window.partitionBy("conv_id").orderBy("g")

    def walk(batches):
        conv, state = None, START
        for batch in batches:
            out = []
            for c, leads_to in zip(batch.column("conv_id").to_pylist(), batch.column("leads_to").to_pylist()):
                if conv != (c,):
                    conv, state = (c,), START
                out.append(state)
                state = leads_to[state]
            yield pa.record_batch([*(batch.column(c) for c in ("g", "codes", "after", "last")), pa.array(out, pa.int32())],
                                  names=["g", "codes", "after", "last", "entry"])

    rows = states.withColumn("last", F.lead("g").over(followed).isNull()).select("conv_id", "g", "codes", "after", "leads_to", "last")
    return rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "g").mapInArrow(
        walk, "g long, codes binary, after array<int>, last boolean, entry int")


PIECE = ("conv_id long, g long, whole boolean, last_turn long, min_turn long, turns long, blank long, duplicate long, "
         "truncated long, illegal long, first_role int, last_role int, cost long, audit string, "
         "repaired array<struct<role: string, text: string>>")
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


def repaired(rows: list[dict], codes: bytes, after: Costs, state: int, last: bool) -> dict:
    """The edits of a chunk from ``state`` on, and what they give."""
    here = [(r, c) for r, c in zip(rows, codes) if c != DROPPED]
    kinds = kinds_of(codes)
    _, vectors = backward(kinds, after)
    audit, out, cost = [], [], 0
    for (row, _), kind, v in zip(here, kinds, vectors):
        letters, to, spent = edits(v, kind, state)
        cost += spent
        audit.append(letters)
        for letter in letters:
            if letter in "IR":
                state = TURN[state]
                out.append({"role": ROLE[state], "text": row["text"] if letter == "R" else ""})
            elif letter == "K":
                out.append(row)
        state = to
    while last and state not in (START, AFTER_ASSISTANT):
        state, cost = TURN[state], cost + INSERT
        audit.append("I")
        out.append({"role": ROLE[state], "text": ""})
    roles = [c & 3 for _, c in here]
    count = lambda bit: sum(bool(c & bit) for _, c in here)
    return {"blank": count(BLANK), "duplicate": count(DUPLICATE), "truncated": count(TRUNCATED), "cost": cost, "audit": "".join(audit),
            "repaired": out, "illegal": sum(p not in LEGAL for p in zip(roles, roles[1:])),
            "first_role": roles[0] if roles else None, "last_role": roles[-1] if roles else None}


def pieces_of(chunked: DataFrame) -> DataFrame:
    """``PIECE`` rows of chunks that have ``after``, ``entry`` and ``last``."""
    arrow = pa.schema([("conv_id", pa.int64()), ("g", pa.int64()), ("whole", pa.bool_()),
                       *[(c, pa.int64()) for c in ("last_turn", "min_turn", "turns", "blank", "duplicate", "truncated", "illegal")],
                       ("first_role", pa.int32()), ("last_role", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()),
                       ("repaired", CHUNK_ARROW.field("rows").type)])
    taken = ["conv_id", "g", "whole", "last_turn", "min_turn", "turns"]

    def trace(batches):
        for batch in batches:
            get = lambda c: batch.column(c).to_pylist()
            out = [repaired(r, c, tuple(a), s, e) for r, c, a, s, e in zip(*map(get, ("rows", "codes", "after", "entry", "last")))]
            yield pa.record_batch([batch.column(f.name) if f.name in taken else pa.array([x[f.name] for x in out], f.type) for f in arrow], schema=arrow)

    return chunked.select(*taken, "codes", "rows", "after", "entry", "last").mapInArrow(trace, PIECE)


def repair_conversations(turns: DataFrame) -> DataFrame:
    """Repaired conversations in pieces (``PIECE``): counts of faults, cost, the letters of the edits, and the repaired turns.

    ``turns`` has conv_id, turn, role, text, and maybe ``times``: how often the row is there,
    one after the other (0: it only names its conversation). Rows are taken by turn, nulls first, ties by
    role and text. Null roles and texts are one space. A role's class is its first letter: s, u, a or other. A row's
    first fault counts: blank (no character other than white space), duplicate (role and text
    seen earlier), truncated (its last such character is none of ``.!?``). Rows are kept (K, 0),
    given the role user or assistant (R, 3) or deleted (D, 4; blank and duplicate ones must be);
    empty user or assistant turns may be inserted anywhere (I, 3); a truncated row that is not deleted costs
    3 more. The roles of what is left have the form ``(s?(ua)+)?``. Of the cheapest edits those
    whose letters are least in ASCII order are taken.

    A piece is a conversation (``whole``) or one of its chunks, in the order of ``g``. Rows without
    a conv_id are one conversation. Repeated rows are duplicates; other columns are ignored; an empty table gives no
    rows. Rows equal in conversation, turn, role and the first 64 characters of the text are sorted
    by one task, as a stream; everything else of a long conversation is spread.
    """
    found = saved(chunks(turns), "repair-chunks")
    final = F.array(*[F.lit(v) for v in FINAL])
    whole = found.where("whole").withColumns({"after": final, "entry": F.lit(START), "last": F.lit(True)})
    opened = found.where("not whole")
    coded = saved(with_late_duplicates(opened.select("conv_id", "g", "codes", "same")), "repair-codes")
    states = entered(saved(converged(coded), "repair-states")).hint("merge")
    return pieces_of(whole).unionByName(pieces_of(opened.drop("codes").join(states, "g")))


REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
REPORT_ARROW = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                          ("audit", pa.string()), ("repaired_sha256", pa.string())])


def report(pieces: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Whole conversations are reported where they are. The pieces of the others come to one task in
    their order, as a stream: a SHA-256 takes its bytes one after the other. Of a conversation that task holds one
    piece and the letters of the edits.
    """
    lines = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    gaps = F.coalesce(F.col("last_turn") - F.col("min_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    whole = pieces.where("whole").select("conv_id", gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                         F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))

    def stitch(batches):
        one, done = None, []

        def close():
            gaps = one["last"] - one["min"] + 1 - one["turns"] if one["min"] is not None else 0
            done.append([one["conv_id"], gaps, *one["sums"], "".join(one["audit"]), one["sha"].hexdigest()])

        def emit():
            out = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*done), REPORT_ARROW)], schema=REPORT_ARROW)
            done.clear()
            return out

        for batch in batches:
            for p in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                if one is None or one["conv_id"] != p["conv_id"]:
                    if one is not None:
                        close()
                    one = {"conv_id": p["conv_id"], "min": None, "last": None, "turns": 0, "sums": [0] * 5, "audit": [], "sha": hashlib.sha256(),
                           "begun": False, "role": None}
                if p["min_turn"] is not None:
                    one["turns"] += p["turns"] - (one["last"] == p["min_turn"])
                    one["min"] = p["min_turn"] if one["min"] is None else one["min"]
                    one["last"] = p["last_turn"]
                for i, c in enumerate(("blank", "duplicate", "truncated", "illegal", "cost")):
                    one["sums"][i] += p[c]
                if p["first_role"] is not None:
                    one["sums"][3] += one["role"] is not None and (one["role"], p["first_role"]) not in LEGAL
                    one["role"] = p["last_role"]
                one["audit"].append(p["audit"])
                for t in p["repaired"]:
                    one["sha"].update((b"\n" if one["begun"] else b"") + f"{t['role']}:{t['text']}".encode())
                    one["begun"] = True
            if done:
                yield emit()
        if one is not None:
            close()
            yield emit()

    columns = ["conv_id", "g", "last_turn", "min_turn", "turns", "blank", "duplicate", "truncated", "illegal", "first_role", "last_role", "cost",
               "audit", "repaired"]
    opened = pieces.where("not whole").select(*columns).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "g")
    return whole.unionByName(opened.mapInArrow(stitch, REPORT))


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with made faults, by crc32 of ``conv_id:turn`` (null: one space) mod 20.

    0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes its role user. Null
    roles and texts are one space before that.
    """
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn"))) % 20
    text = F.when(case == 1, "").when(case == 2, F.translate(word("text"), ".!?", "")).otherwise(word("text"))
    return turns.select("conv_id", "turn", F.when(case == 4, "user").otherwise(word("role")).alias("role"), text.alias("text"),
                        F.when(case == 0, 0).when(case == 3, 2).otherwise(1).alias("times"))
