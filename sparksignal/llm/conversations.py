"""Repair of conversation structure: the cheapest edits that make the roles read system?, (user, assistant)+, or nothing.

The edits of a conversation, in order: Keep a turn (0), Rerole it to user or assistant (3), Delete it (4; blank and
duplicate turns must go), Insert an empty user or assistant turn anywhere (3); a truncated turn that stays adds 3.  Of equally cheap edits
those whose initials D, I, K, R are ASCII-least win.  Which role a turn gets follows from the turns before it, so the
initials (the audit) say all.

The search is iterative-deepening A*: depth first in ASCII order under a cost bound that rises to the least cost seen
beyond it, so the first path that accepts is the answer.  A table holds for each failed (turn, state) the cost that it is known
to need at least; it prunes later visits, in later rounds, too.

Conversations of up to ``BLOCK_TURNS`` are searched at once.  Longer ones are cut into blocks; a block is searched for each pair of
states (start, after system, after user, after assistant) at its ends, and the blocks' 4 x 4 tables are multiplied (least cost, then
least audit).  That is exact: inserts count to the turn after them, so no audit of a block is the beginning of another one.

On Spark the turns are sorted by range of (conversation, turn), so that a conversation of any size is spread over
partitions.  A conversation inside a partition is repaired in that pass.  Those at a partition's ends, or over ``WHOLE_TURNS``,
leave their blocks in a written table; duplicates are then found by a join of digests, tables are multiplied by groups of
``FAN_IN`` at most, and the chosen audits go back to the blocks.  A task holds some blocks, never a whole long conversation;
only the audit of a conversation, one character an edit, is one value, and its digest is a stream over its blocks in one task.

Order: by turn, nulls first; turns of equal number by role, then by XXH64 of the text.

Cases: null roles and texts are one space; a role counts by its first character, and a role without one by none; a null conversation id is a
conversation; repeated rows are turns (duplicates); a blank turn has no character but white space; an empty table gives an empty result;
other columns are left out.
"""

from __future__ import annotations

import hashlib
import pickle
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksignal.llm.chunks import partitions, write_table

BLOCK_TURNS, BLOCK_BYTES = 64, 8 << 20
WHOLE_TURNS, WHOLE_BYTES, FAN_IN = 4096, 16 << 20, 64
WHITE = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NAMES = {"u": "user", "a": "assistant"}
# state (0 start, 1 after system, 2 after user, 3 after assistant) -> initial of the next turn -> state
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FORCED = ("u", "u", "a", "u")  # what an inserted or reroled turn must be
TAIL = (0, 6, 3, 0)  # cost of the inserts that end a conversation: after system two, after user one
END, NEVER = 4, 1 << 60
FINE, GONE, CUT = 0, 1, 2  # a turn's kind: no fault, must go, truncated


@lru_cache(200_000)
def search(turns: tuple[tuple[str, int], ...], entry: int, goal: int) -> tuple[int, str] | None:
    """Least cost and audit of a block of (initial, kind) from state ``entry`` to state ``goal``, or to the end of a conversation."""
    n = len(turns)
    if goal < END and goal != entry and goal < 2 and not (goal == 1 and entry == 0 and any(t[0] == "s" and t[1] != GONE for t in turns)):
        return None
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + (0, DELETE, TRUNCATED)[turns[i][1]]
    need = [[x] * 4 for x in least[:n]]
    need.append(list(TAIL) if goal == END else [0 if q == goal else NEVER for q in range(4)])
    path: list[str] = []

    def reach(i: int, q: int, left: int) -> bool:
        if i == n:
            if goal < END or not TAIL[q]:
                return True
            path.append("I")
            return reach(i, NEXT[q][FORCED[q]], left - INSERT)  # within ``left``, as ``need`` is exact here
        initial, kind = turns[i]
        extra, forced = TRUNCATED if kind == CUT else 0, NEXT[q][FORCED[q]]
        edits = [("D", DELETE, i + 1, q), ("I", INSERT, i, forced)]
        if kind != GONE:
            if initial in NEXT[q]:
                edits.append(("K", extra, i + 1, NEXT[q][initial]))
            edits.append(("R", REROLE + extra, i + 1, forced))
        beyond = NEVER
        for letter, cost, j, p in edits:
            if cost + need[j][p] <= left:
                path.append(letter)
                if reach(j, p, left - cost):
                    return True
                path.pop()
            beyond = min(beyond, cost + need[j][p])
        need[i][q] = max(need[i][q], beyond)  # failed: this state needs more than was left
        return False

    while True:
        bound = need[0][entry]
        if reach(0, entry, bound):
            return bound, "".join(path)


def apply(turns: list[tuple[str, str]], audit: str, state: int) -> list[tuple[str, str]]:
    """The (role, text) of the turns that ``audit`` leaves."""
    out, at = [], iter(turns)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(at)
        if letter == "D":
            continue
        initial = role[:1] if letter == "K" else FORCED[state]
        out.append((role if letter == "K" else NAMES[initial], text))
        state = NEXT[state][initial]
    return out


def kinds(texts: list[str], repeated) -> list[str]:
    """First fault of each turn: blank, duplicate, truncated or none (empty); ``repeated(i)`` says whether turn i was seen before."""
    out = []
    for i, text in enumerate(texts):
        core = text.rstrip(WHITE)
        out.append("blank" if not core else "duplicate" if repeated(i) else "" if core[-1] in ".!?" else "truncated")
    return out


def summary(turns: list, roles: list[str], faults: list[str]) -> dict:
    """What of a block of turns can be added up."""
    known = [t for t in turns if t is not None]
    initials = [r[:1] for r in roles]
    return {"low": min(known, default=None), "high": max(known, default=None), "distinct": len(set(known)),
            "first": initials[0], "last": initials[-1],
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")}}


def signature(roles: list[str], faults: list[str]) -> tuple[tuple[str, int], ...]:
    return tuple((r[:1], CUT if f == "truncated" else GONE if f else FINE) for r, f in zip(roles, faults))


def block(order: int, turns: list, roles: list[str], faults: list[str]) -> dict:
    """A block's summary and its table (entry, goal) -> cost, audit, where each block's audit ends, state there."""
    sign, cells = signature(roles, faults), {}
    for q in range(4):
        for p in range(4):
            got = search(sign, q, p)
            if got:
                cells[q, p] = *got, [len(got[1])], [p]
    return {**summary(turns, roles, faults), "orders": [order], "cells": cells}


def joined(a: dict, b: dict) -> dict:
    """Two neighbouring runs of blocks as one."""
    cells: dict = {}
    for (q, m), (cost, audit, ends, states) in a["cells"].items():
        for p in range(4):
            more = b["cells"].get((m, p))
            if more:
                total, text = cost + more[0], audit + more[1]
                if (q, p) not in cells or (total, text) < cells[q, p][:2]:
                    cells[q, p] = total, text, (ends, len(audit), more[2]), (states, more[3])
    cells = {k: (c, t, e + [n + x for x in f], s + r) for k, (c, t, (e, n, f), (s, r)) in cells.items()}
    pairs = ("su", "ua", "au")
    return {"cells": cells, "orders": a["orders"] + b["orders"], "first": a["first"], "last": b["last"],
            "low": b["low"] if a["low"] is None else a["low"], "high": a["high"] if b["high"] is None else b["high"],
            "distinct": a["distinct"] + b["distinct"] - (a["high"] is not None and a["high"] == b["low"]),
            "illegal": a["illegal"] + b["illegal"] + (a["last"] + b["first"] not in pairs),
            **{k: a[k] + b[k] for k in ("blank", "duplicate", "truncated")}}


def chosen(run: dict) -> tuple[int, str, list[int], list[int]]:
    """Cost, audit, ends and states of a whole conversation's blocks; the last block takes the closing inserts."""
    ways = [(cost + TAIL[p], audit + "I" * (TAIL[p] // INSERT), ends, states)
            for (q, p), (cost, audit, ends, states) in run["cells"].items() if q == 0]
    cost, audit, ends, states = min(ways, key=lambda w: w[:2])
    return cost, audit, [*ends[:-1], len(audit)], states


def gaps(run: dict) -> int:
    return 0 if run["low"] is None else run["high"] - run["low"] + 1 - run["distinct"]


def repair_whole(turns: list, roles: list[str], texts: list[str]) -> tuple[dict, int, str, list[tuple[str, str]]]:
    """Summary, cost, audit and repaired turns of a conversation in order."""
    seen, again = set(), []
    for pair in zip(roles, texts):
        again.append(pair in seen)
        seen.add(pair)
    faults = kinds(texts, again.__getitem__)
    run = summary(turns, roles, faults)
    if len(turns) <= BLOCK_TURNS:
        cost, audit = search(signature(roles, faults), 0, END)
    else:
        spans = [slice(i, i + BLOCK_TURNS) for i in range(0, len(turns), BLOCK_TURNS)]
        cost, audit, _, _ = chosen(reduce(joined, [block(s.start, turns[s], roles[s], faults[s]) for s in spans]))
    return run, cost, audit, apply(list(zip(roles, texts)), audit, 0)


def lines(turns: list[tuple[str, str]]) -> bytes:
    return "\n".join([f"{r}:{t}" for r, t in turns]).encode()


TURNS = "array<struct<turn: long, role: string, text: string>>"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT = ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"


def _turn_lists(lists: list[list[tuple]]) -> pa.Array:
    flat = [t for x in lists for t in x]
    fields = [pa.field("turn", pa.int64()), pa.field("role", pa.string()), pa.field("text", pa.string())]
    cols = [pa.array([t[i] for t in flat], f.type) for i, f in enumerate(fields)]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(cols, fields=fields))


def _result_row(run: dict, cost: int, audit: str, digest: str | None) -> tuple:
    return gaps(run), run["blank"], run["duplicate"], run["truncated"], run["illegal"], cost, audit, digest


def _columns(rows: list[tuple], names: list[str]) -> list[pa.Array]:
    kinds_ = [pa.int64()] * len(COUNTS) + [pa.string(), pa.string()]
    return [pa.array([r[i] for r in rows], kinds_[i]) for i in range(len(names))]


class _Cutter:
    """Turns of a sorted partition -> repaired conversations, and blocks of those that may go on elsewhere."""

    def __init__(self, part: int, conv_type: pa.DataType):
        self.base, self.row, self.first, self.conv_type = part << 32, 0, True, conv_type
        self.clear()

    def clear(self) -> None:
        self.turns, self.roles, self.texts, self.size, self.long = [], [], [], 0, False

    def start(self, conv) -> None:
        self.conv = conv
        self.clear()

    def add(self, turn, role, text) -> list[tuple]:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(role) + len(text)
        self.row += 1
        partial = self.first or self.long
        if len(self.turns) >= (BLOCK_TURNS if partial else WHOLE_TURNS) or self.size >= (BLOCK_BYTES if partial else WHOLE_BYTES):
            self.long = True
            return self.blocks()
        return []

    def blocks(self) -> list[tuple]:
        out, n, lo, size = [], len(self.turns), 0, 0
        for i in range(n):
            size += len(self.roles[i]) + len(self.texts[i])
            if i + 1 == n or i + 1 - lo == BLOCK_TURNS or size >= BLOCK_BYTES:
                some = list(zip(self.turns[lo:i + 1], self.roles[lo:i + 1], self.texts[lo:i + 1]))
                out.append((self.conv, False, self.base + self.row - n + lo, some, (None,) * 8))
                lo, size = i + 1, 0
        self.turns, self.roles, self.texts, self.size = [], [], [], 0
        return out

    def close(self, last: bool) -> list[tuple]:
        """The current conversation has ended, or the partition has (``last``)."""
        if last or self.first or self.long:
            out = self.blocks() if self.turns else []
        else:
            run, cost, audit, turns = repair_whole(self.turns, self.roles, self.texts)
            digest = hashlib.sha256(lines(turns)).hexdigest()
            out = [(self.conv, True, self.base + self.row - len(self.turns), [(None, r, t) for r, t in turns],
                    _result_row(run, cost, audit, digest))]
        self.first = False
        return out

    def batch(self, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], self.conv_type), pa.array([r[1] for r in rows], pa.bool_()),
            pa.array([r[2] for r in rows], pa.int64()), _turn_lists([r[3] for r in rows]),
            *_columns([r[4] for r in rows], names[4:])], names)


def _cut(dealt: DataFrame) -> DataFrame:
    """``conv, whole, place, turns`` and the result columns (null for blocks)."""
    schema = T.StructType([dealt.schema["conv"], *T.StructType.fromDDL(f"whole boolean, place long, turns {TURNS}, {RESULT}").fields])
    names = schema.names

    def run(batches):
        from pyspark import TaskContext

        cutter, conv, begun, out, held = None, None, False, [], 0
        for b in batches:
            cutter = cutter or _Cutter(TaskContext.get().partitionId(), b.column(0).type)
            for c, *turn in zip(*(b.column(i).to_pylist() for i in range(4))):
                if not begun or c != conv:
                    out += cutter.close(False) if begun else []
                    conv, begun = c, True
                    cutter.start(c)
                out += cutter.add(*turn)
                held += len(turn[2])
                if held > BLOCK_BYTES:
                    if out:
                        yield cutter.batch(out, names)
                    out, held = [], 0
        if begun:
            out += cutter.close(True)
        if out:
            yield cutter.batch(out, names)

    return dealt.mapInArrow(run, schema)


def _repeats(blocks: DataFrame) -> DataFrame:
    """``place, again``: in each block the positions of turns whose role and text come earlier in the conversation."""
    turn = F.col("t")
    digest = F.sha2(F.concat(F.length(turn["role"]).cast("string"), F.lit(":"), turn["role"], turn["text"]), 256)
    each = blocks.select("conv", "place", F.posexplode("turns").alias("pos", "t")).where(turn["text"].rlike(r"[^\x20\x09-\x0D]"))
    each = each.select("conv", "place", "pos", digest.alias("digest"))
    row = F.col("place") + F.col("pos")
    first = each.groupBy("conv", "digest").agg(F.min(row).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.col("conv").alias("c"), F.col("digest").alias("d"), "first")
    late = each.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))).where(row > F.col("first"))
    return late.groupBy("place").agg(F.collect_list("pos").alias("again"))  # a block's turns at most


def _long(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Results and repaired blocks (``conv, place, turns``) of the conversations that were left in blocks."""
    conv = blocks.schema["conv"]
    state = T.StructType([conv, *T.StructType.fromDDL("place long, run binary").fields])

    def tables(batches):
        for b in batches:
            out = []
            for place, turns, again in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))):
                roles, texts = [t["role"] for t in turns], [t["text"] for t in turns]
                faults = kinds(texts, set(again or ()).__contains__)
                out.append(pickle.dumps(block(place, [t["turn"] for t in turns], roles, faults)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], state.names)

    def multiply(key, got):
        got = got.sort_by("place")
        run = reduce(joined, [pickle.loads(x) for x in got["run"].to_pylist()])
        return pa.table([got["conv"].slice(0, 1), got["place"].slice(0, 1), pa.array([pickle.dumps(run)], pa.binary())], state.names)

    runs = blocks.join(_repeats(blocks), "place", "left").select("conv", "place", "turns", "again").mapInArrow(tables, state)
    last = blocks.agg(F.max(F.shiftright("place", 32)).alias("p")).first()["p"] or 0
    width = 1
    while True:  # first the blocks of a partition, then partitions by groups
        runs = runs.groupBy("conv", F.expr(f"shiftright(place, 32) div {width}").alias("g")).applyInArrow(multiply, state)
        if width > last:
            break
        width *= FAN_IN
    runs = write_table(runs, "runs")
    done = T.StructType([conv, *T.StructType.fromDDL(
        f"{RESULT}, parts array<struct<at: long, state: int, piece: string>>").fields])

    def finish(batches):
        for b in batches:
            rows, parts = [], []
            for raw in b.column(2).to_pylist():
                run = pickle.loads(raw)
                cost, audit, ends, states = chosen(run)
                rows.append(_result_row(run, cost, audit, None))
                parts.append([{"at": at, "state": q, "piece": audit[lo:hi]}
                              for at, q, lo, hi in zip(run["orders"], [0, *states], [0, *ends], ends)])
            kind = pa.list_(pa.struct([("at", pa.int64()), ("state", pa.int32()), ("piece", pa.string())]))
            yield pa.RecordBatch.from_arrays([b.column(0), *_columns(rows, done.names[1:-1]), pa.array(parts, kind)], done.names)

    results = runs.mapInArrow(finish, done)
    pieces = results.select(F.explode("parts").alias("p")).select("p.*")
    left = T.StructType([conv, *T.StructType.fromDDL(f"place long, turns {TURNS}").fields])

    def edit(batches):
        for b in batches:
            out = [[(None, *t) for t in apply([(t["role"], t["text"]) for t in turns], piece, q)]
                   for turns, q, piece in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _turn_lists(out)], left.names)

    edited = blocks.join(pieces, F.col("place") == F.col("at")).select("conv", "place", "turns", "state", "piece").mapInArrow(edit, left)
    edited = write_table(edited, "repaired")
    hashed = T.StructType([T.StructField("c", conv.dataType), T.StructField("digest", T.StringType())])

    def digests(batches):
        conv_, digest, any_, begun, kind = None, None, False, False, None
        for b in batches:
            kind = b.column(0).type
            for c, turns in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not begun or c != conv_:
                    if begun:
                        yield pa.RecordBatch.from_arrays([pa.array([conv_], kind), pa.array([digest.hexdigest()])], hashed.names)
                    conv_, digest, any_, begun = c, hashlib.sha256(), False, True
                if turns:
                    digest.update((b"\n" if any_ else b"") + lines([(t["role"], t["text"]) for t in turns]))
                    any_ = True
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([conv_], kind), pa.array([digest.hexdigest()])], hashed.names)

    streamed = edited.repartition(partitions(blocks.sparkSession), "conv").sortWithinPartitions("conv", "place")
    sums = streamed.select("conv", "turns").mapInArrow(digests, hashed)
    results = results.drop("parts", "repaired_sha256").join(sums, F.col("conv").eqNullSafe(F.col("c")))
    return results.withColumnRenamed("digest", "repaired_sha256").drop("c"), edited


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """A row per conversation (``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``; the last of
    ``role:text`` lines), and the repaired turns (``conv, place, pos, role, text``, in order of place and pos)."""
    def named(c):
        return F.col(f"`{c}`")

    src = rows.select(named(conv_col).alias("conv"), named(turn_col).cast("long").alias("turn"),
                      F.coalesce(named(role_col), F.lit(" ")).alias("role"), F.coalesce(named(text_col), F.lit(" ")).alias("text"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("tie").asc()]
    dealt = src.withColumn("tie", F.xxhash64("text")).repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    stored = write_table(_cut(dealt.drop("tie")), "conversations")
    whole, blocks = stored.where("whole"), stored.where("not whole").select("conv", "place", "turns")
    results, edited = _long(blocks)
    names = ["conv", *COUNTS, "audit", "repaired_sha256"]
    turns = whole.select("conv", "place", "turns").unionByName(edited)
    turns = turns.select("conv", "place", F.posexplode("turns").alias("pos", "t")).select("conv", "place", "pos", "t.role", "t.text")
    return whole.select(names).unionByName(results.select(names)), turns


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows with planted faults, by CRC-32 of ``conv:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 removes its stops,
    3 repeats it, 4 makes its role user.  Nulls of role and text become one space, in the key those of id and turn, too."""
    def text(c):
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text(conv_col), F.lit(":"), text(turn_col)).cast("binary")) % 20
    src = rows.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), text(role_col).alias("role"),
                      text(text_col).alias("text"), kind.alias("kind"))
    worn = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    return src.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), worn.alias("text"),
                      F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).drop("copy")
