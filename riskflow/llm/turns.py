"""Repair of conversations: turns aligned with the role grammar ``(s?(ua)+)?`` at least cost.

The grammar's strings of one length and one end are one alternating string, so one edit matrix, built from the end, has the
costs of all lengths in its first row. Cells farther from the diagonal than the cost of a simple repair (the incumbent)
allows are not computed. Of the lengths with the least cost, the audits are traced and the ASCII-least wins.

Turns are sorted by range, so a conversation of any size is cut like any other rows. One that lies within a task and has at
most ``BLOCK`` turns is repaired there. Others are cut into blocks, each aligned from every state of the grammar to every
other; a fold over these small tables finds the path of a whole conversation, which every block then follows by itself.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm import store
from riskflow.llm.text import blocks as text_blocks

BLOCK = 64
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States of the grammar: nothing yet; a system turn; user said last; assistant said last.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"u": "user", "a": "assistant"}
WHITE = " \t\n\x0b\x0c\r"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_FAR = 1 << 60


class Turn(NamedTuple):
    """What the alignment sees of a turn."""

    initial: str
    goes: bool
    truncated: bool


# ---- faults ------------------------------------------------------------------------------------

def fault(text: str) -> str:
    """``blank``, ``truncated`` or nothing; duplicates depend on other turns."""
    solid = text.rstrip(WHITE)
    return "blank" if not solid else "" if solid[-1] in ".!?" else "truncated"


def inspect(turns: list[dict], duplicates: set[int] | None = None) -> tuple[list[Turn], dict]:
    """The turns as the alignment sees them, and what was counted. Without ``duplicates`` (places), they are found here."""
    seen: set[tuple[str, str]] = set()
    out, n = [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for k, t in enumerate(turns):
        found = fault(t["text"])
        again = k in duplicates if duplicates is not None else (t["role"], t["text"]) in seen
        if duplicates is None:
            seen.add((t["role"], t["text"]))
        if again and found != "blank":
            found = "duplicate"
        if found:
            n[found] += 1
        out.append(Turn(t["role"][:1], found in ("blank", "duplicate"), found == "truncated"))
    n["illegal"] = sum(a.initial + b.initial not in ("su", "ua", "au") for a, b in zip(out, out[1:]))
    return out, n


def known_turns(turns: list[dict]) -> list[int]:
    return [t["turn"] for t in turns if t["turn"] is not None]


# ---- alignment ---------------------------------------------------------------------------------

class Alignment:
    """Edit costs of a run of turns against all targets that end in one role.

    ``cost(i, r)``: turns from ``i`` on against the last ``r`` symbols of the target. Row ``i`` holds a band of ``r``
    around the number of turns that may stay; outside it, every path costs more than ``limit``.
    """

    def __init__(self, turns: list[Turn], end: str, limit: int):
        self.turns, self.end, self.other = turns, end, "u" if end == "a" else "a"
        stays = 0
        self.low, self.rows = [0], [[INSERT * r for r in range(limit // INSERT + 1)]]
        for t in reversed(turns):
            stays += not t.goes
            self._add(t, max(0, stays - limit // DELETE), stays + limit // INSERT)
        self.low.reverse()
        self.rows.reverse()

    def _add(self, t: Turn, low: int, high: int) -> None:
        under, base = self.rows[-1], self.low[-1]
        more, last, row = TRUNCATED * t.truncated, _FAR, []
        for r in range(low, high + 1):
            at = r - base
            best = last + INSERT
            if 0 <= at < len(under):
                best = min(best, under[at] + DELETE)
            if not t.goes and r and 0 < at <= len(under):
                best = min(best, under[at - 1] + more + (KEEP if t.initial == self.symbol(r) else REROLE))
            row.append(best)
            last = best
        self.low.append(low)
        self.rows.append(row)

    def symbol(self, r: int) -> str:
        return self.end if r % 2 else self.other

    def cost(self, i: int, r: int) -> int:
        at = r - self.low[i]
        return self.rows[i][at] if 0 <= at < len(self.rows[i]) else _FAR

    def lengths(self, first: int, step: int = 2) -> range:
        """Lengths of targets within the band, of one parity; one less too, as a system turn may come before."""
        low = max(first, self.low[0] - 1)
        return range(low + (low - first) % step, self.low[0] + len(self.rows[0]), step)

    def trace(self, i: int, r: int) -> str:
        """The ASCII-least of the cheapest audits: at each cell the least letter that keeps the cost."""
        out = []
        while i < len(self.turns) or r:
            here = self.cost(i, r)
            if i < len(self.turns) and self.cost(i + 1, r) + DELETE == here:
                out.append("D")
                i += 1
            elif r and self.cost(i, r - 1) + INSERT == here:
                out.append("I")
                r -= 1
            else:
                out.append("K" if self.turns[i].initial == self.symbol(r) else "R")
                i, r = i + 1, r - 1
        return "".join(out)


def incumbent(turns: list[Turn]) -> int:
    """Cost, beyond the forced deletions, of giving every turn that may stay an alternating role, with two insertions.

    Two insertions reach any start and any end, and a leading system turn is counted as one that needs a new role, so no
    cheapest repair costs more, whatever state it starts and ends in. Ends that need a kept system turn are exempt.
    """
    staying = [t for t in turns if not t.goes]
    cost = []
    for first in "ua":
        role = first
        total = 2 * INSERT
        for t in staying:
            total += TRUNCATED * t.truncated + (KEEP if t.initial == role else REROLE)
            role = "a" if role == "u" else "u"
        cost.append(total)
    return max(cost)


def _cheapest(options: list[tuple[int, object]]) -> tuple[int, str] | None:
    """(cost, audit) of the best option; audits are traced for the least cost only."""
    least = min((c for c, _ in options), default=_FAR)
    if least >= _FAR:
        return None
    return least, min(trace() for c, trace in options if c == least)


def _after_system(turns: list[Turn], rest: Alignment | None, r: int) -> Iterator[tuple[int, object]]:
    """Keep one system turn, delete those before it, and align what follows with the last ``r`` symbols."""
    for k, t in enumerate(turns):
        if t.initial == "s" and not t.goes:
            if rest is None:
                yield DELETE * (len(turns) - 1) + TRUNCATED * t.truncated, lambda k=k: "D" * k + "K" + "D" * (len(turns) - k - 1)
            else:
                yield min(_FAR, DELETE * k + TRUNCATED * t.truncated + rest.cost(k + 1, r)), lambda k=k: "D" * k + "K" + rest.trace(k + 1, r)


def table(turns: list[Turn], starts: tuple[int, ...] = (EMPTY, SYSTEM, USER, ASSISTANT), ends: tuple[int, ...] = (EMPTY, SYSTEM, USER, ASSISTANT)) -> dict[tuple[int, int], tuple[int, str]]:
    """The cheapest (cost, audit) of the turns from each state to each other that can be reached."""
    limit = incumbent(turns)
    sides = {s: Alignment(turns, c, limit) for s, c in ((USER, "u"), (ASSISTANT, "a")) if s in ends}
    gone = (DELETE * len(turns), "D" * len(turns))
    out = {}
    for p in starts:
        for q in ends:
            options: list[tuple[int, object]] = []
            if q in sides:
                side = sides[q]
                # Targets begin with an assistant's turn after a user's, else with a user's; odd ones end as they begin.
                first = 0 if p == q else 1 if (p == USER) == (q == ASSISTANT) else 2
                options += [(side.cost(0, r), lambda r=r: side.trace(0, r)) for r in side.lengths(first)]
                if p == EMPTY:
                    for r in side.lengths(1 if q == USER else 2):
                        options += _after_system(turns, side, r)
            elif p == q:
                options.append((gone[0], lambda: gone[1]))
            elif p == EMPTY and q == SYSTEM:
                options += _after_system(turns, None, 0)
            best = _cheapest(options)
            if best:
                out[p, q] = best
    return out


def whole(turns: list[Turn]) -> tuple[int, str]:
    """The cheapest (cost, audit) of a whole conversation."""
    found = table(turns, (EMPTY,), (EMPTY, ASSISTANT))
    return min(found.values())


def replay(turns: list[dict], audit: str, state: int = EMPTY) -> list[dict]:
    """The repaired turns of a run that starts in ``state``."""
    out, k = [], 0
    for edit in audit:
        own = turns[k] if edit != "I" else {"text": ""}
        k += edit != "I"
        if edit == "D":
            continue
        role = own["role"] if edit == "K" else ROLES["a" if state == USER else "u"]
        state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]
        out.append({"role": role, "text": own["text"]})
    return out


# ---- Spark -------------------------------------------------------------------------------------

_SAID = "array<struct<role:string,text:string>>"
_HEARD = "array<struct<turn:bigint,role:string,text:string>>"
_FACTS = ", ".join(f"{c} bigint" for c in COUNTS)
PIECE_SCHEMA = f"conv_id bigint, place bigint, {_FACTS}, audit string, repaired {_SAID}, turns {_HEARD}"
_SIDE = "struct<p:int,q:int,cost:bigint,audit:string>"
BLOCK_SCHEMA = f"conv_id bigint, place bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_turn bigint, last_turn bigint, n_turns bigint, first_role string, last_role string, sides array<{_SIDE}>, turns {_HEARD}"
WHOLE_SCHEMA = f"conv_id bigint, {_FACTS}, audit string, path array<struct<place:bigint,p:int,q:int>>"
_A_SAID = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_A_HEARD = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
_LONG = pa.int64()
_A_PIECE = pa.schema([("conv_id", _LONG), ("place", _LONG), *[(c, _LONG) for c in COUNTS], ("audit", pa.string()), ("repaired", _A_SAID), ("turns", _A_HEARD)])
_A_BLOCK = pa.schema([
    *[(c, _LONG) for c in ("conv_id", "place", "blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn", "n_turns")], ("first_role", pa.string()), ("last_role", pa.string()),
    ("sides", pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", _LONG), ("audit", pa.string())]))), ("turns", _A_HEARD),
])
_A_WHOLE = pa.schema([("conv_id", _LONG), *[(c, _LONG) for c in COUNTS], ("audit", pa.string()), ("path", pa.list_(pa.struct([("place", _LONG), ("p", pa.int32()), ("q", pa.int32())])))])


def _texts(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def normal(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and text; a null role or text is one space."""
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _texts("role").alias("role"), _texts("text").alias("text"))


class _Cutter:
    """Gathers one conversation after the other from sorted turns and gives out pieces."""

    def __init__(self, part: int):
        self.part, self.at, self.run, self.key, self.begun, self.open = part, 0, [], None, False, True

    def _cut(self) -> Iterator[dict]:
        """A part of an open conversation."""
        if self.run:
            yield {"conv_id": self.key, "place": (self.part + 1 << 40) | (self.at - len(self.run)), "turns": self.run}
            self.run = []

    def _end(self, last: bool = False) -> Iterator[dict]:
        if self.open or last:
            yield from self._cut()
        elif self.run:
            seen, n = inspect(self.run)
            cost, audit = whole(seen)
            known = known_turns(self.run)
            gaps = known[-1] - known[0] + 1 - len(set(known)) if known else 0
            yield {"conv_id": self.key, "place": 0, **n, "gaps": gaps, "cost": cost, "audit": audit, "repaired": replay(self.run, audit)}
            self.run = []

    def add(self, conv_id, turn: dict) -> Iterator[dict]:
        if not self.begun:
            self.begun, self.key = True, conv_id
        elif conv_id != self.key:
            yield from self._end()
            self.key, self.open = conv_id, False
        if len(self.run) == BLOCK:
            self.open = True
            yield from self._cut()
        self.run.append(turn)
        self.at += 1

    def close(self) -> Iterator[dict]:
        yield from self._end(last=True)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter = _Cutter(TaskContext.get().partitionId())
    for batch in batches:
        for part in text_blocks(batch):
            out = []
            for row in part.to_pylist():
                out += cutter.add(row["conv_id"], {"turn": row["turn"], "role": row["role"], "text": row["text"]})
            if out:
                yield pa.RecordBatch.from_pylist(out, _A_PIECE)
    out = list(cutter.close())
    if out:
        yield pa.RecordBatch.from_pylist(out, _A_PIECE)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            turns, known = row["turns"], known_turns(row["turns"])
            seen, n = inspect(turns, set(row["again"] or ()))
            sides = [{"p": p, "q": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in table(seen).items()]
            out = {
                "conv_id": row["conv_id"], "place": row["place"], **n, "first_turn": known[0] if known else None, "last_turn": known[-1] if known else None,
                "n_turns": len(set(known)), "first_role": seen[0].initial, "last_role": seen[-1].initial, "sides": sides, "turns": turns,
            }
            yield pa.RecordBatch.from_pylist([out], _A_BLOCK)


class _Fold:
    """The cheapest path through the blocks of one conversation, taken in order.

    For each state: its cost and what its audit has beyond the part that all states share. States' paths soon run
    together, so these tails stay short. ``back`` has a byte for each block and state.
    """

    def __init__(self, conv_id):
        self.conv_id, self.best = conv_id, {EMPTY: (0, "")}
        self.done: list[str] = []
        self.places: list[int] = []
        self.back = bytearray()
        self.n = dict.fromkeys(COUNTS, 0)
        self.first_turn = self.last_turn = self.last_role = None

    def add(self, row: dict) -> None:
        for c in ("blank", "duplicate", "truncated", "illegal"):
            self.n[c] += row[c]
        if self.last_role is not None and self.last_role + row["first_role"] not in ("su", "ua", "au"):
            self.n["illegal"] += 1
        self.last_role = row["last_role"]
        if row["first_turn"] is not None:
            self.n["gaps"] -= row["n_turns"] - (row["first_turn"] == self.last_turn)
            self.first_turn = row["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = row["last_turn"]
        best: dict[int, tuple[int, str]] = {}
        came = bytearray(4)
        for side in row["sides"]:
            if side["p"] in self.best:
                cost, tail = self.best[side["p"]]
                way = (cost + side["cost"], tail + side["audit"])
                if side["q"] not in best or way < best[side["q"]]:
                    best[side["q"]] = way
                    came[side["q"]] = side["p"]
        shared = os.path.commonprefix([tail for _, tail in best.values()])
        self.done.append(shared)
        self.best = {q: (cost, tail[len(shared) :]) for q, (cost, tail) in best.items()}
        self.places.append(row["place"])
        self.back += came

    def row(self) -> dict:
        q = min((s for s in (EMPTY, ASSISTANT) if s in self.best), key=lambda s: self.best[s])
        cost, tail = self.best[q]
        path = []
        for k in range(len(self.places) - 1, -1, -1):
            p = self.back[4 * k + q]
            path.append({"place": self.places[k], "p": p, "q": q})
            q = p
        gaps = self.n["gaps"] + (self.last_turn - self.first_turn + 1) if self.first_turn is not None else 0
        return {"conv_id": self.conv_id, **self.n, "gaps": gaps, "cost": cost, "audit": "".join(self.done) + tail, "path": path}


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fold = None
    for batch in batches:
        for row in batch.to_pylist():
            if fold is None or fold.conv_id != row["conv_id"]:
                if fold:
                    yield pa.RecordBatch.from_pylist([fold.row()], _A_WHOLE)
                fold = _Fold(row["conv_id"])
            fold.add(row)
    if fold:
        yield pa.RecordBatch.from_pylist([fold.row()], _A_WHOLE)


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", _LONG), ("place", _LONG), ("repaired", _A_SAID)])
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            audit = next(s["audit"] for s in row["sides"] if (s["p"], s["q"]) == (row["p"], row["q"]))
            yield pa.RecordBatch.from_pylist([{"conv_id": row["conv_id"], "place": row["place"], "repaired": replay(row["turns"], audit, row["p"])}], schema)


def _repeated(open_: DataFrame) -> DataFrame:
    """``again``: for each block the places in it of turns whose role and text came earlier in the conversation."""
    each = open_.select("conv_id", "place", F.posexplode("turns").alias("k", "t")).select(
        "conv_id", "place", "k", F.xxhash64("t.role", "t.text").alias("h1"), F.xxhash64(F.lit(1), "t.text", "t.role").alias("h2"))
    at = F.struct("place", "k")
    first = each.groupBy("conv_id", "h1", "h2").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.col("conv_id").alias("c"), F.col("h1").alias("a"), F.col("h2").alias("b"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b"))
    later = each.join(first, same).where(at > F.col("first"))
    return later.groupBy(F.col("place").alias("of")).agg(F.collect_list("k").alias("again"))


def repair(turns: DataFrame, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Repaired conversations: (``audits``, ``pieces``).

    ``audits`` has one row per conversation: conv_id; the counts of ``COUNTS``; ``audit``, the edits' initials.
    ``pieces`` has the repaired turns: conv_id, ``place`` (order of the pieces of one conversation) and ``repaired``,
    at most ``BLOCK`` original turns and the inserted ones between them.

    A null role or text is one space. Rows are taken by turn (null first), equal turns by role and a hash of the text;
    repeated rows are turns of their own, of which all but the first are duplicates. Rows with a null conv_id are one
    conversation. An empty table gives no rows. Other columns are not read.
    """
    spark = turns.sparkSession
    store.prepare(spark)
    rows = normal(turns).withColumn("tie", F.xxhash64("text"))
    n = partitions or max(rows.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # The last key only spreads equal rows over ranges; their order among each other means nothing.
    spread = rows.withColumn("any", F.monotonically_increasing_id()).repartitionByRange(n, "conv_id", "turn", "role", "tie", "any")
    ordered = spread.sortWithinPartitions("conv_id", "turn", "role", "tie", "text").select("conv_id", "turn", "role", "text")
    cut = store.keep(ordered.mapInArrow(_cut, PIECE_SCHEMA), "turn-pieces")
    closed, open_ = cut.where(F.col("audit").isNotNull()), cut.where(F.col("audit").isNull()).select("conv_id", "place", "turns")

    marked = open_.join(_repeated(open_), F.col("place") == F.col("of"), "left").select("conv_id", "place", "turns", "again")
    blocks = store.keep(marked.mapInArrow(_tables, BLOCK_SCHEMA), "turn-blocks")
    lean = blocks.drop("turns").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    found = store.keep(lean.mapInArrow(_folded, WHOLE_SCHEMA), "turn-audits")
    steps = found.select(F.inline("path")).withColumnRenamed("place", "of")
    followed = blocks.join(steps, F.col("place") == F.col("of")).select("conv_id", "place", "p", "q", "sides", "turns")
    audits = closed.select("conv_id", *COUNTS, "audit").unionByName(found.drop("path"))
    pieces = closed.select("conv_id", "place", "repaired").unionByName(
        followed.mapInArrow(_followed, f"conv_id bigint, place bigint, repaired {_SAID}"))
    return audits, pieces


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of each conversation from its texts in order."""
    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], _LONG), pa.array([sha.hexdigest()])], names=["conv_id", "repaired_sha256"])

    sha = key = None
    for batch in batches:
        for part in text_blocks(batch, "said"):
            for conv_id, said in zip(part.column("conv_id").to_pylist(), part.column("said").to_pylist()):
                if sha is not None and conv_id == key:
                    sha.update(b"\n" if filled and said else b"")
                else:
                    if sha is not None:
                        yield row()
                    sha, key, filled = hashlib.sha256(), conv_id, False
                sha.update(said.encode())
                filled = filled or bool(said)
    if sha is not None:
        yield row()


def digests(pieces: DataFrame) -> DataFrame:
    """conv_id and ``repaired_sha256``: the repaired ``role:text``, joined by newlines.

    The sum of a text cannot be put together from sums of its parts, so the pieces of one conversation pass through one
    task, one after the other; it holds none of them. Conversations in one piece (place 0) are summed where they are.
    """
    said = F.concat_ws("\n", F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))).alias("said")
    rows = pieces.select("conv_id", "place", said)
    one = rows.where("place = 0").select("conv_id", F.sha2("said", 256).alias("repaired_sha256"))
    several = rows.where("place <> 0").repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "said")
    return one.unionByName(several.mapInArrow(_hashed, "conv_id bigint, repaired_sha256 string"))


# ---- damage ------------------------------------------------------------------------------------

def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults put in by the crc32 of ``conv_id:turn`` modulo 20; a null counts as one space.

    0 leaves the row out, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 makes it the user's.
    """
    kind = F.crc32(F.concat_ws(":", _texts("conv_id"), _texts("turn")).cast("binary")) % 20
    rows = normal(turns).withColumn("kind", kind).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def repair_damaged(turns: DataFrame) -> DataFrame:
    """Every conversation of the table with what ``repair`` found after ``damaged``; zeros where no turn was left."""
    audits, pieces = repair(damaged(turns))
    found = audits.join(digests(pieces).withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    every = turns.select(F.col("conv_id").cast("long").alias("own")).distinct()
    joined = every.join(found, F.col("own").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in COUNTS]
    return joined.select(
        F.col("own").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
