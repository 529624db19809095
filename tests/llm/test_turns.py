"""Repair of conversations against a search over all edits, on rows with every kind of fault."""

import hashlib
import heapq
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskflow.llm import turns
from riskflow.llm.queries import repaired_turns
from riskflow.llm.turns import Turn

SCHEMA = "conv_id long, turn long, role string, text string, audit string, place long"


def searched(row_turns):
    """Least (cost, audit) by visiting partial audits in that order, one role initial after the other."""
    heap, seen = [(0, "", 0, "")], set()
    while True:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(row_turns) and state in ("", "a"):
            return cost, audit
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        for role in after:
            if role != "s":
                heapq.heappush(heap, (cost + 3, audit + "I", i, role))
        if i < len(row_turns):
            t = row_turns[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state))
            if not t.goes:
                for role in after:
                    if t.initial == role:
                        heapq.heappush(heap, (cost + 3 * t.truncated, audit + "K", i + 1, role))
                    if role != "s":
                        heapq.heappush(heap, (cost + 3 + 3 * t.truncated, audit + "R", i + 1, role))


TURNS = st.lists(st.builds(Turn, st.sampled_from(["s", "u", "u", "a", "a", "t", " ", ""]), st.sampled_from([False, False, True]), st.booleans()), max_size=14)


@settings(max_examples=1500, deadline=None)
@given(TURNS)
def test_cheapest_audit(found):
    assert turns.whole(found) == searched(found)


@settings(max_examples=500, deadline=None)
@given(TURNS, st.integers(1, 4))
def test_fold_of_blocks(found, size):
    """Blocks of any size give the audit of the whole, and each block's part of it."""
    fold = turns._Fold(1)
    parts = [found[k : k + size] for k in range(0, len(found), size)]
    for k, part in enumerate(parts):
        sides = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in turns.table(part).items()]
        fold.add(dict(place=k, blank=0, duplicate=0, truncated=0, illegal=0, n_turns=1, first_turn=k, last_turn=k, first_role="u", last_role="a", sides=sides))
    row = fold.row()
    assert (row["cost"], row["audit"]) == searched(found)
    steps = sorted(row["path"], key=lambda s: s["place"])
    assert "".join(turns.table(parts[s["place"]])[s["p"], s["q"]][1] for s in steps) == row["audit"]


def brute_damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute(rows):
    """What the query returns, by conversation; ``rows`` have no equal turns with different texts."""
    damaged, result = brute_damage(rows), {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in damaged if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        n, seen, found, known = dict.fromkeys(turns.COUNTS, 0), set(), [], {r[1] for r in own if r[1] is not None}
        for _, _, role, text in own:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                n[fault] += 1
            found.append(Turn(role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        n["gaps"] = max(known) - min(known) + 1 - len(known) if known else 0
        n["illegal"] = sum(a.initial + b.initial not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        n["cost"], audit = searched(found)
        said, k, last = [], 0, ""
        for edit in audit:
            role, text = (own[k][2], own[k][3]) if edit in "KR" else ("", "")
            if edit != "D":
                role = role if edit == "K" else "assistant" if last == "u" else "user"
                said.append(f"{role}:{text}")
                last = role[0]
            k += edit != "I"
        result[conv] = (*n.values(), audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return result


def odd_rows():
    rows = [(None, k, "user", "Hi.", "x", 1) for k in range(3)] + [(1, None, None, None, "x", 1), (1, None, None, None, "x", 1), (2, 5, "", "\x1c", "x", 1)]
    rows += [(3, k, ["user", "assistant"][k % 2], "long " * 40_000 + ".", "x", 1) for k in range(4)] + [(4, 2**40, "tool", "?", "x", 1), (4, -7, "system", "é. \n", "x", 1)]
    # One conversation holds most rows, with one text again and again and equal rows.
    rows += [(9, k // 2 * 2 if k % 40 == 1 else k, ["user", "assistant", "system"][k * k % 7 % 3], ["the same.", f"text {k - k % 2 if k % 40 < 2 else k}.", f"cut {k}"][k % 3 if k % 40 > 1 else 1], "x", 1) for k in range(700)]
    rows = [r if not (r[0] == 9 and r[1] % 40 == 0) else (9, r[1], "user", f"at {r[1]}.", "x", 1) for r in rows]
    rows += [(k, j, ["user", "assistant"][j % 2], f"{k} {j}!", "x", 1) for k in range(100, 160) for j in range(k % 5)]
    return rows


@pytest.mark.parametrize("partitions", [1, 13])
def test_repair_equals_search(spark, partitions):
    rows = odd_rows()
    audits, pieces = turns.repair(turns.damaged(spark.createDataFrame(rows, SCHEMA).repartition(5)), partitions)
    got = {r["conv_id"]: tuple(r[c] for c in (*turns.COUNTS, "audit")) for r in audits.collect()}
    sums = {r["conv_id"]: r["repaired_sha256"] for r in turns.digests(pieces).collect()}
    want = {k: (v[0], v[1], v[2], v[3], v[4], v[5], v[6], v[7]) for k, v in brute(rows).items()}
    left = {r[0] for r in brute_damage(rows)}
    assert {k: (*v, sums[k]) for k, v in got.items()} == {k: v for k, v in want.items() if k in left}


def test_query(spark, tmp_path):
    rows = odd_rows()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    found = repaired_turns(spark, str(tmp_path))
    assert {r["conv_id"]: tuple(r)[1:] for r in found.collect()} == brute(rows)
    assert len(found.columns) == 9


def test_query_on_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    found = repaired_turns(spark, "/root/testdata/sf0.01").collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in found} == brute([tuple(r) for r in table.collect()])


def test_no_turns(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert repaired_turns(spark, str(tmp_path)).collect() == []
