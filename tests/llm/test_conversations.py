"""Conversation repair against a best-first search over whole conversations."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from placerank.llm import conversations
from placerank.llm.conversations import BLANK, CUT, DUPLICATE, SOUND, block_table, joined, repair, repair_report, search

from .conftest import SF

SCHEMA = "conv_id bigint, turn bigint, role string, text string, id string, block string, audit string"
INK = r"[^\x20\x09-\x0D]"
AFTER = {0: "su", 1: "u", 2: "a", 3: "u"}
STATE = {"s": 1, "u": 2, "a": 3}
ROLE = {"u": "user", "a": "assistant"}


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        ink = re.findall(INK, text)
        out.append(BLANK if not ink else DUPLICATE if (role, text) in seen else CUT if ink[-1] not in ".!?" else SOUND)
        seen.add((role, text))
    return out


def cheapest(rows, faults, start=0, ends=(0, 3)):
    """(cost, audit, repaired rows) by Dijkstra's search over (cost, audit)."""
    heap, done = [(0, "", 0, start, ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ends:
            return cost, audit, out
        for c in AFTER[state].replace("s", ""):
            heapq.heappush(heap, (cost + 3, audit + "I", i, STATE[c], (*out, (ROLE[c], ""))))
        if i < len(rows):
            (role, text), fault = rows[i], faults[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, out))
            if fault in (SOUND, CUT):
                more = 3 if fault == CUT else 0
                if role[:1] and role[:1] in AFTER[state]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, STATE[role[:1]], (*out, rows[i])))
                for c in AFTER[state].replace("s", ""):
                    heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, STATE[c], (*out, (ROLE[c], text))))
    return None


def damage(conv, turn, role, text):
    role, text = " " if role is None else role, " " if text is None else text
    kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    if kind == 0:
        return []
    text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
    return [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def expected(table):
    found = {}
    for conv, *row in table:
        found.setdefault(conv, []).extend(damage(conv, *row))
    out = {}
    for conv, rows in found.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        said = [r[1:] for r in rows]
        faults = faults_of(said)
        cost, audit, fixed = cheapest(said, faults)
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out[conv] = (gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, cost, audit, digest)
    return out


def reported(df):
    return {r["conv_id"]: tuple(r)[1:] for r in repair_report(df).collect()}


def messy(n, conversations_, seed=3):
    r = random.Random(seed)
    return [(r.choice(conversations_), r.choice([None, *range(400)]), r.choice(["user", "assistant", "system", "tool", None, ""]),
             r.choice([None, "", "Yes.", "No", "ok? ", "a b c!", "x\n"]), "i", "b", "a") for _ in range(n)]


def test_long_and_broken_conversations(spark):
    df = spark.createDataFrame(messy(1500, [1, 2, 3, None, *range(10, 60)]), SCHEMA).repartition(4)
    assert reported(df) == expected([tuple(r)[:4] for r in df.collect()])


def test_one_conversation_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(conversations, "FAN_BITS", 1)
    df = spark.createDataFrame(messy(900, [7], seed=5), SCHEMA)
    assert reported(df) == expected([tuple(r)[:4] for r in df.collect()])


def test_shared_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    assert reported(df) == expected([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_repeated_rows_and_clean_ones(spark):
    clean = [(5, t, "user" if t % 2 == 0 else "assistant", f"Text {t}.", "", "", "") for t in range(0, 8)]
    df = spark.createDataFrame(clean * 3, SCHEMA)
    rows, _ = repair(df.select("conv_id", "turn", "role", "text"))
    got = rows.collect()[0]
    assert (got["duplicate"], got["cost"], got["audit"]) == (16, 64, "KDD" * 8)
    assert reported(df) == expected([tuple(r)[:4] for r in df.collect()])


def test_no_rows_left_and_no_rows(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(1, gone, "user", "Hi.", "", "", "")], SCHEMA)
    assert reported(df) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert reported(df.where(F.lit(False))) == {}


@pytest.mark.parametrize("seed", range(6))
def test_blocks_join_to_the_whole(seed):
    r = random.Random(seed)
    rows = [(r.choice(["s", "u", "a", "t", ""]), r.choice([SOUND, SOUND, BLANK, DUPLICATE, CUT])) for _ in range(90)]
    spoken, faults = [(c, str(i)) for i, (c, _) in enumerate(rows)], [f for _, f in rows]
    want = cheapest(spoken, faults)[:2]
    assert search(rows, 0, (0, 3))[:2] == want
    table = joined([block_table(rows[i : i + 13], False) for i in range(0, 90, 13)])
    assert min(v for (a, b), v in table.items() if a == 0 and b in (0, 3)) == want
    for start in range(4):
        for end in range(4):
            found, other = search(rows[:12], start, (end,)), cheapest(spoken[:12], faults[:12], start, (end,))
            assert (found and found[:2]) == (other and other[:2])
