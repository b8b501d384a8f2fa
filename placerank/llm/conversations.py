"""Repair of the turn structure of conversations by depth-first branch and bound.

A conversation's rows, in order, are kept, given the other role, deleted, or joined by inserted
rows, at the least cost that leaves role initials of the form ``(s?(ua)+)?``; of the cheapest
edits the one whose audit (initials of the edits) is ASCII-least is taken.

The search runs over nodes (rows used, state of the form) with an explicit stack, the most
promising edit uppermost. A node is cut where its cost and the suffix's lower bound (what the rows
left cost at least from its state, audits aside) exceed the incumbent's cost, or equal it with an
audit that is no smaller; and where the node's dominance table holds a prefix that is as cheap and
has as small an audit. The stack running
empty proves the incumbent. Comparing prefixes by (cost, audit) is safe: both have used the same
rows, so that of equal costs neither audit is a prefix of the other.

Long conversations are split. Rows are numbered in a written, range-sorted table, and each run of
at most ``BLOCK`` rows of a conversation is searched on its own for every pair of states at its
ends; tables of (cost, audit) per pair are then joined ``FAN`` at a time. The chosen audit goes back
to the rows as pieces of a block each. So no task holds a conversation; the last one, for the hash
of the repaired text, which is sequential by definition, reads its rows as a stream.

Defined cases: a null role or text, and in the damage's key a null id or turn, is one space; rows
of equal turn are in order of role and text; rows without an id are one conversation; a role
without a first letter cannot be kept; repeated rows are rows (and duplicates of the first one); an
empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, shuffle_partitions, written

# Costs and audit letters of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK_BITS = 6
BLOCK = 1 << BLOCK_BITS  # rows of a conversation that are searched at once
FAN_BITS = 6  # blocks of a conversation that are joined at once: 64

# States of the form: nothing yet, behind s, behind u, behind a; the last letter leads to a state.
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
STATES, ENDS = range(4), (0, 3)
_OTHER = {s: [(c, t) for (f, c), t in _NEXT.items() if f == s and c != "s"] for s in STATES}
NEVER = 1 << 40
SOUND, BLANK, DUPLICATE, CUT = 0, 1, 2, 3  # faults of a row


def edits(initial: str, fault: int, state: int) -> list[tuple[int, str, int]]:
    """(cost, letter, next state) of using up a row in a state."""
    out = [(DELETE, "D", state)]
    if fault in (SOUND, CUT):
        more = TRUNCATED if fault == CUT else 0
        if (to := _NEXT.get((state, initial))) is not None:
            out.append((KEEP + more, "K", to))
        out += [(REROLE + more, "R", to) for _, to in _OTHER[state]]
    return out


def suffix_bounds(rows: list[tuple[str, int]], ends: tuple[int, ...]) -> list[list[int]]:
    """What rows from i on cost at least from each state to one of ``ends``, audits aside."""
    after = [0 if s in ends else NEVER for s in STATES]
    out = []
    for i in range(len(rows), -1, -1):
        if i < len(rows):
            after = [min(c + after[to] for c, _, to in edits(*rows[i], s)) for s in STATES]
        for _ in STATES:  # rows put in before row i
            after = [min([after[s], *(INSERT + after[to] for _, to in _OTHER[s])]) for s in STATES]
        out.append(after)
    return out[::-1]


def search(rows: list[tuple[str, int]], start: int, ends: tuple[int, ...]) -> tuple[int, str, int] | None:
    """The cheapest (cost, audit, end state) that leads through ``rows`` (initial, fault) from a
    state to one of ``ends``; None if there is none."""
    n, least = len(rows), suffix_bounds(rows, ends)
    best: tuple[int, str, int] | None = None
    seen: list[list[tuple[int, str] | None]] = [[None] * len(STATES) for _ in range(n + 1)]
    stack = [(0, start, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        bound = cost + least[i][state]
        if bound >= NEVER or (best is not None and (bound > best[0] or (bound == best[0] and audit > best[1]))):
            continue
        known = seen[i][state]
        if known is not None and known <= (cost, audit):
            continue
        seen[i][state] = (cost, audit)
        if i == n and state in ends and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, state)
        moves = [(INSERT, "I", i, to) for _, to in _OTHER[state]]
        if i < n:
            moves += [(c, letter, i + 1, to) for c, letter, to in edits(*rows[i], state)]
        # On the stack the most promising edit is uppermost, of equal ones the smaller letter.
        for _, letter, c, j, to in sorted(((c + least[j][to], letter, c, j, to) for c, letter, j, to in moves), reverse=True):
            stack.append((j, to, cost + c, audit + letter))
    return best


Table = dict[tuple[int, int], tuple[int, str]]


def block_table(rows: list[tuple[str, int]], whole: bool) -> Table:
    """(cost, audit) for each pair of states at a block's ends; of a whole conversation only what
    leads from nothing to an end."""
    if whole:
        found = search(rows, 0, ENDS)
        return {(0, found[2]): found[:2]}
    pairs = ((a, b, search(rows, a, (b,))) for a in STATES for b in STATES)
    return {(a, b): r[:2] for a, b, r in pairs if r is not None}


def joined(tables: list[Table]) -> Table:
    """The table of consecutive blocks as one."""
    out = tables[0]
    for table in tables[1:]:
        step: Table = {}
        for (a, m), (c1, s1) in out.items():
            for (m2, b), (c2, s2) in table.items():
                if m == m2:
                    new = (c1 + c2, s1 + s2)
                    if (a, b) not in step or new < step[a, b]:
                        step[a, b] = new
        out = step
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that the crc32 of 'conv_id:turn' deals out."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit(" ")), F.coalesce(F.col("role").cast("string"), F.lit(" "))
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    spoken = [F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv, turn)]
    kind = F.crc32(F.concat(spoken[0], F.lit(":"), spoken[1])) % 20
    rows = conversations.select(conv.alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"), kind.alias("kind"))
    changed = rows.where("kind <> 0").select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return changed.drop("copy")


def in_order(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, id): ``id`` numbers rows in (conv_id, turn, role, text) order,
    nulls first, over a written table. Rows equal in all of these are interchangeable: their input
    place parts them, so that copies of one row are no single task's."""
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")] + [F.col("place")]
    ranged = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(shuffle_partitions(rows.sparkSession), *keys)
    return written(ranged.sortWithinPartitions(*keys).drop("place").withColumn("id", F.monotonically_increasing_id()), "conversation-rows")


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, id, block, initial, fault) of numbered rows."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    plain = rows.select(
        "conv_id", "turn", "id", F.shiftright("id", BLOCK_BITS).alias("block"), F.substring("role", 1, 1).alias("initial"), last.alias("last"),
        F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256).alias("content"),
    )
    first = plain.where("last <> ''").groupBy("conv_id", "content").agg(F.min("id").alias("id")).select("id", F.lit(True).alias("is_first"))
    fault = (
        F.when(F.col("last") == "", BLANK).when(F.col("is_first").isNull(), DUPLICATE).when(~F.col("last").isin(".", "!", "?"), CUT).otherwise(SOUND)
    )
    return plain.join(first, "id", "left").select("conv_id", "turn", "id", "block", "initial", fault.cast("int").alias("fault"))


def totals(found: DataFrame) -> DataFrame:
    """Per conversation: rows, gaps and faults; turns are summed up first, so that a long
    conversation is many groups."""
    turns = found.groupBy("conv_id", "turn").agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col("fault") == f).alias(n) for f, n in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (CUT, "truncated"))]
    )
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
                                        *[F.sum(c).cast("long").alias(c) for c in ("rows", "blank", "duplicate", "truncated")])


_BLOCKS = ("conv_id bigint, block bigint, rows bigint, head string, tail string, illegal bigint, "
           "paths array<struct<a:int,b:int,cost:bigint,audit:string>>")
_LEGAL = {"su", "ua", "au"}


def _paths(table: Table) -> list[dict]:
    return [{"a": a, "b": b, "cost": c, "audit": s} for (a, b), (c, s) in sorted(table.items())]


def searched(found: DataFrame, per_conversation: DataFrame) -> DataFrame:
    """One row a block: its rows, outer initials, illegal neighbours and table of paths."""
    rows = F.sort_array(F.collect_list(F.struct("id", "initial", "fault"))).alias("members")
    blocks = found.groupBy("conv_id", "block").agg(rows)
    size = per_conversation.select(F.col("conv_id").alias("c"), F.col("rows").alias("size"))
    blocks = blocks.join(size, F.col("conv_id").eqNullSafe(F.col("c"))).select("conv_id", "block", "members", "size")

    def solve(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                members = [(m["initial"], m["fault"]) for m in r["members"]]
                illegal = sum(a[0] + b[0] not in _LEGAL for a, b in zip(members, members[1:]))
                out.append({"conv_id": r["conv_id"], "block": r["block"], "rows": len(members), "head": members[0][0], "tail": members[-1][0],
                            "illegal": illegal, "paths": _paths(block_table(members, len(members) == r["size"]))})
            yield _batch(out, _BLOCK_TYPE)

    return map_batches(blocks, solve, _BLOCKS)


_PATH_TYPE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_BLOCK_TYPE = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("rows", pa.int64()), ("head", pa.string()), ("tail", pa.string()),
                         ("illegal", pa.int64()), ("paths", _PATH_TYPE)])


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _merge(parts: list[dict]) -> dict:
    """Consecutive blocks of a conversation as one."""
    seams = sum(a["tail"] + b["head"] not in _LEGAL for a, b in zip(parts, parts[1:]))
    table = joined([{(p["a"], p["b"]): (p["cost"], p["audit"]) for p in part["paths"]} for part in parts])
    return {"rows": sum(p["rows"] for p in parts), "head": parts[0]["head"], "tail": parts[-1]["tail"],
            "illegal": seams + sum(p["illegal"] for p in parts), "paths": _paths(table)}


def merged(blocks: DataFrame, bits: int) -> DataFrame:
    """Blocks whose numbers agree but for the last ``bits`` bits, as one."""
    parts = F.sort_array(F.collect_list(F.struct("block", "rows", "head", "tail", "illegal", "paths"))).alias("parts")
    groups = blocks.groupBy("conv_id", F.shiftright("block", bits).alias("b")).agg(parts)

    def join(batches):
        for batch in batches:
            yield _batch([{"conv_id": r["conv_id"], "block": r["b"], **_merge(r["parts"])} for r in batch.to_pylist()], _BLOCK_TYPE)

    return map_batches(groups, join, _BLOCKS)


def solved(blocks: DataFrame) -> DataFrame:
    """(conv_id, illegal, cost, audit) of each conversation, joining its blocks level by level until
    each has one. ``blocks`` is a written table."""
    level = 0
    while level <= 64 and (blocks.groupBy("conv_id").count().where("count > 1").limit(1).count() > 0):
        blocks = written(merged(blocks, FAN_BITS), f"conversation-level-{level}")
        level += 1
    ends = F.filter("paths", lambda p: (p.a == 0) & p.b.isin(*ENDS))
    best = F.array_min(F.transform(ends, lambda p: F.struct(p.cost.alias("cost"), p.audit.alias("audit"))))
    return blocks.select("conv_id", "illegal", best.alias("best")).select("conv_id", "illegal", "best.cost", "best.audit")


_STEP = re.compile("I*[KRD]")
_EDIT_TYPE = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("steps", pa.string()), ("before", pa.int64()), ("odd", pa.int32())])


def dealt(answers: DataFrame, blocks: DataFrame) -> DataFrame:
    """(conv_id, block, steps, before, odd): each block's piece of its conversation's audit, the
    rows put out before it, and whether the repaired conversation starts with s (an odd number of
    rows). What is inserted behind the last row belongs to the last block."""
    order = F.sort_array(F.collect_list(F.struct("block", "rows"))).alias("blocks")
    whole = blocks.groupBy("conv_id").agg(order).withColumnRenamed("conv_id", "c")
    rows = answers.select("conv_id", "audit").join(whole, F.col("conv_id").eqNullSafe(F.col("c"))).select("conv_id", "audit", "blocks")

    def deal(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                audit, at, before = r["audit"], 0, 0
                odd = (len(audit) - audit.count("D")) % 2
                steps = _STEP.finditer(audit)
                for k, b in enumerate(r["blocks"]):
                    end = at
                    for _ in range(b["rows"]):
                        end = next(steps).end()
                    if k == len(r["blocks"]) - 1:
                        end = len(audit)
                    piece = audit[at:end]
                    out.append({"conv_id": r["conv_id"], "block": b["block"], "steps": piece, "before": before, "odd": odd})
                    before, at = before + len(piece) - piece.count("D"), end
                    if len(out) >= 4096:
                        yield _batch(out, _EDIT_TYPE)
                        out = []
            yield _batch(out, _EDIT_TYPE)

    return map_batches(rows, deal, "conv_id bigint, block bigint, steps string, before bigint, odd int")


def put_out(steps: str, before: int, odd: int, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The repaired (role, text) rows of a block."""
    out, used, at = [], 0, before

    def turn() -> str:
        return "user" if (at - odd) % 2 == 0 else "assistant"

    for letter in steps:
        if letter == "I":
            out.append((turn(), ""))
        else:
            role, text = rows[used]
            used += 1
            if letter == "D":
                continue
            out.append((role if letter == "K" else turn(), text))
        at += 1
    return out


def repaired(rows: DataFrame, edits_of: DataFrame) -> DataFrame:
    """(conv_id, block, roles array, texts array): the repaired conversations' rows, a block each."""
    members = F.sort_array(F.collect_list(F.struct("id", "role", "text"))).alias("members")
    blocks = rows.groupBy("conv_id", F.shiftright("id", BLOCK_BITS).alias("block")).agg(members)
    e = edits_of.withColumnsRenamed({"conv_id": "c", "block": "b"})
    both = blocks.join(e, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).select(
        "conv_id", "block", "members", "steps", "before", "odd")
    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])

    def apply(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                made = put_out(r["steps"], r["before"], r["odd"], [(m["role"], m["text"]) for m in r["members"]])
                out.append({"conv_id": r["conv_id"], "block": r["block"], "roles": [m[0] for m in made], "texts": [m[1] for m in made]})
            yield _batch(out, schema)

    return map_batches(both, apply, "conv_id bigint, block bigint, roles array<string>, texts array<string>")


def text_hashes(blocks: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the repaired rows as ``role:text``, joined by newlines: a
    conversation's blocks pass one task in order, none is held."""
    dealt_out = blocks.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "block")

    def digest(batches):
        at, state, first = None, None, True
        for batch in batches:
            ids, hashes = [], []
            for c, roles, texts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if state is None or c != at:
                    if state is not None:
                        ids.append(at)
                        hashes.append(state.hexdigest())
                    at, state, first = c, hashlib.sha256(), True
                for role, text in zip(roles, texts, strict=True):
                    state.update((("" if first else "\n") + role + ":" + text).encode())
                    first = False
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.string())], names=["conv_id", "repaired_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([state.hexdigest()])], names=["conv_id", "repaired_sha256"])

    return map_batches(dealt_out.select("conv_id", "roles", "texts"), digest, "conv_id bigint, repaired_sha256 string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of (conv_id, turn, role, text): per conversation (conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit), and the repaired rows by ``repaired``."""
    numbered = in_order(rows)
    found = written(faults(numbered), "conversation-faults")
    per_conversation = written(totals(found), "conversation-totals")
    blocks = written(searched(found, per_conversation), "conversation-blocks")
    answers = written(solved(blocks), "conversation-answers")
    a = answers.withColumnRenamed("conv_id", "c")
    report = per_conversation.join(a, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return report, repaired(numbered, dealt(answers, blocks))


def repair_report(conversations: DataFrame) -> DataFrame:
    """Damage, repair and report every conversation of ``conversations``."""
    report, rows = repair(damaged(conversations))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    r = report.withColumnRenamed("conv_id", "r")
    h = text_hashes(rows).withColumnRenamed("conv_id", "h")
    out = every.join(r, F.col("conv_id").eqNullSafe(F.col("r")), "left").join(h, F.col("conv_id").eqNullSafe(F.col("h")), "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
