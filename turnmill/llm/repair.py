"""Repair of conversation structure by one integer-minimum DP over a DAG of edits.

A conversation should read ``(s?(ua)+)?`` in role initials: an optional system turn, then
user and assistant in turns, ending with the assistant. Rows may be kept (K, cost 0),
given another role, user or assistant (R, 3), deleted (D, 4; required for blank and repeated
rows), and empty user or assistant rows may be inserted anywhere (I, 3); a truncated row that
stays costs 3 more.

Every path through the DAG of (row, grammar state, inserts before the row) carries one
integer weight: the cost in its high digits, and the edit letters in fixed-width positional
low digits, a block of three per row (inserts before it, then its own letter) and one after
the last row, padded with zeros at the block's end. Letters are coded in ASCII order
(D < I < K < R), and with blocks of equal width, comparing two weights compares cost first
and then the audit strings letter by letter, a shorter one first. So the plain integer
minimum is the cheapest repair with the ASCII-least audit, and both are read back from its
digits. Two inserts before a row are enough: a third would undo one of them.

The rows are damaged first, for the tests of the contract, by crc32 of ``conv_id:turn``
modulo 20 (nulls written as one space): 0 drops the row, 1 empties its text, 2 removes its
``.!?``, 3 repeats it (same turn), 4 makes it a user row. Null role and text are one space.

Damage, the turn gaps and the list of conversations are DataFrame work; rows are dealt by
``conv_id`` and sorted within tasks, and ``mapInArrow`` solves the conversations of a batch in
one call, carrying an unfinished last one into the next batch. A conversation is a sequence whose SHA-256 and DP are sequential,
so one very long conversation is one task's work.

Edge cases: rows of a conversation are ordered by turn (nulls first), role and text, so
equal rows are interchangeable; a conversation whose rows are all dropped gives zeros, an
empty audit and the hash of the empty string; a null ``conv_id`` is a conversation of its
own; roles other than system, user and assistant are never kept; extra columns are not
read.
"""

from __future__ import annotations

import hashlib
import re
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

# Fixed values of the contract: edit costs, codes of audit letters, legal role pairs.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
CODE = {"D": 1, "I": 2, "K": 3, "R": 4}
LEGAL = {"su", "ua", "au"}
BLOCK, BITS = 3, 3  # letters per row block; bits per letter digit

_LETTER = {v: k for k, v in CODE.items()}
_SPACE = re.compile(r"[^\x20\x09-\x0D]")
_END = re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")
START, SYS, USER, ASSISTANT = 0, 1, 2, 3


def faults(rows: list[tuple[str, str]]) -> list[str]:
    """First fault of each (role, text): blank, duplicate, truncated or ''."""
    seen, out = set(), []
    for role, text in rows:
        if not _SPACE.search(text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            end = _END.search(text)
            out.append("truncated" if end.group(1) not in ".!?" else "")
        seen.add((role, text))
    return out


def _slot(state: int) -> tuple[str, int]:
    """Role an inserted or re-roled row takes in ``state``, and the state after it."""
    return ("a", ASSISTANT) if state == USER else ("u", USER)


def _keep(state: int, initial: str) -> int | None:
    if initial == "s" and state == START:
        return SYS
    if initial == "u" and state != USER:
        return USER
    if initial == "a" and state == USER:
        return ASSISTANT
    return None


def cheapest(initials: list[str], kinds: list[str]) -> tuple[int, str]:
    """Cost and ASCII-least audit of the cheapest repair, by integer-minimum DP."""
    n = len(initials)
    width = BLOCK * (n + 1)
    top = BITS * width

    def letter(code: str, block: int, j: int) -> int:
        return CODE[code] << (BITS * (width - 1 - (BLOCK * block + j)))

    def relax(table, key, w):
        if key not in table or w < table[key]:
            table[key] = w

    here = {(START, 0): 0}
    for i in range(n + 1):
        # Inserts before row i (or after the last row): at most two, j counts them.
        for j in range(BLOCK - 1):
            for (state, used), w in list(here.items()):
                if used == j:
                    _, after = _slot(state)
                    relax(here, (after, j + 1), w + (INSERT << top) + letter("I", i, j))
        if i == n:
            break
        nxt: dict = {}
        extra = TRUNCATED if kinds[i] == "truncated" else 0
        for (state, j), w in here.items():
            relax(nxt, (state, 0), w + (DELETE << top) + letter("D", i, j))
            if kinds[i] in ("blank", "duplicate"):
                continue
            kept = _keep(state, initials[i])
            if kept is not None:
                relax(nxt, (kept, 0), w + ((KEEP + extra) << top) + letter("K", i, j))
            _, after = _slot(state)
            relax(nxt, (after, 0), w + ((REROLE + extra) << top) + letter("R", i, j))
        here = nxt
    best = min(w for (state, _), w in here.items() if state in (START, ASSISTANT))
    digits = best & ((1 << top) - 1)
    audit = []
    for b in range(width):
        code = (digits >> (BITS * (width - 1 - b))) & ((1 << BITS) - 1)
        if code:
            audit.append(_LETTER[code])
    return best >> top, "".join(audit)


def repaired(rows: list[tuple[str, str]], audit: str) -> list[str]:
    """``role:text`` lines after the edits of ``audit``."""
    lines, state, i = [], START, 0
    for code in audit:
        if code == "D":
            i += 1
            continue
        if code == "K":
            role, text = rows[i]
            state = _keep(state, role[:1])
            i += 1
        else:
            initial, state = _slot(state)
            role = "user" if initial == "u" else "assistant"
            text = "" if code == "I" else rows[i][1]
            i += code == "R"
        lines.append(f"{role}:{text}")
    return lines


def _solved(conv_id, turns: list, roles: list, texts: list) -> tuple:
    """The output row of one conversation's rows after damage."""
    order = sorted(range(len(roles)), key=lambda i: (turns[i] is not None, turns[i] or 0, roles[i], texts[i]))
    rows = [(roles[i], texts[i]) for i in order]
    kinds = faults(rows)
    initials = [r[:1] for r, _ in rows]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    cost, audit = cheapest(initials, kinds)
    digest = hashlib.sha256("\n".join(repaired(rows, audit)).encode()).hexdigest()
    return (conv_id, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit, digest)


_OUT = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
                  ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _conversations(table: pa.Table) -> list[tuple]:
    """Output rows of the whole conversations of ``table``, whose rows of one conv_id are
    adjacent."""
    ids, null = table.column("conv_id"), table.column("conv_id").is_null().to_numpy(zero_copy_only=False)
    key = pc.fill_null(ids, 0).to_numpy()
    cut = np.flatnonzero((key[1:] != key[:-1]) | (null[1:] != null[:-1])) + 1
    turns, roles, texts = (table.column(c).to_pylist() for c in ("turn", "role", "text"))
    out = []
    for a, b in zip([0, *cut], [*cut, table.num_rows]):
        out.append(_solved(None if null[a] else int(key[a]), turns[a:b], roles[a:b], texts[a:b]))
    return out


def _repair_batches(batches):
    """All conversations of a task's rows, sorted by conv_id: those a batch ends are solved
    with it; the last one of a batch may go on and waits for the next."""
    carry = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if carry is not None:
            table = pa.concat_tables([carry, table])
        if table.num_rows == 0:
            carry = table
            continue
        ids, null = table.column("conv_id"), table.column("conv_id").is_null().to_numpy(zero_copy_only=False)
        key = pc.fill_null(ids, 0).to_numpy()
        last = table.num_rows - 1
        same = (key == key[last]) & (null == null[last])
        start = int(np.flatnonzero(~same).max(initial=-1)) + 1  # rows of one conv_id are adjacent
        carry = table.slice(start)
        if start:
            rows = _conversations(table.slice(0, start))
            yield pa.RecordBatch.from_pylist([dict(zip(_OUT.names, r)) for r in rows], schema=_OUT)
    if carry is not None and carry.num_rows:
        rows = _conversations(carry)
        yield pa.RecordBatch.from_pylist([dict(zip(_OUT.names, r)) for r in rows], schema=_OUT)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the contract's damage: conv_id, turn, role, text."""
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    hit = F.crc32(key) % 20
    rows = conversations.select(
        "conv_id", "turn", hit.alias("_hit"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
    ).where(F.col("_hit") != 0)
    text = F.when(F.col("_hit") == 1, F.lit("")).when(F.col("_hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_hit") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("_hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def repairs(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text; no nulls in role and text):
    faults, illegal pairs, gaps, cost, audit and the hash of the repaired conversation."""
    gaps = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps")
    )
    # Rows of a conversation meet in one task, sorted so that they are adjacent; each Arrow
    # batch is solved in one call, not one pandas frame per conversation.
    fixed = (
        rows.select("conv_id", "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first())
        .mapInArrow(_repair_batches, SCHEMA)
    )
    return fixed.alias("f").join(gaps.alias("g"), F.col("f.conv_id").eqNullSafe(F.col("g.conv_id"))).select("f.*", "g.gaps")


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation of the input, damaged and repaired."""
    ids = conversations.select("conv_id").distinct().alias("i")
    done = repairs(damaged(conversations)).alias("r")
    empty = hashlib.sha256(b"").hexdigest()
    out = ids.join(done, F.col("i.conv_id").eqNullSafe(F.col("r.conv_id")), "left")
    zero = lambda c: F.coalesce(F.col(f"r.{c}"), F.lit(0)).cast("long").alias(c)
    return out.select(
        F.col("i.conv_id").alias("conv_id"),
        *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce(F.col("r.audit"), F.lit("")).alias("audit"),
        F.coalesce(F.col("r.repaired_sha256"), F.lit(empty)).alias("repaired_sha256"),
    )


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by the contract's rule and repaired."""
    return repaired_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
