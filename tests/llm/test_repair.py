"""Conversation repair (op13) against exhaustive search and a plain damage step."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from turnmill.llm import repair

SF = "/root/testdata/sf0.01"
GRAMMAR = re.compile(r"(s?(ua)+)?")
GAPS = ["", "u", "a", "uu", "ua", "au", "aa"]


def exhaustive(rows):
    """Every edit sequence: inserts before each row and after the last, and per row D, K or R."""
    kinds = repair.faults(rows)
    best = None
    for gaps in itertools.product(GAPS, repeat=len(rows) + 1):
        for acts in itertools.product(["D", "K", "Ru", "Ra"], repeat=len(rows)):
            cost, audit, out = 0, "", []
            ok = True
            for i, (role, text) in enumerate(rows):
                for g in gaps[i]:
                    cost, audit = cost + 3, audit + "I"
                    out.append((g, ""))
                act = acts[i]
                if act != "D" and kinds[i] in ("blank", "duplicate"):
                    ok = False
                    break
                if act == "D":
                    cost, audit = cost + 4, audit + "D"
                    continue
                extra = 3 if kinds[i] == "truncated" else 0
                if act == "K":
                    cost, audit = cost + extra, audit + "K"
                    out.append((role[:1], role + ":" + text))
                else:
                    cost, audit = cost + 3 + extra, audit + "R"
                    out.append((act[1], text))
            if not ok:
                continue
            for g in gaps[-1]:
                cost, audit = cost + 3, audit + "I"
                out.append((g, ""))
            if not GRAMMAR.fullmatch("".join(r for r, _ in out)):
                continue
            if best is None or (cost, audit) < best[:2]:
                best = (cost, audit)
    return best


ROLES = ["system", "user", "assistant", " ", "tool"]
TEXTS = ["Hi.", "hi", "", "  ", "What?", "ok!"]


@pytest.mark.parametrize("seed", range(40))
def test_dp_equals_exhaustive_search(seed):
    rng = random.Random(seed)
    rows = [(rng.choice(ROLES), rng.choice(TEXTS)) for _ in range(rng.randint(0, 3))]
    kinds = repair.faults(rows)
    got = repair.cheapest([r[:1] for r, _ in rows], kinds)
    assert got == exhaustive(rows)


def damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub(r"[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        out += [(conv_id, turn, role, text)] * (2 if hit == 3 else 1)
    return out


def plain(rows):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], [])
    for r in damage(rows):
        convs[r[0]].append(r)
    out = []
    for conv_id, items in convs.items():
        items.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        pairs = [(r[2], r[3]) for r in items]
        kinds = repair.faults(pairs)
        turns = {r[1] for r in items if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        ini = [p[:1] for p, _ in pairs]
        illegal = sum(a + b not in repair.LEGAL for a, b in zip(ini, ini[1:]))
        cost, audit = repair.cheapest(ini, kinds) if pairs else (0, "")
        digest = hashlib.sha256("\n".join(repair.repaired(pairs, audit)).encode()).hexdigest()
        out.append((conv_id, gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
                    illegal, cost, audit, digest))
    return sorted(out, key=str)


COLS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_whole_table_equals_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, repair.op13_repair(spark, SF).select(*COLS).collect()), key=str)
    assert got == plain(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hello."), (1, None, "assistant", "x"), (1, 3, "system", "a.")]
    rows += [(2, t, "user", "same.") for t in range(6)] + [(3, 0, "user", "long " * 30000 + ".")]
    rows += [(i, 0, "user", "gone.") for i in range(10, 60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, repair.repaired_conversations(df).select(*COLS).collect()), key=str)
    assert got == plain(rows)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repaired_conversations(df).count() == 0
    df = spark.createDataFrame([(1, 0, "user", "Hi.", 5, "x")], "conv_id long, turn long, role string, text string, _hit long, audit string")
    assert repair.repaired_conversations(df).count() == 1


def test_conversations_across_small_batches(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(None, 3, "user", "Hi."), (None, 1, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "3")
    try:
        got = sorted(map(tuple, repair.repaired_conversations(df).select(*COLS).collect()), key=str)
    finally:
        spark.conf.set(setting, before)
    assert got == plain(rows)
