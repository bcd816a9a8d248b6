"""Merkle manifest (op11) against a plain Python tree."""

import hashlib
import zlib

import pytest

from turnmill.llm import merkle

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(d, n_chars):
    return H("".join(enc(x) for x in (d["doc_id"], d["source"], d["lang"], n_chars, d["text"])))


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        cur = levels[-1]
        levels.append([H("".join(cur[i:i + 2])) for i in range(0, len(cur), 2)])
    return levels


def path(levels, r):
    out = []
    for cur in levels[:-1]:
        start = r - r % 2
        sibs = [(j, cur[j]) for j in range(start, min(start + 2, len(cur))) if j != r]
        out.append((sibs[0][1] if sibs else None, r % 2 == 0))
        r //= 2
    return out


def fold(p, h):
    for sib, left in p:
        h = H(h) if sib is None else H(h + sib) if left else H(sib + h)
    return h


def brute(rows):
    groups = {}
    for d in rows:
        groups.setdefault(d["lang"], []).append(d)
    keys = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, subroots = {}, []
    for g in keys:
        items = sorted(groups[g], key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, leaf(d, d["n_chars"])))
        groups[g] = items
        trees[g] = tree([leaf(d, d["n_chars"]) for d in items])
        subroots.append(trees[g][-1][0])
    upper = tree(subroots)
    root = upper[-1][0]
    out = []
    for gi, g in enumerate(keys):
        top = path(upper, gi)
        for r, d in enumerate(groups[g]):
            p = path(trees[g], r) + top
            n = d["n_chars"]
            hit = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 7 == 0
            t = leaf(d, n + 1 if hit and n is not None else n)
            folded = fold(p, t)
            out.append((d["doc_id"], leaf(d, n), trees[g][-1][0], root,
                        H("".join(s for s, _ in p if s is not None)), folded, folded == root))
    return sorted(out, key=str)


COLS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def run(spark, rows):
    df = spark.createDataFrame([(d["doc_id"], d["text"], d["lang"], d["source"], d["n_chars"]) for d in rows], SCHEMA)
    got = merkle.manifest(df, "lang", merkle.tampered_leaf()).select(*COLS).collect()
    return sorted(map(tuple, got), key=str)


def test_whole_table_equals_plain_tree(spark):
    got = merkle.op11_merkle(spark, SF)
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, got.select(*COLS).collect()), key=str) == brute(rows)


def d(doc_id, text, lang="en", source="s", n_chars=None):
    return {"doc_id": doc_id, "text": text, "lang": lang, "source": source, "n_chars": n_chars}


@pytest.mark.parametrize("rows", [
    [d(1, "a")],
    [d(1, "a"), d(2, "b", lang="de")],
    [d(None, None, None, None, None), d(None, None, None, None, None), d(3, "", lang=None, n_chars=0)],
    [d(i % 3, "x" * (i % 4), lang=["en", "de", None, "é", "e"][i % 5], n_chars=i) for i in range(37)],
    [d(7, "same", n_chars=4)] * 5 + [d(7, "other", n_chars=5)],
    [d(i, "long " * 20000, n_chars=100000) for i in range(3)],
])
def test_odd_rows_equal_plain_tree(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(df, "lang", merkle.tampered_leaf()).count() == 0
    df = spark.createDataFrame([(1, "a", "en", "s", 1, "x", 2, "y")], SCHEMA + ", g string, lo long, leaf string")
    assert merkle.manifest(df, "lang", merkle.tampered_leaf()).select("verified").first()[0] is True
