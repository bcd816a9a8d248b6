"""SpotSigs fingerprints (op12) against a plain Python version."""

import hashlib

import pytest
import regex
import xxhash

from turnmill.llm import spotsigs

SF = "/root/testdata/sf0.01"
ANCHORS = set(spotsigs.ANCHORS.split())


def words(text):
    t = regex.sub(r"[^\p{L}\p{N}\x20\x09-\x0D]", "", (text or "").lower())
    return regex.split(r"[\x20\x09-\x0D]+", t.strip(" \t\n\x0b\x0c\r")) if t.strip(" \t\n\x0b\x0c\r") else []


def fp(text):
    w = words(text)
    sigs = set()
    for i, x in enumerate(w):
        if x in ANCHORS:
            chain = [y for y in w[i + 1:] if y not in ANCHORS][:2]
            if len(chain) == 2:
                sigs.add(":".join([x, *chain]))
    return sorted({f"{xxhash.xxh64_intdigest(s.encode(), seed=42) & 0xFFFFFFFF:08x}" for s in sigs})


def like(a, b):
    a, b = set(a), set(b)
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        t, nxt = text or "", rows[(i + 1) % len(rows)][1] or ""
        n, h = len(t), len(t) // 2
        edited = t[: n - h] + nxt[:h]
        f, e = fp(t), fp(edited)
        out.append((doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), " ".join(f), " ".join(e),
                    round(like(f, e), 12), round(like(f, fp(nxt)), 12)))
    return sorted(out, key=str)


COLS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def got(df):
    return sorted(((*r[:5], round(r[5], 12), round(r[6], 12)) for r in df.select(*COLS).collect()), key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = spotsigs.with_fingerprint(spotsigs.edited_against_next(df), "edited", "efp")
    F = spotsigs.F
    return got(out.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        spotsigs.text_of(F.col("fp")).alias("fingerprint"), spotsigs.text_of(F.col("efp")).alias("edited_fingerprint"),
        spotsigs.likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
        spotsigs.likeness(F.col("fp"), F.col("next_fp")).alias("near_next")))


def test_whole_table_equals_plain_version(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(spotsigs.op12_spotsigs(spark, SF)) == brute(rows)


@pytest.mark.parametrize("rows", [
    [(1, "the cat sat on the mat")],
    [(1, None), (2, ""), (3, "   "), (None, "the a an of")],
    [(5, "The Big, big dog; of THE yard and the end."), (5, "The Big, big dog; of THE yard and the end."), (4, "x")],
    [(i, "der Hund und die Katze " * (i + 1) + "é ü") for i in range(6)],
    [(i % 700, "the x%d y%d and z%d" % (i, i * 7, i % 5)) for i in range(900)],
    [(1, "the word " * 30000), (2, "a b c")],
])
def test_odd_rows_equal_plain_version(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_equal_texts_have_equal_fingerprints(spark):
    df = spark.createDataFrame([(1, "the red fox and the brown dog"), (2, "the red fox and the brown dog"), (3, None)],
                               "doc_id long, text string")
    fps = {r.doc_id: r.f for r in spotsigs.with_fingerprint(df, "text", "fp").select("doc_id", spotsigs.text_of(spotsigs.F.col("fp")).alias("f")).collect()}
    assert fps[1] == fps[2] != "" and fps[3] == ""


def test_empty_table_and_clashing_columns(spark):
    assert spotsigs.edited_against_next(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(1, "the a b c", 3, "z")], "doc_id long, text string, _t long, fp string")
    assert spotsigs.edited_against_next(df).count() == 1
