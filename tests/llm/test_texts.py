"""Near duplicates, repeated passages and quality rules against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from tests.llm import cases
from turnmill.llm import jaccard, quality, repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_groups(docs):
    sets = {}
    for i, t in docs:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    both = Counter((a, b) for ids in holders.values() for k, a in enumerate(ids) for b in ids[k + 1:])
    for (a, b), n in both.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def groups(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()}


def test_near_duplicates_of_odd_texts(spark):
    df = cases.documents(spark)
    assert groups(df) == brute_groups(enumerate(cases.odd_texts()))


@pytest.mark.parametrize("share", [0.005, 0.02, 0.04])
def test_near_copies_around_the_threshold(spark, share):
    """A family of near copies, most of them too far from each other, and bystanders that
    share a passage with it."""
    base = cases.prose(150, 11)
    texts = [base, *[cases.edited(base, share, 100 + i) for i in range(60)]]
    texts += [cases.prose(100, 300 + i) + " " + " ".join(base.split()[:50]) for i in range(30)]
    assert groups(cases.documents(spark, texts)) == brute_groups(enumerate(texts))


def test_chunked_buckets_give_the_same_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 4)
    monkeypatch.setattr(jaccard, "HUB_ROUNDS", 1)
    base = cases.prose(150, 11)
    texts = [cases.edited(base, 0.03, 100 + i) for i in range(50)]
    assert groups(cases.documents(spark, texts)) == brute_groups(enumerate(texts))


def test_sizes_around_a_class_border(spark):
    """Sets of 120 to 140 shingles: links across the border of a size class."""
    base = cases.prose(144, 12).split()
    texts = [" ".join(base[k % 5: 124 + k]) for k in range(20)]
    assert groups(cases.documents(spark, texts)) == brute_groups(enumerate(texts))


def test_null_and_repeated_ids(spark):
    text = cases.prose(50, 1)
    df = spark.createDataFrame(
        [(None, text), (5, text), (3, text), (3, text), (4, cases.prose(50, 2)), (None, None)], "doc_id long, text string")
    got = sorted(jaccard.near_duplicates(df).select("doc_id", "component_id").collect(), key=str)
    assert [tuple(r) for r in got] == sorted(
        [(None, 3), (5, 3), (3, 3), (3, 3), (4, 4), (None, None)], key=lambda r: str(r).replace("(", "Row(doc_id=").replace(
            ", ", ", component_id="))
    kept = jaccard.keep_one(df)
    assert Counter((r.doc_id, r.text == text) for r in kept.collect())[3, True] == 1


def test_empty_tables(spark):
    none = cases.empty(spark)
    assert jaccard.near_duplicates(none).count() == 0
    assert jaccard.keep_one(none).columns == none.columns
    assert repeats.without_repeats(none).collect() == []
    assert quality.judged(none).count() == 0
    assert quality.keep_clean(none).columns == none.columns


def brute_repeats(docs):
    seen, out = set(), {}
    for i, t in sorted(docs):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 99):
            window = data[k:k + 100]
            if window in seen:
                gone[k:k + 100] = b"\1" * 100
            seen.add(window)
        spans = sum(1 for k in range(len(data)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def reported(df):
    rows = repeats._marked(df.select("doc_id", "text")).mapInArrow(
        lambda batches: repeats._cut(batches, repeats._report),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return {r[0]: tuple(r[1:]) for r in rows.collect()}


def test_repeats_of_odd_texts(spark):
    assert reported(cases.documents(spark)) == brute_repeats(enumerate(cases.odd_texts()))


def test_shifted_and_overlapping_passages(spark):
    """Passages of every length around the limit, in changing surroundings."""
    passage = cases.prose(40, 21)
    texts = [cases.prose(30, 400 + i) + passage[i % 7: 95 + i % 13] + cases.prose(20, 500 + i) for i in range(60)]
    texts += ["xyz" * 80, "zxy" * 50 + passage, "é" * 120, "aé" * 90 + "é" * 80]
    assert reported(cases.documents(spark, texts)) == brute_repeats(enumerate(texts))


def test_cut_texts_keep_columns_and_characters(spark):
    text = cases.prose(60, 31)
    df = cases.documents(spark, [text, "é" + text + "ü", None, text])
    got = {r.doc_id: r for r in repeats.without_repeats(df).collect()}
    assert got[0].text == text and got[1].text == "éü" and got[2].text is None and got[3].text == ""
    assert [got[i].n_chars for i in (0, 1, 3)] == [len(text), 2, 0]
    assert repeats.without_repeats(df).columns == df.columns


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    n = Counter(grams)
    repeated = {k + j for k, g in enumerate(grams) if n[g] > 1 for j in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))


def test_quality_counts_of_odd_texts(spark):
    got = {r.doc_id: tuple(r[1:6]) for r in quality.judged(cases.documents(spark)).collect()}
    assert got == {i: brute_counts(t) for i, t in enumerate(cases.odd_texts())}


def test_verdict_is_that_of_all_rules_in_any_order(spark):
    df = cases.documents(spark)
    kept = {r.doc_id for r in quality.keep_clean(df).collect()}
    assert kept == {r.doc_id for r in quality.judged(df, rules=quality.RULES[::-1]).where("kept").collect()}
    wanted = set()
    for i, t in enumerate(cases.odd_texts()):
        n, chars, symbols, lines, repeated = brute_counts(t)
        of = len([x for x in (t or "").split("\n") if WORD.search(x)])
        if (n >= 10 and 100 * repeated <= 20 * n and 100 * symbols <= 10 * n
                and not (lines >= 3 and 100 * lines > 30 * of) and 2 * n <= chars <= 20 * n):
            wanted.add(i)
    assert kept == wanted
    assert quality.keep_clean(df).columns == df.columns


def test_rules_run_by_rejection_per_cost(spark):
    a, b, c = (quality.Rule(n, None) for n in "abc")
    order = quality.ordered([{"rule": a, "cost": 4.0, "rejects": 0.4}, {"rule": b, "cost": 1.0, "rejects": 0.2},
                             {"rule": c, "cost": 0.1, "rejects": 0.0}])
    assert [r.name for r in order] == ["b", "a", "c"]


def test_rejected_texts_are_not_measured_again(spark):
    import pyarrow as pa
    seen = []

    def first(t):
        return t.n_words < 10

    def second(t):
        seen.append(t.rows)
        return t.n_words < 0

    part = pa.RecordBatch.from_pydict({"text": ["short"] * 9 + ["word " * 20]})
    kept = quality.survivors(part, [quality.Rule("first", first), quality.Rule("second", second)])
    assert kept.tolist() == [False] * 9 + [True] and seen == [1]
