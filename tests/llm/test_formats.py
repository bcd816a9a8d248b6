"""Pieces, archives, URL lists and neighbours."""

import datetime
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.llm import cases
from turnmill.llm import neighbours, pieces, urls, warc
from turnmill.llm.queries import REGISTRY

MODEL = pieces.read_model()


def as_unigram(data):
    """The same pieces as a unigram model: the model type in its settings changed."""
    from turnmill.llm.pieces import _fields

    at = data.index(dict(_fields(data))[2])
    settings = data[at:]
    place = settings.index(b"\x18\x02")
    return data[: at + place] + b"\x18\x01" + data[at + place + 2:]


def check(model, data, texts):
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    ids, counts = model.encode(texts)
    ends = np.append(0, np.cumsum(counts))
    wanted = library.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == wanted
    assert model.decode(ids, counts) == [library.decode(w) for w in wanted]


def random_texts(n, alphabet, seed):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 200))) for _ in range(n)]


def test_pieces_equal_the_library():
    model = pieces.Model(MODEL)
    check(model, MODEL, [t for t in cases.odd_texts() if t is not None])
    check(model, MODEL, random_texts(150, "ab eé\n日本語ther in on😀   .,", 1))
    check(model, MODEL, random_texts(60, "theinonerandabc", 2))  # no spaces: the moving window
    check(model, MODEL, [" " * n + "x" for n in range(70)])


def test_window_and_batch_search_agree(monkeypatch):
    model = pieces.Model(MODEL)
    texts = random_texts(40, "theinonerandabc  é", 3)
    first = model.encode(texts)
    monkeypatch.setattr(pieces, "SHORT", 0)
    second = pieces.Model(MODEL).encode(texts)
    assert first[0].tolist() == second[0].tolist() and first[1].tolist() == second[1].tolist()


def test_unigram_models_take_the_best_sum():
    """Against all segmentations of short words."""
    data = as_unigram(MODEL)
    model = pieces.Model(data)
    assert model.kind == 1
    for word in ("there", "another", "nation", "standing"):
        text = pieces.SPACE + word
        best = {0: 0.0}
        for end in range(1, len(text) + 1):
            best[end] = max(best[start] + (model.scores[model.known[text[start:end]]] if text[start:end] in model.known
                                           else model.worst if end - start == 1 else -1e30)
                            for start in range(end))
        ids, _ = model.encode([word])
        assert sum(model.scores[i] for i in ids) == pytest.approx(best[len(text)])
        assert model.decode(ids, np.array([len(ids)])) == [word]


def test_pieces_of_tables(spark):
    df = cases.documents(spark).withColumn("ids", F.lit("clash"))
    rows = pieces.decoded(pieces.encoded(df)).collect()
    for r in rows:
        if r.text is None:
            assert r.ids is None and r.n_tokens is None and r.decoded is None
        else:
            assert r.decoded == r.text.replace(pieces.SPACE, " ") and r.n_tokens == len(r.ids) and r.extra == "x"
    assert len(rows) == len(cases.odd_texts())
    assert pieces.encoded(cases.empty(spark)).count() == 0


def test_models_that_change_texts_are_refused():
    with pytest.raises(ValueError):
        pieces.Model(b"\x12\x02\x18\x01\x1a\x02\x20\x01")


PAGES = [(i, f"http://h/{i}", ("payload %d " % (i % 4)) * (20 if i % 4 else 2)) for i in range(40)]
PAGES += [(100, None, None), (101, "", ""), (102, "u\r\nv", "é😀" * 4000), (None, "n", "payload 1 " * 20),
          (103, "b", "WARC/1.1\r\n\r\n" * 30), (3, "again", "payload 3 " * 20)]


@pytest.fixture(scope="module")
def archives(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "a")
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("kind", F.lit("clash"))
    warc.write_archives(pages.repartition(3), path)
    return path


def test_archives_round_trip(spark, archives):
    rows = warc.read_archives(spark, archives).collect()
    assert {r.kind for r in rows} == {"record"} and len(rows) == len(PAGES)
    first = {}
    for i, _, h in PAGES:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    want = sorted((str(i), "revisit" if h in first and i is not None and i > first[h] else "response",
                   hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in PAGES)
    assert sorted((str(r.page_id), r.record_type, r.payload_digest) for r in rows) == want
    for r in rows:
        if r.record_type == "response":
            assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest
        else:
            assert r.payload is None and r.refers_to is not None


def test_salvage_after_damage(spark, archives, tmp_path):
    """Flipped, cut and inserted bytes: other records survive, gaps and records cover all."""
    data = b"".join(warc.member(warc.record(i, f"http://x/{i}", (f"p{i} " * (i * 7)).encode(), "0")) for i in range(40))
    r = random.Random(3)
    for _ in range(60):
        damaged = bytearray(data)
        for _ in range(2):
            at = r.randrange(len(damaged))
            kind = r.choice("fci")
            if kind == "f":
                damaged[at] ^= r.randint(1, 255)
            elif kind == "c":
                del damaged[at: at + r.randint(1, 300)]
            else:
                damaged[at:at] = bytes(r.randrange(256) for _ in range(20))
        out = list(warc.salvaged(bytes(damaged)))
        assert sum(x[0] == "record" for x in out) >= 40 - 10
        assert [x[1] for x in out] == [0, *[x[2] for x in out[:-1]]] and out[-1][2] == len(damaged)


def test_salvage_inside_a_member():
    """Of a member with many records, those around a damaged one, before a cut and before a
    wrong checksum are kept."""
    r = random.Random(4)
    rows = [warc.record(i, "u", r.randbytes(200 + i).hex().encode(), "0") for i in range(50)]
    ids = lambda out: [x[3]["warc-record-id"] for x in out if x[0] == "record"]
    want = [f"<urn:page:{i}>" for i in range(50)]
    broken = rows[20].replace(b"HTTP/1.1 200", b"HTTP/1.1 404")
    whole = warc.member(b"".join([*rows[:20], broken, *rows[21:]]))
    out = list(warc.salvaged(whole))
    begin = sum(map(len, rows[:20]))
    assert ids(out) == want[:20] + want[21:]
    assert [x[3] for x in out if x[0] == "gap"] == [f"wrong digest, bytes {begin} to {begin + len(broken)} of the member"]
    good = warc.member(b"".join(rows), 6)
    after = warc.member(warc.record(77, "u", b"x", "0"))
    out = list(warc.salvaged(good[: len(good) // 2]))
    assert 20 <= len(ids(out)) < 30 and ids(out) == want[: len(ids(out))] and any(x[0] == "gap" for x in out)
    flipped = bytearray(warc.zlib.compress(b"".join(rows), wbits=31))
    flipped[-6] ^= 1
    out = list(warc.salvaged(bytes(flipped) + after))
    assert ids(out) == [*want, "<urn:page:77>"] and any(x[0] == "gap" for x in out)
    stored = warc.member(b"".join(rows), 0)
    out = list(warc.salvaged(stored[: len(stored) * 3 // 4] + after))
    assert len(set(ids(out))) == len(ids(out)) > 30 and ids(out)[-1] == "<urn:page:77>"


def test_plain_records_and_gaps(spark, tmp_path):
    records = [warc.record(i, "u", b"payload", hashlib.sha256(b"payload").hexdigest()) for i in range(4)]
    broken = records[1].replace(b"payload", b"PAYLOAD")
    (tmp_path / "a.warc").write_bytes(records[0] + broken + b"noise" + records[2] + warc.member(records[3]) + records[0][:50])
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert [r.page_id for r in rows if r.kind == "record"] == [0, 2, 3]
    gaps = [(r.offset, r.length, r.reason) for r in rows if r.kind == "gap"]
    assert gaps[0] == (len(records[0]), len(broken) + 5, "wrong digest") and len(gaps) == 2


def test_large_members_end_in_zero():
    assert warc.member(b"x" * (17 << 20))[-1] == 0


def test_empty_archive(spark, tmp_path):
    path = str(tmp_path / "e")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.with_first(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(n)


ENTRIES = [
    ("l", "host", "a.b.com", "add", day(10)), ("l", "host", "a.b.com", "remove", day(20)),
    ("l", "host", "a.b.com", "add", day(30)), ("l", "host", "a.b.com", "add", day(30)),
    ("m", "domain", "b.com", "add", day(15)), ("m", "domain", "b.com", "remove", day(15)),
    ("m", "domain", "b.com", "add", day(40)), ("s", "url", "a.b.com/x?q=1", "add", day(5)),
    (None, "host", "a.b.com", "add", day(1)), ("l", "host", None, "add", day(1)), ("l", "host", "z", "add", None),
]
CAPTURES = [
    (1, "http://a.b.com/", day(10)), (2, "http://a.b.com/", day(19)), (3, "http://a.b.com/", day(20)),
    (4, "https://user@A.B.com:80/x?q=1#f", day(5)), (5, "http://c.b.com", day(15)), (6, "http://b.com", day(40)),
    (7, "http://xb.com", day(50)), (8, None, day(10)), (9, "", day(10)), (10, "no address", day(10)),
    (11, "http://a.b.com/", None), (1, "http://a.b.com/", day(10)), (12, "http://a.b.com/x?q=1/", day(4)),
]


def test_lists_as_of_the_day(spark):
    captures = spark.createDataFrame(CAPTURES, "page_id long, url string, day date").withColumn("lists", F.lit("clash"))
    entries = spark.createDataFrame(ENTRIES, "list string, kind string, pattern string, action string, day date")
    rows = urls.judged(captures, entries).collect()
    assert len(rows) == len(CAPTURES)
    got = {r.page_id: tuple(r.lists) for r in rows}
    assert got == {1: ("l",), 2: ("l",), 3: (), 4: ("s",), 5: (), 6: ("m",), 7: (), 8: (), 9: (), 10: (), 11: (), 12: ()}
    assert all(r.blocked == bool(r.lists) for r in rows)
    assert not any(r.blocked for r in urls.judged(captures, entries.where("false")).collect())
    assert urls.judged(captures.where("false"), entries).count() == 0


def test_url_plan_has_no_python(spark):
    plan = REGISTRY["op3_urls"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_nearest(rows, queries, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in good:
        if q in queries:
            near = sorted({(-round(float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), 12), i) for i, w in good if i != q})
            out[q] = [i for _, i in near[:k]]
    return out


def found(df, is_query, **more):
    out = {}
    for r in sorted(neighbours.nearest(df, is_query, **more).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


def test_nearest_of_small_tables(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.normal(size=8).round(2).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0] * 8) for i in range(30)]  # copies: more than a result holds
    rows += [(200, None), (201, [0.0] * 8), (202, [None] * 8), (203, [float("nan")] * 8), (204, [float("inf")] + [1.0] * 7),
             (205, [1.0]), (206, []), (None, [2.0] * 8), (10, rows[10][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("key", F.lit("clash"))
    usable = [(i, v) for i, v in rows if v is None or len(v) == 8]
    queries = {i for i in range(0, 300, 5)}
    assert found(df, F.col("vec_id") % 5 == 0) == brute_nearest(usable, queries, 5)
    assert found(df, F.col("vec_id") % 5 == 0, k=2, shard_points=40) == brute_nearest(usable, queries, 2)


def test_fewer_candidates_than_wanted(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert found(df, F.col("vec_id") == 0) == {0: [1]}
    assert neighbours.nearest(df.where("false"), F.col("vec_id") == 0).count() == 0


def test_recall_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = found(df, F.col("vec_id") % 50 == 0, shard_points=1024)
    want = brute_nearest(rows, {i for i, _ in rows if i % 50 == 0}, 5)
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert set(got) == set(want) and hits >= 0.95 * sum(map(len, want.values()))


def test_queries_are_not_shuffled_once_per_shard(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 8)
    monkeypatch.setattr(neighbours, "RUN_BLOCKS", 2, raising=False)
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=8).astype(np.float32).tolist()) for i in range(400)]
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
        near = neighbours.nearest(df, F.col("vec_id") % 5 == 0, shard_points=40)
        plan = near._jdf.queryExecution().executedPlan().toString()
        assert "explode" not in plan and "SortMergeJoin" not in plan
        assert ("vectors:array<float>" in plan) == (kind == "float")
        got = {}
        for x in sorted(near.collect(), key=lambda x: (x.query_id, x.rank)):
            got.setdefault(x.query_id, []).append(x.vec_id)
        assert got == brute_nearest(rows, {i for i in range(0, 400, 5)}, 5)


def test_revisits_of_a_repeated_page_id(spark):
    x, y = "<p>" + "x" * 200 + "</p>", "<p>" + "y" * 300 + "</p>"
    pages = spark.createDataFrame([(5, "u", x), (5, "u", y), (9, "u", x), (7, "u", y), (3, "u", "small"), (4, "u", "small")],
                                  "page_id long, url string, html string")
    got = sorted(tuple(r) for r in warc.archived(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    h = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == sorted([
        (5, len(x), h(x), "response", None), (5, len(y), h(y), "response", None),
        (9, len(x), h(x), "revisit", 5), (7, len(y), h(y), "revisit", 5),
        (3, 5, h("small"), "response", None), (4, 5, h("small"), "response", None)])
