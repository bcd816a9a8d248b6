"""Language model, toxicity, mixing: exact parts by brute force, learnt parts on held-out
rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from turnmill.llm import kernels, lm, mixing, toxicity

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def lm_rows(spark):
    df = cases.documents(spark, cases.odd_texts() + [cases.prose(200, i) for i in range(30)])
    return df, {r.doc_id: r for r in lm.scored(df, F.col("doc_id") % 3 == 1, listed=50, steps=50).collect()}


def test_lm_base_counts_and_scores(lm_rows):
    df, got = lm_rows
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {r.doc_id: WORD.findall((r.text or "").translate(lower)) + [None] for r in df.collect()}
    counts = Counter(w for i, t in tokens.items() if i % 3 != 1 for w in t)
    n, v = sum(counts.values()), len(counts)
    assert set(got) == set(tokens)
    for i, t in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            i % 3 == 1, len(t), sum(counts[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
        assert r.score < 0


def test_lm_beats_the_base_on_held_out_texts(spark):
    row = lm.op9_lm(spark, SF).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert row.s > row.b


def test_lm_edge_tables(spark):
    held = F.lit(False)
    assert lm.scored(cases.empty(spark), held, steps=5).count() == 0
    nothing_learnt = lm.scored(cases.documents(spark, ["a b", None]), F.lit(True), steps=5).collect()
    assert [(r.n_known, r.train_tokens) for r in nothing_learnt] == [(0, 0), (0, 0)]
    twice = spark.createDataFrame([(1, "x y z"), (1, "x y z"), (1, "x q"), (None, "x y z")], "doc_id long, text string")
    rows = lm.scored(twice, F.col("doc_id") < 0, listed=1, steps=5).collect()
    same = [r for r in rows if r.n_tokens == 4]
    assert len(rows) == 4 and len({(r.n_known, round(r.score, 9)) for r in same}) == 1


def test_lm_own_words_grow_and_see_their_context():
    """Words beyond the symbols have vectors and a place in a normalised tree, and learn what
    they follow."""
    import pyarrow as pa

    r = random.Random(2)
    heads, tails = [f"h{i:03d}ead" for i in range(120)], [f"t{i:03d}ail" for i in range(120)]
    lines = [" ".join(x for _ in range(30) for i in [r.randrange(120)] for x in (heads[i], tails[i])) for _ in range(300)]
    t = kernels.Texts(*kernels.unpack(pa.array(lines)), lower=True)
    k, first, c = np.unique(t.word_hash, return_index=True, return_counts=True)
    order = np.argsort(-c, kind="stable")
    words = lm.Words(k[order], c[order], lm.forms(t)[first][order], 5)
    assert words.units == 240
    start = np.random.default_rng(1).normal(0, 0.1, (2, words.end + 1, 24))
    outputs = np.random.default_rng(2).normal(0, 0.1, (lm.SYMBOLS, 25))
    nodes = np.zeros((words.base[-1], 25))
    nodes[:, -1] = words.trees(np.ones(lm.FORMS))
    model = lm.Model(words, *start, outputs, nodes)
    tokens = words.tokens(t)[1:5]
    learner = lm.Learner(model, np.full(lm.SYMBOLS, 1 / lm.SYMBOLS), 1)
    for _ in range(30):
        learner.learn(*tokens)
    # Of all places in all classes, after one context: sums to one.
    symbol = np.concatenate([np.arange(1 + lm.OWN), *[
        np.full(1 << words.depth[f], 1 + lm.OWN + f) for f in range(lm.FORMS)]])
    leaf = np.concatenate([np.zeros(1 + lm.OWN, int), *[np.arange(1 << d) for d in words.depth]])
    for a, b in ((0, 1), (words.end, 200), (words.units, 7)):
        p = 10 ** learner.own.log10(np.full(len(leaf), a), np.full(len(leaf), b), symbol, leaf)
        assert p.sum() == pytest.approx(1, abs=1e-4)
    tail = tokens[3] > 0
    gain = (learner.own.log10(*tokens) - model.log10(*tokens))[tail].mean()
    assert tail.sum() > 5000 and gain > 0.1


def test_lm_vocabulary_is_not_of_fixed_size(spark, monkeypatch):
    sizes = []
    inner = lm.train_words
    monkeypatch.setattr(lm, "train_words", lambda learn, model, *a: sizes.append(model.words.units) or inner(learn, model, *a))
    for n in (200, 400):
        df = cases.documents(spark, [" ".join(f"w{i}" for i in range(n))] * 6)
        lm.scored(df, F.lit(False), listed=1, least=5, steps=5).count()
    assert sizes == [200, 400]


def test_lm_changes_weigh_no_more_than_the_texts():
    """All learners together send as many bytes as there are of text, at most by a small share more."""
    k = np.arange(1, 3001, dtype=np.uint64)
    words = lm.Words(k, np.full(3000, 50), (k % 16).astype(np.int8), 20)
    model = lm.Model(words, *np.zeros((2, words.end + 1, 24)), np.zeros((lm.SYMBOLS, 25)), np.zeros((words.base[-1], 25)))
    learner = lm.Learner(model, np.full(lm.SYMBOLS, 1 / lm.SYMBOLS), 1)
    for met in learner.met:
        met[:] = 1
    sent = sum(batch.nbytes for batch in learner.changes())
    assert sent < 1.2 * sum(p.nbytes for p in model.parts)
    for text_bytes in (0, 10 ** 6, 10 ** 9):
        assert (lm.learners(model, text_bytes) - 1) * sent <= 1.2 * text_bytes


def plain_way(words, symbol, leaf):
    """(node, way) from the root to a leaf of a symbol's tree."""
    form = symbol - 1 - lm.OWN
    depth = words.depth[form] if form >= 0 else 0
    return [(words.base[form] + (1 << level) - 1 + (leaf >> (depth - level)), leaf >> (depth - level - 1) & 1)
            for level in range(depth)]


def test_lm_steps_and_scores_against_plain_loops():
    """Nodes of heads, nodes below them, symbols and units move as token by token; so do scores add up."""
    r = np.random.default_rng(3)
    k = np.arange(1, 3001, dtype=np.uint64)
    words = lm.Words(k, np.sort(r.integers(20, 10 ** 5, 3000))[::-1], (k % 16).astype(np.int8), 20)
    assert all(0 < len(head[0]) < (1 << d) - 1 for head, d in zip(words.heads, words.depth))
    model = lm.Model(words, *r.normal(0, 0.5, (2, words.end + 1, 24)), r.normal(0, 0.5, (lm.SYMBOLS, 25)),
                     r.normal(0, 0.5, (words.base[-1], 25)))
    n = 700
    at = np.where(r.random(n) < 0.3, 0, r.integers(0, 3000, n))
    at[:40] = 2999  # one rare word in a long run
    symbol, leaf = words.symbol[at], words.leaf[at]
    leaf[40:60] = 0
    a, b = r.integers(0, words.end + 1, n), r.integers(0, 50, n)
    noise = np.full(lm.SYMBOLS, 1 / lm.SYMBOLS)
    learner = lm.Learner(model, noise, 5)
    learner.learn(a, b, symbol, leaf)
    fake = np.searchsorted(np.cumsum(noise), np.random.default_rng(5).random(lm.NOISE)).clip(max=lm.SYMBOLS - 1)

    first, second, outputs, nodes = parts = [p.astype(np.float64) for p in model.parts]
    grads, met = [np.zeros_like(p) for p in parts], [np.zeros(len(p), int) for p in parts]
    met[2] += np.bincount(fake, minlength=lm.SYMBOLS)
    sure, shift, wanted = lambda z: 1 / (1 + np.exp(-z)), np.log(lm.NOISE / lm.SYMBOLS), []
    for x, y, s, l in zip(a, b, symbol, leaf):
        context, back = np.append(first[x] + second[y], 1), np.zeros(25)
        every = outputs @ context
        log = every[s] - np.log(np.exp(every).sum())
        decisions = [(2, i, every[i] - shift, int(j == 0)) for j, i in enumerate([s, *fake])]
        decisions += [(3, i, nodes[i] @ context, way) for i, way in plain_way(words, s, l)]
        for part, i, z, wish in decisions:
            grads[part][i] += (sure(z) - wish) * context
            back += (sure(z) - wish) * parts[part][i]
            if part == 3:
                log += np.log(sure(z) if wish else 1 - sure(z))
                met[3][i] += 1
        met[0][x], met[1][y], met[2][s] = met[0][x] + 1, met[1][y] + 1, met[2][s] + 1
        grads[0][x] += back[:-1]
        grads[1][y] += back[:-1]
        wanted.append(log / np.log(10))
    assert model.log10(a, b, symbol, leaf) == pytest.approx(np.array(wanted), rel=1e-5, abs=1e-5)
    for own, p, g, m, learnt in zip(learner.own.parts, parts, grads, met, learner.met):
        assert np.allclose(own, p - lm.PACE * g / np.sqrt(1 + g * g), atol=2e-5)
        assert (learnt == m).all()


def test_lm_counts_are_summed_in_the_task():
    """A word, or a triple, of many batches of a task leaves the task once."""
    import pyarrow as pa

    texts = ["one two Two three", None, "", "three four one"]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])] * 5
    counts = pa.Table.from_batches(lm._word_counts(iter(batches))).to_pylist()
    assert sorted(c["n"] for c in counts) == [5, 10, 10, 10] and len({c["k"] for c in counts}) == 4
    none = np.zeros(0, np.uint64)
    triples = pa.Table.from_batches(lm._triple_counts(none, none.astype(np.int64))(iter(batches))).to_pylist()
    assert len({c["code"] for c in triples}) == len(triples) and sum(c["n"] for c in triples) == 5 * 11
    assert list(lm._word_counts(iter([]))) == list(lm._triple_counts(none, none.astype(np.int64))(iter([]))) == []


def test_lm_words_are_found_by_their_first_bits():
    r = np.random.default_rng(4)
    k = np.unique(r.integers(0, 1 << 63, 5000, dtype=np.uint64) << np.uint64(1))
    k = np.concatenate([k, np.array([2 ** 64 - 1, 2 ** 64 - 2, 2 ** 64 - 3, 0], np.uint64)])
    for keys in (k, k[:1], k[-4:]):
        keys = np.unique(keys)
        words = lm.Words(keys, np.full(len(keys), 30), np.zeros(len(keys), np.int8), 20)
        asked = np.concatenate([keys, keys + np.uint64(1), r.integers(0, 1 << 63, 2000, dtype=np.uint64)])
        at, hit = words.find(asked)
        assert (hit == np.isin(asked, keys)).all() and (words.keys[at[hit]] == asked[hit]).all()


def test_lm_hashes_a_text_once_not_per_word(spark):
    """What numbers the rows is written with them: after the words are unfolded, it would be hashed for each."""
    got = lm.scored(cases.documents(spark, [cases.prose(50, i) for i in range(5)]), F.lit(False), listed=1, least=50, steps=5)
    assert "xxhash64" not in got._jdf.queryExecution().optimizedPlan().toString()


INSULTS = ["grumbler", "blockhead", "nincompoop"]


def toxic_texts(n, seed, spell=lambda w: w):
    r = random.Random(seed)
    out = []
    for i in range(n):
        words = cases.prose(r.randint(30, 200), seed * 1000 + i).split()
        if i % 2:
            for _ in range(max(1, len(words) // 30)):
                words.insert(r.randrange(len(words)), spell(r.choice(INSULTS)))
        out.append((" ".join(words), i % 2))
    return out


@pytest.fixture(scope="module")
def toxic_model(spark):
    rows = toxic_texts(2400, 1)
    docs = cases.documents(spark, [t for t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)] + [(None, 1), (7, None), (9999, 1)],
                                   "doc_id long, toxic int")
    return docs, labels


def test_toxicity_of_unseen_texts_and_misspellings(spark, toxic_model):
    weights, bias = toxicity.fit(*toxic_model)
    import pyarrow as pa

    def scores(rows):
        t = kernels.Texts(*kernels.unpack(pa.array([x for x, _ in rows])), lower=True)
        return toxicity.text_scores(t, weights, bias), np.array([y for _, y in rows])

    s, y = scores(toxic_texts(400, 2))
    assert ((s >= 0.5) == y).mean() > 0.95
    s, y = scores(toxic_texts(400, 3, spell=lambda w: w[:-2] + w[-2:] * 2))
    assert ((s >= 0.5) == y).mean() > 0.85


def test_toxicity_edge_cases(spark, toxic_model):
    _, labels = toxic_model
    got = {r.doc_id: r for r in toxicity.scored(cases.documents(spark), labels, rounds=3).collect()}
    assert set(got) == set(range(len(cases.odd_texts())))
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert got[8].score == got[9].score
    none = labels.where("false")
    assert {r.score for r in toxicity.scored(cases.documents(spark), none).collect()} == {0.5}
    assert toxicity.scored(cases.empty(spark), labels).count() == 0


def mixed_documents(spark, n=400):
    r = random.Random(5)
    words = {"a": [f"a{i}" for i in range(50)], "b": [f"b{i}" for i in range(50)], "c": [f"c{i}" for i in range(50)]}
    rows = []
    for i in range(n):
        d = "a" if i % 10 < 7 else "b" if i % 10 < 9 else "c"
        other = r.choice("abc")
        text = " ".join(r.choice(words[d if r.random() < 0.8 else other]) for _ in range(r.randint(5, 60)))
        rows.append((i, text, d))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_mixing_meets_targets(spark):
    docs = mixed_documents(spark)
    weights = {"a": 0.4, "b": 0.4, "c": 0.2}
    features, domains, _, steps = mixing.rates(docs, docs.select("doc_id"), weights=weights)
    rows = features.select("tokens", "p", mixing.rate_of(F.col("p"), steps, 0.0).alias("rate")).collect()
    total = sum(r.rate * r.tokens * np.array(r.p) for r in rows)
    assert domains == ["a", "b", "c"] and np.allclose(total / total.sum(), [0.4, 0.4, 0.2], atol=1e-3)
    assert min(r.rate for r in rows) >= 0


def test_mixing_keeps_rates_in_range(spark):
    docs = mixed_documents(spark)
    features, _, _, steps = mixing.rates(docs, docs.select("doc_id"), weights={"b": 1.0}, total=500.0)
    assert features.select(F.min(mixing.rate_of(F.col("p"), steps, 0.0))).first()[0] >= 0


def test_mixed_repeats_and_drops_nothing(spark):
    docs = mixed_documents(spark).withColumn("_x", F.lit(1))
    out = mixing.mixed(docs, docs.select("doc_id"), least=1.0)
    n = Counter(r.doc_id for r in out.collect())
    assert out.columns == docs.columns and set(n) == set(range(400)) and max(n.values()) > 1


def test_mixing_edge_cases(spark):
    odd = cases.documents(spark)
    out = mixing.mixed(odd, odd.select("doc_id"), least=1.0)
    assert {r.doc_id for r in out.collect()} == set(range(len(cases.odd_texts())))
    assert mixing.mixed(odd, odd.select("doc_id").where("false")).count() == odd.count()
    assert mixing.mixed(cases.empty(spark), odd.select("doc_id")).count() == 0


def test_mixing_counts_reach_the_driver_as_columns(spark, monkeypatch):
    """The counts of all domains and buckets are no row objects in the driver."""
    docs = mixed_documents(spark)
    kind, sizes = type(docs), []
    inner = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: sizes.append(len(rows := inner(self))) or rows)
    domains, log, _ = mixing.fit(docs, docs.select("doc_id"))
    assert domains == ["a", "b", "c"] and log.shape == (3, mixing.BUCKETS) and max(sizes) == 3


def test_mixing_shuffles_no_text(spark, monkeypatch):
    """However many rows are labelled, the texts that fit the classifier are picked by id where they are."""
    plans = []
    docs = mixed_documents(spark)
    inner = type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda self: plans.append(
        self._jdf.queryExecution().optimizedPlan().toString()) or inner(self))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mixing.fit(docs, docs.select("doc_id"), train_rows=20)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(plans) == 1
    joins = [x for x in plans[0].splitlines() if "Join LeftSemi" in x]
    assert len(joins) == 2 and "strategy=broadcast" in joins[0]


def test_mixing_keeps_rare_domains(spark):
    """A domain far below one row in the bound has its place and its target; weights for what
    cannot be fitted are an error."""
    rows = [(i, f"a{i % 50} a{i % 7} a{i % 11}", "a") for i in range(3000)] + [(3000, "z1 z2 z3", "z"), (3001, "y1 y2 y3", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labelled = docs.where("lang <> 'y'").select("doc_id")
    with pytest.warns(UserWarning, match="'y'"):
        features, domains, _, steps = mixing.rates(docs, labelled, train_rows=10, weights={"a": 0.9, "z": 0.1})
    assert domains == ["a", "y", "z"]
    got = features.select("doc_id", mixing.rate_of(F.col("p"), steps, 0.0).alias("rate")).where("doc_id = 3000").first()
    assert got.rate > 50
    for weights in ({"a": 0.5, "y": 0.5}, {"a": 0.5, "nowhere": 0.5}):
        with pytest.raises(ValueError, match="without labelled rows"):
            mixing.rates(docs, labelled, weights=weights)


def test_mixing_levels_a_hot_source(spark):
    """A source with half of all rows and texts like those of the others meets its target."""
    rows = [(i, cases.prose(30, i), "en", "hot" if i % 2 else f"s{i // 2 % 4}") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    features, domains, _, steps = mixing.rates(docs, docs.select("doc_id"), domain="source", temper=0.0)
    taken = Counter()
    source = {r[0]: r[3] for r in rows}
    for r in features.select("doc_id", (mixing.rate_of(F.col("p"), steps, 0.0) * F.col("tokens")).alias("n")).collect():
        taken[source[r.doc_id]] += r.n
    share = {k: n / sum(taken.values()) for k, n in taken.items()}
    assert set(share) == set(domains) and max(share.values()) < 0.25 and min(share.values()) > 0.15


def test_registered_mixing_is_of_sources(spark):
    assert {r.domain for r in mixing.op7_mixing(spark, SF).select("domain").distinct().collect()} == {
        f"src{i}" for i in range(20)}
