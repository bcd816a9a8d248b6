"""Mixing a corpus to target weights with soft domain membership.

A classifier learns domains from labelled rows and gives every document a probability for
each domain. A document's rate says how often it is to be taken; the expected tokens of a
domain are the sum over documents of rate, tokens and probability. Rates are fitted so that
these totals meet their targets in the least squares sense, by projected gradient steps
from rate 1 that keep every rate at ``least`` (zero) or above: a document's gradient is its
probabilities times the residuals of the domains, each divided by the domain's own tokens,
which is the step that a corpus with one domain per document needs just once.

A step is a handful of residuals. Tasks replay the steps so far for each document, so no
state is kept with the documents, and the driver sees one row of domain totals per step.

The classifier is naive Bayes over hashed words (lower case, A-Z only), its evidence counted
as that of at most ``EVIDENCE`` words, which keeps memberships soft. What a document itself
states as its domain is prior evidence of weight ``STATED``; where it states none, the shares
of the domains are. Domains and their labelled rows are counted over all data. About
``train_rows`` labelled rows of each domain at most, chosen by a hash, fit the classifier, a
documented bound for fitting only; token totals, rates and copies cover all documents. A
domain without labelled rows has the words of all domains and gives a warning; if a weight
is asked for it, or for a domain that does not occur, that is an error.

By default the targets are the corpus's own domain shares to the power ``temper``, and the
total is the smallest for which no domain shrinks, so that mixing repeats what is rare and
drops nothing.

Edge cases: a null or empty text has no tokens and the membership that its stated
domain gives; without any labelled row every rate is 1; a null label is ignored; repeated rows get equal rates, and
each is taken by its own; further columns are carried along by ``mixed``; an empty table
gives an empty table.
"""

from __future__ import annotations

import sys
import warnings

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnmill.llm import kernels
from turnmill.scratch import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 15
EVIDENCE = 24
STATED = 0.9
TRAIN_ROWS = 4000
TEMPER = 0.7
ROUNDS = 40
TOLERANCE = 1e-4
_U = np.uint64


def _label_counts(batches):
    for batch in batches:
        for part in kernels.slices(batch):
            t = kernels.texts(part, lower=True)
            bucket = (t.word_hash & _U(BUCKETS - 1)).astype(np.int64)
            labels, number = np.unique(part.column(1).to_numpy(zero_copy_only=False), return_inverse=True)
            code, n = np.unique(number[t.row_of_word()] * BUCKETS + bucket, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels[code // BUCKETS], pa.string()), pa.array((code % BUCKETS).astype(np.int32)),
                 pa.array(n)], ["label", "bucket", "n"])


def fit(docs: DataFrame, labelled: DataFrame, domain: str = "lang", train_rows: int = TRAIN_ROWS, weights=None):
    """(domains, log-probability of each bucket by domain, log-probability of each domain by
    stated domain, the last row for none): naive Bayes on labelled rows.

    ``labelled`` names them by ``doc_id``; a document's domain is its column ``domain``.
    """
    ids = labelled.where("doc_id is not null").select("doc_id").distinct()
    rows = docs.select("doc_id", "text", F.col(domain).cast("string").alias("label")).where("label is not null")
    seen = {r["label"]: [r["n"], 0] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = rows.join(ids, "doc_id", "left_semi")
    for r in chosen.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect():
        seen[r["label"]][1] = r["n"]
    domains = sorted(seen)
    bare = sorted({d for d in domains if not seen[d][1]} | set(weights or ()) - set(domains))
    wanted = [d for d in bare if (weights or {}).get(d, 0.0) > 0]
    if wanted:
        raise ValueError(f"weights for domains without labelled rows: {wanted}")
    if not any(n for _, n in seen.values()):
        return [], None, None
    if bare:
        warnings.warn(f"domains without labelled rows: {bare}", stacklevel=2)
    # Of each domain as large a part as its bound allows.
    part = F.create_map(*[F.lit(x) for d in domains for x in (d, train_rows / max(seen[d][1], 1))])
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.where(chance < part[F.col("label")])
    # Which of them are labelled is found by id alone: about train_rows ids of each domain, small
    # enough for every task, so that no text is shuffled.
    few = drawn.select("doc_id").join(ids, "doc_id", "left_semi").distinct()
    counts = drawn.join(F.broadcast(few), "doc_id", "left_semi").select("text", "label").mapInArrow(
        _label_counts, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow()
    # As columns: a row object for each of domains x BUCKETS counts would be most of the driver's memory.
    place = pc.index_in(counts["label"], value_set=pa.array(domains, pa.string())).to_numpy()
    table = np.zeros((len(domains), BUCKETS))
    table[place, counts["bucket"].to_numpy()] += counts["n"].to_numpy()
    # Where a domain has few words, those of all domains stand in.
    share = np.array([seen[d][0] for d in domains], float)
    share /= share.sum()
    every = table.sum(0)
    table += BUCKETS * every / max(every.sum(), 1)
    log = np.log(np.maximum(table, 1e-9) / np.maximum(table.sum(1, keepdims=True), 1))
    log[:, every == 0] = 0  # no evidence for any domain, however many rows fitted it
    prior = np.concatenate([STATED * np.eye(len(domains)) + (1 - STATED) * share, share[None, :]])
    return domains, log.astype(np.float32), np.log(prior)


def membership(t: kernels.Texts, log: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Probability of each domain for each text, given the log-prior of each."""
    bucket = (t.word_hash & _U(BUCKETS - 1)).astype(np.int64)
    row = t.row_of_word()
    score = np.stack([np.bincount(row, weights=own[bucket], minlength=t.rows) for own in log], 1)
    words = np.maximum(t.n_words, 1)
    score *= (np.minimum(words, EVIDENCE) / words)[:, None]
    score += prior
    score -= score.max(1, keepdims=True)
    score = np.exp(score)
    return score / score.sum(1, keepdims=True)


def _stated(docs: DataFrame, domain: str, domains: list[str]) -> Column:
    """Number of the domain that a document states; the number of domains where it states none."""
    at = F.array_position(F.array(*map(F.lit, domains)), F.col(domain).cast("string"))
    return F.coalesce(F.when(at > 0, at - 1), F.lit(len(domains))).cast("int")


def _features(sent):
    def run(batches):
        log, prior = sent.value
        for batch in batches:
            for part in kernels.slices(batch):
                t = kernels.texts(part, lower=True)
                p = membership(t, log, prior[part.column(2).to_numpy()])
                at = pa.array((np.arange(t.rows + 1) * p.shape[1]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(t.n_words), pa.ListArray.from_arrays(at, pa.array(p.ravel()))],
                    ["doc_id", "tokens", "p"])
    return run


def rate_of(p: Column, steps: list[list[float]], least: float) -> Column:
    """A document's rate after the given steps: each moves it against its gradient and
    back into range."""
    rate = F.lit(1.0)
    if not steps:
        return F.greatest(rate, F.lit(least))
    taken = F.array(*[F.array(*map(F.lit, step)) for step in steps])
    return F.aggregate(taken, rate, lambda r, step: F.greatest(F.lit(least), r - F.aggregate(
        F.zip_with(p, step, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)))


def targets(own: np.ndarray, weights: dict[str, float] | None, domains: list[str], temper: float = TEMPER,
            total: float | None = None) -> np.ndarray:
    """Tokens wanted of each domain. Without a total, as few as let no domain shrink."""
    if weights is None:
        share = np.where(own > 0, (own / max(own.sum(), 1e-300)) ** temper, 0.0)
    else:
        share = np.array([weights.get(d, 0.0) for d in domains])
    share = share / max(share.sum(), 1e-300)
    if total is None:
        some = share > 0
        total = float((own[some] / share[some]).max(initial=0.0))
    return share * total


def fit_rates(features: DataFrame, domains: list[str], weights=None, temper: float = TEMPER, total=None,
              least: float = 0.0, rounds: int = ROUNDS) -> list[list[float]]:
    """Steps of the projected gradient until all totals are within ``TOLERANCE``."""
    def totals(steps):
        taken = features.select("p", (rate_of(F.col("p"), steps, least) * F.col("tokens")).alias("taken"))
        row = taken.agg(*[F.sum(F.col("taken") * F.col("p")[i]) for i in range(len(domains))]).first()
        return np.array([x or 0.0 for x in row])

    own = totals([])
    if not own.sum():
        return []
    want = targets(own, weights, domains, temper, total)
    steps: list[list[float]] = []
    now = own
    for _ in range(rounds):
        if np.all(np.abs(now - want) <= TOLERANCE * np.maximum(want, 1.0)):
            break
        steps.append((np.where(own > 0, (now - want) / np.maximum(own, 1e-300), 0.0)).tolist())
        now = totals(steps)
    return steps


def rates(docs: DataFrame, labelled: DataFrame, domain: str = "lang", train_rows: int = TRAIN_ROWS,
          **mixing) -> tuple[DataFrame, list[str], tuple, list]:
    """Documents as (doc_id, tokens, p) rows, the domains, the classifier and the steps."""
    domains, *model = fit(docs, labelled, domain, train_rows, mixing.get("weights"))
    if not domains:
        domains, model = ["none"], [np.zeros((1, BUCKETS), np.float32), np.zeros((2, 1))]
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))
    features = stage(kernels.small_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", _stated(docs, domain, domains).alias("stated")).mapInArrow(
        _features(sent), "doc_id long, tokens long, p array<double>"), "membership")
    return features, domains, tuple(model), fit_rates(features, domains, **mixing)


def _repeat(sent, steps, least, names):
    def run(batches):
        log, prior = sent.value
        for batch in batches:
            for part in kernels.slices(batch):
                stated = part.column(part.schema.get_field_index("_stated")).to_numpy()
                p = membership(kernels.texts(part, lower=True), log, prior[stated])
                rate = np.full(part.num_rows, max(1.0, least))
                for step in steps:
                    rate = np.maximum(least, rate - p @ np.array(step))
                chance = part.column(part.schema.get_field_index("_chance")).to_numpy()
                rate = np.round(rate, 9)
                copies = np.floor(rate) + (chance < rate - np.floor(rate))
                take = pa.array(np.repeat(np.arange(part.num_rows), copies.astype(np.int64)))
                yield part.select(names).take(take)
    return run


def mixed(docs: DataFrame, labelled: DataFrame, domain: str = "lang", least: float = 0.0,
          train_rows: int = TRAIN_ROWS, **mixing) -> DataFrame:
    """Documents as often as their rates say: the whole part of a rate for certain, the
    rest with its probability, drawn from a hash of id and text."""
    _, domains, model, steps = rates(docs, labelled, domain, train_rows, least=least, **mixing)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    inner = kernels.small_batches(docs).withColumn("_chance", chance).withColumn("_stated", _stated(docs, domain, domains))
    return inner.mapInArrow(_repeat(sent, steps, least, docs.columns), docs.schema)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to equal weights, as many tokens in all as no source needs to shrink for."""
    features, domains, _, steps = rates(
        kernels.documents(spark, sf_dir), kernels.documents(spark, sf_dir, "labels"), domain="source", temper=0.0)
    best = F.array_max("p")
    names = F.array(*map(F.lit, domains))
    return features.select(
        "doc_id", "tokens", F.element_at(names, F.array_position("p", best).cast("int")).alias("domain"),
        best.alias("membership"), rate_of(F.col("p"), steps, 0.0).alias("rate"))
