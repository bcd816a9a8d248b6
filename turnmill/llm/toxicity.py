"""Toxicity scores: subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the vectors of its character n-grams (three to five code
points, with marks for both ends of the word) and of the word itself, all hashed into a
fixed number of buckets. Words are lower-cased (A-Z). The vectors of a window of words
are averaged, and a linear softmax tells toxic from other windows; a text is as toxic as
its most toxic window, so that one abusive sentence counts the same in a long text as in
a short one. Vectors and softmax are trained jointly in numpy: every window of texts that
are not toxic is an example of that class, and of a toxic text its most toxic window so
far is one of the other. A misspelling that training has never seen shares most of its
n-grams with the word it stands for.

Training takes at most ``train_rows`` labelled texts, half of each label where there are
enough, chosen by a hash of their ids: a documented bound for fitting only, as every text
is scored, whole. At scoring time a bucket's vector and the softmax weights collapse into
one number per bucket, which is all that is sent to tasks.

Edge cases: a null or empty text has one empty window and gets a score like any other;
ids without a text and null labels are not trained on; with no labelled text of either
class all scores are 0.5; repeated rows get equal results; further columns are ignored;
an empty table gives an empty table.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from turnmill.llm import kernels
from turnmill.llm.lm import remainder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
WINDOW = 48
LEAST = 24  # a shorter window is averaged over so many places
DIM = 4
TRAIN_ROWS = 3000
_U = np.uint64


def subwords(t: kernels.Texts, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of the given words, and the word each belongs to."""
    size = ends - starts
    begin = np.cumsum(size + 2) - (size + 2)
    data = np.empty(int((size + 2).sum()), np.uint8)
    data[begin] = ord("<")
    data[begin + size + 1] = ord(">")
    inner = np.ones(len(data), bool)
    inner[begin] = inner[begin + size + 1] = False
    offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    data[inner] = t.data[np.repeat(starts, size) + offset]
    marked = kernels.Texts(data, np.array([0, len(data)]))
    point = np.flatnonzero((data & 0xC0) != 0x80)
    word = np.searchsorted(begin, point, "right") - 1
    after = np.append(point[1:], len(data))
    hashes = [marked.span_hash(begin, begin + size + 2) + _U(1)]
    owners = [np.arange(len(starts))]
    for n in GRAMS:
        if len(point) >= n:
            same = np.flatnonzero(word[n - 1:] == word[: len(word) - n + 1])
            hashes.append(marked.span_hash(point[same], after[same + n - 1]))
            owners.append(word[same])
    return (np.concatenate(hashes) & _U(BUCKETS - 1)).astype(np.int32), np.concatenate(owners)


def distinct_words(t: kernels.Texts):
    """First occurrences of all words, and for every word the number of its own."""
    _, first, number = np.unique(t.word_hash, return_index=True, return_inverse=True)
    return t.words[0][first], t.words[1][first], number


def windows(t: kernels.Texts) -> tuple[np.ndarray, np.ndarray]:
    """The window of each word, and the text of each window; every text has one."""
    count = np.maximum(-(-t.n_words // WINDOW), 1)
    first = np.cumsum(count) - count
    row = t.row_of_word()
    place = np.arange(len(row)) - t.words[2][row]
    return first[row] + place // WINDOW, np.repeat(np.arange(t.rows), count)


class Examples:
    """Windows of labelled texts as numbers: which words they hold, how often, and which
    buckets a word's subwords fall in. Texts are taken in a slice at a time."""

    def __init__(self, column: pa.Array, least_texts: int):
        self.rows = len(column)
        known = np.zeros(0, _U)  # distinct words so far, sorted
        buckets, owners, pairs, texts_of = [], [], [], []
        self.windows = rows = 0
        texts, sizes = [], []
        for part in kernels.slices(pa.RecordBatch.from_arrays([column], ["text"]), limit=1 << 20):
            t = kernels.texts(part, lower=True)
            words, first, number = np.unique(t.word_hash, return_index=True, return_inverse=True)
            fresh = np.flatnonzero(~np.isin(words, known))
            bucket, owner = subwords(t, t.words[0][first[fresh]], t.words[1][first[fresh]])
            buckets.append(bucket)
            owners.append(words[fresh][owner])
            known = np.union1d(known, words[fresh])
            window, text = windows(t)
            code, times = np.unique(window * np.int64(max(len(words), 1)) + number, return_counts=True)
            pairs.append((words[code % max(len(words), 1)], code // max(len(words), 1) + self.windows, times))
            held = np.unique(t.row_of_word() * np.int64(max(len(words), 1)) + number)
            texts_of.append(words[held % max(len(words), 1)])
            sizes.append(np.bincount(window, minlength=len(text)))
            texts.append(text + rows)
            rows += t.rows
            self.windows += len(text)
        self.words = len(known)
        self.text = np.concatenate(texts)
        scale = 1.0 / np.maximum(np.concatenate(sizes), LEAST)
        self.word = np.concatenate([np.searchsorted(known, w).astype(np.int32) for w, _, _ in pairs])
        self.window = np.concatenate([w for _, w, _ in pairs]).astype(np.int32)
        self.weight = np.concatenate([n for _, _, n in pairs]) * scale[self.window]
        bucket = np.concatenate(buckets)
        owner = np.concatenate([np.searchsorted(known, o).astype(np.int32) for o in owners])
        self.parts = np.maximum(np.bincount(owner, minlength=self.words), 1)
        # A bucket's texts are at most the sum over its words: a cheap bound that needs no
        # pass over all pairs of text and subword. What only a few texts hold would be
        # learnt by heart; its vector stays zero.
        texts_with = np.bincount(np.searchsorted(known, np.concatenate(texts_of)), minlength=self.words)
        held = np.bincount(bucket, weights=texts_with[owner], minlength=BUCKETS)
        self.used = np.flatnonzero(held >= least_texts)
        number = np.full(BUCKETS, -1, np.int32)
        number[self.used] = np.arange(len(self.used), dtype=np.int32)
        kept = number[bucket] >= 0
        self.bucket, self.owner = number[bucket[kept]], owner[kept]


def train(column: pa.Array, toxic: np.ndarray, rounds: int = 80, rate: float = 0.25, floor: float = 0.02,
          least_texts: int = 10, decay: float = 1e-4, seed: int = 3):
    """Weight of each bucket, and of an empty window, for the class ``toxic``."""
    rng = np.random.default_rng(seed)
    x = Examples(column, least_texts)
    n = x.windows
    params = {"vectors": rng.normal(0, 0.05, (DIM, len(x.used))), "softmax": rng.normal(0, 1, (DIM, 2)), "bias": np.zeros(2)}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    largest: dict = {}
    label = toxic[x.text].astype(np.int64)
    of_class = np.maximum(np.bincount(toxic, minlength=2), 1)
    windows_of = np.bincount(x.text, minlength=x.rows)
    begin = np.searchsorted(x.text, np.arange(x.rows))
    for round_ in range(rounds):
        pace = rate * (1 - round_ / rounds)
        softmax = params["softmax"]
        hidden = np.empty((n, DIM))
        for d, own in enumerate(params["vectors"]):
            words = np.bincount(x.owner, weights=own[x.bucket], minlength=x.words) / x.parts
            hidden[:, d] = np.bincount(x.window, weights=words[x.word] * x.weight, minlength=n)
        score = hidden @ softmax + params["bias"]
        score -= score.max(1, keepdims=True)
        chance = np.exp(score)
        chance /= chance.sum(1, keepdims=True)
        share = 1.0 / windows_of[x.text]
        if round_ >= rounds // 6:
            # Of each text the most toxic window: all that counts of a toxic one, and
            # counts double of another.
            best = np.lexsort((-chance[:, 1], x.text))
            top = best[begin]
            share = np.where(label == 1, 0.0, share)
            share[top[toxic == 1]] = 1.0
            share[top[toxic == 0]] += 1.0
        error = chance.copy()
        error[np.arange(n), label] -= 1
        error *= (share / of_class[label])[:, None]
        back = error @ softmax.T
        grads = {"vectors": decay * params["vectors"], "softmax": hidden.T @ error, "bias": error.sum(0)}
        for d in range(DIM):
            words = np.bincount(x.word, weights=back[x.window, d] * x.weight, minlength=x.words) / x.parts
            grads["vectors"][d] += np.bincount(x.bucket, weights=words[x.owner], minlength=len(x.used))
        for name, value in params.items():
            # Adam with a floor under the step's divisor: n-grams of a few texts, whose
            # gradients are small, move little, and those that tell the classes apart fast.
            g = grads[name]
            largest[name] = max(largest.get(name, 0.0), float(np.abs(g).max(initial=0.0)))
            first[name] = 0.8 * first[name] + 0.2 * g
            second[name] = 0.95 * second[name] + 0.05 * g * g
            value -= pace * first[name] / (np.sqrt(second[name]) + floor * largest[name] + 1e-12)
    weights = np.zeros(BUCKETS, np.float32)
    softmax, bias = params["softmax"], params["bias"]
    weights[x.used] = (softmax[:, 1] - softmax[:, 0]) @ params["vectors"]
    return weights, float(bias[1] - bias[0])


def text_scores(t: kernels.Texts, weights: np.ndarray, bias: float) -> np.ndarray:
    starts, ends, number = distinct_words(t)
    window, text = windows(t)
    total = np.zeros(len(text))
    if len(starts):
        bucket, owner = subwords(t, starts, ends)
        value = (np.bincount(owner, weights=weights[bucket], minlength=len(starts))
                 / np.bincount(owner, minlength=len(starts)))
        total = np.bincount(window, weights=value[number], minlength=len(text))
    mean = total / np.maximum(np.bincount(window, minlength=len(text)), LEAST)
    if not t.rows:
        return np.zeros(0)
    best = np.maximum.reduceat(mean, np.searchsorted(text, np.arange(t.rows))) + bias
    return 1 / (1 + np.exp(-np.clip(best, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, **training):
    """Train on labelled texts; half of ``train_rows`` of each label where there are
    enough. Which ones depends on a hash of their ids alone."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("doc_id")
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("toxic") == value).orderBy(order, "doc_id").limit(train_rows // 2)
        chosen = some if chosen is None else chosen.union(some)
    found = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "text", "toxic").toArrow().sort_by([("doc_id", "ascending")])
    toxic = found.column("toxic").to_numpy().astype(np.int64)
    if len(np.unique(toxic)) < 2:
        return np.zeros(BUCKETS, np.float32), 0.0
    return train(found.column("text").combine_chunks(), toxic, **training)


def scored(docs: DataFrame, labels: DataFrame, **training) -> DataFrame:
    """(doc_id, score, predicted) of every row; ``labels`` holds (doc_id, toxic)."""
    weights, bias = fit(docs, labels, **training)
    sent = docs.sparkSession.sparkContext.broadcast(weights)  # one number per bucket

    def run(batches):
        for batch in batches:
            for part in kernels.slices(batch, limit=1 << 20):
                score = text_scores(kernels.texts(part, lower=True), sent.value, bias)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    ["doc_id", "score", "predicted"])

    return kernels.small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double, predicted int")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(5) == 0
    labels = kernels.documents(spark, sf_dir, "labels").where(~held_out)
    return scored(kernels.documents(spark, sf_dir), labels).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")
