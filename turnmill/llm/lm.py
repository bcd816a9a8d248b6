"""Text scores of a log-bilinear language model trained with noise-contrastive estimation.

Tokens are words in lower case (A-Z only) and one end per text. Every word seen ``least``
times in training has vectors of its own, so the vocabulary grows with the corpus; rarer and
unknown words share those of their form class (length and last two bytes). The vectors of the
two tokens before, one per position, are added to a context, and a word's probability
is taken in two steps, each normalised. The symbol comes first: the end, one of the most
frequent words, or a form class, by the product of the context with the symbol's vector. Within
a class, a binary tree leads to the word: every inner node has a vector, and the sigmoid of
its product with the context, plus a bias, says which way. The first leaf of a class is for all its rare
words, where each has its smoothed share and one share is left for unknown words. The
product is normalised over all words.

Words are counted by a shuffle. Symbols are trained first, on at most ``SYMBOLS ** 3`` counts of
symbol triples, and give all vectors their start; the nodes' biases start at the words' shares.
Then every training token takes a step: each task goes through the triples of its own texts,
symbols by noise-contrastive estimation, trees by the logistic loss of their decisions, and
the changes of a vector are averaged over the tasks that met it, weighted by how often. Each
such task goes through at least as many bytes of text as the model has, so that the changes
that are shuffled weigh no more than the texts, however many tasks would read them.

The nodes met most in a class, its head, are multiplied with all its tokens of a batch as one
matrix; below them each level is gone through for the tokens it concerns. Neither changes a
step but for the order in which single-precision sums are made.

Own words and their vectors are sent to all tasks and gathered by the driver, so memory
grows with the vocabulary; counts of all other words reach their texts by joins.

Edge cases: a null or empty text is one end token; rows with a null ``doc_id`` are scored
and used for training; repeated rows get equal results; further columns are ignored; an
empty table gives an empty table, and without any training text all words are unknown.
A word stands for its 64-bit hash.
"""

from __future__ import annotations

import sys
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnmill.llm import kernels
from turnmill.scratch import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SYMBOLS = 128
FORMS = 16
OWN = SYMBOLS - FORMS - 1  # symbol 0 is the end, and what stands before a text
LISTED = 1 << 16
LEAST = 20
BATCH = 8192
NOISE = 16
PACE = 0.05
WAIT = 1 << 19  # words of which a task sums the counts before it hands them on
BLOCK = 4096  # parameter rows whose changes travel together
SHORT = 8  # so many rows of every run are added run by run at once, the rest of the longer ones by run
NEAR = 2048  # rows that are worked on while they are in the processor's cache
HEAD = 32  # nodes of a class that all its tokens are multiplied with at once
_U = np.uint64


def forms(t: kernels.Texts) -> np.ndarray:
    """Form class of each word: four lengths by four values of the last two bytes."""
    starts, ends, _ = t.words
    size = ends - starts
    length = np.searchsorted([5, 8, 11], size, "right")
    last = t.data[ends - 1].astype(np.int64)
    before = t.data[np.maximum(ends - 2, starts)].astype(np.int64)
    return (length * 4 + (last * 3 + before * 5) % 4).astype(np.int8)


def _merged(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Each word once, the sum of its counts, and its form."""
    k, n, form = map(np.concatenate, zip(*parts))
    order = np.argsort(k)
    k = k[order]
    first = _runs(k)[0]
    return [k[first], np.add.reduceat(n[order], first) if len(first) else n, form[order[first]]]


def _word_counts(batches):
    """Words and their counts; a task's texts are counted together while their words are few enough to wait."""
    wait, size = [], 0
    for batch in batches:
        for part in kernels.slices(batch):
            t = kernels.texts(part, lower=True)
            wait.append(_merged([[t.word_hash, np.ones(len(t.word_hash), np.int64), forms(t)]]))
            size += len(wait[-1][0])
            if size > WAIT:
                wait = [_merged(wait)]
                size = len(wait[0][0])
                if size > WAIT // 2:
                    yield _counted(wait.pop())
                    size = 0
    if wait:
        yield _counted(_merged(wait))


def _counted(words: list[np.ndarray]) -> pa.RecordBatch:
    k, n, form = words
    return pa.RecordBatch.from_arrays([pa.array(kernels.signed(k)), pa.array(n), pa.array(form)], ["k", "n", "form"])


def lookup(values: np.ndarray, keys: np.ndarray, found: np.ndarray, default: np.ndarray) -> np.ndarray:
    """What stands at each value in sorted keys; the default where the value is missing."""
    if not len(keys):
        return default
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, found[at], default)


def _symbols(t: kernels.Texts, own: np.ndarray, number: np.ndarray) -> np.ndarray:
    return lookup(t.word_hash, own, number, 1 + OWN + forms(t).astype(np.int64))


def triples(t: kernels.Texts, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each token's symbol triple, and the text it is in."""
    first = t.words[2]
    line = np.zeros(len(symbols) + 3 * t.rows, np.int64)
    place = np.arange(len(symbols)) + 3 * t.row_of_word() + 2
    line[place] = symbols
    token = np.ones(len(line), bool)
    begin = first[:-1] + 3 * np.arange(t.rows)
    token[begin] = token[begin + 1] = False
    at = np.flatnonzero(token)
    code = (line[at - 2] * SYMBOLS + line[at - 1]) * SYMBOLS + line[at]
    return code, np.repeat(np.arange(t.rows), np.diff(first) + 1)


def _triple_counts(own, number):
    """The counts of a task, of all its texts together."""
    def run(batches):
        total = None
        for batch in batches:
            for part in kernels.slices(batch):
                t = kernels.texts(part, lower=True)
                code = np.bincount(triples(t, _symbols(t, own, number))[0], minlength=SYMBOLS ** 3)
                total = code if total is None else np.add(total, code, out=total)
        if total is not None:
            code = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int32)), pa.array(total[code])], ["code", "n"])
    return run


def fit_symbols(code: np.ndarray, n: np.ndarray, dim: int = 24, steps: int = 1000, batch: int = 2048,
                noise: int = 16, rate: float = 0.1, seed: int = 1) -> list[np.ndarray]:
    """Vectors, output vectors, matrices of the positions, and biases of the symbols.

    Noise-contrastive estimation: the model tells drawn triples from noise symbols drawn
    from the unigram distribution; updates by Adagrad.
    """
    rng = np.random.default_rng(seed)
    s = SYMBOLS
    vectors, outputs = rng.normal(0, 0.1, (s, dim)), rng.normal(0, 0.1, (s, dim))
    places = np.stack([np.eye(dim) * 0.5, np.eye(dim)])
    unigram = np.bincount(code % s, weights=n, minlength=s) + 1.0
    unigram /= unigram.sum()
    bias = np.log(unigram)
    parts = [vectors, outputs, places, bias]
    squares = [np.full_like(p, 1e-3) for p in parts]
    chance, noise_chance = np.cumsum(n / n.sum()) if len(n) else None, np.cumsum(unigram)
    log_noise = np.log(noise * unigram)
    for step in range(steps if len(n) else 0):
        drawn = code[np.minimum(np.searchsorted(chance, rng.random(batch)), len(code) - 1)]
        a, b, w = drawn // (s * s), drawn // s % s, drawn % s
        fake = np.minimum(np.searchsorted(noise_chance, rng.random((batch, noise))), s - 1)
        words = np.concatenate([w[:, None], fake], 1)
        context = vectors[a] @ places[0] + vectors[b] @ places[1]
        every = context @ outputs.T + (bias - log_noise)
        score = np.take_along_axis(every, words, 1)
        error = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        error[:, 0] -= 1
        error /= batch
        # Sums by symbol as one product with a dense table of errors.
        place = (np.arange(batch)[:, None] * s + words).ravel()
        table = np.bincount(place, weights=error.ravel(), minlength=batch * s).reshape(batch, s)
        d_context = table @ outputs
        one_a, one_b = np.eye(s)[a], np.eye(s)[b]
        grads = [one_a.T @ (d_context @ places[0].T) + one_b.T @ (d_context @ places[1].T),
                 table.T @ context,
                 np.stack([vectors[a].T @ d_context, vectors[b].T @ d_context]),
                 table.sum(0)]
        pace = rate * (1 - step / steps)
        for p, q, g in zip(parts, squares, grads):
            q += g * g
            p -= pace * g / np.sqrt(q)
    return parts


class Words:
    """Words with a count known to all tasks: symbol, vectors and leaf of each."""

    def __init__(self, k: np.ndarray, c: np.ndarray, form: np.ndarray, least: int):
        """In order of falling counts."""
        rank = np.arange(len(k))
        own = (c >= least) | (rank < OWN)
        self.units = int(own.sum())  # then one for each form, and the end
        self.end = self.units + FORMS
        form = form.astype(np.int64)
        symbol = np.where(rank < OWN, rank + 1, 1 + OWN + form)
        unit = np.where(own, rank, self.units + form)
        leaf = np.zeros(len(k), np.int64)
        self.depth = np.zeros(FORMS, np.int64)
        for f in range(FORMS):
            inside = np.flatnonzero(own & (rank >= OWN) & (form == f))
            leaf[inside] = np.arange(1, len(inside) + 1)
            self.depth[f] = len(inside).bit_length()
        self.base = np.concatenate([[0], np.cumsum((1 << self.depth) - 1)])
        # By symbol: how deep its tree is, and the first node.
        self.depths = np.concatenate([np.zeros(1 + OWN, np.int64), self.depth])
        self.roots = np.concatenate([np.zeros(1 + OWN, np.int64), self.base[:-1]])
        order = np.argsort(k)
        self.keys, self.counts = k[order], c[order]
        self.symbol, self.unit, self.leaf = symbol[order], unit[order], leaf[order]

        # Places: the symbols without a tree, then the leaves of each class.
        offsets = 1 + OWN + np.concatenate([[0], np.cumsum(1 << self.depth)])
        self.places = np.concatenate([np.arange(1 + OWN), offsets[:-1]])
        self.below, self.exits = np.zeros(offsets[-1], np.int8), np.zeros(offsets[-1], np.int8)
        self.heads = []
        for f in range(FORMS):
            inside = own & (rank >= OWN) & (form == f)
            mass = np.zeros(1 << self.depth[f])
            mass[leaf[inside]] = c[inside]
            part = slice(offsets[f], offsets[f + 1])
            nodes, self.exits[part], self.below[part], ways = _head(mass, int(self.depth[f]))
            self.heads.append((self.base[f] + nodes, ways))

    @cached_property
    def _begin(self) -> np.ndarray:
        """Of each value of the first bits, the first key not below it."""
        bits = len(self.keys).bit_length() + 1
        return np.searchsorted(self.keys, np.arange(1 << bits, dtype=_U) << _U(64 - bits)).astype(np.int32)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_begin"}

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word may stand among the keys, and whether it does."""
        begin, last = self._begin, len(self.keys) - 1
        at = np.minimum(begin[words >> _U(65 - len(begin).bit_length())], last)
        # Keys are spread evenly, so few have the same first bits.
        ahead = np.flatnonzero(self.keys[at] < words)
        while len(ahead):
            at[ahead] += 1
            ahead = ahead[at[ahead] <= last]
            ahead = ahead[self.keys[at[ahead]] < words[ahead]]
        at = np.minimum(at, last)
        return at, self.keys[at] == words

    def trees(self, rest: np.ndarray) -> np.ndarray:
        """Biases of all nodes for which leaves have the words' smoothed shares; ``rest``
        is the weight of each form's first leaf."""
        out = np.zeros(self.base[-1])
        for f in range(FORMS):
            mass = np.zeros(1 << self.depth[f])
            mass[0] = rest[f]
            inside = (self.symbol == 1 + OWN + f) & (self.leaf > 0)
            mass[self.leaf[inside]] = self.counts[inside] + 1
            for level in range(self.depth[f] - 1, -1, -1):
                left, right = mass[::2], mass[1::2]
                at = self.base[f] + (1 << level) - 1
                with np.errstate(divide="ignore", invalid="ignore"):
                    odds = np.log(right) - np.log(left)
                out[at: at + len(left)] = np.clip(np.nan_to_num(odds), -40, 40)
                mass = left + right
        return out

    def tokens(self, t: kernels.Texts):
        """Of each token, ends included: its text, the units before, symbol, leaf; of each word: count or -1."""
        form = forms(t).astype(np.int64)
        if len(self.keys):
            at, hit = self.find(t.word_hash)
            symbol = np.where(hit, self.symbol[at], 1 + OWN + form)
            unit = np.where(hit, self.unit[at], self.units + form)
            leaf = np.where(hit, self.leaf[at], 0)
            count = np.where(hit, self.counts[at], -1)
        else:
            symbol, unit = 1 + OWN + form, self.units + form
            leaf, count = np.zeros(len(form), np.int64), np.full(len(form), -1)
        first = t.words[2]
        n, rows = len(form), t.rows
        line = np.full(n + 3 * rows, self.end, np.int64)
        text = t.row_of_word()
        line[np.arange(n) + 3 * text + 2] = unit
        token = np.ones(len(line), bool)
        begin = first[:-1] + 3 * np.arange(rows)
        token[begin] = token[begin + 1] = False
        at = np.flatnonzero(token)
        word = np.arange(n) + text
        what = np.zeros((2, n + rows), np.int64)
        what[0, word], what[1, word] = symbol, leaf
        row = np.repeat(np.arange(rows), np.diff(first) + 1)
        return row, line[at - 2], line[at - 1], *what, count

    def order(self, symbol: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """An order in which the tokens of a symbol and of a node stand together."""
        return _ordered(self.places[symbol] + leaf)

    def deep_order(self, symbol: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """The same, and those with a decision at a level are the last ones."""
        return _ordered((self.depths[symbol] << 36) + self.places[symbol] + leaf)

    def met_heads(self, symbol: np.ndarray, leaf: np.ndarray):
        """Of tokens in that order, by class: where its tokens are, the nodes of its head, and each token's
        row in a table of the ways it takes at these: 1 to the second child, -1 to the first, 0 if not met."""
        border = np.searchsorted(symbol, np.arange(1 + OWN, SYMBOLS + 1))
        for f, (nodes, ways) in enumerate(self.heads):
            if len(nodes) and border[f] < border[f + 1]:
                s = slice(border[f], border[f + 1])
                yield s, nodes, self.exits[self.places[symbol[s]] + leaf[s]], ways

    def below_heads(self, symbol: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens whose way goes on below the head, shorter ways first, else in the same order, and how far."""
        below = self.below[self.places[symbol] + leaf]
        order = np.argsort(below, kind="stable")
        order = order[np.searchsorted(below[order], 1):]
        return order, below[order]

    def decisions(self, symbol: np.ndarray, leaf: np.ndarray, far: np.ndarray):
        """By level from the leaves, of tokens in order of how far up they are asked for: the first that is
        asked for here; of it and all after it the nodes met, where each begins, how often it stands, and
        the ways: 1 to the second child, -1 to the first."""
        root, heap = self.roots[symbol] - 1, (1 << self.depths[symbol]) + leaf
        for level in range(1, int(far[-1]) + 1 if len(far) else 1):
            begin = int(np.searchsorted(far, level))
            way = heap[begin:] >> (level - 1)
            node = root[begin:] + (way >> 1)
            first, n = _runs(node)
            yield begin, node[first], first, n, ((way & 1) * 2 - 1).astype(np.float32)


def _head(mass: np.ndarray, depth: int):
    """Of a tree of so many levels over leaves with these counts: the nodes met most, at most ``HEAD``; of each
    leaf a number for its way through them, and how many levels are below; by that number, the way
    at each of the nodes: 1 to the second child, -1 to the first, 0 if not met.

    The way to the first leaf, which has all rare words, is always among them. A node is met
    at least as often as those below it, so they are the top of the tree.
    """
    if not depth:
        return np.zeros(0, np.int64), np.zeros(1, np.int8), np.zeros(1, np.int8), np.zeros((1, 0), np.float32)
    mass[0] = np.inf
    levels = [mass[::2] + mass[1::2]]
    while len(levels[-1]) > 1:
        levels.append(levels[-1][::2] + levels[-1][1::2])
    nodes = np.argsort(-np.concatenate(levels[::-1]), kind="stable")[:HEAD]
    column = np.full((1 << depth) - 1, -1)
    column[nodes] = np.arange(len(nodes))
    heap = (1 << depth) + np.arange(1 << depth)
    leave, below = heap.copy(), np.zeros(len(heap), np.int8)
    for level in range(1, depth + 1):
        outside = column[(heap >> level) - 1] < 0
        leave[outside] = heap[outside] >> level
        below[outside] = level
    leave, leaf, way = np.unique(leave, return_index=True, return_inverse=True)
    ways = np.zeros((len(leave), len(nodes)), np.float32)
    for i, x in enumerate(leaf):
        for level in range(int(below[x]) + 1, depth + 1):
            ways[i, column[(heap[x] >> level) - 1]] = 2 * (heap[x] >> (level - 1) & 1) - 1
    return nodes, way.astype(np.int8), below, ways


def _ordered(values: np.ndarray) -> np.ndarray:
    """The order of values, few enough to stand in 64 bits with their number; equal ones stay as they were."""
    width = len(values).bit_length()
    return np.sort(values << width | np.arange(len(values))) & ((1 << width) - 1)


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values begins, and how long it is."""
    begins = np.ones(len(ordered) + 1, bool)
    np.not_equal(ordered[1:], ordered[:-1], out=begins[1:-1])
    border = np.flatnonzero(begins)
    return border[:-1], np.diff(border)


def _run_sums(rows: np.ndarray, at: np.ndarray, first: np.ndarray, n: np.ndarray, weight: np.ndarray | None = None):
    """Where the sum of each run is, and the sums of the rows at the runs' places, times the weights; sums
    stand in order of the length of their runs."""
    def picked(places):
        got = np.take(rows, at[places], axis=0)
        return got if weight is None else np.multiply(got, weight[places][:, None], out=got)

    order = np.argsort(np.minimum(n, SHORT + 1).astype(np.int8), kind="stable")
    first, n = first[order], n[order]
    out, longer = picked(first), 0
    for k in range(1, SHORT):
        longer += int(np.count_nonzero(n[longer:] == k))
        out[longer:] += picked(first[longer:] + k)
    longer += int(np.count_nonzero(n[longer:] == SHORT))
    if longer < len(n):
        more = n[longer:] - SHORT
        begin = np.cumsum(more) - more
        places = np.repeat(first[longer:] + SHORT - begin, more) + np.arange(more.sum())
        out[longer:] += np.add.reduceat(picked(places), begin, axis=0)
    where = np.empty(len(order), np.int64)
    where[order] = np.arange(len(order))
    return where, out


class Model:
    """Arrays of all parameters; the last column of outputs and nodes is the bias."""

    NAMES = ("first", "second", "outputs", "nodes")

    def __init__(self, words: Words, first, second, outputs, nodes):
        self.words = words
        self.parts = [np.ascontiguousarray(p, np.float32) for p in (first, second, outputs, nodes)]

    def context(self, a, b):
        return np.take(self.parts[0], a, axis=0) + np.take(self.parts[1], b, axis=0)

    def log10(self, a, b, symbol, leaf) -> np.ndarray:
        """Log10 probability of each token: of its symbol, and of its leaf in the class."""
        out = np.empty(len(a))
        _, _, outputs, nodes = self.parts
        biggest = np.linalg.norm(outputs, axis=1).max()
        every = self.words.deep_order(symbol, leaf)
        for i in range(0, len(a), BATCH):
            order = every[i: i + BATCH]
            ordered, place = symbol[order], leaf[order]
            context = self.context(a[order], b[order])
            context = np.concatenate([context, np.ones((len(context), 1), np.float32)], 1)
            got = np.empty(len(context))
            # Exponents within 80 need no shift.
            shift = np.sqrt(np.einsum("ij,ij->i", context, context).max()) * biggest > 80
            for near in range(0, len(context), NEAR // 2):
                t = slice(near, near + NEAR // 2)
                score = outputs @ context[t].T
                if shift:
                    score -= score.max(0)
                got[t] = np.take(score, ordered[t] * score.shape[1] + np.arange(score.shape[1]))
                got[t] -= np.log(np.ones(SYMBOLS, np.float32) @ np.exp(score, out=score))
            # The logarithms of a way are taken at once, of a product of at most 2 to the number of its nodes.
            product, loss = np.ones(len(context)), np.zeros(len(context))
            for begin, node, first, n, way in self.words.decisions(ordered, place, self.words.depths[ordered]):
                c, rows = context[begin:], np.take(nodes, node, axis=0)
                if len(c) > 128 * len(rows):
                    z = np.concatenate([c[i: i + k] @ q for i, k, q in zip(first, n, rows)])
                else:
                    z = np.einsum("ij,ij->i", c, np.repeat(rows, n, axis=0))
                z *= -way
                loss[begin:] += np.maximum(z, 0)
                np.exp(np.negative(np.abs(z, out=z), out=z), out=z)
                z += 1
                product[begin:] *= z
            out[order] = got - loss - np.log(product)
        return out / np.log(10)


def _errors(z: np.ndarray, ways: np.ndarray) -> np.ndarray:
    """What the logistic function of z lacks, in place: to 1 where the way is 1, above 0 (negative) where it is -1."""
    z *= ways
    with np.errstate(over="ignore"):
        np.exp(z, out=z)
    z += 1
    return np.divide(ways, z, out=z)


class Learner:
    """One task's own copy of the parameters, and what it has changed."""

    def __init__(self, model: Model, noise: np.ndarray, seed: int):
        self.model = model
        # In a row, the parameters and then the sums of squares of their gradients.
        self.state = [np.concatenate([p, np.ones_like(p)], 1) for p in model.parts]
        self.met = [np.zeros(len(p), np.int64) for p in model.parts]
        self.noise, self.reach = noise, np.cumsum(noise)
        self.rng = np.random.default_rng(seed)

    @property
    def own(self) -> Model:
        return Model(self.model.words, *[s[:, : s.shape[1] // 2] for s in self.state])

    def _change(self, part: int, at, n, rows, where, g):
        """A step of Adagrad up the gradients of these rows, which are all different; ``where`` each has its own."""
        self.met[part][at] += n
        width = g.shape[1]
        for i in range(0, len(at), NEAR):
            near, step = rows[i: i + NEAR], np.take(g, where[i: i + NEAR], axis=0)
            squares = step * step
            squares += near[:, width:]
            near[:, width:] = squares
            step /= np.sqrt(squares, out=squares)
            step *= PACE
            near[:, :width] += step
            whole = f"V{near.itemsize * near.shape[1]}"  # a row is copied as one value
            self.state[part].view(whole)[:, 0][at[i: i + NEAR]] = near.view(whole)[:, 0]

    def learn(self, a, b, symbol, leaf):
        """A step for each batch of tokens."""
        for i in range(0, len(a), BATCH):
            self._step(*(x[i: i + BATCH] for x in (a, b, symbol, leaf)))

    def _units(self, part: int, index):
        """The vector of each unit, and the distinct ones: order, where each begins in it, how often it
        stands, its number and its row."""
        order = _ordered(index)
        ordered = index[order]
        first, n = _runs(ordered)
        rows = np.take(self.state[part], ordered[first], axis=0)
        number = np.empty(len(index), np.int64)
        number[order] = np.repeat(np.arange(len(first)), n)
        return np.take(rows[:, : rows.shape[1] // 2], number, axis=0), (order, first, n, ordered[first], rows)

    def _step(self, a, b, symbol, leaf):
        words = self.model.words
        order = words.order(symbol, leaf)
        a, b, symbol, leaf = a[order], b[order], symbol[order], leaf[order]
        context, *units = zip(*(self._units(part, index) for part, index in ((0, a), (1, b))))
        context = np.concatenate([context[0] + context[1], np.ones((len(a), 1), np.float32)], 1)
        wide = context.shape[1]
        # Symbols against noise; the noise of a batch is drawn once for all its tokens.
        outputs = self.state[2][:, :wide]
        fake = np.minimum(np.searchsorted(self.reach, self.rng.random(NOISE)), SYMBOLS - 1)
        log_noise = np.log(NOISE * self.noise).astype(np.float32)
        first, n = _runs(symbol)
        met, fake_out = symbol[first], outputs[fake]
        true_out = np.repeat(outputs[met], n, axis=0)
        e_true = _errors(np.einsum("ij,ij->i", context, true_out) - log_noise[symbol], np.float32(1))
        e_fake = _errors(context @ fake_out.T - log_noise[fake], np.float32(-1))
        true_out *= e_true[:, None]
        back = true_out
        back += e_fake @ fake_out
        g = np.zeros((SYMBOLS, wide), np.float32)
        for s, i, k in zip(met, first, n):
            g[s] = e_true[i: i + k] @ context[i: i + k]
        g += (np.arange(SYMBOLS)[:, None] == fake).astype(np.float32) @ (e_fake.T @ context)
        times = np.bincount(fake, minlength=SYMBOLS)
        times[met] += n
        at = np.flatnonzero(times)
        self._change(2, at, times[at], self.state[2][at], at, g)
        # Nodes of heads are multiplied with all tokens of their class, met or not; an error of 0 changes nothing.
        changes = []
        for t, head, exits, ways in words.met_heads(symbol, leaf):
            c, q = context[t], np.take(self.state[3], head, axis=0)[:, :wide]
            e = _errors(c @ q.T, np.take(ways, exits, axis=0))
            back[t] += e @ q
            changes.append((head, np.bincount(exits, minlength=len(ways)) @ (ways != 0), e.T @ c))
        if changes:
            head, n, g = map(np.concatenate, zip(*changes))
            self._change(3, head, n, np.take(self.state[3], head, axis=0), np.arange(len(head)), g)
        # Classes share no nodes, so a few are worked on at a time.
        border = np.searchsorted(symbol, np.arange(1 + OWN, SYMBOLS + 1))
        border = border[np.unique(np.searchsorted(border, np.arange(border[0], len(symbol) + NEAR, NEAR).clip(max=len(symbol))))]
        for t in map(slice, border[:-1], border[1:]):
            self._learn_below(context[t], back[t], symbol[t], leaf[t])
        back = np.ascontiguousarray(back[:, :-1])
        for part, (order, first, n, at, rows) in enumerate(*units):
            self._change(part, at, n, rows, *_run_sums(back, order, first, n))

    def _learn_below(self, context, back, symbol, leaf):
        """A step for the nodes below the heads; what the errors say of the contexts is added to ``back``."""
        words, wide = self.model.words, context.shape[1]
        rest, far = words.below_heads(symbol, leaf)
        if not len(rest):
            return
        levels = list(words.decisions(symbol[rest], leaf[rest], far))
        node = np.concatenate([x[1] for x in levels])
        n = np.concatenate([x[3] for x in levels])
        rows = np.take(self.state[3], node, axis=0)
        c_rest, back_rest, errors, done = np.take(context, rest, axis=0), np.take(back, rest, axis=0), [], 0
        for begin, nodes, _, times, way in levels:
            q = np.repeat(rows[done: done + len(nodes), :wide], times, axis=0)
            e = _errors(np.einsum("ij,ij->i", c_rest[begin:], q), way)
            q *= e[:, None]
            back_rest[begin:] += q
            errors.append(e)
            done += len(nodes)
        back[rest] = back_rest
        tokens = np.concatenate([np.arange(x[0], len(rest)) for x in levels])
        self._change(3, node, n, rows, *_run_sums(c_rest, tokens, np.cumsum(n) - n, n, np.concatenate(errors)))

    def changes(self):
        """Batches of one row (part, block, ids within it, n of each, changes times n)."""
        for part, (own, start, met) in enumerate(zip(self.state, self.model.parts, self.met)):
            for block in range(0, len(met), BLOCK):
                at = np.flatnonzero(met[block: block + BLOCK])
                if len(at):
                    n = met[block + at]
                    moved = (own[block + at, : start.shape[1]] - start[block + at]) * n[:, None].astype(np.float32)
                    yield _packed(part, block, at, n, moved)


def _packed(part: int, block: int, at: np.ndarray, n: np.ndarray, moved: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([block], pa.int64()),
         *[pa.array([x.tobytes()], pa.binary()) for x in (at.astype(np.int32), n, moved.astype(np.float32))]],
        ["part", "block", "at", "n", "moved"])


def _unpacked(rows: pa.Table):
    """(part, numbers of the rows in the part, n, their changes) of each block."""
    for part, block, at, n, moved in zip(*(rows[c].to_pylist() for c in ("part", "block", "at", "n", "moved"))):
        at = np.frombuffer(at, np.int32)
        yield part, block + at.astype(np.int64), np.frombuffer(n, np.int64), np.frombuffer(moved, np.float32).reshape(len(at), -1)


def _mean(rows: pa.Table) -> pa.Table:
    """The mean change of each parameter row of a block."""
    block = rows["block"][0].as_py()
    total, met = None, np.zeros(BLOCK, np.int64)
    for part, at, n, moved in _unpacked(rows):
        if total is None:
            total = np.zeros((BLOCK, moved.shape[1]))
        total[at - block] += moved
        met[at - block] += n
    at = np.flatnonzero(met)
    return pa.Table.from_batches([_packed(part, block, at, met[at], total[at] / met[at, None])])


def _learn(sent, noise, turn):
    def run(batches):
        learner = None
        for batch in batches:
            for part in kernels.slices(batch):
                if learner is None:
                    learner = Learner(sent.value, noise, 1_000_003 * turn + TaskContext.get().partitionId())
                learner.learn(*sent.value.words.tokens(kernels.texts(part, lower=True))[1:5])
        if learner is not None:
            yield from learner.changes()
    return run


def learners(model: Model, text_bytes: int) -> int:
    """Tasks that learn: together, their changes weigh no more than the texts."""
    return max(1, text_bytes // max(sum(p.nbytes for p in model.parts), 1))


def train_words(learn: DataFrame, model: Model, noise: np.ndarray, text_bytes: int, rounds: int = 1) -> Model:
    """The model after every training token was seen ``rounds`` times."""
    schema = "part int, block long, at binary, n binary, moved binary"
    for turn in range(rounds):
        sent = learn.sparkSession.sparkContext.broadcast(model)
        mean = learn.coalesce(learners(model, text_bytes)).mapInArrow(
            _learn(sent, noise, turn), schema).groupBy("part", "block").applyInArrow(_mean, schema).toArrow()
        parts = [p.copy() for p in model.parts]
        for part, at, _, change in _unpacked(mean):
            parts[part][at] += change
        model = Model(model.words, *parts)
        sent.unpersist()
    return model


def _score(sent, rare_total):
    """Per text: counts, the part of both scores known here, and its other words."""
    def run(batches):
        for batch in batches:
            for part in kernels.slices(batch):
                t = kernels.texts(part, lower=True)
                row, a, b, symbol, leaf, c = sent.value.words.tokens(t)
                rows = t.rows
                model = np.bincount(row, weights=sent.value.log10(a, b, symbol, leaf), minlength=rows).astype(np.float64)
                word_row = t.row_of_word()
                here = c > 0
                gain = np.where(here, np.log10(np.maximum(c, 0) + 1.0), 0.0)
                base = np.bincount(word_row, weights=gain, minlength=rows).astype(np.float64)
                # In a class's first leaf, each word has its share of the leaf.
                token = np.ones(len(row), bool)
                token[np.cumsum(t.n_words + 1) - 1] = False
                symbol, leaf = symbol[token], leaf[token]
                rare = (symbol > OWN) & (leaf == 0)
                inside = np.where(rare, gain - rare_total[np.maximum(symbol - 1 - OWN, 0)], 0.0)
                model += np.bincount(word_row, weights=inside, minlength=rows)
                known = np.bincount(word_row[here], minlength=rows)
                # Other words, once per text with their number.
                rest = np.flatnonzero(~here)
                order = rest[np.lexsort((t.word_hash[rest], word_row[rest]))]
                h, r = t.word_hash[order], word_row[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(h)))
                offsets = pa.array(np.searchsorted(r[at], np.arange(rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(2), pa.array(t.n_words + 1), pa.array(known),
                    pa.array(base, pa.float64()), pa.array(model, pa.float64()),
                    pa.ListArray.from_arrays(offsets, pa.array(kernels.signed(h[at]))),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                ], ["doc_id", "held_out", "n_tokens", "known", "base", "model", "words", "times"])
    return run


def scored(docs: DataFrame, held_out: Column, listed: int = LISTED, least: int = LEAST, **training) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row."""
    spark = docs.sparkSession
    rows = kernels.small_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.coalesce(held_out, F.lit(False)).alias("held_out"))
    learn = rows.where(~F.col("held_out")).select("doc_id", "text")
    counts = stage(
        learn.mapInArrow(_word_counts, "k long, n long, form byte")
        .groupBy("k").agg(F.sum("n").alias("c"), F.min("form").alias("form")), "word_counts")
    ends, text_bytes = learn.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    most = counts.orderBy(F.desc("c"), "k").limit(max(listed, OWN)).toPandas()
    if len(most) and most["c"].iloc[-1] >= least:
        # More words have vectors of their own than are listed.
        most = counts.where(F.col("c") >= least).toPandas().sort_values(["c", "k"], ascending=[False, True])
    forms_ = counts.groupBy("form").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    train_tokens, distinct = size["n"] + ends, size["v"] + (ends > 0)

    words = Words(most["k"].to_numpy(np.int64).view(_U), most["c"].to_numpy(np.int64), most["form"].to_numpy(), least)
    # Weight of each form's rare words: of all words of the form, less those with a place of their own.
    rest = np.ones(FORMS)
    for r in forms_:
        rest[r["form"]] += r["c"] + r["v"]
    own_rows = most[: words.units]
    np.subtract.at(rest, own_rows["form"].to_numpy(np.int64), own_rows["c"].to_numpy(np.float64) + 1)
    own_words = most["k"].to_numpy()[:OWN].astype(np.int64).view(_U)
    order = np.argsort(own_words)
    own, number = own_words[order], order.astype(np.int64) + 1
    gathered = (
        learn.mapInArrow(_triple_counts(own, number), "code int, n long")
        .groupBy("code").agg(F.sum("n").alias("n")).toArrow().sort_by("code"))
    code, times = (gathered[c].to_numpy().astype(t) for c, t in (("code", np.int64), ("n", np.float64)))
    vectors, outputs, places, bias = fit_symbols(code, times, **training)
    # Each unit starts with the vectors of its symbol.
    start = np.zeros(words.end + 1, np.int64)
    start[words.unit] = words.symbol
    start[words.units: words.end] = 1 + OWN + np.arange(FORMS)
    nodes = np.zeros((words.base[-1], vectors.shape[1] + 1))
    nodes[:, -1] = words.trees(rest)
    model = Model(words, (vectors @ places[0])[start], (vectors @ places[1])[start],
                  np.concatenate([outputs, bias[:, None]], 1), nodes)
    noise = np.bincount(code % SYMBOLS, weights=times, minlength=SYMBOLS) + 1.0
    model = train_words(learn, model, noise / noise.sum(), text_bytes)
    run = _score(spark.sparkContext.broadcast(model), np.log10(rest))
    local = stage(
        rows.select("doc_id", "text", "held_out").mapInArrow(
            run, "doc_id long, held_out boolean, n_tokens long, known long, base double, model double,"
                 " words array<long>, times array<int>")
        # Rows are numbered by what tells them apart; equal rows share a number and a result.
        .withColumns({"key": F.coalesce("doc_id", F.lit(-1)), "sub": F.xxhash64("words", "times", "base")}), "scores")
    other = local.select("key", "sub", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "key", "sub", F.col("w.words").alias("k"), F.col("w.times").alias("times"))
    copies = local.groupBy("key", "sub").agg(F.count(F.lit(1)).alias("copies"))
    added = (
        other.join(counts.select("k", "c"), "k")
        .groupBy("key", "sub").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("gain"),
                                   F.sum("times").alias("more"))
    )
    end_gain = float(np.log10(ends + 1.0))
    each = float(np.log10(train_tokens + distinct + 1.0))
    result = local.drop("words", "times").join(added, ["key", "sub"], "left").join(copies, ["key", "sub"])
    gain = F.coalesce(F.col("gain") / F.col("copies"), F.lit(0.0))
    more = F.coalesce((F.col("more") / F.col("copies")).cast("long"), F.lit(0))
    return result.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + more + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + gain + F.lit(end_gain) - F.col("n_tokens") * F.lit(each)).alias("base_score"),
        (F.col("model") + gain).alias("score"),
    )


def remainder(divisor: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(kernels.documents(spark, sf_dir), remainder(7) == 2)
