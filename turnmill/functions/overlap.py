"""Word overlap between an answer and its reference.

What Spark's expressions do well stays with them: case, whitespace, punctuation, set
overlap, and all sums. Counting shared n-grams and aligning sequences is done by two
small Arrow functions: the same counting as a fold over arrays measured 3.5 times
slower, and the alignment several hundred times, more so on long answers.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

from turnmill.functions.text import normalize, words

ORDERS = (1, 2, 3, 4)

# The Arrow functions travel with the job, so that executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---------------------------------------------------------------------------
# Tokenised texts (tokens separated by whitespace)
# ---------------------------------------------------------------------------


def rouge_text(text: Column) -> Column:
    """Text whose runs of ASCII letters and digits are the words of ROUGE scores."""
    return F.lower(text)


# The bytes of such words, and of line breaks; every other byte becomes a space, those
# of characters beyond ASCII included. A byte table is some 50 times faster than a
# regex over the same text.
_WORD_BYTES = bytes(
    b if b in b"abcdefghijklmnopqrstuvwxyz0123456789\n" else 0x20 for b in range(256)
)


def _rouge_bytes(texts: pa.Array) -> list[bytes]:
    return [text.encode().translate(_WORD_BYTES) for text in texts.to_pylist()]


# The replacement rules of the mteval-13a tokeniser, in order. The first
# pattern lists its characters one by one, which Java looks up in a single table; it
# leaves spaces alone, as more of them change no token.
BLEU_RULES = (
    ("<skipped>", ""),
    ("-\n", ""),
    ("\n", " "),
    ("&quot;", '"'),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
)
BLEU_PATTERNS = (
    (r"""[!"#$%&()*+/:;<=>?@\[\\\]^_`{|}~]""", " $0 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
)


def bleu_text(text: Column) -> Column:
    """Case-sensitive words with punctuation split off."""
    for old, new in BLEU_RULES:
        text = F.replace(text, F.lit(old), F.lit(new))
    text = F.concat(F.lit(" "), text, F.lit(" "))
    for pattern, replacement in BLEU_PATTERNS:
        text = F.regexp_replace(text, pattern, replacement)
    return text


# ---------------------------------------------------------------------------
# Row scores from Spark expressions
# ---------------------------------------------------------------------------


def exact_match(answer: Column, reference: Column) -> Column:
    return (normalize(answer) == normalize(reference)).cast("int")


def shared_word_share(answer: Column, reference: Column) -> Column:
    """Distinct shared words over all words of the reference."""
    reference_words = words(reference)
    shared = F.size(F.array_intersect(words(answer), reference_words))
    return shared / F.greatest(F.size(reference_words), F.lit(1))


# ---------------------------------------------------------------------------
# Row scores from Arrow functions
# ---------------------------------------------------------------------------


_CHUNK_BYTES = 4 << 20  # text of one vectorised step; bounds its memory


def _chunks(answers: pa.Array, references: pa.Array):
    """Slices of both columns with about equal bytes."""
    rows = len(answers)
    step = max(1, rows * _CHUNK_BYTES // max(1, answers.nbytes + references.nbytes))
    for start in range(0, rows, step):
        yield answers.slice(start, step), references.slice(start, step)


def _split(texts: list) -> tuple[list, np.ndarray]:
    """All words of a list of texts, one after another, and the number of words of each."""
    rows = [text.split() for text in texts]
    return list(chain.from_iterable(rows)), np.fromiter(map(len, rows), np.int64, len(rows))


def _shared_ngrams(answers: pa.Array, references: pa.Array, longest: int, texts=pa.Array.to_pylist):
    """Shared n-grams per row for n = 1 to ``longest``, each counted at most as often as
    in the text that has it less often; and the word counts of both texts.

    ``texts`` turns a column into texts to be split at whitespace.

    All rows of a chunk are counted together: words become numbers that differ between
    rows, and an n-gram the number of the pair (its first n-1 words, its last word).
    """
    parts = []
    for a_texts, r_texts in _chunks(answers, references):
        n_rows = len(a_texts)
        (a_words, a_sizes), (r_words, r_sizes) = _split(texts(a_texts)), _split(texts(r_texts))
        if not longest:
            parts.append(np.stack([a_sizes, r_sizes]))
            continue
        rows = np.repeat(np.tile(np.arange(n_rows), 2), np.concatenate([a_sizes, r_sizes]))
        codes, known = pd.factorize(np.array(a_words + r_words, dtype=object))
        is_answer = np.arange(len(rows)) < len(a_words)
        single, _ = pd.factorize(rows * (len(known) + 1) + codes)
        grams, at = single, np.arange(len(rows))  # n-gram and position of its last word
        hits = []
        for n in range(1, longest + 1):
            if n > 1:
                follows = at + 1 < len(rows)
                grams, at = grams[follows], at[follows] + 1
                same = (rows[at - 1] == rows[at]) & (is_answer[at - 1] == is_answer[at])
                grams, at = grams[same], at[same]
                grams, _ = pd.factorize(grams * (len(single) + 1) + single[at])
            top = int(grams.max(initial=-1)) + 1
            mine = is_answer[at]
            least = np.minimum(
                np.bincount(grams[mine], minlength=top), np.bincount(grams[~mine], minlength=top)
            )
            row_of = np.zeros(top, np.int64)
            row_of[grams] = rows[at]
            hits.append(np.bincount(row_of, least, minlength=n_rows).astype(np.int64))
        parts.append(np.stack([*hits, a_sizes, r_sizes]))
    out = np.concatenate(parts, axis=1) if parts else np.zeros((longest + 2, 0), np.int64)
    return out[:longest], out[longest], out[longest + 1]


def _f_scores(hits: np.ndarray, answer_sizes: np.ndarray, reference_sizes: np.ndarray):
    """Harmonic mean of precision and recall; 0 where nothing is shared."""
    some = np.maximum(hits, 1)
    precision, recall = (some / np.maximum(sizes, 1) for sizes in (answer_sizes, reference_sizes))
    return np.where(hits > 0, 2 * precision * recall / (precision + recall), 0.0)


# The table of longest common subsequences is kept as integers: the row of one word
# has a zero bit at every position of the other text where the length grows. A row
# then costs a few integer operations, so that long texts need no cap.


def _places(words: list[str]) -> dict[str, int]:
    """Positions of every word, as bits."""
    places: dict[str, int] = {}
    for j, word in enumerate(words):
        places[word] = places.get(word, 0) | 1 << j
    return places


def _lcs_hits(answer: bytes, reference: bytes) -> int:
    """Length of the longest common subsequence of words."""
    a, b = answer.split(), reference.split()
    if len(a) < len(b):
        a, b = b, a
    places = _places(b)
    row = full = (1 << len(b)) - 1
    for word in a:
        match = row & places.get(word, 0)
        if match:
            row = ((row + match) | (row - match)) & full
    return len(b) - row.bit_count()


def _lcs_positions(words: list[str], positions: list[int], size: int, places: dict) -> list[int]:
    """Of ``positions`` in ``words``, those on one longest common subsequence with a
    line of ``size`` words: traced from the ends, an unused word of ``words`` is passed
    over before one of the line.

    A row of bits is kept for every so many words only, and those between are made again
    when the trace comes to them: two square roots of the rows are held at a time.
    """
    full = (1 << size) - 1

    def step(row: int, i: int) -> int:
        match = row & places[words[i]]
        return ((row + match) | (row - match)) & full

    every = max(1, math.isqrt(len(positions)))
    row, kept = full, [full]
    for k, i in enumerate(positions, 1):
        row = step(row, i)
        if k % every == 0:
            kept.append(row)
    hits, end = [], full  # bits of the line's words still open
    for block in range((len(positions) - 1) // every, -1, -1):
        low = block * every
        rows = [kept[block]]
        for i in positions[low: low + every]:
            rows.append(step(rows[-1], i))
        for k in range(len(rows) - 1, 0, -1):
            place = places[words[positions[low + k - 1]]] & end
            last = place.bit_length()
            if last != end.bit_length() and (
                (rows[k] & end).bit_count() == (rows[k - 1] & end).bit_count()
            ):
                continue
            hits.append(positions[low + k - 1])
            end = (1 << (last - 1)) - 1
            if not end:
                return hits
    return hits


def _line_hits(answer: bytes, reference: bytes) -> int:
    """For each reference line the union of its subsequences with all answer lines,
    every word counted at most as often as it occurs on either side."""
    answer_lines = [line.split() for line in answer.splitlines()]
    indexed = [(len(line), _places(line)) for line in answer_lines]
    near: dict[str, list[int]] = {}
    for k, (_, places) in enumerate(indexed):
        for word in places:
            near.setdefault(word, []).append(k)
    found: Counter = Counter()
    for text in reference.splitlines():
        line = text.split()
        by_line: dict[int, list[int]] = {}
        for i, word in enumerate(line):
            for k in near.get(word, ()):
                by_line.setdefault(k, []).append(i)
        union: set[int] = set()
        # Lines with most words in common first; one that can add nothing is skipped.
        for k, positions in sorted(by_line.items(), key=lambda item: -len(item[1])):
            if not union.issuperset(positions):
                union.update(_lcs_positions(line, positions, *indexed[k]))
        found.update(line[i] for i in union)
    left = Counter(word for line in answer_lines for word in line)
    return sum(min(count, left[word]) for word, count in found.items())


def rouge_scores(keys: tuple[str, ...], answers: int = 1):
    """Arrow function (answer, ..., reference) -> struct of the asked F-scores.

    All texts come from ``rouge_text``. With several answers the fields of the i-th are
    named ``m<i>_<key>``.
    """
    n_grams = [int(key[-1]) for key in keys if key in ("rouge1", "rouge2")]
    names = [key if answers == 1 else f"m{i}_{key}" for i in range(answers) for key in keys]

    def score(*texts: pa.Array) -> pa.Array:
        references, columns = texts[-1], []
        prepared = _rouge_bytes(references)
        for own in texts[:-1]:
            shared, a_sizes, r_sizes = _shared_ngrams(own, references, max(n_grams, default=0), _rouge_bytes)
            for key in keys:
                if key in ("rouge1", "rouge2"):
                    n = int(key[-1])
                    hits, less = shared[n - 1], n - 1
                else:
                    count = _lcs_hits if key == "rougeL" else _line_hits
                    pairs = zip(_rouge_bytes(own), prepared)
                    hits, less = np.array([count(a, r) for a, r in pairs], np.int64), 0
                columns.append(pa.array(_f_scores(hits, a_sizes - less, r_sizes - less)))
        return pa.StructArray.from_arrays(columns, names=names)

    return F.arrow_udf(score, ", ".join(f"{name} double" for name in names))


BLEU_COUNTS = (*(f"m{n}" for n in ORDERS), "answer_size", "reference_size")


def bleu_counts(answers: int = 1):
    """Arrow function (answer, ..., reference) -> struct of matches by order and lengths.

    All texts come from ``bleu_text``. With several answers the fields of the i-th are
    named ``a<i>_<field>``.
    """
    names = [key if answers == 1 else f"a{i}_{key}" for i in range(answers) for key in BLEU_COUNTS]

    def count(*texts: pa.Array) -> pa.Array:
        columns = []
        for own in texts[:-1]:
            shared, a_sizes, r_sizes = _shared_ngrams(own, texts[-1], max(ORDERS))
            columns += [pa.array(c, pa.int64()) for c in (*shared, a_sizes, r_sizes)]
        return pa.StructArray.from_arrays(columns, names=names)

    return F.arrow_udf(count, ", ".join(f"{name} long" for name in names))


def bleu_from_sums(matches: list[Column], possible: list[Column],
                   answer_size: Column, reference_size: Column) -> Column:
    """Corpus score from summed counts: geometric mean of the precisions times the
    brevity penalty; 0 if any order has no match."""
    logs = [F.log(m / F.when(p > 0, p)) for m, p in zip(matches, possible)]
    mean = F.exp(sum(logs[1:], logs[0]) / len(logs))
    ratio = reference_size / F.when(answer_size > 0, answer_size)
    penalty = F.when(answer_size > reference_size, F.lit(1.0)).otherwise(F.exp(1 - ratio))
    return F.when(F.least(*matches) > 0, mean * penalty).otherwise(F.lit(0.0))
