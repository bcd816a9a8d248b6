"""Quality rules as a short-circuit cascade.

Each rule is a measure of whole texts and a test of it. What a rule costs per text and
what share it rejects are estimated on a bounded sample; rules then run in the order of
rejections per second, and a text that one rule rejects is not measured by those after
it. The order changes the cost alone: a text is kept if and only if every rule passes
it, so verdicts are the same on every run.

Edge cases: a null or empty text has no words and is rejected; every row, repeated ones
included, gets its own verdict; further columns are carried along; an empty table gives
an empty table.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from turnmill.llm import kernels
from turnmill.llm.kernels import Texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_U = np.uint64


def _keyed(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes that differ between texts."""
    return kernels.mix(values + kernels.mix(row.astype(_U) + _U(1)))


def word_chars(t: Texts) -> np.ndarray:
    """Code points inside words."""
    return t.per_row(t.in_word & ((t.data & 0xC0) != 0x80))


def symbols(t: Texts) -> np.ndarray:
    return t.per_row(SYMBOLS[t.data])


def lines(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word, and those of them equal to an earlier one."""
    if not len(t.data):
        return np.zeros(t.rows, np.int64), np.zeros(t.rows, np.int64)
    feeds = np.flatnonzero(t.data == 10)
    bounds = t.at[:-1][np.diff(t.at) > 0]
    starts = np.union1d(bounds, feeds + 1)
    starts = starts[starts < len(t.data)]
    ends = np.append(starts[1:], len(t.data))
    ends = ends - (t.data[ends - 1] == 10)
    first_word = t.words[0]
    with_word = np.searchsorted(first_word, ends) > np.searchsorted(first_word, starts)
    starts, ends = starts[with_word], ends[with_word]
    row = np.searchsorted(t.at, starts, "right") - 1
    _, first = np.unique(_keyed(t.span_hash(starts, ends), row), return_index=True)
    all_lines = np.bincount(row, minlength=t.rows)
    return all_lines, all_lines - np.bincount(row[first], minlength=t.rows)


def repeat_words(t: Texts, n: int = 5) -> np.ndarray:
    """Words inside windows of ``n`` words that the text holds at least twice."""
    grams, begin = t.ngrams(n)
    if not len(grams):
        return np.zeros(t.rows, np.int64)
    row = np.searchsorted(t.words[2], begin, "right") - 1
    keys = _keyed(grams, row)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(t.words[0]), bool)
    for k in range(n):
        covered[begin[again] + k] = True
    total = np.zeros(len(covered) + 1, np.int64)
    np.cumsum(covered, out=total[1:])
    return total[t.words[2][1:]] - total[t.words[2][:-1]]


@dataclass(frozen=True)
class Rule:
    """``rejects`` takes texts and marks those to reject."""

    name: str
    rejects: Callable[[Texts], np.ndarray]


def _few_words(t):
    return t.n_words < 10


def _repeats(t):
    return 100 * repeat_words(t) > 20 * t.n_words


def _symbols(t):
    return 100 * symbols(t) > 10 * t.n_words


def _duplicate_lines(t):
    found, again = lines(t)
    return (again >= 3) & (100 * again > 30 * found)


def _word_length(t):
    chars = word_chars(t)
    return (chars < 2 * t.n_words) | (chars > 20 * t.n_words)


BASE_RULES = (Rule("few_words", _few_words), Rule("repeats", _repeats))
RULES = (*BASE_RULES, Rule("symbols", _symbols), Rule("duplicate_lines", _duplicate_lines),
         Rule("word_length", _word_length))


def estimate(docs: DataFrame, rules=RULES, sample_rows: int = 256, rounds: int = 3) -> list[dict]:
    """Cost in seconds and share rejected of each rule, on at most ``sample_rows`` texts.

    The sample sets nothing but the order of the rules. Spark reads only as many parts
    of the input as it takes to find these rows.
    """
    texts = [row.text for row in docs.select("text").take(sample_rows)]
    sample = pa.table({"text": pa.array(texts, pa.string())})
    out = []
    for rule in rules:
        cost, rejected = 0.0, 0
        for batch in sample.to_batches():
            for part in kernels.slices(batch):
                seconds = []
                for _ in range(rounds):
                    t = kernels.texts(part)
                    begun = time.perf_counter()
                    found = int(rule.rejects(t).sum())
                    seconds.append(time.perf_counter() - begun)
                cost, rejected = cost + min(seconds), rejected + found
        n = max(sample.num_rows, 1)
        out.append({"rule": rule, "cost": cost / n, "rejects": rejected / n})
    return out


def ordered(estimates: list[dict]) -> list[Rule]:
    """Rules by rejections per second, the highest first; ties by cost, then as given."""
    return [e["rule"] for e in sorted(
        estimates, key=lambda e: (-e["rejects"] / max(e["cost"], 1e-12), e["cost"]))]


def survivors(part: pa.RecordBatch, rules) -> np.ndarray:
    """Which rows of a batch pass all rules; a rejected text is not measured again once
    a fifth of the rows is gone."""
    kept = np.arange(part.num_rows)
    t = kernels.texts(part)
    alive = np.ones(len(kept), bool)
    for rule in rules:
        if alive.sum() < 0.8 * len(alive):
            kept = kept[alive]
            t = kernels.texts(pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("text")).take(pa.array(kept))], ["text"]))
            alive = np.ones(len(kept), bool)
        if not len(kept):
            break
        alive &= ~rule.rejects(t)
    out = np.zeros(part.num_rows, bool)
    out[kept[alive]] = True
    return out


def keep_clean(docs: DataFrame, rules=RULES, sample_rows: int = 256) -> DataFrame:
    """The rows that pass all rules, every column as it was."""
    plan = ordered(estimate(docs, rules, sample_rows))

    def run(batches):
        for batch in batches:
            for part in kernels.slices(batch):
                yield part.filter(pa.array(survivors(part, plan)))

    return kernels.small_batches(docs).mapInArrow(run, docs.schema)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judged(docs: DataFrame, rules=RULES, sample_rows: int = 256) -> DataFrame:
    """(doc_id, the five counts, kept): the cascade's verdict beside what it measures."""
    plan = ordered(estimate(docs, rules, sample_rows))

    def run(batches):
        for batch in batches:
            for part in kernels.slices(batch):
                t = kernels.texts(part)
                counts = (t.n_words, word_chars(t), symbols(t), lines(t)[1], repeat_words(t))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c.astype(np.int64)) for c in counts],
                     pa.array(survivors(part, plan))],
                    ["doc_id", *COUNTS, "kept"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", kept boolean"
    return kernels.small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_words")
    failed = (n < 10) | (100 * F.col("n_repeat_words") > 20 * n)
    return judged(kernels.documents(spark, sf_dir)).select(
        "doc_id", *COUNTS, failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept"))


_WORD = r"[^\x20\x09-\x0D]+"
OP8_SQL = rf"""
with d as (
  select row_number() over () as k, doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') as w
  from documents),
c as (
  select k, doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols
  from d),
lines as (
  select k, line, count(*) as n
  from (select k, unnest(string_split(text, chr(10))) as line from d)
  where regexp_matches(line, '{_WORD}') group by k, line),
l as (select k, sum(n) as n_lines, sum(n - 1) as n_dup_lines from lines group by k),
g as (
  select k, i, array_to_string(w[i:i + 4], ' ') as gram
  from (select k, w, unnest(range(1, len(w) - 3)) as i from d where len(w) >= 5)),
again as (
  select k, i from (select k, i, count(*) over (partition by k, gram) as n from g) where n > 1),
r as (
  select k, count(distinct i + j) as n_repeat_words
  from again, (select unnest(range(0, 5)) as j) group by k)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars,
       n_symbols::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
       coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
       n_words < 10 or 100 * coalesce(n_repeat_words, 0) > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * coalesce(n_repeat_words, 0) > 20 * n_words
            or 100 * n_symbols > 10 * n_words
            or (coalesce(n_dup_lines, 0) >= 3 and 100 * coalesce(n_dup_lines, 0) > 30 * coalesce(n_lines, 0))
            or word_chars < 2 * n_words or word_chars > 20 * n_words) as kept
from c left join l using (k) left join r using (k)"""
