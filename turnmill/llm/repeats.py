"""Removal of byte passages that stand elsewhere already, by refined suffix buckets.

A byte goes if a string of ``length`` bytes (100) that covers it also starts at an
earlier place: in a document with a smaller id, or earlier in the same one.

Suffixes are sorted into buckets by their first bytes, and buckets are refined by the
identifiers of what stands at later offsets, as in bucket-pointer refinement; a bucket
that has become final is not looked at again, and what has been learnt of one suffix is
reused for the others of its bucket.

1. *Initial buckets.* Every string of 100 bytes holds ``length - Q + 1`` q-grams; the one
   with the smallest hash is its anchor (the last of equals). Equal strings have their
   anchor at the same offset, so only suffixes at anchors, some one in 35, need sorting.
   The bucket of an anchor is its q-gram. A bucket with one member is final: no string
   with this anchor stands anywhere else.
2. *Refinement.* A larger bucket is refined by the identifier of all that its strings can
   reach, from ``length - Q`` bytes before the anchor to ``length`` bytes behind it. In a
   refined bucket the first member stands for all: every string of the others stands
   earlier. If a bucket does not fall apart at all, it is final.
3. *Recursion.* Firsts of buckets that fell apart are cut into pieces of ``BLOCK`` strings
   at neighbouring offsets. Their bucket is the identifier of the bytes that all strings of
   the piece share, at the offsets around the anchor, and it is refined by what they reach
   together, as in step 2. What falls apart again is cut into single strings.

Inside one document a string that stands earlier in it is found in the same pass that
makes the anchors; tables hold one row per document and bucket. Identifiers are 64-bit
polynomials, compared only inside the bucket of another such identifier. All
steps are counts, minima and joins by identifier: counts are combined before a shuffle,
and joins may be split where one identifier is very frequent.

Edge cases: a null or empty text has no bytes and the hash of the empty string; texts
below 100 bytes stay whole; rows with a null ``doc_id`` are left as they are; of rows
that share a ``doc_id``, equal texts get equal results, as a document is no earlier than
itself. Further columns are carried along by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from turnmill.llm import kernels
from turnmill.scratch import drop, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 100
Q = 32
SLICE = 256 << 10  # bytes of text handled at once: arrays that stay in the cache
BLOCK = 8
_U = np.uint64


def _last_least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest value in each run of ``width``, the last of equals.

    Smallest values from the left and from the right inside blocks of ``width``: a run
    is the end of one block and the beginning of the next.
    """
    n = len(values)
    full = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    full[:n] = values
    place = np.arange(len(full), dtype=np.int32)
    block, at = full.reshape(-1, width), place.reshape(-1, width)
    left = np.minimum.accumulate(block, 1)
    left_at = np.maximum.accumulate(np.where(block == left, at, 0), 1).reshape(-1)
    right = np.minimum.accumulate(block[:, ::-1], 1)[:, ::-1]
    fresh = np.ones(block.shape, bool)
    fresh[:, :-1] = block[:, :-1] < right[:, 1:]
    right_at = np.minimum.accumulate(np.where(fresh, at, len(full))[:, ::-1], 1)[:, ::-1].reshape(-1)
    ends = slice(width - 1, n)
    runs = slice(0, n - width + 1)
    return np.where(left.reshape(-1)[ends] <= right.reshape(-1)[runs], left_at[ends], right_at[runs])


class Strings:
    """The strings of ``LENGTH`` bytes of some texts, by anchor. Places are counted over
    the bytes of all the texts; strings never cross from one text to the next."""

    def __init__(self, t: kernels.Texts):
        self.t = t
        size = len(t.data)
        fits = np.diff(t.at) >= LENGTH
        counts = np.where(fits, np.diff(t.at) - LENGTH + 1, 0)
        total = int(counts.sum())
        #: Where each string starts, and the text it is in.
        self.row = np.repeat(np.arange(t.rows), counts)
        self.start = np.arange(total) + np.repeat(t.at[:-1] - (np.cumsum(counts) - counts), counts)
        empty = np.zeros(0, np.int64)
        self.first, self.anchor, self.of = empty, empty, empty
        self.h = np.zeros(0, _U)
        if not total:
            return
        grams = t.run_hash(Q)
        # The order of q-grams is that of half their hash: half the memory to go through.
        chosen = _last_least((grams >> _U(32)).astype(np.uint32), LENGTH - Q + 1)[self.start].astype(np.int64)
        new = np.ones(total, bool)
        new[1:] = chosen[1:] != chosen[:-1]
        #: By anchor: its first string, its place, its text, its bucket.
        self.first = np.flatnonzero(new)
        self.anchor, self.of = chosen[self.first], self.row[self.first]
        self.h = grams[self.anchor]

    def reach(self, low, high, anchor, of) -> np.ndarray:
        """Identifier of spans, cut at the ends of their texts, with the anchor's place."""
        low, high = np.maximum(low, self.t.at[of]), np.minimum(high, self.t.at[of + 1])
        return kernels.mix(self.t.span_hash(low, high) ^ kernels.mix((anchor - low).astype(_U) + _U(7)))

    def of_string(self, strings: np.ndarray) -> np.ndarray:
        """Number of the anchor of each string."""
        return np.searchsorted(self.first, strings, "right") - 1

    def strings_of(self, anchors: np.ndarray) -> np.ndarray:
        """Strings of the given anchors."""
        return _ranges(self.first[anchors], np.append(self.first[1:], len(self.start))[anchors])

    def end_of(self, level: int, first: np.ndarray) -> np.ndarray:
        """Where the pieces of a level end that begin with the given strings."""
        if level == 2 or not len(first):
            return first + 1
        of = self.of_string(first)
        end = np.append(self.first[1:], len(self.start))[of]
        if level == 1:
            # Strings of a block start at its anchor's distance or nearer.
            last = self.anchor[of] - (self.anchor[of] - self.start[first]) // BLOCK * BLOCK
            end = np.minimum(end, first + (last - self.start[first]) + 1)
        return end

    def ids(self, strings: np.ndarray) -> np.ndarray:
        return self.t.span_hash(self.start[strings], self.start[strings] + LENGTH)

    def pieces(self, level: int, inside: np.ndarray | None = None):
        """Pieces of a level, of the given strings or of all: the strings of an anchor
        (0), those of a block of offsets (1), single ones (2). Gives the first string, the
        end, the bucket and the refined bucket of each."""
        if level == 0:
            around = self.reach(self.anchor - (LENGTH - Q), self.anchor + LENGTH, self.anchor, self.of)
            return self.first, np.append(self.first[1:], len(self.start)), self.h, around
        if level == 2:
            ids = self.ids(inside)
            return inside, inside + 1, ids, ids
        of = self.of_string(inside)
        block = (self.anchor[of] - self.start[inside]) // BLOCK
        new = np.ones(len(inside), bool)
        new[1:] = (of[1:] != of[:-1]) | (block[1:] != block[:-1])
        first = inside[new]
        of, block, end = of[new], block[new], np.append(np.flatnonzero(new)[1:], len(inside))
        count = end - np.flatnonzero(new)
        near = self.anchor[of] - block * BLOCK
        far = near - np.minimum(BLOCK - 1, LENGTH - Q - block * BLOCK)
        shared = kernels.mix(self.t.span_hash(near, far + LENGTH) ^ kernels.mix(block.astype(_U) + _U(11)))
        return first, first + count, shared, self.reach(far, near + LENGTH, self.anchor[of], self.row[first])


def _ranges(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers from each first to its end."""
    sizes = end - first
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def first_places(*keys: np.ndarray) -> np.ndarray:
    """Indexes of the first occurrence of each combination of keys."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    order = np.lexsort(keys)  # stable: equal keys keep their order
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    return np.sort(order[new])


def _listed(column: pa.Array, at: np.ndarray) -> np.ndarray:
    """Lists of places inside texts, one list per text, as places over all texts."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(at[:-1], sizes)


def _pieces(level: int):
    """Rows (k, c, doc_id, start): pieces of a level, those of what is open above it."""
    def run(batches):
        for batch in batches:
            for part in kernels.slices(batch, limit=SLICE):
                t = kernels.texts(part)
                s = Strings(t)
                inside = None
                for above in range(level):
                    first, end, _, _ = s.pieces(above, inside)
                    some = np.isin(s.start[first], _listed(part.column(2 + above), t.at))
                    inside = _ranges(first[some], end[some])
                first, _, k, c = s.pieces(level, inside)
                row = s.row[first]
                only = first_places(c, k, row)
                yield pa.RecordBatch.from_arrays([
                    pa.array(kernels.signed(k[only])), pa.array(kernels.signed(c[only])),
                    part.column(0).take(pa.array(row[only])),
                    pa.array((s.start[first] - t.at[row])[only].astype(np.int32)),
                ], ["k", "c", "doc_id", "start"])
    return run


def covered(t: kernels.Texts, known: list[np.ndarray]) -> np.ndarray:
    """Which bytes go. ``known``: by level, where pieces start all of whose strings stand
    in earlier documents."""
    s = Strings(t)
    again = np.zeros(len(s.start), bool)
    for level, starts in enumerate(known):
        first = np.flatnonzero(np.isin(s.start, starts)) if len(starts) else np.zeros(0, np.int64)
        again[_ranges(first, s.end_of(level, first))] = True
    # Anchors whose bucket the text holds more than once: compare their strings.
    key = kernels.mix(s.h + kernels.mix(s.of.astype(_U) + _U(1)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    strings = s.strings_of(np.flatnonzero(twice))
    if len(strings):
        later = np.ones(len(strings), bool)
        later[first_places(s.ids(strings), s.row[strings])] = False
        again[strings[later]] = True
    step = np.zeros(len(t.data) + 1, np.int32)
    at = s.start[again]
    step[at] += 1
    step[at + LENGTH] -= 1
    return np.cumsum(step[:-1]) > 0


LEVELS = ("known0", "known1", "known2")


def _refined(rows: DataFrame, level: int) -> DataFrame:
    """(doc_id, start, later, apart) of the pieces in buckets of more than one: whether
    all strings of a piece stand earlier, and whether its bucket fell apart."""
    # Two steps read the pieces. Those of the first level are the most, and made twice;
    # those below come from texts brought together with what is open, and are written down.
    if level:
        rows = stage(rows, f"pieces{level}")
    large = rows.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("low"), F.max("c").alias("high")
    ).where("n > 1").select("k", (F.col("low") != F.col("high")).alias("apart"))
    members = stage(rows.join(large, "k"), f"members{level}")
    if level:
        drop(rows)
    firsts = members.groupBy("k", "c").agg(F.min("doc_id").alias("first"))
    told = stage(members.join(firsts, ["k", "c"]).where("apart or doc_id > first").select(
        "doc_id", "start", "apart", (F.col("doc_id") > F.col("first")).alias("later")), f"told{level}")
    drop(members)
    return told


def found(docs: DataFrame) -> DataFrame:
    """(doc_id, known0, known1, known2): pieces of each document that stand in earlier
    ones, by level. Documents without any have no row."""
    texts = kernels.small_batches(docs, 250).where("doc_id is not null and octet_length(text) >= 100").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text")
    known, opened, with_open = None, [], texts
    for level, name in enumerate(LEVELS):
        rows = with_open.mapInArrow(_pieces(level), "k long, c long, doc_id long, start int")
        told = _refined(rows, level)
        own = told.where("later").groupBy("doc_id").agg(F.collect_list("start").alias(name))
        known = own if known is None else known.join(own, "doc_id", "full")
        opened.append(told.where("apart and not later").groupBy("doc_id").agg(
            F.collect_list("start").alias(f"open{level}")))
        with_open = texts
        for more in opened[::-1]:
            with_open = with_open.join(more, "doc_id")
        with_open = with_open.select("doc_id", "text", *[f"open{i}" for i in range(level + 1)])
    return known


def _cut(batches, emit):
    for batch in batches:
        for part in kernels.slices(batch, limit=SLICE):
            t = kernels.texts(part)
            lists = [part.column(part.schema.get_field_index(n)) for n in LEVELS]
            gone = covered(t, [_listed(x, t.at) for x in lists])
            if lists[0].null_count:
                whole = lists[0].is_null().to_numpy(zero_copy_only=False)
                gone &= ~np.repeat(whole, np.diff(t.at))
            yield emit(part, t, gone)


def _marked(docs: DataFrame) -> DataFrame:
    """Rows with the lists of ``found``; they are empty where only the text itself can
    repeat something, and null where the row is to stay whole."""
    empty = F.array().cast("array<int>")
    return docs.join(found(docs), "doc_id", "left").select(
        *[docs[c] for c in docs.columns],
        *[F.when(F.col("doc_id").isNotNull(), F.coalesce(n, empty)).alias(n) for n in LEVELS])


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows with every repeated passage cut out of ``text``.

    Where a cut would split a character, its left-over bytes go too. ``n_chars``, if
    there, is counted anew. Rows whose whole text goes stay with an empty text.
    """
    names = docs.columns

    def emit(part, t, gone):
        text = part.column(part.schema.get_field_index("text"))
        touched = t.per_row(gone) > 0
        cut = [t.data[a:b][~gone[a:b]].tobytes().decode("utf-8", "ignore")
               for a, b in zip(t.at[:-1][touched], t.at[1:][touched])]
        text = pc.replace_with_mask(text, pa.array(touched), pa.array(cut, pa.string()))
        return pa.RecordBatch.from_arrays(
            [text if n == "text" else part.column(part.schema.get_field_index(n)) for n in names], names)

    inner = docs.select(*names)
    cut = _marked(inner).mapInArrow(lambda batches: _cut(batches, emit), inner.schema)
    if "n_chars" in names:
        kind = inner.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.length("text").cast(kind))
    return cut


def _report(part, t, gone):
    opens = gone.copy()
    opens[1:] &= ~gone[:-1]
    opens[t.at[:-1][np.diff(t.at) > 0]] |= gone[t.at[:-1][np.diff(t.at) > 0]]
    kept = t.data[~gone].tobytes()
    removed = t.per_row(gone)
    ends = np.cumsum(np.diff(t.at) - removed)
    hashes = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(np.append(0, ends[:-1]), ends)]
    return pa.RecordBatch.from_arrays(
        [part.column(0), pa.array(np.diff(t.at)), pa.array(removed), pa.array(t.per_row(opens)),
         pa.array(hashes, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = kernels.documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _marked(docs).mapInArrow(
        lambda batches: _cut(batches, _report),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
