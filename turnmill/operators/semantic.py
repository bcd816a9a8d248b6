"""Semantic score of answers by greedy token alignment (A14).

Each token of an answer is matched with its most similar token of the reference (cosine of
unit token vectors), and each reference token with its most similar answer token:

    precision = sum_a w(a) * max_r cos(a, r) / sum_a w(a)
    recall    = sum_r w(r) * max_a cos(r, a) / sum_r w(r)
    f1        = 2 * precision * recall / (precision + recall)

``w`` is 1 per occurrence, or with a corpus of references its idf, ln((M + 1) / (df + 1)),
counted over the M corpus texts by one aggregate.

Tokens are words of the lower-cased text split on white space (space, 0x09 to 0x0D). A
token's vector is the row of ``vectors`` whose ``vec_id`` is its bucket: the first eight hex
digits of its MD5, as a number, modulo (largest vec_id + 1). Vectors that are null, zero or hold
a null or non-finite value are no vectors; a token without one is alike to nothing (0).

Plan: tokens are counted over all rows with a map-side combine. Weights of the most frequent
tokens and the vectors most used (``LISTED``, ``NUMBERS``) are sent to every task once, and each row
takes one matrix product in a vectorised Python step, where it stands. Only what is not
held by the tasks is joined: a row's rare tokens, each once, with their weights, and with
vectors where the tasks lack them. No pair of tokens becomes a row, and no vector
is shuffled per occurrence of a frequent token.

Edge cases: null and blank texts have no tokens, and a row with no answer or no reference
tokens scores 0, 0, 0; precision + recall = 0 gives f1 0; repeated rows each get their row;
vectors of different lengths are alike to nothing (0); values are rounded to ``DIGITS`` places.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from turnmill.scratch import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIGITS = 6
SCORES = ("precision", "recall", "f1")
LISTED = 1 << 17  # tokens whose weights are sent to every task at most, the most frequent ones
NUMBERS = 1 << 23  # numbers in the vectors sent to every task at most
SPLIT = r"[\x20\x09-\x0D]+"


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPLIT), lambda w: w != "")


def bucket(token: Column, buckets: int) -> Column:
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long") % F.lit(buckets)


def unit_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, unit): usable vectors scaled to length 1."""
    v = F.col(vec_col).cast("array<double>")
    square = F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    usable = (
        v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & (square > 0)
    )
    unit = F.transform(v, lambda x: x / F.sqrt(square))
    # Of rows with one vec_id the least vector (element by element) is taken.
    return vectors.where(usable).groupBy(F.col(id_col).alias("vec_id")).agg(F.min(unit).alias("unit"))


def _flat(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where each row's list begins, and the items of all lists."""
    items = column.flatten()
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), items


class Known:
    """Weights of listed tokens and the vectors that tasks hold. Vectors stand in columns of their
    own length, so that those of different lengths are alike to nothing."""

    def __init__(self, words: pa.Array, w: np.ndarray, vec_id: np.ndarray, ids: np.ndarray, units: pa.Array,
                 lengths: list[int]):
        self.words, self.w = words, w
        self.column = dict(zip(lengths, np.cumsum([0, *lengths])))
        self.width = sum(lengths)
        order = np.argsort(ids)
        self.ids, self.matrix = ids[order], np.zeros((len(ids) + 1, self.width))  # the last row: no vector
        self.place(self.matrix, units.take(pa.array(order)))
        self.at = self.row(vec_id)

    def place(self, matrix: np.ndarray, units: pa.Array) -> None:
        begin, values = _flat(units)
        values, sizes = values.to_numpy(zero_copy_only=False), np.diff(begin)
        for n, column in self.column.items():
            mine = np.flatnonzero(sizes == n)
            matrix[mine, column: column + n] = values[begin[mine][:, None] + np.arange(n)]

    def row(self, vec_id: np.ndarray) -> np.ndarray:
        if not len(self.ids):
            return np.zeros(len(vec_id), np.int64)
        at = np.minimum(np.searchsorted(self.ids, vec_id), len(self.ids) - 1)
        return np.where(self.ids[at] == vec_id, at, len(self.ids))

    def with_items(self, items: pa.Array | None):
        """Words, weights, rows and further vectors of a batch: what is listed, then what its rows bring along."""
        if items is None or not len(items):
            return self.words, self.w, self.at, np.zeros((0, self.width))
        first = np.unique(items.field("token").dictionary_encode().indices.to_numpy(), return_index=True)[1]
        own = items.take(pa.array(first))
        more = np.zeros((len(own), self.width))
        self.place(more, own.field("unit"))
        at = self.row(own.field("vec_id").to_numpy(zero_copy_only=False))
        brought = own.field("unit").is_valid().to_numpy(zero_copy_only=False)
        at = np.where(brought, len(self.matrix) + np.arange(len(own)), at)
        words = pa.concat_arrays([self.words, own.field("token").cast(self.words.type)])
        return words, np.append(self.w, own.field("w").to_numpy()), np.append(self.at, at), more


def _unlisted(sent):
    """(_row, tokens of both sides that are not listed, each once)."""
    def run(batches):
        for batch in batches:
            parts = []
            for name in ("a", "r"):
                begin, found = _flat(batch.column(batch.schema.get_field_index(name)))
                rare = pc.is_null(pc.index_in(found, value_set=sent.value.words.cast(found.type)))
                row = np.repeat(np.arange(batch.num_rows), np.diff(begin))[rare.to_numpy(zero_copy_only=False)]
                parts.append(pa.table({"_row": batch.column(0).take(pa.array(row)), "token": found.filter(rare).cast(pa.string())}))
            yield from pa.concat_tables(parts).group_by(["_row", "token"]).aggregate([]).to_batches()
    return run


def _aligned(sent, keys):
    def run(batches):
        known = sent.value
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            items = _flat(column("items"))[1] if "items" in batch.schema.names else None
            words, w, at, more = known.with_items(items)
            (a_begin, a), (r_begin, r) = _flat(column("a")), _flat(column("r"))
            a, r = (pc.index_in(x, value_set=words.cast(x.type)).to_numpy(zero_copy_only=False) for x in (a, r))

            def vectors(token):
                here = at[token]
                out = known.matrix[np.minimum(here, len(known.matrix) - 1)]
                beyond = here >= len(known.matrix)
                out[beyond] = more[here[beyond] - len(known.matrix)]
                return out

            out = np.zeros((batch.num_rows, 3))
            for i in range(batch.num_rows):
                ta, na = np.unique(a[a_begin[i]: a_begin[i + 1]], return_counts=True)
                tr, nr = np.unique(r[r_begin[i]: r_begin[i + 1]], return_counts=True)
                if len(ta) == 0 or len(tr) == 0:
                    continue
                wa, wr = na * w[ta], nr * w[tr]
                sim = vectors(ta) @ vectors(tr).T
                p = float(wa @ sim.max(axis=1)) / wa.sum() if wa.sum() else 0.0
                rec = float(wr @ sim.max(axis=0)) / wr.sum() if wr.sum() else 0.0
                out[i] = (p, rec, 2 * p * rec / (p + rec) if p + rec else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*map(column, keys), *map(pa.array, out.T)], [*keys, *SCORES])
    return run


def _least(counted: DataFrame, n: str, limit: int) -> int:
    """The least value of ``n`` that at most ``limit`` rows have or exceed."""
    least, total = 1 << 62, 0
    for r in counted.groupBy(n).agg(F.count("*").alias("rows")).orderBy(F.desc(n)).toLocalIterator():
        total += r["rows"]
        if total > limit:
            break
        least = r[n]
    return least


def greedy_alignment(
    answers: DataFrame,
    vectors: DataFrame,
    corpus: DataFrame | None = None,
    keys: tuple[str, ...] = ("row_id", "model"),
    listed: int = LISTED,
    numbers: int = NUMBERS,
) -> DataFrame:
    """``keys`` of every row of ``answers`` (keys, answer, reference) with precision, recall
    and f1. ``vectors`` (vec_id, embedding) gives token vectors; ``corpus`` (reference), if
    given, the texts that idf is counted over."""
    spark = answers.sparkSession
    buckets = (vectors.agg(F.max("vec_id")).first()[0] or 0) + 1
    units = stage(unit_vectors(vectors), "units")
    # Numbered once and written, so that all readers see the same numbers.
    rows = stage(answers.select(*keys, "answer", "reference").withColumn("_row", F.monotonically_increasing_id()), "answers")
    sides = [tokens(F.col("answer")).alias("a"), tokens(F.col("reference")).alias("r")]
    seen = rows.select(*sides).select(F.explode(F.concat("a", "r")).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    if corpus is None:
        weights = seen.withColumn("w", F.lit(1.0))
    else:
        # The empty token stands once for each text.
        distinct = F.concat(F.array(F.lit("")), F.array_distinct(tokens(F.col("reference"))))
        df = stage(corpus.select(F.explode(distinct).alias("token")).groupBy("token").agg(F.count("*").alias("df")), "references")
        m = (df.where("token = ''").select("df").first() or [0])[0]
        weights = seen.join(df, "token", "left").select(
            "token", "n", F.log((F.lit(m) + 1) / (F.coalesce("df", F.lit(0)) + 1)).alias("w")
        )
    table = stage(weights.withColumn("vec_id", bucket(F.col("token"), buckets)), "tokens")
    used = stage(table.groupBy("vec_id").agg(F.sum("n").alias("uses")).join(units, "vec_id"), "used")
    lengths = sorted(r[0] for r in used.select(F.size("unit")).distinct().collect())
    common = _least(table, "n", listed)
    often = _least(used, "uses", numbers // max(sum(lengths), 1))
    held, lacking = used.where(F.col("uses") >= often).toArrow(), used.where(F.col("uses") < often)
    few = lacking.select("vec_id", "unit")
    words = table.where(F.col("n") >= common).join(few.select("vec_id"), "vec_id", "left_anti").toArrow()
    rare = table.join(few, "vec_id", "left").where((F.col("n") < common) | F.col("unit").isNotNull())
    sent = spark.sparkContext.broadcast(Known(
        words["token"].combine_chunks(), words["w"].to_numpy(), words["vec_id"].to_numpy(),
        held["vec_id"].to_numpy(), held["unit"].combine_chunks(), lengths))
    texts = rows.select(*keys, *sides)
    if not rare.isEmpty():
        items = (
            rows.select("_row", *sides).mapInArrow(_unlisted(sent), "_row long, token string").join(rare, "token")
            .groupBy("_row").agg(F.collect_list(F.struct("token", "w", "vec_id", "unit")).alias("items"))
        )
        texts = rows.join(items, "_row", "left").select(*keys, *sides, "items")
    schema = StructType([*texts.select(*keys).schema, *[StructField(c, DoubleType()) for c in SCORES]])
    out = texts.mapInArrow(_aligned(sent, keys), schema)
    return out.select(*keys, *[F.round(c, DIGITS).alias(c) for c in SCORES])
