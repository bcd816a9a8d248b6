"""Approximate nearest neighbours by cosine: robust-pruned graphs, one per shard.

Equal vectors are one point that carries its smallest ids, as many as a result can hold;
a vector that a third of all rows share is therefore one point as well. Points go to
shards of bounded size by a hash. In each shard points are put into a directed graph,
a batch at a time: a greedy search for the point proposes what it passed as neighbours, and
pruning keeps of them, nearest first, those that no neighbour kept before is nearer to by
the factor ``relax``. Edges are added in the other direction too, and lists that grow too
long are pruned alike. Relaxed pruning leaves long edges, so that searches need few steps.

Queries are cut into blocks; every block searches every shard by a beam search from the
shard's medoid, and the best of all shards are merged. Blocks and shards meet in a cross
join of two small tables, so that no shuffle holds a copy of the queries for every shard and
a task holds a bounded run of blocks, whatever their number. The beam works on unit vectors in
single precision; what it returns is measured again on the original vectors in double.
Vectors of floats are kept as floats up to there.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no
part, nor do those of another length than most; null ids take no part; repeated rows of
one id and vector count once; fewer candidates than wanted give fewer rows; further columns
are ignored; an empty table gives an empty table. Ties go to the smaller id.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, FloatType

from turnmill.llm import kernels
from turnmill.scratch import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

K = 5
SHARD_POINTS = 4096
QUERY_BLOCK = 512
RUN_BLOCKS = 64  # blocks of queries a task holds
DEGREE = 32
BEAM = 64
RELAX = 1.2
_STEP = 4  # points a search expands at once


def search(points: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int):
    """Beam search of all queries at once: best ids and cosines, and what was expanded."""
    n, count = len(points), len(queries)
    ids = np.full((count, beam), -1)
    sims = np.full((count, beam), -np.inf, np.float32)
    done = np.ones((count, beam), bool)
    ids[:, 0], sims[:, 0], done[:, 0] = start, queries @ points[start], False
    seen = np.zeros((count, n + 1), bool)
    seen[:, start] = seen[:, n] = True
    passed = []
    rows = np.arange(count)
    while len(rows):
        open_ = np.where(done[rows], -np.inf, sims[rows])
        best = np.argpartition(-open_, _STEP - 1, 1)[:, :_STEP]
        usable = np.take_along_axis(open_, best, 1) > -np.inf
        rows, best, usable = rows[usable.any(1)], best[usable.any(1)], usable[usable.any(1)]
        if not len(rows):
            break
        done[rows[:, None], best] |= usable
        at = np.where(usable, ids[rows[:, None], best], -1)
        passed.append((rows, at))
        near = np.where((at >= 0)[:, :, None], graph[at], n).reshape(len(rows), -1)
        near[near < 0] = n
        fresh = ~seen[rows[:, None], near]
        seen[rows[:, None], near] = True
        # A point named twice in one step counts once.
        order = np.argsort(near, 1, kind="stable")
        ranked = np.take_along_axis(near, order, 1)
        twice = np.zeros_like(fresh)
        np.put_along_axis(twice, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], 1)
        fresh &= ~twice
        found = np.einsum("bmd,bd->bm", points[np.minimum(near, n - 1)], queries[rows])
        found = np.where(fresh, found, -np.inf).astype(np.float32)
        all_sims = np.concatenate([sims[rows], found], 1)
        top = np.argpartition(-all_sims, beam - 1, 1)[:, :beam]
        sims[rows] = np.take_along_axis(all_sims, top, 1)
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], near], 1), top, 1)
        done[rows] = np.take_along_axis(np.concatenate([done[rows], ~fresh], 1), top, 1)
    return ids, sims, passed


def prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """At most ``degree`` diverse neighbours of each point, nearest first; -1 is none."""
    count = len(own)
    candidates = np.sort(candidates, 1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    candidates[candidates == own[:, None]] = -1
    vectors = points[np.maximum(candidates, 0)]
    far = 2 - 2 * np.einsum("bmd,bd->bm", vectors, points[own])
    far = np.where(candidates < 0, np.inf, far)
    alive = candidates >= 0
    out = np.full((count, degree), -1)
    rows = np.arange(count)
    for slot in range(degree):
        pick = np.argmin(np.where(alive, far, np.inf), 1)
        good = alive[rows, pick]
        if not good.any():
            break
        out[good, slot] = candidates[rows, pick][good]
        between = 2 - 2 * np.einsum("bmd,bd->bm", vectors, vectors[rows, pick])
        alive &= (relax * relax * between > far) | ~good[:, None]
        alive[rows, pick] = False
    return out


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, relax: float = RELAX,
          seed: int = 5) -> tuple[np.ndarray, int]:
    """Graph over unit vectors, and the point where searches start."""
    n = len(points)
    start = int(np.argmax(points @ points.mean(0)))
    graph = np.full((n + 1, degree), -1)
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    first = order[: degree + 1]
    for p in first:
        graph[p, : len(first) - 1] = first[first != p]
    at = len(first)
    while at < n:
        batch = order[at: at + min(max(at // 4, 32), 384)]
        ids, _, passed = search(points, graph, start, points[batch], beam)
        lists = [ids]
        for rows, expanded in passed:
            some = np.full((len(batch), expanded.shape[1]), -1)
            some[rows] = expanded
            lists.append(some)
        kept = prune(points, batch, np.where(np.concatenate(lists, 1) < n, np.concatenate(lists, 1), -1),
                     degree, relax)
        graph[batch] = kept
        # The same edges in the other direction.
        source, slot = np.nonzero(kept >= 0)
        target, source = kept[source, slot], batch[source]
        by = np.argsort(target, kind="stable")
        target, source = target[by], source[by]
        own, begin, size = np.unique(target, return_index=True, return_counts=True)
        more = np.full((len(own), int(size.max(initial=0))), -1)
        place = np.arange(len(target)) - np.repeat(begin, size)
        more[np.repeat(np.arange(len(own)), size), place] = source
        for low in range(0, len(own), 512):
            some = own[low: low + 512]
            graph[some] = prune(points, some, np.concatenate([graph[some], more[low: low + 512]], 1), degree, relax)
        at += len(batch)
    return graph[:n], start


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    top = np.abs(wide).max(1, keepdims=True)
    wide /= top
    return (wide / np.sqrt((wide * wide).sum(1, keepdims=True))).astype(np.float32)


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def _index(table: pa.Table) -> pa.Table:
    """One row for a shard: its points, their ids, their graph."""
    table = table.sort_by([("id", "ascending"), ("key", "ascending")])
    vectors = _matrix(table.column("vector"))
    graph, start = build(_unit(vectors))
    return pa.table({
        "shard": table.column("shard")[:1], "start": pa.array([start]),
        "vectors": pa.array([vectors.ravel()], pa.list_(table.schema.field("vector").type.value_type)),
        "graph": pa.array([graph.astype(np.int32).ravel()], pa.list_(pa.int32())),
        "ids": pa.array([table.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))),
    })


def _search_shards(k: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                start, count = batch.column(0)[i].as_py(), len(batch.column(3)[i])
                vectors = batch.column(1)[i].values.to_numpy().reshape(count, -1)
                graph = batch.column(2)[i].values.to_numpy().reshape(count, -1).astype(np.int64)
                graph = np.concatenate([graph, np.full((1, graph.shape[1]), -1)])
                names = batch.column(3)[i].as_py()
                asked = batch.column(4)[i].values.to_numpy()
                wanted = batch.column(5)[i].values.flatten().to_numpy().reshape(len(asked), -1)
                beam = max(BEAM, 4 * (k + 1))
                ids, _, _ = search(_unit(vectors), graph, start, _unit(wanted), beam)
                out = ([], [], [])
                for q, found in enumerate(ids):
                    found = found[(found >= 0) & (found < count)]
                    score = cosine(vectors[found], wanted[q])
                    rows = [(-s, v) for s, f in zip(score.tolist(), found) for v in names[f] if v != asked[q]]
                    for s, v in sorted(rows)[:k]:
                        for column, value in zip(out, (asked[q], v, -s)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                    ["query_id", "vec_id", "score"])
    return run


def cosine(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines in double precision; each depends on its two vectors alone."""
    a, b = vectors.astype(np.float64), query.astype(np.float64)
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum()))


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query: Column, k: int = K, shard_points: int = SHARD_POINTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every query.

    ``vectors`` holds (vec_id, embedding); ``is_query`` marks the queries by ``vec_id``.
    """
    given = vectors.select("embedding").schema[0].dataType
    single = isinstance(given, ArrayType) and isinstance(given.elementType, FloatType)
    held = "array<float>" if single else "array<double>"
    wide = F.col("vector").cast("array<double>")
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(held).alias("vector"))
    most = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("vector") == (most["d"] if most else 0))
    keyed = rows.withColumn("key", F.xxhash64(wide))
    # The k + 1 smallest ids of each distinct vector: one of them may be the query's own.
    ids = Window.partitionBy("key", "vector").orderBy("vec_id")
    points = stage(
        keyed.withColumn("n", F.dense_rank().over(ids)).where(F.col("n") <= k + 1)
        .groupBy("key", "vector").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
        .select("key", "vector", "ids", F.col("ids")[0].alias("id")), "points")
    shards = max(1, -(-points.count() // shard_points))
    shard = F.pmod(F.xxhash64("id", "key"), F.lit(shards)).cast("int")
    index = stage(
        points.withColumn("shard", shard).groupBy("shard").applyInArrow(
            _index, f"shard int, start long, vectors {held}, graph array<int>, ids array<array<long>>"),
        "index")
    asked = stage(rows.where(is_query).dropDuplicates(), "asked")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = (
        asked.groupBy(F.pmod(F.xxhash64("vec_id", wide), F.lit(blocks)).alias("block"))
        .agg(F.collect_list("vec_id").alias("asked"), F.collect_list("vector").alias("wanted"))
        .repartition(-(-blocks // RUN_BLOCKS))
    )
    found = index.crossJoin(asked).select("start", "vectors", "graph", "ids", "asked", "wanted").mapInArrow(
        _search_shards(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(kernels.documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
