"""Exact near-duplicate groups by word shingles: a parity-sketch join.

A document is its set of distinct word shingles. Sets of equal size class share a
number of blocks ``m``; every shingle flips bits of one block, chosen by its hash. A
block is kept as the XOR of its shingles' 64-bit hashes, and the whole sketch once more as
single bits, one flipped per shingle, four to eight bits for each. A shingle that only one
of two sets holds changes one block and one bit at most, so both the number of unequal
blocks and the Hamming distance of the bits are lower bounds of the symmetric difference.
Bits fold to half their number by XOR, so that sketches of unequal sizes compare.

Two sets of sizes a and b link at similarity 0.8 only if they differ in at most
``(a + b) / 9`` shingles, and then in at most ``d = a / 4`` blocks. Hence (pigeonhole):

* a set all but ``m - d`` of whose blocks are found in no other set links with nothing;
* with blocks in one order for all, rare ones first, the first ``d + 1`` of both sets
  share an equal block.

Equal sets are one class from the start. Classes that share such a block are candidates:
those whose bits differ too much are dropped, the rest are verified on the
sets themselves. Every block first proposes a single partner, its hub, to each of its
classes, a few times over with other hubs; what the hubs have joined needs no comparing
any more, so that a group of thousands of near copies costs its size and not its square.
Pairs that still share a block across components are then compared by their sketches,
chunk against chunk inside the block's bucket, and those near enough verified, which makes
the result exact. Only pairs near enough ever leave a task.

Size classes are ``[2^j, 2^(j+1))``. A set in the lowest quarter of its class may link
with one of the class below, and is sketched with that class's blocks as well.

Edge cases: a null or empty text, or one without words, has no shingles and is linked
with nothing; with fewer words than a shingle, the whole sequence is the only one. A row
with a null ``doc_id`` takes part like any other; the smallest id of a component is taken
over those that are not null. Rows with one ``doc_id`` but unequal texts are linked by
their texts only. Further columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from turnmill.llm import kernels
from turnmill.scratch import drop, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
HUB_ROUNDS = 2
CHUNK = 512
SLICE = 512 << 10  # bytes of text whose blocks leave Python at once
_U = np.uint64
_SALT = _U(0xA24BAED4963EE407)


def shingle_sets(t: kernels.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and where each begins."""
    grams, begin = t.ngrams(SHINGLE)
    row = np.searchsorted(t.words[2], begin, "right") - 1
    short = np.flatnonzero((t.n_words > 0) & (t.n_words < SHINGLE))
    if len(short):
        whole = []
        for i in short:
            value = 1
            for h in t.word_hash[t.words[2][i]: t.words[2][i + 1]]:
                value = (value * 0x9E3779B97F4A7C15 + int(h) + 1) % (1 << 64)
            whole.append(value)
        grams = np.concatenate([grams, kernels.mix(np.array(whole, _U))])
        row = np.concatenate([row, short])
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    if len(grams):
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
        grams, row = grams[new], row[new]
    return grams, np.searchsorted(row, np.arange(t.rows + 1))


def set_keys(grams: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for a whole set."""
    a, b = np.zeros(len(at) - 1, _U), np.zeros(len(at) - 1, _U)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        a[full] = np.bitwise_xor.reduceat(kernels.mix(grams + _SALT), at[full])
        b[full] = np.add.reduceat(kernels.mix(grams ^ _SALT), at[full])
    return a, b


def blocks_of(level: int) -> int:
    """Blocks of the sets of size ``2^level`` to ``2^(level + 1) - 1``: a fifth more than
    the largest of them may differ in."""
    return (6 << level) // 10 + 2


def block_words(grams: np.ndarray, m: int) -> np.ndarray:
    """XOR of the hashes that fall in each of ``m`` blocks."""
    words = np.zeros(m, _U)
    if len(grams):
        block = ((grams >> _U(32)) * _U(m)) >> _U(32)
        order = np.argsort(block, kind="stable")
        starts = np.flatnonzero(np.diff(block[order], prepend=_U(m)))
        words[block[order][starts]] = np.bitwise_xor.reduceat(kernels.mix(grams[order]), starts)
    return words


def parities(grams: np.ndarray) -> np.ndarray:
    """The sketch as bits: the parity of the shingles at each place. It has four to eight
    bits for every shingle, in words of 64."""
    size = max(256, 4 << len(grams).bit_length())
    odd = np.bincount((grams & _U(size - 1)).astype(np.int64), minlength=size).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def fold(words: np.ndarray, size: int) -> np.ndarray:
    """A sketch at a smaller size: places that fall together add up."""
    return np.bitwise_xor.reduce(words.reshape(-1, size), 0)


def near_enough(apart: np.ndarray, n: np.ndarray, m) -> np.ndarray:
    """Whether sets of sizes n and m, whose sketches are so far apart, may link."""
    return (9 * apart <= n + m) & (5 * np.minimum(n, m) >= 4 * np.maximum(n, m))


def _lists(column: pa.Array) -> list[np.ndarray]:
    values, at = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
    return [values[a:b] for a, b in zip(at[:-1], at[1:])]


def _sketch(batches):
    for batch in batches:
        for part in kernels.slices(batch):
            t = kernels.texts(part, lower=True)
            grams, at = shingle_sets(t)
            a, b = set_keys(grams, at)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(at)), pa.array(kernels.signed(a)),
                 pa.array(kernels.signed(b))],
                ["doc_id", "n_shingles", "ka", "kb"])


def levels_of(n: int) -> list[int]:
    """Size classes whose blocks a set of ``n`` shingles is cut into: its own, and the one
    below if it may link with a set there."""
    level = n.bit_length() - 1
    return [level, level - 1] if level and 4 * n <= 5 << level else [level]


def _signatures(batches):
    """Rows (owner, sig): a class's blocks. ``owner`` is twice the class id, plus one for
    the sketch of the size class below."""
    for batch in batches:
        for part in kernels.slices(batch, limit=SLICE):
            t = kernels.texts(part, lower=True)
            grams, at = shingle_sets(t)
            a, b = set_keys(grams, at)
            good = ((a == part.column(2).to_numpy().view(_U))
                    & (b == part.column(3).to_numpy().view(_U)) & (np.diff(at) > 0))
            ids = part.column(0).to_numpy()
            owners, sizes, sigs = [], [], []
            for i in np.flatnonzero(good):
                own = grams[at[i]: at[i + 1]]
                for below, j in enumerate(levels_of(len(own))):
                    m = blocks_of(j)
                    place = kernels.mix(np.arange(m, dtype=_U) + _U(m << 34))
                    owners.append(2 * ids[i] + below)
                    sizes.append(m)
                    sigs.append(kernels.mix(block_words(own, m) ^ place))
            if sigs:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(owners, sizes)), pa.array(kernels.signed(np.concatenate(sigs))),
                ], ["owner", "sig"])


def _candidate_sets(batches):
    for batch in batches:
        for part in kernels.slices(batch):
            t = kernels.texts(part, lower=True)
            grams, at = shingle_sets(t)
            a, b = set_keys(grams, at)
            good = np.flatnonzero((a == part.column(2).to_numpy().view(_U))
                                  & (b == part.column(3).to_numpy().view(_U)))
            own = [grams[at[i]: at[i + 1]] for i in good]
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(pa.array(good)),
                pa.array([kernels.signed(g) for g in own], pa.list_(pa.int64())),
                pa.array([parities(g) for g in own], pa.list_(pa.int64())),
            ], ["id", "grams", "bits"])


def _verify(batches):
    """Pairs whose sets link."""
    for batch in batches:
        left, right = batch.column(2), batch.column(3)
        keep = []
        for i in range(batch.num_rows):
            x, y = left[i].values.to_numpy(), right[i].values.to_numpy()
            both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
            keep.append(100 * both >= 80 * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1)], ["x", "y"]).filter(pa.array(keep, pa.bool_()))


def _near_in_buckets(batches):
    """Pairs of one bucket, from different components, that their sketches allow to link.

    Rows come sorted by bucket; the members of one are compared a block of sketches at a
    time. A bucket is at most two chunks of ``CHUNK`` members.
    """
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])

    def pairs(ids, groups, sizes, sketches):
        x, y = [], []
        least = min(map(len, sketches))
        bits = np.stack([fold(k, least) for k in sketches]).view(_U)
        for i in range(len(ids) - 1):
            rest = slice(i + 1, None)
            good = groups[rest] != groups[i]
            if not good.any():
                continue
            apart = np.bitwise_count(bits[rest] ^ bits[i]).sum(1, dtype=np.int64)
            good &= near_enough(apart, sizes[rest], sizes[i])
            found = np.flatnonzero(good) + i + 1
            x.append(np.minimum(ids[i], ids[found]))
            y.append(np.maximum(ids[i], ids[found]))
        return (np.concatenate(x), np.concatenate(y)) if x else (np.zeros(0, np.int64),) * 2

    held = None
    for batch in batches:
        held = batch if held is None else pa.concat_batches([held, batch])
        keys = [held.column(i).to_numpy() for i in range(3)]
        new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], 0)) + 1
        if not len(new):
            continue
        yield from _blocks_out(held, np.append(0, new), pairs, schema)
        held = held.slice(int(new[-1]))
    if held is not None and held.num_rows:
        yield from _blocks_out(held, np.array([0, held.num_rows]), pairs, schema)


def _blocks_out(batch, bounds, pairs, schema):
    ids, groups, sizes = (batch.column(i).to_numpy() for i in (3, 4, 5))
    bits = _lists(batch.column(6))
    out = [pairs(ids[a:b], groups[a:b], sizes[a:b], bits[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    x, y = (np.concatenate(v) for v in zip(*out))
    if len(x):
        both = np.unique(np.stack([x, y]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], schema=schema)


def _left_apart(member: DataFrame, sets: DataFrame) -> DataFrame:
    """Candidate pairs (x, y) across the components that a bucket still holds.

    A frequent bucket is cut into chunks, and every pair of chunks is a piece of work of
    its own: no task holds more than two chunks, and none but the pairs near enough
    leave it.
    """
    size = member.groupBy("sig").agg(
        F.count(F.lit(1)).alias("size"), F.min("g").alias("low"), F.max("g").alias("high"))
    split = size.where("low <> high").select("sig", F.ceil(F.col("size") / CHUNK).cast("int").alias("chunks"))
    chunk = F.pmod(F.hash("id"), F.col("chunks"))
    spread = (
        member.join(split, "sig").withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("sig", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"), "id", "g")
    )
    bits = sets.select("id", F.size("grams").cast("long").alias("n"), "bits")
    return (
        spread.join(bits, "id").repartition("sig", "a", "b").sortWithinPartitions("sig", "a", "b")
        .select("sig", "a", "b", "id", "g", "n", "bits")
        .mapInArrow(_near_in_buckets, "x long, y long").distinct()
    )


def _near_pairs(batches):
    for batch in batches:
        nx, ny = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        apart = []
        for x, y in zip(_lists(batch.column(4)), _lists(batch.column(5))):
            least = min(len(x), len(y))
            apart.append(int(np.bitwise_count((fold(x, least) ^ fold(y, least)).view(_U)).sum()))
        good = near_enough(np.array(apart, np.int64), nx, ny)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["x", "y"]).filter(pa.array(good))


def _near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (x, y) that their sketches allow to link."""
    bits = sets.select("id", "bits", F.size("grams").cast("long").alias("n"))
    return (
        pairs.join(bits.select(F.col("id").alias("x"), F.col("bits").alias("bx"), F.col("n").alias("nx")), "x")
        .join(bits.select(F.col("id").alias("y"), F.col("bits").alias("by"), F.col("n").alias("ny")), "y")
        .where(5 * F.least("nx", "ny") >= 4 * F.greatest("nx", "ny"))
        .select("x", "y", "nx", "ny", "bx", "by").mapInArrow(_near_pairs, "x long, y long")
    )


def _linked(near: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (x, y) whose sets link."""
    full = (
        near.join(sets.select(F.col("id").alias("x"), F.col("grams").alias("gx")), "x")
        .join(sets.select(F.col("id").alias("y"), F.col("grams").alias("gy")), "y")
        .select("x", "y", "gx", "gy")
    )
    return full.mapInArrow(_verify, "x long, y long")


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id of an edge that links two.

    Rounds of large-star and small-star: ids are linked to the smallest id near them
    until nothing changes. Every round is written to the shared folder; the driver sees
    a count and a checksum.
    """
    both = edges.where("x <> y")
    both = stage(both.select("x", "y").distinct(), "edges")
    seen = None
    while True:
        near = both.union(both.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = near.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
        large = near.where("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = large.where("x <> y").distinct()
        down = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(down, "x").select(
            F.when(F.col("y") == F.col("m"), F.col("x")).otherwise(F.col("y")).alias("x"),
            F.col("m").alias("y"))
        after = stage(small.where("x <> y").distinct(), "edges")
        state = after.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(x, y))")).first()
        drop(both)
        both = after
        if state == seen:
            break
        seen = state
    return both.groupBy("x").agg(F.min("y").alias("component")).select(F.col("x").alias("id"), "component")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, ka, kb) of every row; ``ka`` and ``kb`` are the
    key of its shingle set."""
    texts = kernels.small_batches(docs, 250).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stage(texts.mapInArrow(_sketch, "doc_id long, n_shingles long, ka long, kb long"), "keys")
    # One class per distinct set; its first id names it.
    classes = (
        rows.where("n_shingles > 0 and doc_id is not null").groupBy("ka", "kb")
        .agg(F.min("doc_id").alias("id"), F.min("n_shingles").alias("n_shingles"))
    )
    classes = stage(classes, "classes")
    named = classes.select(F.col("id").alias("doc_id"), "ka", "kb")
    firsts = texts.join(named, "doc_id").select("doc_id", "text", "ka", "kb")
    signatures = firsts.mapInArrow(_signatures, "owner long, sig long")
    counted = signatures.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("sig")))
    shared = stage(counted.where("df > 1"), "shared")
    n, below = F.col("n_shingles"), F.col("owner") % 2
    level = F.length(F.bin("n_shingles")) - 1 - F.abs(below).cast("int")
    m = F.floor(F.pow(F.lit(2.0), level) * 6 / 10).cast("long") + 2
    held = (
        shared.groupBy("owner").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("blocks"))
        .withColumn("id", F.floor((F.col("owner") - F.pmod("owner", F.lit(2))) / 2))
        .join(classes.select("id", "n_shingles"), "id")
        .withColumns({"reach": F.floor(n / 4), "unique": m - F.size("blocks")})
    )
    prefix = held.where("unique <= reach").select(
        "id", F.explode(F.slice("blocks", F.lit(1), F.expr("cast(reach + 1 - unique as int)"))).alias("b"))
    buckets = stage(prefix.select("id", F.col("b.sig").alias("sig")), "buckets")
    drop(shared)
    wanted = buckets.select(F.col("id").alias("doc_id")).distinct().join(named, "doc_id")
    sets = stage(
        texts.join(wanted, "doc_id").select("doc_id", "text", "ka", "kb")
        .mapInArrow(_candidate_sets, "id long, grams array<long>, bits array<long>")
        .dropDuplicates(["id"]), "sets")

    links, groups, done = None, None, [buckets, sets]
    member = buckets.withColumn("g", F.col("id"))
    for round_ in range(HUB_ROUNDS):
        # Each block proposes one hub; other hubs in every round.
        order = F.xxhash64(F.col("id"), F.lit(round_))
        hubs = member.groupBy("sig").agg(
            F.min_by("id", order).alias("hub"), F.min_by("g", order).alias("hub_g"))
        pairs = member.join(hubs, "sig").where("g <> hub_g").select(
            F.least("id", "hub").alias("x"), F.greatest("id", "hub").alias("y")).distinct()
        found = stage(_linked(_near(pairs, sets), sets), "links")
        links = found if links is None else links.union(found)
        groups = stage(components(links), "groups")
        done += [found, groups]
        member = buckets.join(groups, "id", "left").select(
            "id", "sig", F.coalesce("component", "id").alias("g"))
    member = stage(member, "members")
    found = stage(_linked(_left_apart(member, sets), sets), "links")
    groups = stage(components(links.union(found)), "groups")
    drop(*done, member, found)
    named = classes.join(groups, "id", "left").select(
        "ka", "kb", F.coalesce("component", "id").alias("component_id"))
    return rows.join(named, ["ka", "kb"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "ka", "kb")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest id; every column as it was.

    Rows without words stay, as they link with nothing. Of repeated rows of the document
    that stays, one is kept.
    """
    found = near_duplicates(docs).where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(found, "doc_id", "left_anti")
    return kept.dropDuplicates(["doc_id", "text"])


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(kernels.documents(spark, sf_dir)).select(
        "doc_id", "n_shingles", "component_id")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP1_SQL = rf"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                    '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select distinct doc_id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') as gram
  from (select doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (
  select a.doc_id as x, b.doc_id as y, count(*) as cnt
  from s a join s b on a.gram = b.gram and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
l as (
  select x, y from c join n nx on nx.doc_id = x join n ny on ny.doc_id = y
  where 100 * cnt >= 80 * (nx.n + ny.n - cnt)),
reach as (
  select doc_id, doc_id as other from w
  union
  select l.x as doc_id, reach.other from reach join l on l.y = reach.doc_id)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, min(other)::bigint as component_id
from w join reach using (doc_id) left join n using (doc_id) group by w.doc_id, n.n"""
