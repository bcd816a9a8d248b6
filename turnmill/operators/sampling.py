"""Shuffled order, dedup, splits and heads.

The shuffled order is the order of a hash of seed and row key. It needs no sort until
something asks for its first rows, and it is the same for any partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from turnmill import config
from turnmill.functions.text import strip

SPLITS = ("train", "validation", "test")


def order_hash(seed: int, row_id: str = "row_id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(row_id).cast("string")))


def dedup_key(column: str = "instruction") -> Column:
    """Rows with the same key are repeats: the text, stripped and lower-cased."""
    return F.lower(strip(F.col(column)))


def dedup(df: DataFrame, seed: int = 42, column: str = "instruction",
          row_id: str = "row_id") -> DataFrame:
    """Keep the first row of each key in shuffled order.

    Rows are grouped by a 32-byte digest of the key, so that long texts are not moved
    and compared twice. Spark keeps one row per key in every map task before the
    exchange, which also takes the weight out of a key that very many rows share.
    """
    first = Window.partitionBy("_key").orderBy("_order", row_id)
    return (
        df.withColumn("_key", F.unhex(F.sha2(dedup_key(column), 256)))
        .withColumn("_order", F.unhex(order_hash(seed, row_id)))
        .withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") == 1)
        .drop("_key", "_order", "_rank")
    )


# ---------------------------------------------------------------------------
# Exact split
# ---------------------------------------------------------------------------

_DIGITS = 3  # hex digits resolved per pass: at most 4,096 counts per group
_SMALL = 20_000  # rows of one bucket that may be listed


def _locate(keys: DataFrame, ranks_of) -> tuple[dict, dict]:
    """Find rows by their 1-based rank in (hash, row_id) order, inside groups.

    ``keys`` holds (g, h, row_id). ``ranks_of`` gets the group sizes and returns the
    (group, rank) pairs wanted. Returns the sizes and a map from each pair to its
    (hash, row_id).

    Each pass counts rows by the next hash digits inside the bucket that holds a rank;
    counts are combined on the map side, and the driver sees at most 4,096 per group.
    Hash values are uniform, so a bucket is 4,096 times smaller after every pass, until
    its rows can be listed.
    """
    def bucket(digits: int) -> Column:
        return F.substring("h", 1, digits)

    def within(digits: int, buckets) -> DataFrame:
        return keys.where(F.concat("g", F.lit("/"), bucket(digits)).isin(
            sorted(f"{g}/{b}" for g, b in buckets)
        ))

    def ordered_counts(rows) -> dict:
        counts: dict = {}
        for r in sorted(rows):
            counts.setdefault(r[0], []).append(tuple(r[1:]))
        return counts

    depth = _DIGITS
    counted = F.count(F.lit(1)).alias("n")
    counts = ordered_counts(keys.groupBy("g", bucket(depth).alias("b")).agg(counted).collect())
    sizes = {g: sum(n for _, n in buckets) for g, buckets in counts.items()}
    wanted = {pair: (pair[1], "") for pair in ranks_of(sizes)}  # rank inside, bucket
    found = {}
    while wanted:
        small = {}
        for pair, (inside, prefix) in wanted.items():
            for name, n in counts[pair[0]]:
                if name.startswith(prefix):
                    if inside <= n:
                        wanted[pair] = (inside, name)
                        if n <= _SMALL or depth >= 32:
                            small[pair] = (inside, name)
                        break
                    inside -= n
            else:
                raise RuntimeError("rows changed between counting passes")
        if small:
            rows = ordered_counts(
                within(depth, {(pair[0], name) for pair, (_, name) in small.items()})
                .groupBy("g", "h", "row_id").agg(counted).collect()
            )
            for pair, (inside, name) in small.items():
                for h, row_id, n in rows.get(pair[0], []):
                    if h.startswith(name):
                        inside -= n
                        if inside <= 0:
                            found[pair] = (h, row_id)
                            break
                else:
                    raise RuntimeError("rows changed between counting passes")
                del wanted[pair]
        if wanted:
            scope = within(depth, {(pair[0], name) for pair, (_, name) in wanted.items()})
            depth += _DIGITS
            counts = ordered_counts(
                scope.groupBy("g", bucket(depth).alias("b")).agg(counted).collect()
            )
    return sizes, found


def _upto(bound: tuple, order: str, row_id: str) -> Column:
    h, key = bound
    at = F.col(order)
    return (at < h) | ((at == h) & (F.col(row_id) <= F.lit(key)))


def split_counts(n: int, params: config.CurateParams | None = None) -> tuple[int, int]:
    """Rows held out of training, and test rows among them; both rounded up."""
    p = params or config.CurateParams()
    holdout = math.ceil(n * p.holdout_share)
    return holdout, math.ceil(holdout * p.test_share)


def _split_by(df: DataFrame, params: config.CurateParams | None, row_id: str,
              caps: dict[str, int] | None) -> DataFrame:
    """Splits, and with ``caps`` only the first rows of the splits named there.

    All rows wanted have a rank over the whole input: test rows come first, then
    validation, then train. One lookup finds every bound.
    """
    p = params or config.CurateParams()
    order = order_hash(p.split_seed, row_id)
    keys = df.select(F.lit("all").alias("g"), order.alias("h"), F.col(row_id).alias("row_id"))

    def ranks(n: int) -> tuple[int, int, dict[str, int]]:
        holdout, test = split_counts(n, p)
        begins = {"test": (0, test), "validation": (test, holdout), "train": (holdout, n)}
        lasts = {s: min(begins[s][0] + max(c, 0), begins[s][1]) for s, c in (caps or {}).items()}
        return holdout, test, lasts

    def ranks_of(sizes: dict) -> list:
        n = sizes.get("all", 0)
        holdout, test, lasts = ranks(n)
        return [("all", rank) for rank in {holdout, test, *lasts.values()} if 0 < rank < n]

    sizes, bounds = _locate(keys, ranks_of)
    n = sizes.get("all", 0)
    holdout, test, lasts = ranks(n)

    def upto(rank: int) -> Column:
        if not rank:
            return F.lit(False)
        return F.lit(True) if rank >= n else _upto(bounds["all", rank], "split_order", row_id)

    split = df.withColumn("split_order", order).withColumn(
        "split",
        F.when(upto(test), "test").when(upto(holdout), "validation").otherwise("train"),
    )
    if caps is None:
        return split
    kept = F.lit(False)
    for name, last in lasts.items():
        kept = kept | ((F.col("split") == name) & upto(last))
    return split.where(kept)


def split_exact(df: DataFrame, params: config.CurateParams | None = None,
                row_id: str = "row_id") -> DataFrame:
    """Add ``split`` with exact sizes, and ``split_order``, the order inside a split.

    The two rows where the split changes are looked up first (small counting jobs
    over two columns of ``df``, which should be a table or staged). Giving every row
    its split is then a comparison with two constants: no row moves, and no window
    runs over the whole data.
    """
    return _split_by(df, params, row_id, None)


def split_first(df: DataFrame, caps: dict[str, int], params: config.CurateParams | None = None,
                row_id: str = "row_id") -> DataFrame:
    """``split_exact``, and of it the first rows of each split named in ``caps``; other
    splits drop out. One lookup serves both."""
    return _split_by(df, params, row_id, caps)


_DRAWS = 1 << 32  # values of the 32 hash bits that decide a split


def split_hashed(df: DataFrame, params: config.CurateParams | None = None,
                 row_id: str = "row_id") -> DataFrame:
    """Add ``split`` by hash: sizes are approximate, one pass, and a row never changes its
    split when data is added. Shares may be as small as one in some billions; ``bucket``
    is a hundredth of the rows, for sampling, and has no part in the split."""
    p = params or config.CurateParams()
    draw = F.conv(F.substring(order_hash(p.split_seed, row_id), 1, 8), 16, 10).cast("long")
    test = round(_DRAWS * p.holdout_share * p.test_share)
    holdout = round(_DRAWS * p.holdout_share)
    return df.withColumn("bucket", draw % 100).withColumn(
        "split",
        F.when(draw < test, "test").when(draw < holdout, "validation").otherwise("train"),
    )


# ---------------------------------------------------------------------------
# First rows of splits
# ---------------------------------------------------------------------------


def first_of_splits(df: DataFrame, caps: dict[str, int], row_id: str = "row_id") -> DataFrame:
    """The first rows of each named split in split order, up to the cap given for it;
    other splits drop out.

    The last row to keep is looked up by counting, and the rest is a filter: no task
    gathers candidates from all others.
    """
    keys = df.where(F.col("split").isin(list(caps))).select(
        F.col("split").alias("g"), F.col("split_order").alias("h"), F.col(row_id).alias("row_id")
    )
    sizes, bounds = _locate(keys, lambda sizes: [
        (split, caps[split]) for split in sizes if 0 < caps[split] < sizes[split]
    ])
    kept = F.lit(False)
    for split, cap in caps.items():
        inside = F.col("split") == split
        if (split, cap) in bounds:
            inside = inside & _upto(bounds[split, cap], "split_order", row_id)
        if cap > 0:
            kept = kept | inside
    return df.where(kept)


def evaluation_sample(df: DataFrame, n: int = config.EVAL_SAMPLES, row_id: str = "row_id") -> DataFrame:
    """The first ``n`` test rows, in order, of rows that have their split."""
    return in_order(first_of_splits(df, {"test": n}, row_id), n, row_id)


def in_order(df: DataFrame, n: int, row_id: str = "row_id") -> DataFrame:
    """At most ``n`` rows in split order: a limit, so that no pass samples for a sort."""
    return df.orderBy("split_order", row_id).limit(n)


def training_subset(df: DataFrame, params: config.TrainParams | None = None,
                    row_id: str = "row_id") -> DataFrame:
    """The capped training and validation rows of one run."""
    p = params or config.TrainParams()
    return first_of_splits(df, {"train": p.train_cap, "validation": p.validation_cap}, row_id)


def first_examples(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """The first row of every split."""
    return first_of_splits(df, {split: 1 for split in SPLITS}, row_id)
