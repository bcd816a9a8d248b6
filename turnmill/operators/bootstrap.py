"""Resampled means in one pass: a Poisson bootstrap with hash weights.

A bootstrap replicate draws the examples again with replacement; for many examples the
number of times one is drawn is Poisson(1). Here that count is a function of the example's
key and the replicate number alone: the first 32 bits of MD5(``key:replicate``) give a
uniform number, which the Poisson(1) distribution function turns into a count. So every
replicate mean is a weighted sum that any task can add to in any order, all replicates of a
row are made where the row is, partial sums are combined before the shuffle, and a retry or
another layout gives the same weights.

The low, mid and high values are the 2.5th, 50th and 97.5th percentiles of the replicate
means (linear between order statistics).

Edge cases: rows with a null value take no part in that value's means; a replicate in which
no row of a group is drawn has no mean and is left out; an empty group gives no row; rows
with the same key get the same weights.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

REPLICATES = 1000
QUANTILES = (0.025, 0.5, 0.975)
DIGITS = 6
_SCALE = float(1 << 32)


def poisson_bounds(most: int = 12) -> list[float]:
    """P(X <= k) of Poisson(1) for k = 0 .. most. With 32-bit uniforms the last bound is
    never passed: P(X > 12) is about 6e-11, below one step of 2**-32."""
    return [math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1)) for k in range(most + 1)]


BOUNDS = poisson_bounds()


def uniform(key: Column, replicate: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of MD5(``key:replicate``)."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(":"), replicate.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(_SCALE)


def poisson(u: Column) -> Column:
    """The Poisson(1) count whose distribution function first exceeds ``u``."""
    out = F.when(u < F.lit(BOUNDS[0]), F.lit(0))
    for k, bound in enumerate(BOUNDS[1:], 1):
        out = out.when(u < F.lit(bound), F.lit(k))
    return out.otherwise(F.lit(len(BOUNDS)))


def resampled_means(
    rows: DataFrame,
    key: str,
    groups: list[str],
    values: list[str],
    replicates: int = REPLICATES,
) -> DataFrame:
    """Per group and value: n (rows with the value), mean, and low, mid, high of the means
    of ``replicates`` Poisson-weighted resamples."""
    drawn = rows.select(
        *groups, *values, F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("_b"), F.col(key).alias("_key")
    ).withColumn("_w", poisson(uniform(F.col("_key"), F.col("_b")))).where(F.col("_w") > 0)
    sums = drawn.groupBy(*groups, "_b").agg(*[
        agg
        for v in values
        for agg in (
            F.sum(F.when(F.col(v).isNotNull(), F.col("_w") * F.col(v))).alias(f"_s_{v}"),
            F.sum(F.when(F.col(v).isNotNull(), F.col("_w"))).alias(f"_n_{v}"),
        )
    ])
    long = sums.select(*groups, F.inline(F.array(*[
        F.struct(F.lit(v).alias("metric"), (F.col(f"_s_{v}") / F.col(f"_n_{v}")).alias("m")) for v in values
    ]))).where(F.col("m").isNotNull())
    spread = long.groupBy(*groups, "metric").agg(
        F.percentile("m", F.array(*[F.lit(q) for q in QUANTILES])).alias("_q")
    )
    plain = rows.select(*groups, F.inline(F.array(*[
        F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("x")) for v in values
    ]))).where(F.col("x").isNotNull()).groupBy(*groups, "metric").agg(
        F.count("*").alias("n"), F.avg("x").alias("mean")
    )
    on = [F.col(f"p.{g}").eqNullSafe(F.col(f"s.{g}")) for g in groups] + [F.col("p.metric") == F.col("s.metric")]
    return plain.alias("p").join(spread.alias("s"), on).select(
        *[F.col(f"p.{g}").alias(g) for g in groups],
        F.col("p.metric").alias("metric"),
        "n",
        F.round("mean", DIGITS).alias("mean"),
        *[F.round(F.col("_q")[i], DIGITS).alias(name) for i, name in enumerate(("low", "mid", "high"))],
    )
