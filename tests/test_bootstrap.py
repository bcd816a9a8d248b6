"""Poisson bootstrap with hash weights."""

import math

from pyspark.sql import functions as F

from turnmill.operators import bootstrap


def test_bounds_are_poisson():
    b = bootstrap.BOUNDS
    assert abs(b[0] - math.exp(-1)) < 1e-15 and all(x < y for x, y in zip(b, b[1:]))
    assert 1 - b[-1] < 2 ** -32


def test_weights_have_mean_and_variance_one(spark):
    df = spark.range(20000).select(bootstrap.poisson(bootstrap.uniform(F.col("id"), F.lit(3))).alias("w"))
    mean, var = df.agg(F.avg("w"), F.var_pop("w")).first()
    assert abs(mean - 1) < 0.03 and abs(var - 1) < 0.05


def test_order_and_layout_do_not_matter(spark):
    rows = [(f"k{i}", "g" if i % 3 else None, float(i % 7), None if i % 5 == 0 else float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "key string, g string, x double, y double")
    one = bootstrap.resampled_means(df.coalesce(1), "key", ["g"], ["x", "y"], replicates=200).collect()
    many = bootstrap.resampled_means(df.repartition(7).orderBy(F.rand(1)), "key", ["g"], ["x", "y"], replicates=200).collect()
    assert sorted(map(tuple, one), key=str) == sorted(map(tuple, many), key=str)
    by = {(r.g, r.metric): r for r in one}
    assert by[(None, "x")].n == 100 and by[("g", "y")].n == 160
    assert all(r.low <= r.mid <= r.high for r in one)


def test_a_row_always_drawn_gives_its_value_and_empty_input_no_rows(spark):
    df = spark.createDataFrame([("a", 1, 2.5)] * 3, "key string, g int, x double")
    (r,) = bootstrap.resampled_means(df, "key", ["g"], ["x"], replicates=50).collect()
    assert (r.n, r.mean, r.low, r.mid, r.high) == (3, 2.5, 2.5, 2.5, 2.5)
    empty = spark.createDataFrame([], "key string, g int, x double")
    assert bootstrap.resampled_means(empty, "key", ["g"], ["x"]).count() == 0
