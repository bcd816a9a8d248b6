"""Positions of rows in a total order, without one task holding a whole group.

A window ``row_number() over (partition by g order by k)`` puts every row of a group into one
task; with one group holding a third of all rows that task is a third of the job. Here the rows
are sorted once by range partitioning over all tasks, each task numbers its own rows, and the
offsets of the (task, group) runs, one row each, are summed in the driver's plan as a small
table. Its size is bounded by the number of tasks plus the number of groups, and it is only
broadcast below a counted size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from turnmill.scratch import stage

BROADCAST_ROWS = 1 << 20  # offset rows shipped to every task at most

_LOW = (1 << 33) - 1  # monotonically_increasing_id: task number above bit 33, row below


def ranked(df: DataFrame, group: list[str], order: list[Column], name: str = "_rank") -> DataFrame:
    """``df`` with ``name``: 0-based position of the row in its group under ``order``, and
    ``name + '_n'``: the size of the group.

    ``group`` columns may hold nulls (a group of its own). Rows equal in ``group`` and ``order``
    get distinct consecutive positions in an order that is fixed once written; callers order by
    enough columns that such rows are interchangeable.
    """
    spark = df.sparkSession
    keys = [F.col(g).asc_nulls_first() for g in group] + list(order)
    part, idx = f"{name}_part", f"{name}_idx"
    numbered = stage(
        df.orderBy(*keys)
        .withColumn(idx, F.monotonically_increasing_id())
        .withColumn(part, F.shiftright(F.col(idx), 33))
        .withColumn(idx, F.col(idx).bitwiseAND(F.lit(_LOW))),
        "ranked",
    )
    runs = numbered.groupBy(part, *group).agg(F.count("*").alias("_c"), F.min(idx).alias("_m"))
    whole = Window.partitionBy(*[F.col(g) for g in group]) if group else Window.partitionBy(F.lit(0))
    # The run table is tiny: at most tasks + groups rows.
    runs = stage(
        runs.withColumn("_start", F.sum("_c").over(whole.orderBy(part)) - F.col("_c"))
        .withColumn(f"{name}_n", F.sum("_c").over(whole)),
        "runs",
    )
    small = runs.count() <= BROADCAST_ROWS
    runs = F.broadcast(runs) if small else runs
    on = [numbered[part] == runs[part]] + [numbered[g].eqNullSafe(runs[g]) for g in group]
    out = numbered.join(runs, on, "inner").select(
        numbered["*"],
        (runs["_start"] + numbered[idx] - runs["_m"]).alias(name),
        runs[f"{name}_n"],
    )
    return out.drop(part, idx)
