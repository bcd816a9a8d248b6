"""Merkle manifest of a dataset by nested-interval labels.

Every row is a leaf. Leaves of one group (here: a language) are ranked, and a node of level k
is named by the interval of leaf ranks it covers, ``[lo, lo + 2**k)``; its parent is the node
of level k + 1 whose interval contains it, found by an equality on ``lo >> (k + 1)``. Levels are
built bottom up by grouping each level on that key (runs of two, the last run of a level may
be one node), and the nodes of all groups' tops form a second tree in the same way.

Proofs go top down: a node's parent is attached by the same containment key, and the
parent's covered interval minus the node's own is the sibling (absent for a lone last
node). A leaf's path is its sibling at each level, leaf level first, then the path of its
group's top in the upper tree. No step groups more than two nodes or joins more than one
row to one, so a language that holds a third of all rows spreads over all tasks; ranks come
from :func:`turnmill.llm.order.ranked`, not a window per language.

H(x) is the lowercase hex SHA-256 of x's UTF-8 bytes; inner nodes hash the concatenation of
their children's hex digests. A leaf is H of its fields, each ``-`` if null, else its UTF-8
byte count, ``:`` and its text (integers in decimal).

Edge cases: an empty table gives no rows; a group of one leaf has that leaf as its top and an
empty path; null languages form one group, ordered first; rows with equal ``doc_id`` are
ordered by their leaf, so equal rows are interchangeable; null ``doc_id`` sort first and are
never tampered; extra columns are not read and may have any names; texts of any length are
hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnmill.llm.kernels import documents
from turnmill.llm.order import ranked
from turnmill.scratch import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 7  # rows whose crc32 of the decimal id this divides get n_chars + 1


def encoded(value: Column) -> Column:
    """``-`` for null, else byte count, ``:``, text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """All levels of the trees of ``leaves`` (g, lo, h, n): level 0 is ``leaves``, level k
    holds (g, lo, h, n, kids) of groups that still had several nodes at level k - 1."""
    levels = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    k = 0
    while (1 << k) < most:
        runs = (
            levels[-1]
            .where(F.col("n") > (1 << k))
            .groupBy("g", "n", F.shiftright("lo", k + 1).alias("p"))
            .agg(F.array_sort(F.collect_list(F.struct("lo", "h"))).alias("kids"))
        )
        kids = F.transform("kids", lambda x: x["h"])
        levels.append(
            stage(
                runs.select(
                    "g",
                    F.shiftleft("p", k + 1).alias("lo"),
                    F.sha2(F.array_join(kids, ""), 256).alias("h"),
                    "n",
                    kids.alias("kids"),
                ),
                f"level{k + 1}",
            )
        )
        k += 1
    return levels


def _paths(levels: list[DataFrame], starts: DataFrame, carried: list[str]) -> DataFrame:
    """(g, lo, path, *carried) of every leaf; ``starts`` gives (g, path, *carried) of each
    group's top. A path entry is (sib, left): the sibling's hash, or null for a lone node,
    and whether the node is the left one of its run."""
    top = lambda level, k: level.where(F.col("n") <= (1 << k)).alias("a")
    b = starts.alias("b")
    kept = [F.col(f"b.{c}") for c in ["path", *carried]]
    frontier = None
    for k in range(len(levels) - 1, 0, -1):
        level = levels[k]
        here = top(level, k).join(b, F.col("a.g").eqNullSafe(F.col("b.g"))).select(
            "a.g", "a.lo", "a.kids", *kept
        )
        if frontier is not None:
            f = frontier.alias("b")
            below = level.alias("a").join(
                f, F.col("a.g").eqNullSafe(F.col("b.g")) & (F.col("a.lo") == F.col("b.lo"))
            ).select("a.g", "a.lo", "a.kids", *kept)
            here = here.unionByName(below)
        step = F.lit(1 << (k - 1))
        child = here.select(
            "g", "lo", "kids", "path", *carried, F.posexplode("kids").alias("i", "h")
        ).select(
            "g",
            (F.col("lo") + F.col("i") * step).alias("lo"),
            F.concat(
                F.array(
                    F.struct(
                        F.when(F.size("kids") == 2, F.col("kids")[1 - F.col("i")]).alias("sib"),
                        (F.col("i") == 0).alias("left"),
                    )
                ),
                F.col("path"),
            ).alias("path"),
            *carried,
        )
        frontier = stage(child, f"path{k - 1}")
    here = top(levels[0], 0).join(b, F.col("a.g").eqNullSafe(F.col("b.g"))).select("a.g", "a.lo", *kept)
    return here if frontier is None else here.unionByName(frontier)


def _proof(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(F.filter(path, lambda e: e["sib"].isNotNull()), lambda e: e["sib"]), ""), 256)


def _fold(path: Column, start: Column) -> Column:
    return F.aggregate(
        path,
        start,
        lambda acc, e: F.when(e["sib"].isNull(), F.sha2(acc, 256))
        .when(e["left"], F.sha2(F.concat(acc, e["sib"]), 256))
        .otherwise(F.sha2(F.concat(e["sib"], acc), 256)),
    )


def manifest(docs: DataFrame, group: str = "lang", tampered: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``group`` (as ``g``), leaf, subroot (top of its
    group), root, proof_sha256 (H of its path's siblings, bottom up), folded_root (root
    recomputed from ``tampered`` (a leaf column, default the leaf) and the path), verified."""
    leaf = leaf_hash(*[F.col(c) for c in FIELDS])
    rows = docs.select(
        F.col("doc_id").alias("_id"),
        F.col(group).alias("g"),
        leaf.alias("leaf"),
        (leaf if tampered is None else tampered).alias("_tampered"),
    )
    rows = ranked(rows, ["g"], [F.col("_id").asc_nulls_first(), F.col("leaf")], "lo").withColumnRenamed("lo_n", "n")
    rows = stage(rows, "leaves")
    levels = _levels(rows.select("g", "lo", F.col("leaf").alias("h"), "n"))

    # Tops of the groups, ordered by group, are the leaves of the upper tree.
    tops = levels[0].where(F.col("n") == 1).select("g", "h")
    for k in range(1, len(levels)):
        tops = tops.unionByName(levels[k].where(F.col("n") <= (1 << k)).select("g", "h"))
    tops = ranked(tops, [], [F.col("g").asc_nulls_first()], "lo")
    tops = stage(tops.select(F.lit(0).alias("g"), "lo", "h", F.col("lo_n").alias("n"), F.col("g").alias("group")), "tops")
    upper = _levels(tops.select("g", "lo", "h", "n"))
    crown = upper[-1].where(F.col("lo") == 0).select("g", F.array().cast("array<struct<sib:string,left:boolean>>").alias("path"), F.col("h").alias("root"))
    above = _paths(upper, crown, ["root"])
    starts = tops.alias("a").join(above.alias("b"), "lo").select(
        F.col("a.group").alias("g"), "b.path", "b.root", F.col("a.h").alias("subroot")
    )
    below = _paths(levels, stage(starts, "starts"), ["root", "subroot"]).alias("b")
    out = rows.alias("a").join(below, F.col("a.g").eqNullSafe(F.col("b.g")) & (F.col("a.lo") == F.col("b.lo"))).select(
        F.col("a._id").alias("doc_id"),
        "a.g",
        "a.leaf",
        "b.subroot",
        "b.root",
        _proof(F.col("b.path")).alias("proof_sha256"),
        _fold(F.col("b.path"), F.col("a._tampered")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered_leaf(docs_n_chars: Column = None) -> Column:
    """Leaf of the row with ``n_chars + 1`` where ``TAMPER_EVERY`` divides the unsigned crc32
    of the decimal ``doc_id``; nulls stay null."""
    hit = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0)
    n_chars = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all of ``documents`` by language, with every seventh-by-crc row tampered."""
    docs = documents(spark, sf_dir)
    return manifest(docs, "lang", tampered_leaf()).drop("g")
