"""Document fingerprints by spot signatures (SpotSigs), in DataFrame functions only.

Common words are anchors ("spots"); each anchor and the chain of the next two content words
after it (anchors in between are skipped) form one signature. The distinct signatures of a
text, hashed to 32 bits, are its fingerprint: they stay put when a page's frame changes, because frames
are short on function words. Two fingerprints are compared by the Jaccard measure of their
sets; the sizes bound it from above (min / max), and where that bound is zero the sets are
not intersected.

Words: the text is lower-cased, characters other than letters, digits and white space
(space, 0x09 to 0x0D) are removed, and white space splits words. Signatures are made by one
regular-expression pass and array functions over the whole text, so no row is exploded and
texts of any length stay inside JVM expressions.

Edge cases: a null text is empty; a text without an anchor followed by two content words has
an empty fingerprint; two empty fingerprints are alike (1.0), an empty and a non-empty one not
(0.0); equal texts have equal fingerprints; repeated signatures count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from turnmill.llm.kernels import documents
from turnmill.llm.order import ranked

# Anchor words of the four languages of the corpus (English, German, French,
# Spanish), their most common function words.
ANCHORS = (
    "the a an of and to in is was that for it on with be as by are this at "
    "der die das und ist zu den von mit ein eine nicht sich des auf "
    "le la les de et un une du est en que qui dans pour pas au "
    "el los las y del por con no su es se al"
)
CHAIN = 2  # content words after an anchor
BLOCK = 256  # ranks whose next rows are found inside one window partition
HASH_MASK = 0xFFFFFFFF  # signatures are kept as 32-bit hashes

_WORDS = sorted(set(ANCHORS.split()), key=lambda w: (-len(w), w))
_A = "(?:" + "|".join(_WORDS) + ")"
_MARK = "\u0001"
# A content word: a word that is not an anchor; it gets a mark after it.
CONTENT = f" (?!{_A} )([^ ]+)(?= )"


def normalised(text: Column) -> Column:
    """Words of ``text`` in lower case, single spaces between, one space at both ends."""
    t = F.lower(F.coalesce(text, F.lit("")))
    t = F.regexp_replace(t, r"[^\p{L}\p{N}\x20\x09-\x0D]", "")
    t = F.regexp_replace(t, r"[\x20\x09-\x0D]+", " ")
    return F.concat(F.lit(" "), F.trim(t), F.lit(" "))


def segments(text: Column) -> Column:
    """Words of the text cut after every content word: each segment is the anchors before a
    content word, then that word; the last segment holds what follows the last one."""
    marked = F.regexp_replace(normalised(text), CONTENT, f" $1{_MARK}")
    return F.transform(F.split(marked, _MARK), lambda x: F.split(F.trim(x), " "))


def signatures(segments: Column) -> Column:
    """Spot signatures ``anchor:c1:c2`` from a column of :func:`segments`: an anchor of
    segment i has the chain of the last words of segments i .. i + CHAIN - 1.

    ``segments`` must be a column of its own (not an expression), as it is read once per
    segment inside the lambda. Finding the marks is one regular-expression pass without
    repeated groups, so long runs of anchors cost no stack; the rest are array functions,
    linear in the words.
    """
    closed = F.size(segments) - 1  # the last segment has no content word
    last = lambda i: F.element_at(segments[i], -1)
    per_segment = F.transform(
        F.sequence(F.lit(0), closed - CHAIN),
        lambda i: F.transform(
            F.slice(segments[i], 1, F.size(segments[i]) - 1),
            lambda a: F.concat_ws(":", a, *[last(i + k) for k in range(CHAIN)]),
        ),
    )
    return F.when(closed >= CHAIN, F.flatten(per_segment)).otherwise(F.array().cast("array<string>"))


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the distinct 32-bit hashes (low bits of xxhash64) of the spot
    signatures of column ``text`` (:func:`text_of` writes them as text). Two different
    signatures of one pair of texts share a hash with a chance of about m^2 / 2^33 for m
    signatures: a likeness moves by far less than one part in a thousand."""
    seg = f"{out}_segments"
    # The low 32 bits as a signed number, so that the cast is exact.
    low = lambda x: (F.xxhash64(x).bitwiseAND(F.lit(HASH_MASK)).bitwiseXOR(F.lit(1 << 31)) - F.lit(1 << 31)).cast("int")
    hashes = F.transform(signatures(F.col(seg)), low)
    return df.withColumn(seg, segments(F.col(text))).withColumn(out, F.array_sort(F.array_distinct(hashes))).drop(seg)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard measure of two fingerprints; the size bound skips intersecting empty sets."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    exact = F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))
    return F.when(large == 0, F.lit(1.0)).when(small == 0, F.lit(0.0)).otherwise(exact).cast("double")


def text_of(fp: Column) -> Column:
    """A fingerprint as text: its hashes as 8 lowercase hex digits, ascending, spaced."""
    hexed = F.transform(fp, lambda x: F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(HASH_MASK))), 8, "0")))
    return F.array_join(F.array_sort(hexed), " ")


def edited_against_next(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with the next document (descending ``doc_id``, nulls last, ties by
    the SHA-256 of the text; after the last comes the first): ``n_chars`` (code points), ``edited`` (the last
    floor(n_chars / 2) code points replaced by as many, or all, first ones of the next text),
    ``fp``, ``next_fp``."""
    rows = docs.select(F.col("doc_id").alias("_id"), F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    # Only ids and texts are sorted and written; fingerprints are made once a row, from the
    # written ranks, on the way into the one shuffle below.
    # Ties of doc_id are broken by the text's SHA-256, so that no text is a sort key (the
    # sort's sample of keys goes to the driver).
    rows = ranked(rows, [], [F.col("_id").desc_nulls_last(), F.sha2("_t", 256)], "_r")
    table = with_fingerprint(rows, "_t", "_fp").select("_id", "_t", "_fp", "_r", "_r_n")
    # The next row is found by lead inside blocks of BLOCK ranks, in one shuffle of the table:
    # the first row of every block also stands, after all others, in the block before (row 0
    # in the last block), so the last row of a block has its successor there too.
    r, total = F.col("_r"), F.col("_r_n")
    cols = ["_id", "_t", "_fp"]
    own = table.select(*cols, F.floor(r / BLOCK).alias("_k"), r.alias("_o"), F.lit(False).alias("_copy"))
    copies = table.where(r % BLOCK == 0).select(
        *cols,
        F.when(r == 0, F.floor((total - 1) / BLOCK)).otherwise(F.floor(r / BLOCK) - 1).alias("_k"),
        F.when(r == 0, total).otherwise(r).alias("_o"),
        F.lit(True).alias("_copy"),
    )
    blocks = Window.partitionBy("_k").orderBy("_o")
    pairs = own.unionByName(copies).select(
        *cols, "_copy", F.lead("_t").over(blocks).alias("_nt"), F.lead("_fp").over(blocks).alias("_nfp")
    ).where(~F.col("_copy"))
    n = F.length("_t")
    half = F.floor(n / 2).cast("int")
    return pairs.select(
        F.col("_id").alias("doc_id"),
        n.cast("long").alias("n_chars"),
        F.concat(F.substring("_t", 1, n - half), F.substring("_nt", 1, half)).alias("edited"),
        F.col("_fp").alias("fp"),
        F.col("_nfp").alias("next_fp"),
    )


def op12_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    rows = with_fingerprint(edited_against_next(documents(spark, sf_dir)), "edited", "efp")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        text_of(F.col("fp")).alias("fingerprint"),
        text_of(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
