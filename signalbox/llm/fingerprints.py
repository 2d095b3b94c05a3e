"""Document fingerprints: bottom-k sketches of shingle hashes.

A document's shingles are its runs of five lower-cased words (the whole
sequence where there are fewer; none for an empty or null text). Its sketch is
the ``K`` least distinct 63-bit hashes of them, ascending. Sketches merge: the
sketch of a union is the K least values of the sketches. From two sketches
follow resemblance, containment and the distinct shingle count.

DataFrame functions only. Equal texts have equal sketches; two empty sketches
resemble each other fully, an empty one resembles no other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, let, store

K = 128
SHINGLE = 5
HASH_RANGE = float(1 << 63)
#: Documents are dealt by blocks of 2**12 successive ids to find neighbours.
BLOCK_BITS = 12
MERGE_FAN = 64


def shingle_hashes(text: Column, n: int = SHINGLE) -> Column:
    """Hashes of all shingles of a text, in order, repeats included."""
    def hashed(part: Column) -> Column:
        return F.xxhash64(part).bitwiseAND(F.lit((1 << 63) - 1))

    def of(words: Column) -> Column:
        return (F.when(F.size(words) >= n, F.transform(
                    F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: hashed(F.slice(words, i, n))))
                .when(F.size(words) > 0, F.array(hashed(words)))
                .otherwise(F.array().cast("array<bigint>")))
    return let(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACES), ""), of)


def sketch(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def fingerprint(text: Column, k: int = K, n: int = SHINGLE) -> Column:
    return sketch(shingle_hashes(text, n), k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two shingle sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the part of the union's sketch in both."""
    return let(F.struct(a.alias("a"), b.alias("b"), merged(a, b, k).alias("u")), lambda x: F.when(
        F.size(x["u"]) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(x["u"], F.array_intersect(x["a"], x["b"]))).cast("double") / F.size(x["u"])))


def distinct_count(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise(
        F.lit(k - 1.0) * F.lit(HASH_RANGE) / F.element_at(s, k).cast("double"))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated part of a's shingles that b has; 1 for an empty a."""
    share = resemblance(a, b, k) * distinct_count(merged(a, b, k), k) / distinct_count(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share))


def merge_sketches(df: DataFrame, by: list[str], sketch_col: str, k: int = K) -> DataFrame:
    """One sketch per group of ``by`` from the sketches of its parts.

    Merges in a tree of fan-in ``MERGE_FAN``: distinct parts fall by hash into
    as many cells as the largest group needs, so no task gathers a whole hot
    group. Null sketches are no parts.
    """
    parts = df.select(*by, F.col(sketch_col).alias("_s")).where(F.col("_s").isNotNull()).distinct()
    parts = parts.withColumn("_h", F.xxhash64("_s"))
    largest = parts.groupBy(*by).count().agg(F.max("count")).first()[0] or 1
    levels = max(1, math.ceil(math.log(largest, MERGE_FAN)))
    for level in range(levels - 1, -1, -1):
        cell = F.pmod("_h", F.lit(MERGE_FAN ** level))
        parts = parts.groupBy(*by, cell.alias("_h")).agg(
            sketch(F.flatten(F.collect_list("_s")), k).alias("_s"))
    return parts.select(*by, F.col("_s").alias(sketch_col))


def with_next(df: DataFrame) -> DataFrame:
    """``df`` (doc_id, text, not null) with sketch, next_text and next_sketch:
    next is the following row by descending doc_id (ties by descending text,
    null ids last); after the last row, the first.

    Rows are dealt once, by blocks of successive ids; only one row a block
    travels to the block above.
    """
    ord_ = order_key_desc()
    blocked = lambda x: x.withColumn("_ord", ord_).withColumn("_block", F.shiftright("_ord", BLOCK_BITS))
    # a stored table of one row a block: its size is known when the join is planned
    heads = store(blocked(df).groupBy("_block").agg(F.max("_ord").alias("_head")), "block-heads")
    # the next block below, by cells of 2**12 blocks; after the last, the first
    cells = heads.withColumn("_cell", F.shiftright("_block", 12))
    tops = cells.groupBy("_cell").agg(F.max("_block").alias("_top"))
    every = Window.partitionBy(F.lit(0))
    tops = tops.withColumn("_then", F.coalesce(F.lead("_top").over(every.orderBy(F.desc("_cell"))),
                                               F.max("_top").over(every))).drop("_top")
    follows = (cells.join(tops, "_cell")
               .withColumn("_next", F.coalesce(F.lead("_block").over(
                   Window.partitionBy("_cell").orderBy(F.desc("_block"))), F.col("_then"))))
    first = (df.withColumn("_ord", ord_).join(heads, F.col("_ord") == F.col("_head"))
             .groupBy("_block").agg(F.max("text").alias("_first"))
             .withColumn("_first", F.struct(F.col("_first").alias("text"), fingerprint(F.col("_first")).alias("sketch"))))
    tails = store(follows.select(F.col("_block").alias("_to"), F.col("_next").alias("_block")).join(first, "_block")
                  .select(F.col("_to").alias("_block"), "_first"), "block-tails")
    rows = blocked(df.withColumn("sketch", fingerprint(F.col("text"))))
    w = Window.partitionBy("_block").orderBy(F.desc("_ord"), F.desc("text"))
    return (rows.withColumn("_lead", F.lead(F.struct("text", "sketch")).over(w))
            .join(tails, "_block", "left")
            .withColumn("_n", F.coalesce("_lead", "_first"))
            .withColumns({"next_text": F.col("_n.text"), "next_sketch": F.col("_n.sketch")})
            .drop("_ord", "_block", "_lead", "_first", "_n"))


def order_key_desc() -> Column:
    """Like doc_id, but null ids sort below all others."""
    low = F.lit(-(1 << 62)) - F.pmod(F.xxhash64("text"), F.lit(1 << 50))
    return F.when(F.col("doc_id").isNull(), low).otherwise(F.col("doc_id").cast("long"))


def hex_join(s: Column) -> Column:
    """16 hex digits a value, joined by commas."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), ",")


def edit_report(df: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. Null text is empty; every row
    counts, repeated ones as well; a table of one row is its own next."""
    rows = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    x = with_next(rows).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half),
                      F.substr("next_text", F.lit(1), half))
    x = x.withColumn("edited", edited).drop("text", "next_text")
    x = x.withColumns({"edited_sketch": fingerprint(F.col("edited")),
                       "edited_sha256": F.sha2(F.col("edited").cast("binary"), 256)}).drop("edited")
    return x.select("doc_id", "n_chars", "edited_sha256", hex_join(F.col("sketch")).alias("fingerprint"),
                    hex_join(F.col("edited_sketch")).alias("edited_fingerprint"),
                    resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                    resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
