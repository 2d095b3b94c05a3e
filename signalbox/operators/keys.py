"""Surrogate keys and insert-if-absent.

Ids are dense, start after the target's largest id and follow the natural
key order, so they depend only on the keys. The numbering is distributed:
keys are range-partitioned and sorted, each partition is counted, and a
running sum over the per-partition counts (one row per partition, a proven
size bound) is broadcast back as offsets. No step sees all keys in one task.

The tagged rows are written once to the shared folder
(``spark.checkpoint.dir``) and read back before they are counted: range
bounds are sampled from shuffle output whose row order is not fixed, so
counting and numbering must read the same materialized tags, also after a
lost executor. Positions live in the stored ``_mid`` column, so the read-back
split layout does not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bits import key_value, may_be_in, sized_table
from ..session import compiled, materialize, ship_package, work_path

_POS_BITS = 33  # monotonically_increasing_id: partition id << 33 | row position


def max_id(target: DataFrame | None, id_col: str) -> Column:
    """Largest id of ``target`` as a scalar-subquery Column (0 when empty)."""
    if target is None:
        return F.lit(0).cast("long")
    return target.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).scalar()


def assign_ids(df: DataFrame, key_cols: Sequence[str], id_col: str,
               start_after: Column | int = 0,
               num_partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = start_after + rank of the (unique) key, distributed.

    ``df`` must be unique on ``key_cols``; ties would make positions depend
    on task order. Without ``num_partitions`` the range shuffle uses the
    session's partition count and adaptive execution merges adjacent ranges
    of a small input (merged ranges stay contiguous and sorted).
    """
    keys = [F.col(k).asc_nulls_first() for k in key_cols]
    spark = df.sparkSession
    path = work_path(spark, "ids")
    # The range bounds come from a sample of the input: a caller with an
    # expensive input hands in a written one. The written tags fix the numbering.
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    with compiled(spark):
        (ranged.sortWithinPartitions(*keys)
         .withColumn("_mid", F.monotonically_increasing_id())
         .write.option("compression", "zstd").parquet(path))
    tagged = spark.read.parquet(path)
    ordered = (tagged.withColumn("_part", F.shiftright("_mid", _POS_BITS))
               .withColumn("_pos", F.col("_mid").bitwiseAND((1 << _POS_BITS) - 1)))
    counts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0))
                            .alias("_off"))
    start = start_after if isinstance(start_after, Column) else F.lit(int(start_after))
    return (ordered.join(F.broadcast(offsets), "_part")
            .withColumn(id_col, (start + F.col("_off") + F.col("_pos") + 1).cast("long"))
            .drop("_mid", "_part", "_pos", "_off"))


def repeated_keys(df: DataFrame, key_cols: Sequence[str]) -> DataFrame | None:
    """The keys (``_k0``, ``_k1``, ...) that stand in several rows, written; None
    when there are none. A hash aggregate over the key columns alone."""
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(key_cols)]
    found = materialize(df.groupBy(*named).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), "repeated-keys")
    return None if found.isEmpty() else found


_UNKNOWN = object()
#: From so many repeated keys on, their join would shuffle every row before the
#: repeated ones are shuffled again: then a bit table of them lets the other rows pass.
MANY_REPEATED = 200_000


def first_per_key(df: DataFrame, key_cols: Sequence[str],
                  order_cols: Sequence[str], repeated=_UNKNOWN,
                  joined: bool = False) -> DataFrame:
    """One row per key: the smallest by ``order_cols`` (nulls first), then by
    the other columns.

    Rows whose key does not repeat pass through without a shuffle or a sort,
    and only the repeated ones go through ``min``, which combines them
    map-side; beyond ``MANY_REPEATED`` keys so do the few others that a bit
    table takes for repeated. ``repeated`` is what ``repeated_keys`` found in
    ``df`` or in a table that ``df`` is a part of; without it ``df`` is read
    for them here: hand in a written table. Rows that are ``joined`` by the key
    next are then combined all at once: the join goes on from that shuffle.
    """
    payload = [c for c in df.columns if c not in key_cols]
    if not payload:
        return df.select(*key_cols).distinct()
    if repeated is _UNKNOWN:
        repeated = repeated_keys(df, key_cols)
    if repeated is None:
        return df
    # the order holds the whole payload, so the least one is the row itself
    least = F.min(F.struct(*[F.col(c) for c in dict.fromkeys([*(c for c in order_cols if c in payload), *payload])])).alias("_row")
    taken = [*key_cols, *[F.col("_row")[c].alias(c) for c in payload]]
    if repeated.limit(MANY_REPEATED).count() == MANY_REPEATED:
        if joined:
            return df.groupBy(*key_cols).agg(least).select(*taken)
        ship_package(df.sparkSession)
        maybe = may_be_in(sized_table(repeated.select(key_value(*repeated.columns).alias("v"))))(key_value(*key_cols))
        # a row that only may repeat is combined with none if it does not
        again = df.where(maybe).groupBy(*key_cols).agg(least).select(*taken)
        return df.where(~maybe).select(*key_cols, *payload).unionByName(again)
    same = F.lit(True)
    for i, k in enumerate(key_cols):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    again = df.join(repeated, same, "left_semi").groupBy(*key_cols).agg(least).select(*taken)
    return df.join(repeated, same, "left_anti").unionByName(again)


def check_unique(target: DataFrame | None, key_cols: Sequence[str], name: str,
                 prune: tuple[str, DataFrame] | None = None) -> None:
    """Fail when a stored table repeats a key: appending to it would go on from a
    broken load. ``prune`` as in ``absent_rows``."""
    if target is None:
        return
    if prune is not None:
        target = target.join(F.broadcast(prune[1].select(prune[0]).distinct()), prune[0], "left_semi")
    twice = target.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    if not twice.isEmpty():
        raise ValueError(f"{name}: stored rows repeat a key of {', '.join(key_cols)}; load into a fresh folder")


def absent_rows(batch: DataFrame, target: DataFrame | None, key_cols: Sequence[str],
                prune: tuple[str, DataFrame] | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` (ON CONFLICT DO NOTHING).

    ``target`` is unique on ``key_cols`` (every load keeps it so), so its keys
    are joined as stored, without a distinct over the whole table. ``prune``
    = (partition column of ``target``, DataFrame of the values the batch
    touches): the target is first cut to those partitions with a semi join
    against the batch's few values, so a daily load reads one month of the
    stored fact instead of all of it.
    """
    if target is None:
        return batch
    keys = target.select(*key_cols, *([prune[0]] if prune else []))
    if prune is not None:
        col, values = prune
        keys = keys.join(F.broadcast(values.select(col).distinct()), col, "left_semi")
    return batch.join(keys.select(*key_cols), list(key_cols), "left_anti")


def insert_if_absent(batch: DataFrame, target: DataFrame | None,
                     key_cols: Sequence[str], order_cols: Sequence[str] = (),
                     id_col: str | None = None,
                     id_order: Sequence[str] | None = None) -> DataFrame:
    """New rows to append: batch repeats collapsed (first by ``order_cols``),
    keys already in ``target`` dropped, ids numbered after the target's max.
    """
    first = first_per_key(batch, key_cols, order_cols)
    new = absent_rows(first, target, key_cols)
    if id_col is None:
        return new
    out = assign_ids(new, id_order or key_cols, id_col, max_id(target, id_col))
    return out.select(id_col, *[c for c in batch.columns])
