"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each level every child of the chosen node draws ``-ln(u) / weight`` with u
hashed from (key, level, child); the least draw wins. A draw depends on that
child alone, so a changed weight moves rows only into or out of the subtree
whose weight changed, and all other rows stay. A new shard goes into a region
of its own (``grow``), so it only takes rows and moves none between the rest.

A null key is an ordinary key value (all null keys share a shard). DataFrame
functions only; the tree is configuration (one entry per shard), not data.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, order_key, running_total, store


class Leaf(NamedTuple):
    shard: int
    rack: int
    region: int
    weight: float = 1.0


def tree(shards: int, per_rack: int = 2, racks_per_region: int = 2) -> list[Leaf]:
    """Shards 0..n-1 of weight 1, filled rack by rack and region by region."""
    return [Leaf(s, s // per_rack, s // (per_rack * racks_per_region)) for s in range(shards)]


def grow(leaves: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, in a rack and region of its own."""
    top = [max((x[i] for x in leaves), default=-1) + 1 for i in range(3)]
    return [*leaves, Leaf(*top, weight)]


def _draw(key: Column, level: str, children: dict[int, float]) -> Column:
    """The winning child; ties (equal draws) go to the smaller id."""
    def straw(child: int, weight: float) -> Column:
        u = (F.pmod(F.xxhash64(F.lit(level), F.lit(child), key), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
        return F.struct((-F.log(u) / F.lit(weight)).alias("d"), F.lit(child).alias("c"))
    live = [(c, w) for c, w in sorted(children.items()) if w > 0]
    if len(live) == 1:
        return F.lit(live[0][0])
    return F.array_min(F.array(*[straw(c, w) for c, w in live]))["c"]


def _weights(leaves: list[Leaf], level: int) -> dict[int, float]:
    out: dict[int, float] = defaultdict(float)
    for x in leaves:
        out[x[level]] += x.weight
    return dict(out)


def shard_of(key: Column, leaves: list[Leaf]) -> Column:
    """Shard (int) of a key: region draw, rack draw within it, shard draw."""
    def descend(part: list[Leaf], level: int) -> Column:
        name = ("shard", "rack", "region")[level]
        won = _draw(key, name, _weights(part, level))
        if level == 0:
            return won
        nodes = sorted({x[level] for x in part if x.weight > 0})
        subs = {n: descend([x for x in part if x[level] == n], level - 1) for n in nodes}
        if len(nodes) == 1:
            return subs[nodes[0]]

        def choose(w: Column) -> Column:
            out = F.lit(None).cast("int")
            for n in reversed(nodes):
                out = F.when(w == n, subs[n]).otherwise(out)
            return out
        return let(won, choose)
    return descend(leaves, 2).cast("int")


def shard_rows(df: DataFrame, key: str, leaves: list[Leaf], out: str = "shard") -> DataFrame:
    """``df`` with its shard; every other column stays as it is."""
    return df.withColumn(out, shard_of(F.col(key), leaves))


def shard_slots(df: DataFrame, leaves: list[Leaf]) -> DataFrame:
    """Per document: doc_id, size (UTF-8 bytes + 1; null text: 1), text_crc32,
    law ('key'), shard, slot (gapless from 0 within the shard, in the order of
    doc_id, then crc and size) and grown_shard (with one more shard).

    Empty table: no rows. Repeated rows: one slot each. Null ids come last.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = df.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                     F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = store(shard_rows(rows, "doc_id", leaves).withColumns({
        "grown_shard": shard_of(F.col("doc_id"), grow(leaves)),
        "_ord": order_key("doc_id", F.col("text_crc32"), F.col("size")),
        "_one": F.lit(1).cast("long")}), "shard-rows")
    slots = running_total(rows, ["shard"], "_ord", ["text_crc32", "size"], "_one", "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                        "slot", "grown_shard")
