"""W02 on unbounded keys: Bloom filters pick the stored parts that are read.

A table is stored in parts, one a load (``part=<n>``). Beside each part lies a
Bloom filter of its keys, made by Spark and stored as rows (word, bits) of its
non-zero 64-bit words: no filter passes through the driver, whatever a part's
size. A batch's keys are hashed to their ``HASHES`` places and joined with the
words; a part is read when some key has all its places there. The exact anti
join then runs against those parts alone, so a false positive costs a read and
changes nothing.

All filters of a table have the same number of bits, so the filters of several
parts merge by OR (``merge_filters``), as their parts do. With 32 bits and 8
hashes a key, a part of that size takes in a strange key about once in 170,000:
a batch of a thousand new keys reads hardly a part, one of millions reads most
of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import children, materialize, path_exists, remove, rename, work_path

HASHES = 8
BITS_A_KEY = 32
#: Keys of a batch whose places go to every task that reads filters.
FEW_KEYS = 1 << 14


def _places(key_cols: Sequence[str], bits: int) -> Column:
    """The places of a key in a filter of ``bits`` (a power of two)."""
    cols = [F.col(c) for c in key_cols]
    a, b = F.xxhash64(*cols), F.xxhash64(F.lit("step"), *cols)
    return F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda i: F.pmod(
        F.xxhash64(a, b, i), F.lit(bits)))


def _words(rows: DataFrame, key_cols: Sequence[str], bits: int) -> DataFrame:
    return (rows.select(F.explode(_places(key_cols, bits)).alias("p"))
            .groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits")))


class PartedTable:
    """The table ``name`` under ``root``, in parts with filters on ``key_cols``."""

    def __init__(self, spark: SparkSession, root: str, name: str, key_cols: Sequence[str], keys_a_part: int):
        self.spark, self.key_cols = spark, list(key_cols)
        self.path, self.filters = f"{root.rstrip('/')}/{name}", f"{root.rstrip('/')}/_filters/{name}"
        self.bits = 1 << max(10, (BITS_A_KEY * keys_a_part - 1).bit_length())
        self.read_parts: list[int] = []

    def parts(self) -> list[int]:
        return [int(n.removeprefix("part=")) for n in children(self.spark, self.path) if n.startswith("part=")]

    def read(self, parts: Sequence[int]) -> DataFrame | None:
        paths = [f"{self.path}/part={n}" for n in parts]
        return self.spark.read.parquet(*paths) if paths else None

    def append(self, rows: DataFrame) -> int:
        """Stores ``rows`` as the next part. The filter is written first: a part
        without one would be missed, a filter without a part only costs a look."""
        number = max(self.parts(), default=-1) + 1
        attempt = work_path(self.spark, "part")
        rows.write.parquet(attempt)
        stored = self.spark.read.schema(rows.schema).parquet(attempt)
        _words(stored, self.key_cols, self.bits).write.mode("overwrite").parquet(f"{self.filters}/part={number}")
        if not path_exists(self.spark, self.path):
            self.spark.range(0).write.mode("ignore").parquet(f"{self.path}/_made")
        if not rename(self.spark, attempt, f"{self.path}/part={number}"):
            raise RuntimeError(f"{self.path}/part={number}: another load is at work")
        return number

    def holding(self, batch: DataFrame) -> list[int]:
        """The parts that may hold a key of ``batch`` (numbers of parts: one a load)."""
        if not self.parts():
            return []
        keys = materialize(batch.select(*self.key_cols).distinct(), "probed-keys")
        # a key has HASHES places: by the size of the keys the planner would broadcast the places of far too many
        how = "broadcast" if keys.limit(FEW_KEYS + 1).count() <= FEW_KEYS else "merge"
        probes = keys.select(F.xxhash64(*self.key_cols).alias("key"), F.posexplode(_places(self.key_cols, self.bits)).alias("i", "p"))
        words = self.spark.read.parquet(self.filters)
        hits = probes.hint(how).join(words, F.shiftright(F.col("p"), 6) == F.col("word")).where(
            F.expr("shiftright(bits, cast(p % 64 as int)) & 1") == 1)
        whole = hits.groupBy("part", "key").agg(F.bit_or(F.expr("shiftleft(1, i)")).alias("all")).where(F.col("all") == (1 << HASHES) - 1)
        known = set(self.parts())
        return sorted(r.part for r in whole.select("part").distinct().collect() if r.part in known)

    def absent(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` whose key no part holds; ``read_parts`` says which were read."""
        self.read_parts = self.holding(batch)
        stored = self.read(self.read_parts)
        return batch if stored is None else batch.join(stored.select(*self.key_cols), self.key_cols, "left_anti")

    def merge(self, parts: Sequence[int]) -> int:
        """Puts some parts together as one new part, their filters with them."""
        number = max(self.parts()) + 1
        rows, attempt = self.read(parts), work_path(self.spark, "part")
        rows.write.parquet(attempt)
        words = self.spark.read.parquet(*[f"{self.filters}/part={n}" for n in parts])
        (words.groupBy("word").agg(F.bit_or("bits").alias("bits")).write.mode("overwrite").parquet(f"{self.filters}/part={number}"))
        rename(self.spark, attempt, f"{self.path}/part={number}")
        for n in parts:
            remove(self.spark, f"{self.path}/part={n}")
            remove(self.spark, f"{self.filters}/part={n}")
        return number
