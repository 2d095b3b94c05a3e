"""Helpers shared by the operators: working tables in the cluster's shared
folder, single evaluation of an expression, and distributed running totals."""

from __future__ import annotations

import contextlib
import contextvars
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.bits import bit_table, in_table, slots  # noqa: F401 - the operators take them from here
from ..session import remove, shared_dir

#: Words are maximal runs of anything but these; Java regex.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def work_root(spark: SparkSession) -> str:
    """Folder of this application's working tables, below the shared folder."""
    return f"{shared_dir(spark)}/signalbox-llm-{spark.sparkContext.applicationId}"


def store(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage for a
    table that several jobs read, and survives lost executors."""
    spark = df.sparkSession
    return _written(df, f"{_FOLDER.get() or work_root(spark)}/{label}-{uuid.uuid4().hex}", **options)


def _written(df: DataFrame, path: str, **options) -> DataFrame:
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_FOLDER: contextvars.ContextVar[str | None] = contextvars.ContextVar("folder", default=None)


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Working tables stored inside the block are deleted at its end; those
    stored by the function that it gives belong to what is around the block. For
    steps that leave a small table of what took large ones to find."""
    outer = _FOLDER.get() or work_root(spark)
    folder = f"{outer}/passing-{uuid.uuid4().hex}"
    token = _FOLDER.set(folder)
    try:
        yield lambda df, label: _written(df, f"{outer}/{label}-{uuid.uuid4().hex}")
    finally:
        _FOLDER.reset(token)
        remove(spark, folder)


def release(spark: SparkSession) -> None:
    """Delete the working tables of this application. Call it after the last
    result has been written: results read their working tables lazily."""
    root = work_root(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct ``_row``, so that working columns
    beside it clash with none of them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def order_key(doc_id: str, *spread: Column) -> Column:
    """A non-null long that sorts like ``doc_id``; null ids come last, spread
    over many cells by a hash so that no task gets them all."""
    last = F.lit(1 << 62) + F.pmod(F.xxhash64(*spread), F.lit(1 << 50))
    return F.when(F.col(doc_id).isNull(), last).otherwise(F.col(doc_id).cast("long"))


#: Rows of a key that one task may well take, and the most keys that count as hot.
ROWS_PER_COPY, MOST_HOT = 512, 1 << 14


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], spread: Column,
                counts: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table`` on ``keys``, where one key may hold a large
    part of ``rows``: its rows are dealt by ``spread`` (a long) to copies of its
    rows of ``table``. ``counts`` is a stored table (keys, m): rows per key.

    A key is hot beyond ``ROWS_PER_COPY`` rows and one ``MOST_HOT``-th of all
    rows, so there are fewer than ``MOST_HOT`` hot keys in any table, and they
    go to every task. The join has one form at every size.
    """
    least = max(ROWS_PER_COPY, (counts.agg(F.sum("m")).first()[0] or 0) // MOST_HOT)
    hot = F.broadcast(counts.where(F.col("m") > least).select(
        *keys, F.ceil(F.col("m") / least).cast("int").alias("_copies")))
    dealt = rows.join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_copies").isNull(), 0).otherwise(F.pmod(spread, F.col("_copies"))).cast("int"))
    copied = table.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_copies") - 1, F.lit(0)))))
    return dealt.drop("_copies").join(copied.drop("_copies"), [*keys, "_salt"], how).drop("_salt")


def running_total(df: DataFrame, by: list[str], order: str, ties: list[str],
                  value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same ``by`` that
    come before in (``order``, ``ties``). ``by`` and ``order`` must not be null.

    Works in cells of 2**12, 2**24 and 2**36 successive order keys, so a hot
    group is never one task: a window sees at most 4096 distinct keys.
    """
    cells = ["_c1", "_c2", "_c3"]
    x = df.withColumns({c: F.shiftright(order, 12 * (i + 1)) for i, c in enumerate(cells)})
    sums = [x.groupBy(*by, *cells).agg(F.sum(value).alias("_v"))]
    for i in (1, 2):
        sums.append(sums[-1].groupBy(*by, *cells[i:]).agg(F.sum("_v").alias("_v")))
    before = None
    for i in (2, 1, 0):
        within = [*by, *cells[i + 1:]]
        w = (Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))).orderBy(cells[i])
        t = sums[i].withColumn("_o", F.coalesce(F.sum("_v").over(
            w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        if before is not None:
            t = t.join(before, within).withColumn("_o", F.col("_o") + F.col("_b"))
        before = t.select(*by, *cells[i:], F.col("_o").alias("_b"))
    w = Window.partitionBy(*by, *cells).orderBy(order, *ties)
    return (x.withColumn("_o", F.coalesce(F.sum(value).over(
                w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .join(before, [*by, *cells])
            .withColumn(out, F.col("_o") + F.col("_b")).drop("_o", "_b", *cells))
