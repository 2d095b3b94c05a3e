"""Benchmark decontamination: size-partitioned MinHash containment search.

A short item inside a long document has almost no Jaccard similarity with it,
so both sides are partitioned by size. An item of up to 2**c shingles belongs
to class c. For every class in use a document is covered by windows of twice
that length, half overlapping, so that any run as long as an item lies wholly
in one window, and window and item are of comparable size. Windows and items
are sketched by their ``K`` least shingle hashes; a window is a candidate for
an item when the sketches share a value and the share of the item's retained
values in the window's range, less ``SLACK`` standard errors, may reach
``CONTAINED`` (in a partition of upper size u this is a similarity of
``t * n / (u + n - t * n)`` with an item of n shingles, t being the share). An
item's pieces may stand far apart: the sketches of a partition's windows are
therefore merged, over twice as many windows at each step up to the whole
document. A merged sketch is whole below the least reach of its windows, and is
probed like a window's. Candidates are verified by exact shingle containment of
the item in the whole document.

A bit table of fixed size (``BITS``; two bits a value) of the benchmark's
shingles goes along with the scan, so documents hand on only the values that
some item may have; false positives fall out of the join. With a benchmark too
large for the table it fills up and more values travel; results are the same.

Null or empty texts and items match nothing. Items and documents of under five
words match only as whole sequences. Repeated rows of a document count once in
a search; each is dropped when contaminated. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bit_table, in_table, passing, store, whole_row
from .shingles import shingle_hashes

K = 64
CONTAINED = 0.8
SLACK = 5.0
BITS = 1 << 22

_ITEMS = "item long, item_id long, class int, n long, whole array<long>, sketch array<long>"
_HITS = "doc_id long, k1 long, k2 long, hits array<long>, windows array<struct<class:int,w:long,reach:long,vs:array<long>>>"


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [np.unique(shingle_hashes(t.as_py())) for t in b.column(2)]
        keep = [i for i, s in enumerate(sets) if len(s)]
        sets = [sets[i] for i in keep]
        yield pa.RecordBatch.from_arrays(
            [*[b.column(j).take(pa.array(keep, pa.int64())) for j in range(2)], pa.array([(len(s) - 1).bit_length() for s in sets], pa.int32()),
             pa.array([len(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64())),
             pa.array([s[:K] for s in sets], pa.list_(pa.int64()))], ["item", "item_id", "class", "n", "whole", "sketch"])


def item_sets(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, class, n, whole, sketch) of the items that have words;
    item names a row by its id and text, repeated rows count once."""
    rows = benchmark.select(F.xxhash64("item_id", "text").alias("item"), F.col("item_id").cast("long").alias("item_id"),
                            "text").dropDuplicates(["item"])
    return store(rows.mapInArrow(_items, _ITEMS), "bench-items")


def _windows(s: np.ndarray, at: np.ndarray, hit: np.ndarray, classes: list[int]) -> list[dict]:
    """The sketched windows around the hits of every class that retains one."""
    out = []
    for c in classes:
        hop, own = 1 << c, []
        near = at // hop
        for w in np.unique(np.concatenate([near, np.maximum(near - 1, 0)])).tolist():
            a, z = w * hop, w * hop + 2 * hop
            kept = np.unique(s[a:z])
            reach = int(kept[K - 1]) if len(kept) >= K else (1 << 63) - 1
            vs = np.unique(s[a:z][hit[a:z]])
            own.append({"class": c, "w": w, "reach": reach, "vs": vs[vs <= reach]})
        if any(len(x["vs"]) for x in own):
            out += own
    return out


def _scan(batches: Iterator[pa.RecordBatch], table: np.ndarray, classes: list[int]) -> Iterator[pa.RecordBatch]:
    shape = pa.list_(pa.struct([("class", pa.int32()), ("w", pa.int64()), ("reach", pa.int64()), ("vs", pa.list_(pa.int64()))]))
    for b in batches:
        keep, hits, windows = [], [], []
        for i, t in enumerate(b.column(3)):
            s = shingle_hashes(t.as_py())
            hit = in_table(table, s)
            if hit.any():
                keep.append(i)
                hits.append(np.unique(s[hit]))
                windows.append(_windows(s, np.flatnonzero(hit), hit, classes))
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*[b.column(j).take(at) for j in range(3)], pa.array(hits, pa.list_(pa.int64())), pa.array(windows, shape)],
            ["doc_id", "k1", "k2", "hits", "windows"])


def _keys():
    return [F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", F.lit("2"), "doc_id").alias("k2")]


def contained_items(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, item_id, item_shingles, shared, containment): the items
    of which a document has at least ``CONTAINED`` of the shingles; k1, k2 name
    the row by its id and text."""
    items = item_sets(benchmark)
    classes = sorted(r[0] for r in items.select("class").distinct().collect())  # 64 at most
    table = bit_table(items.select(F.explode("whole").alias("v")), BITS)
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), *_keys(), "text")
    found = store(rows.mapInArrow(lambda it: _scan(it, table, classes), _HITS), "bench-hits").dropDuplicates(["k1", "k2"])
    keys = ["k1", "k2"]
    windows = found.select(*keys, F.explode("windows").alias("x")).select(
        *keys, "x.class", "x.w", "x.reach", "x.vs")
    listed = items.select("item", "class", F.explode("sketch").alias("v"))
    met = store(windows.select(*keys, "class", "w", "reach", F.explode("vs").alias("v")).join(listed, ["class", "v"]), "bench-met")
    sketches = items.select("item", "sketch")

    def likely_in(probed: DataFrame) -> DataFrame:
        """(keys, item) of (keys, place, item, reach, both): may the share reach the bound?"""
        x = probed.join(sketches, "item")
        tried = F.size(F.filter("sketch", lambda v: v <= F.col("reach")))
        slack = F.lit(SLACK) * F.sqrt(F.lit(CONTAINED * (1 - CONTAINED)) / tried)
        return x.where(F.col("both") / tried >= F.lit(CONTAINED) - slack).select(*keys, "item")
    likely = likely_in(met.groupBy(*keys, "class", "w", "item").agg(F.count(F.lit(1)).alias("both"), F.first("reach").alias("reach")))
    # windows 2**step * i to 2**step * (i + 1) - 1 merged; the last step has them all in one
    top = F.max("w").over(Window.partitionBy(*keys, "class"))   # the windows of a document
    steps = F.explode(F.sequence(F.lit(1), F.ceil(F.log2(F.col("top") + F.lit(1.0))).cast("int") + 1)).alias("step")
    tall = store(windows.select(*keys, "class", "w", "reach", top.alias("top")).select(*keys, "class", "w", "reach", "top", steps)
                 .groupBy(*keys, "class", "step", F.expr("shiftright(w, step)").alias("g")).agg(F.min("reach").alias("low"), F.first("top").alias("top")),
                 "bench-merged")
    merged = (met.join(tall.select(*keys, "class", "step", "g", "low"), [*keys, "class"])
              .where((F.expr("shiftright(w, step)") == F.col("g")) & (F.col("v") <= F.col("low")))
              .groupBy(*keys, "class", "step", "g", "item").agg(F.count_distinct("v").alias("both"), F.first("low").alias("reach")))
    likely = likely.unionByName(likely_in(merged)).distinct()
    pairs = likely.join(found.select(*keys, "doc_id", "hits"), keys).join(items.select("item", "item_id", "n", "whole"), "item")
    shared = F.size(F.array_intersect("hits", "whole")).cast("long")
    return (pairs.select(*keys, "doc_id", "item_id", F.col("n").alias("item_shingles"), shared.alias("shared"))
            .withColumn("containment", F.col("shared") / F.col("item_shingles")).where(F.col("containment") >= CONTAINED))


def contamination_report(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, item_shingles, shared, containment."""
    return contained_items(df, benchmark).drop("k1", "k2")


def drop_contaminated(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``df`` without the documents that contain an item."""
    with passing(df.sparkSession) as keep:  # a stored table: its size is known when the join is planned
        bad = keep(contained_items(df, benchmark).select("k1", "k2").distinct(), "contaminated")
    return df.select(whole_row(df), *_keys()).join(bad, ["k1", "k2"], "left_anti").select("_row.*")


def oracle() -> str:
    """DuckDB SQL for ``contamination_report`` over documents and benchmark."""
    def shingles(table: str, key: str) -> str:
        return f"""
  SELECT DISTINCT {key}, s FROM (
    SELECT {key}, unnest(CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM (SELECT {key}, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\\x20\\x09-\\x0D]+') AS w FROM {table}))"""
    return f"""
WITH item AS ({shingles("benchmark", "item_id")}),
doc AS ({shingles("documents", "doc_id")}),
n AS (SELECT item_id, count(*) AS item_shingles FROM item GROUP BY item_id),
both_have AS (SELECT doc_id, item_id, count(*) AS shared FROM doc JOIN item USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, item_shingles, shared, CAST(shared AS DOUBLE) / item_shingles AS containment
FROM both_have JOIN n USING (item_id) WHERE CAST(shared AS DOUBLE) / item_shingles >= {CONTAINED}
"""
