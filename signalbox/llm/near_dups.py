"""Near-duplicates by bottom-k sketches of one hash function.

1. One scan gives each document its shingle count, a 128-bit key of its whole
   shingle set and its sketch (the ``K`` least shingle hashes). Documents of
   equal sets are one class from here on; its id is the least of theirs.
2. Inverted lists. Two sets of Jaccard similarity 0.85 share at least ``LEAST``
   of their retained values (a miss is a 5-sigma event), so they share one of
   the ``K - LEAST + 1`` values that are rarest in the corpus. Only those are
   listed: what many texts share is looked at only where a text has little else.
3. Each list compares its members with its least member. The union sketch
   estimates the similarity; the pairs that may pass are verified on the full
   sets. Links give components.
4. Members of one list that are in different components even so are listed
   again by the rarest values of their full sets, where the place of a shared
   value bounds the similarity; what is left meets in blocks and is verified.

Only links matter, so no list is expanded into all pairs, and copies of a
text never meet. Nothing is capped. All working tables are in the shared
folder. Rows whose text has no words link with nothing. Null ids count as
larger than all others; a component of null ids alone has a null id, and its
rows are kept. Repeated rows share a component; so do rows of one doc_id with
different texts, the least of which then speaks for the id. Extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bits import in_table, key_value, may_be_in, sized_table
from .common import order_key, passing, spread_join, store, whole_row
from .components import components
from .shingles import shingle_hashes

K = 64
PERCENT = 85
#: Least number of shared retained values of two linked sets of K or more.
LEAST = 40
#: Least similarity of the union sketch for a pair to be verified.
ESTIMATE = LEAST / K
#: Rows of a block of a list.
BLOCK = 512

_SETS = "rid long, th long, doc_id long, n long, key1 long, key2 long, sketch array<long>"


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rid, th, doc_id, texts = (b.column(i) for i in range(4))
        n, key1, key2, sketches = [], [], [], []
        for t in texts:
            s = np.unique(shingle_hashes(t.as_py()))
            d = xxhash.xxh3_128_intdigest(s.tobytes())
            n.append(len(s))
            key1.append((d >> 64) - (1 << 63))
            key2.append((d & (1 << 64) - 1) - (1 << 63))
            sketches.append(s[:K])
        yield pa.RecordBatch.from_arrays(
            [rid, th, doc_id, pa.array(n, pa.int64()), pa.array(key1, pa.int64()), pa.array(key2, pa.int64()),
             pa.array(sketches, pa.list_(pa.int64()))], ["rid", "th", "doc_id", "n", "key1", "key2", "sketch"])


def _rid() -> Column:
    return order_key("doc_id", F.col("text"))


def _text_hash() -> Column:
    return F.xxhash64(F.col("text").isNull(), "text")


def shingle_sets(df: DataFrame) -> DataFrame:
    """Per row: rid (an id that is never null), th (hash of the text), doc_id, n, key1, key2, sketch."""
    rows = df.select(_rid().alias("rid"), _text_hash().alias("th"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return store(rows.mapInArrow(_sketched, _SETS), "near-sets")


def _prefix(size: Column) -> Column:
    """How many of a sketch's rarest values must hold one that any linked set lists too."""
    share = F.ceil(size * PERCENT / F.lit(100)).cast("int")
    return size - F.least(share, F.lit(LEAST)) + 1


def _shared_values(each: DataFrame) -> DataFrame:
    """``each`` (cid, n, v, ...) where another class has the value too, with
    ``df``, the number of classes that have it; a value that most have is split."""
    shared = store(each.groupBy("v").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "near-shared")
    return spread_join(each, shared.withColumnRenamed("m", "df"), ["v"], F.xxhash64("cid"), shared)


def inverted_lists(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(v, cid, n), each class under those of its rarest values that are in
    another sketch as well and can be needed to find a linked set; and per
    list of several classes v, m (classes), the least (pivot) and its size (pn)."""
    each = classes.where("n > 0").select("cid", "n", F.size("sketch").alias("size"), F.explode("sketch").alias("v"))
    mine = _shared_values(each).groupBy("cid").agg(
        F.array_sort(F.collect_list(F.struct("df", "v"))).alias("vs"),  # K at most
        F.first("n").alias("n"), F.first("size").alias("size"))
    room = _prefix(F.col("size")) - (F.col("size") - F.size("vs"))
    lists = mine.where(room > 0).select("cid", "n", F.explode(F.slice("vs", F.lit(1), room)).alias("x"))
    lists = store(lists.select("cid", "n", F.col("x.v").alias("v")), "near-lists")
    first = F.min(F.struct("cid", "n"))
    several = lists.groupBy("v").agg(F.count(F.lit(1)).alias("m"), first.alias("first")).where("m > 1")
    return lists, store(several.select("v", "m", F.col("first.cid").alias("pivot"), F.col("first.n").alias("pn")), "near-heads")


def _size_fits(a: str, b: str) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _with_side(pairs: DataFrame, table: DataFrame, side: str) -> DataFrame:
    """``pairs`` with the row of ``table`` (cid, ...) for its ``side``, which may be in very many pairs."""
    counts = store(pairs.groupBy(side).agg(F.count(F.lit(1)).alias("m")), "near-sides")
    return spread_join(pairs, table.withColumnRenamed("cid", side), [side], F.xxhash64("a", "b"), counts)


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose union sketch says that they may be linked."""
    sk = classes.select("cid", "sketch")
    x = _with_side(pairs, sk.withColumnRenamed("sketch", "sa"), "a")
    x = _with_side(x, sk.withColumnRenamed("sketch", "sb"), "b")
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, K)
    both = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    return x.where(both >= F.size(union) * ESTIMATE).select("a", "b")


def _whole_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [np.unique(shingle_hashes(t.as_py())) for t in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], ["cid", "whole"])


def _passing(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield b.filter(pa.array(in_table(table, _place(b.column(0).to_numpy()))))


def _place(cid):
    """Class ids as non-negative values of a bit table."""
    return cid & ((1 << 62) - 1)


def whole_sets(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """(cid, whole): the full shingle sets of the classes in ``ids``. A bit table,
    sized by their number up to ``MOST_BITS``, drops most other texts before
    they are shuffled; it only spares work."""
    table = sized_table(ids.select(F.col("cid").bitwiseAND(F.lit((1 << 62) - 1)).alias("v")))
    some = texts.mapInArrow(lambda it: _passing(it, table), texts.schema)
    one = some.join(ids, "cid").groupBy("cid").agg(F.min("text").alias("text"))
    return store(one.mapInArrow(_whole_set, "cid long, whole array<long>"), "near-whole")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets have the similarity. ``texts``: (cid, text) of all classes."""
    ids = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
    sets = whole_sets(texts, ids)
    x = _with_side(pairs, sets.withColumnRenamed("whole", "wa"), "a")
    x = _with_side(x, sets.withColumnRenamed("whole", "wb"), "b")
    both = F.size(F.array_intersect("wa", "wb"))
    return x.where(both * 100 >= (F.size("wa") + F.size("wb") - both) * PERCENT).select("a", "b")


def _meetings(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components among the members (v, cid, n, root,
    pos) of each list v that can still be linked.

    Two sets that are linked lie in one size class or in two next to each other
    (a class goes up to 100 / 85 of its least size). A list's members of a class
    are cut into blocks; only blocks of such classes meet, each two under a key
    of their own, and a pair comes out of the join only if the sizes fit and
    what follows the list's value in either is enough: all rarer values differ.
    """
    rows = rows.withColumn("c", F.floor(F.log("n") / F.lit(math.log(100 / PERCENT)) + 1e-9).cast("int"))
    parts = store(rows.groupBy("v", "c").agg(
        F.count(F.lit(1)).alias("m"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("own"),
        F.min("root").alias("lo"), F.max("root").alias("hi")), "near-parts")
    around = parts
    for name, step in (("below", 1), ("above", -1)):  # blocks of the class before and after
        other = parts.select("v", (F.col("c") + step).alias("c"), F.col("own").alias(name))
        around = around.join(other, ["v", "c"], "left")
    lists = parts.groupBy("v").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi").select("v")
    around = around.join(lists, "v", "left_semi").select("v", "c", "own", *[F.coalesce(x, F.lit(0)).alias(x) for x in ("below", "above")])
    x = spread_join(rows, around, ["v", "c"], F.xxhash64("cid"), parts.select("v", "c", "m"))
    x = x.withColumn("k", F.pmod(F.xxhash64("cid"), F.col("own")).cast("int"))

    def side(same: Column, next_class: Column, up: bool) -> DataFrame:
        """Each row once per block that it meets: ``same`` of its own class, all of the next or the one before."""
        c, k = F.col("c"), F.col("k")
        met = F.concat(F.transform(same, lambda j: F.struct(c.alias("c"), j.alias("k"))),
                       F.transform(next_class, lambda j: F.struct((c + 1 if up else c - 1).alias("c"), j.alias("k"))))
        at = x.select("v", "cid", "n", "root", "pos", F.struct(c.alias("c"), k.alias("k")).alias("mine"), F.explode(met).alias("met"))
        lo, hi = ("mine", "met") if up else ("met", "mine")
        return at.select("v", F.col(f"{lo}.c").alias("c0"), F.col(f"{lo}.k").alias("k0"), F.col(f"{hi}.c").alias("c1"),
                         F.col(f"{hi}.k").alias("k1"), *[F.col(y).alias(y + str(int(not up))) for y in ("cid", "n", "root", "pos")])

    def upto(n: Column) -> Column:
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    low = side(F.sequence(F.col("k"), F.col("own") - 1), upto(F.col("above")), True)
    high = side(F.sequence(F.lit(0), F.col("k")), upto(F.col("below")), False)
    most = F.least(F.col("n0") - F.col("pos0"), F.col("n1") - F.col("pos1"))
    meet = low.join(high, ["v", "c0", "k0", "c1", "k1"]).where(
        (F.col("root0") != F.col("root1")) & _size_fits("n0", "n1")
        & (most * (100 + PERCENT) >= (F.col("n0") + F.col("n1")) * PERCENT))
    return meet.select(F.least("cid0", "cid1").alias("a"), F.greatest("cid0", "cid1").alias("b")).distinct()


def across_components(lists: DataFrame, heads: DataFrame, roots: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of one list in different components that may be linked, by full sets.

    Lists of two and those in one component by now drop out. The members of
    the rest are listed anew under the rarest values of their full sets: only
    ``n - 0.85 n + 1`` of them, with their place, which rules out almost all
    pairs of large loose groups.
    """
    rooted = roots.withColumnRenamed("node", "cid")
    large = heads.where("m > 2").select("v", "m")
    at = lists.join(rooted, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    split = at.groupBy("v").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    split = store(large.join(split.select("v"), "v"), "near-split")
    open_ = store(spread_join(at, split.select("v"), ["v"], F.xxhash64("cid"), split)
                  .select("cid", "root").distinct(), "near-open")
    sets = whole_sets(texts, open_.select("cid"))
    each = sets.select("cid", F.size("whole").alias("n"), F.explode("whole").alias("v"))
    mine = _shared_values(each).groupBy("cid").agg(
        F.array_sort(F.collect_list(F.struct("df", "v"))).alias("vs"), F.first("n").alias("n"))  # one text's shingles
    alone = F.col("n") - F.size("vs")
    room = F.col("n") - F.ceil(F.col("n") * PERCENT / F.lit(100)).cast("int") + 1 - alone
    rows = mine.where(room > 0).select("cid", "n", alone.alias("alone"), F.posexplode(F.slice("vs", F.lit(1), room)).alias("i", "x"))
    rows = rows.select("cid", "n", (F.col("alone") + F.col("i")).alias("pos"), F.col("x.v").alias("v"))
    return _meetings(store(rows.join(open_, "cid"), "near-open-lists"))


def link_components(df: DataFrame) -> DataFrame:
    """Per row of ``df``: rid, th, key1, key2 (of its text and set), doc_id, n_shingles, component_id, kept."""
    sets = shingle_sets(df)
    keys = ["key1", "key2"]
    classes = store(sets.where("n > 0").groupBy(*keys).agg(
        F.min("rid").alias("cid"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
        F.count(F.lit(1)).alias("m")), "near-classes")
    texts = df.select(_rid().alias("cid"), "text")
    lists, heads = inverted_lists(classes)
    star = spread_join(lists, heads.drop("m"), ["v"], F.xxhash64("cid"), heads.select("v", "m")).where(
        (F.col("cid") != F.col("pivot")) & _size_fits("n", "pn"))
    star = store(star.select(F.col("pivot").alias("a"), F.col("cid").alias("b")).distinct(), "near-star")
    with passing(df.sparkSession) as keep:
        links = keep(verified(store(estimated(star, classes), "near-pairs"), texts), "near-links")
    roots = components(links)
    with passing(df.sparkSession) as keep:
        rest = keep(across_components(lists, heads, roots, texts).join(star, ["a", "b"], "left_anti"), "near-pairs")
    if not rest.isEmpty():
        more = store(verified(rest, texts), "near-links")
        roots = components(links.unionByName(more))
    return _report(sets, classes, roots)


def _report(sets: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    keys = ["key1", "key2"]
    cls = classes.select(*keys, "cid").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    cls = cls.select(*keys, F.coalesce("root", "cid").alias("root"))
    plain = sets.drop("sketch")
    # all copies of a text have one key; rows without words meet nothing
    rows = spread_join(plain.where("n > 0"), cls, keys, F.xxhash64("rid", "th"), classes.select(*keys, "m"))
    rows = rows.unionByName(plain.where("n = 0").withColumn("root", F.col("rid")))
    known = F.col("root") < (1 << 62)
    return rows.select("rid", "th", *keys, "doc_id", F.col("n").alias("n_shingles"),
                       F.when(known, F.col("root")).alias("component_id"), (F.col("rid") == F.col("root")).alias("kept"))


def duplicate_report(df: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    return link_components(df).drop("rid", "th", "key1", "key2")


def _without(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose ``keys`` are not in ``gone``. Most stay, and a bit table
    tells so of nearly all of these; only the others go through the join."""
    value = key_value(*keys)
    maybe = may_be_in(sized_table(gone.select(value.alias("v"))))
    return rows.where(~maybe(value)).unionByName(rows.where(maybe(value)).join(gone, keys, "left_anti"))


def keep_one(df: DataFrame) -> DataFrame:
    """``df`` without the documents that are not the first of their component.

    Rows of one id are told apart by their texts: different sets under one id
    are each in a component of their own and stay if they are its first. Of rows
    with one id and equal sets the first text stays, and of equal rows one."""
    with passing(df.sparkSession) as keep:
        with passing(df.sparkSession) as keep_rows:
            rows = keep_rows(link_components(df), "near-rows")
        alike = ["rid", "key1", "key2"]
        again = rows.where("kept").groupBy(*alike).agg(F.count(F.lit(1)).alias("m"), F.min("th").alias("first")).where("m > 1")
        later = rows.where("kept").join(again, alike).where(F.col("th") != F.col("first"))
        # a stored table: its size is known when the join is planned
        gone = keep(rows.where("not kept").select("rid", "th").unionByName(later.select("rid", "th")).distinct(), "near-gone")
        repeated = not rows.groupBy("rid", "th").count().where("count > 1").isEmpty()
    out = _without(df.select(whole_row(df), _rid().alias("rid"), _text_hash().alias("th")), gone, ["rid", "th"])
    if repeated:
        out = out.groupBy("rid", "th").agg(F.first("_row").alias("_row"))  # combines before the shuffle
    return out.select("_row.*")


def oracle() -> str:
    """DuckDB SQL for ``duplicate_report`` over documents: all pairs that share
    a shingle, exact similarity, and reachability."""
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
      THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM shared JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
  WHERE 100 * both_have >= {PERCENT} * (p.n + q.n - both_have)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT edge.b, reach.r FROM reach JOIN edge ON edge.a = reach.doc_id)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept
FROM reach LEFT JOIN size USING (doc_id) GROUP BY doc_id
"""
