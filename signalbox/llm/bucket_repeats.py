"""Suffix-array dedup by bucket-pointer refinement.

Removes every byte that a string of ``LENGTH`` bytes covers which also starts
earlier: in a document of a smaller id, or further left in the same one. The
starts are sorted as far as ``LENGTH`` bytes by refining buckets of starts:

1. *Initial q-gram buckets.* Every string of ``LENGTH`` bytes is represented by
   one of its ``GRAM``-byte grams, the one of least hash (the leftmost of
   equals), so equal strings have equal grams at equal places. The grams are
   counted over all documents; a start whose gram occurs once is alone in its
   bucket and in its final place. A bit table of the repeated grams, sized by
   their number (64 MB at most), goes along with the second scan; what it lets
   through beyond them stays alone in its bucket. A like table of the grams with
   several representatives picks the runs whose bytes are shuffled.
2. *Whole runs.* Successive starts with the same gram place are a run; the bytes
   that their strings cover are hashed (with the gram 128 bits). Of runs with
   equal bytes the earliest one represents all; the starts of the others are
   repeats as a whole. A copied text leaves a bucket here.
3. *Refinement.* Buckets with several representatives are refined in tasks:
   pointers of 8-byte grams are ranks of their bytes; sorting starts on their
   own pointer and the one at the later offset of 8 gives pointers of 16 bytes,
   which serve as both keys of the next sort, and so on (16, 32, 64) up to
   ``LENGTH``, where the last offset overlaps. A start alone in its bucket takes
   part no more. Comparisons are of bytes, not hashes. A bucket of more than
   ``CROWD`` representatives is refined by Spark, which groups its starts by
   their bytes; tasks combine them before the shuffle.

Only gram hashes of all documents are shuffled, then the runs with repeated
grams, then the texts in which repeats were found, to be cut.

A null text is empty. Texts under ``LENGTH`` bytes lose nothing. Null ids count
as larger than any id (ids lie below 2**62); different texts of one id, or of
none, come in the order of a hash. Rows that repeat id and text are one
document: both keep the same bytes. Texts are scanned in pieces of ``PIECE``
starts. Empty table: no rows. Extra columns are ignored by the report and kept
in ``_row`` by ``cut``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bit_table, in_table, order_key, store, whole_row

LENGTH = 100
GRAM = 32
#: Starts of a text that are handled at once.
PIECE = 1 << 20
#: Representatives of a bucket that one task refines.
CROWD = 4096
#: Representatives that a task refines at once, whole buckets apart.
AT_ONCE = 1 << 13
#: Bits of the table of repeated grams, per gram, and the least and most of it.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 28

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_LOW = np.uint64(0xFFFFFFFF)

_RUNS = "dk long, th long, lo int, hi int, q long, u long, body binary"
_SPANS = "dk long, th long, lo int, hi int"


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a * _A) ^ (b + _B)
    h ^= h >> np.uint64(29)
    h *= _B
    h ^= h >> np.uint64(32)
    return h


def _words8(b: bytes) -> np.ndarray:
    """The 8 bytes at every place as one number."""
    return np.ndarray((len(b) - 7,), dtype="<u8", buffer=b, strides=(1,))


def gram_hashes(b: bytes) -> np.ndarray:
    """Hash of the ``GRAM`` (32) bytes at every place."""
    w = _words8(b)
    h = _mixed(w[:-8], w[8:])
    return _mixed(h[:-16], h[16:])


def runs(b: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start, gram hash) of each run of successive strings of
    ``length`` bytes that have the same least gram at the same place."""
    if len(b) < length:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.int64),)
    h = gram_hashes(b)
    least = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    width, done = length - GRAM + 1, 1
    while 2 * done <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < width:
        least = np.minimum(least[:len(least) - (width - done)], least[width - done:])
    at = least & _LOW
    lo = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    hi = np.concatenate([lo[1:] - 1, [len(at) - 1]])
    return lo, hi, (h[at[lo].astype(np.int64)] >> np.uint64(1)).astype(np.int64)


def _pieces(text: str | None, length: int) -> Iterator[tuple[int, bytes]]:
    b = (text or "").encode("utf-8", "surrogatepass")
    for a in range(0, max(len(b) - length + 1, 0), PIECE):
        yield a, b[a:a + PIECE + length - 1]


def _grams(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text in b.column(0):
                for _, piece in _pieces(text.as_py(), length):
                    yield pa.RecordBatch.from_arrays([pa.array(runs(piece, length)[2])], ["q"])
    return _gathered(run, 1 << 16)


def _gathered(make, rows: int):
    """Batches of ``make`` put together until they have so many rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0
        for b in make(batches):
            kept.append(b)
            n += b.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
                kept, n = [], 0
        if n:
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
    return run


def _live(length: int, table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dk, th, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                for a, piece in _pieces(text.as_py(), length):
                    lo, hi, q = runs(piece, length)
                    maybe = in_table(table, q)
                    if not maybe.any():
                        continue
                    lo, hi, q = lo[maybe], hi[maybe], q[maybe]
                    bodies = [piece[x:y + length] for x, y in zip(lo.tolist(), hi.tolist())]
                    u = np.fromiter(map(xxhash.xxh3_64_intdigest, bodies), np.uint64, len(bodies)).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(q), dk)), pa.array(np.full(len(q), th)), pa.array((lo + a).astype(np.int32)),
                         pa.array((hi + a).astype(np.int32)), pa.array(q), pa.array(u), pa.array(bodies, pa.binary())],
                        ["dk", "th", "lo", "hi", "q", "u", "body"])
    return _gathered(run, 1 << 13)


def _sized_table(values: DataFrame) -> np.ndarray:
    """A bit table of the one column of a stored table, sized by its rows."""
    return bit_table(values, min(max(1 << (BITS_EACH * values.count()).bit_length(), LEAST_BITS), MOST_BITS))


def _held(table: np.ndarray):
    """The runs whose gram the table may hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(in_table(table, b.column("q").to_numpy())))
    return run


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts: each key's bucket, and which are not alone in theirs."""
    order = np.argsort(keys, kind="stable")
    new = np.empty(len(keys), bool)
    new[:1] = True
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    bucket = np.cumsum(new) - 1
    size = np.bincount(bucket)
    rank = np.empty(len(keys), np.int64)
    rank[order] = bucket
    return rank, size[rank] > 1


def refined(bodies: list[bytes], length: int) -> list[np.ndarray]:
    """For byte strings in the order of their places, per string the starts of
    those substrings of ``length`` that also start earlier in this order."""
    ends = np.cumsum([len(x) for x in bodies])
    text = b"".join(bodies)
    row_end = np.repeat(ends, [len(x) for x in bodies])
    starts = np.arange(len(text))
    at = starts[:len(text) - 7][starts[:len(text) - 7] + 8 <= row_end[:len(text) - 7]]
    pointer = np.full(len(text), -1, np.int64)
    rank, alive = _ranks(_words8(text)[at])
    pointer[at[alive]] = rank[alive]
    gram = 8
    while gram < length:
        offset = min(gram, length - gram)           # a later bucket's offset
        at = np.flatnonzero(pointer >= 0)
        at = at[at + offset + gram <= row_end[at]]
        at = at[pointer[at + offset] >= 0]
        own, later = pointer[at], pointer[at + offset]
        rank, alive = _ranks(own * len(text) + later)
        pointer = np.full(len(text), -1, np.int64)
        pointer[at[alive]] = rank[alive]
        gram += offset
    at = np.flatnonzero(pointer >= 0)
    _, first = np.unique(pointer[at], return_index=True)
    again = np.delete(at, first)
    row = np.searchsorted(ends, again, side="right")
    begin = ends - [len(x) for x in bodies]
    cut = np.searchsorted(row, np.arange(len(bodies) + 1))
    return [again[cut[i]:cut[i + 1]] - begin[i] for i in range(len(bodies))]


def _stretches(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of successive numbers."""
    gap = np.flatnonzero(np.diff(starts) != 1)
    return starts[np.concatenate([[0], gap + 1])], starts[np.concatenate([gap, [len(starts) - 1]])]


def _refine_chunk(t: pa.Table, length: int) -> pa.RecordBatch:
    t = t.sort_by([("dk", "ascending"), ("th", "ascending"), ("lo", "ascending")])
    out: dict[str, list] = {"dk": [], "th": [], "lo": [], "hi": []}
    place = list(zip(*[t[c].to_pylist() for c in ("dk", "th", "lo")]))
    for (dk, th, lo), again in zip(place, refined(t["body"].to_pylist(), length)):
        if len(again):
            a, z = _stretches(again)
            out["dk"] += [dk] * len(a)
            out["th"] += [th] * len(a)
            out["lo"] += (a + lo).tolist()
            out["hi"] += (z + lo).tolist()
    kinds = {"dk": pa.int64(), "th": pa.int64(), "lo": pa.int32(), "hi": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array(out[c], k) for c, k in kinds.items()], list(kinds))


def _refine(length: int):
    """Whole buckets of a partition sorted by q, some ``AT_ONCE`` rows together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b])
            rest = t if rest is None else pa.concat_tables([rest, t])
            if rest.num_rows < AT_ONCE:
                continue
            q = rest["q"].to_numpy()
            n = int(np.searchsorted(q, q[-1]))      # the last bucket may go on
            if n:
                yield _refine_chunk(rest.slice(0, n), length)
                rest = rest.slice(n)
        if rest is not None and rest.num_rows:
            yield _refine_chunk(rest, length)
    return run


def place_key(df: DataFrame) -> list[Column]:
    """(dk, th): a document's place in the order of documents."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return [order_key("doc_id", F.xxhash64(F.lit("place"), text)).alias("dk"), F.xxhash64(text).alias("th")]


def repeated_starts(df: DataFrame, length: int = LENGTH) -> DataFrame:
    """(dk, th, lo, hi): in the document with that key, the strings of
    ``length`` bytes that start from lo to hi start earlier as well."""
    if length < GRAM + 8:
        raise ValueError(f"length must be at least {GRAM + 8}")
    grams = df.select("text").mapInArrow(_grams(length), "q long")
    repeated = store(grams.groupBy("q").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("q"), "repeat-grams")
    live = store(df.select(*place_key(df), "text").mapInArrow(_live(length, _sized_table(repeated)), _RUNS), "repeat-runs",
                 compression="zstd")

    classes = store(live.groupBy("q", "u").agg(F.min(F.struct("dk", "th", "lo")).alias("first"), F.count(F.lit(1)).alias("n")),
                    "repeat-classes", compression="zstd")
    firsts = classes.where("n > 1").select("q", "u", *[F.col(f"first.{c}").alias(f"f_{c}") for c in ("dk", "th", "lo")])
    later = (F.col("dk") != F.col("f_dk")) | (F.col("th") != F.col("f_th")) | (F.col("lo") != F.col("f_lo"))
    whole = live.drop("body").join(firsts, ["q", "u"]).where(later).select("dk", "th", "lo", "hi")

    mixed = store(classes.groupBy("q").agg(F.count(F.lit(1)).alias("nc")).where("nc > 1"), "repeat-mixed")
    some = live.mapInArrow(_held(_sized_table(mixed.select("q"))), _RUNS)
    run = F.struct("dk", "th", "lo", "hi", "body")
    open_runs = store(some.groupBy("q", "u").agg(F.min(run).alias("first")).select("q", "first.*").join(mixed, "q"), "repeat-open",
                      compression="zstd")
    parts = (open_runs.where(F.col("nc") <= CROWD).select("dk", "th", "lo", "q", "body")
             .repartition("q").sortWithinPartitions("q").mapInArrow(_refine(length), _SPANS))
    crowd = open_runs.where(F.col("nc") > CROWD).select(
        "dk", "th", "lo", "body", F.explode(F.sequence(F.lit(0), F.col("hi") - F.col("lo"))).alias("o")).select(
        "dk", "th", (F.col("lo") + F.col("o")).alias("s"), F.substring("body", F.col("o") + 1, F.lit(length)).alias("bytes"))
    first = crowd.groupBy("bytes").agg(F.min(F.struct("dk", "th", "s")).alias("f")).select("f.*")
    crowded = crowd.drop("bytes").join(first, ["dk", "th", "s"], "left_anti").select("dk", "th", F.col("s").alias("lo"), F.col("s").alias("hi"))
    return whole.unionByName(parts).unionByName(crowded)


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed, spans, kept = [], [], []
            for text, found in zip(b.column("text"), b.column("spans")):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                if not found.is_valid:
                    removed.append(0)
                    spans.append(0)
                    kept.append(raw)
                    continue
                lo = found.values.field("lo").to_numpy()
                edge = np.zeros(len(raw) + 1, np.int64)
                np.add.at(edge, lo, 1)
                np.add.at(edge, found.values.field("hi").to_numpy() + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                kept.append(np.frombuffer(raw, np.uint8)[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in b.schema.names if c not in ("text", "spans")],
                 pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                [*[c for c in b.schema.names if c not in ("text", "spans")], "n_removed", "n_spans", "kept"])
    return run


def _told(table: np.ndarray, wanted: bool):
    """The rows whose ``_at`` the table may hold, or the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(in_table(table, b.column("_at").to_numpy()) == wanted))
    return run


def _cut_rows(df: DataFrame, carried: DataFrame, length: int) -> DataFrame:
    """``carried``: the column to keep, dk, th and text of each row. Only texts
    that may have repeats are shuffled to them."""
    starts = store(repeated_starts(df, length).groupBy("dk", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "repeat-spans")
    at = F.shiftrightunsigned(F.xxhash64("dk", "th"), 1)
    table = _sized_table(starts.select(at.alias("at")))
    rows = carried.withColumn("_at", at)
    some = rows.mapInArrow(_told(table, True), rows.schema).join(starts, ["dk", "th"], "left")
    none = rows.mapInArrow(_told(table, False), rows.schema).withColumn("spans", F.lit(None).cast(starts.schema["spans"].dataType))
    columns = [carried.columns[0], "text", "spans"]
    name, kind = carried.columns[0], carried.schema[0].dataType.simpleString()
    shape = f"{name} {kind}, n_removed long, n_spans long, kept binary"
    return (some.select(*columns).mapInArrow(_cut(length), shape)
            .unionByName(none.select(*columns).mapInArrow(_cut(length), shape)))


def cut(df: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row: ``_row`` (all its columns), n_removed, n_spans and ``kept``, the
    bytes that stay (which may begin or end within a character)."""
    return _cut_rows(df, df.select(whole_row(df), *place_key(df), "text"), length)


def repeat_report(df: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = _cut_rows(df, df.select("doc_id", *place_key(df), "text"), length)
    return rows.select("doc_id", (F.octet_length("kept") + F.col("n_removed")).cast("long").alias("n_bytes"),
                       "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def oracle() -> str:
    """DuckDB SQL for ``repeat_report``: every string of every document, as hex,
    taken from pieces (SQL finds a place in a text by walking to it)."""
    return f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, k, substr(h, 2 * k + 1, {2 * (499 + LENGTH)}) AS h
      FROM d, unnest(range(0, greatest(CAST(length(h) AS BIGINT) // 2 - {LENGTH - 1}, 0), 500)) t(k)),
w AS (SELECT doc_id, k + s AS s, substr(h, 2 * s + 1, {2 * LENGTH}) AS x
      FROM p, unnest(range(0, CAST(length(h) AS BIGINT) // 2 - {LENGTH - 1})) t(s)),
again AS (SELECT doc_id, s FROM w QUALIFY row_number() OVER (PARTITION BY x ORDER BY doc_id, s) > 1),
g AS (SELECT doc_id, s, coalesce(s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) > {LENGTH}, TRUE) AS new FROM again),
r AS (SELECT doc_id, s, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM g),
spans AS (SELECT doc_id, min(s) AS a, max(s) + {LENGTH} AS z FROM r GROUP BY doc_id, run),
k AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before,
             row_number() OVER (PARTITION BY doc_id ORDER BY a DESC) AS back FROM spans),
c AS (SELECT doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a)
             || max(CASE WHEN back = 1 THEN substr(h, 2 * z + 1) ELSE '' END) AS kept,
             sum(z - a) AS n_removed, count(*) AS n_spans FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""
