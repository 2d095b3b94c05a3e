"""Vector code compression: product codes by ball k-means.

A vector is cut into ``PARTS`` equal consecutive parts; every part position has
a codebook of at most ``ENTRIES`` entries. An assignment knows the entry that a
part had before, at the codebook before (at the start: entry 0). The members of
an entry form a ball around it, as wide as its farthest member:

* *neighbours*: only entries nearer than twice the radius can take a member;
* *stable core*: members nearer than half the way to the nearest neighbour stay
  without another distance;
* *annular rings*: the rest is sorted by distance; a member in the ring between
  half the ways to neighbours k and k + 1 looks at the k nearest only.

An entry at a distance of exactly twice the member's own may tie, so it is
looked at (ties go to the lower index). All numbers are integers and exact. A
ball is that of a task's batch, so neighbours never depend on other tasks.

Spark holds the vectors in tables beside their present codes, one assignment a
pass; sums and counts are added up by part and entry. The driver sees the
codebooks alone (entries x dimensions). They grow with nothing.

Dropped are null vectors and those with null or non-finite components; also
those whose length is not that of the first kept vector (by vec_id). A length
that ``PARTS`` does not divide gives the first parts one component more; with
fewer components than parts the rest are empty (code 00). Floors beyond
+-2**62 count as that, and an error beyond a long as the largest long. Null ids
come last, repeated ids by their vectors. Fewer kept rows than ``ENTRIES``
make a smaller codebook. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Components up to here keep squared distances of a part within 63 bits.
EXACT = 1 << 26
MOST = 1 << 62
LONGEST = (1 << 63) - 1

_CODED = "vec_id long, label string, vector array<double>, codes binary, error long"


def integers(vectors: pa.ListArray, length: int) -> np.ndarray:
    """Rows of floor(SCALE * x); Python integers where int64 would not be exact."""
    flat = np.floor(np.asarray(vectors.flatten(), np.float64) * SCALE)
    x = flat.reshape(len(vectors), length)
    if not x.size or np.abs(x).max() < EXACT:
        return x.astype(np.int64)
    exact = [max(-MOST, min(MOST, int(v))) if np.isfinite(v) else (MOST if v > 0 else -MOST) for v in flat]
    return np.array(exact, object).reshape(x.shape)


def cuts(length: int, parts: int = PARTS) -> list[slice]:
    sizes = [length // parts + (i < length % parts) for i in range(parts)]
    ends = np.cumsum(sizes)
    return [slice(int(e - s), int(e)) for s, e in zip(sizes, ends)]


def ball_assign(x: np.ndarray, entries: np.ndarray, old: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row of ``x`` and its squared distance, from the
    entries ``old`` that the rows had before."""
    own = ((x - entries[old]) ** 2).sum(1)
    best, least = old.copy(), own.copy()
    between = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(2)
    order = np.argsort(old, kind="stable")
    ends = np.searchsorted(old[order], np.arange(len(entries) + 1))
    for i in range(len(entries)):
        ball = order[ends[i]:ends[i + 1]]
        if not len(ball):
            continue
        reach = 4 * own[ball]                      # (twice the distance) squared
        near = np.argsort(between[i], kind="stable")
        near = near[near != i]
        gaps = between[i][near]
        neighbours = gaps <= reach.max()           # the ball's radius
        near, gaps = near[neighbours], gaps[neighbours]
        if not len(near):
            continue
        outward = np.argsort(-reach, kind="stable")
        ball, reach = ball[outward], reach[outward]
        rings = np.searchsorted(-reach, -gaps, side="right")  # members that reach each neighbour
        for e, n in zip(near.tolist(), rings.tolist()):
            rows = ball[:n]
            d = ((x[rows] - entries[e]) ** 2).sum(1)
            won = (d < least[rows]) | ((d == least[rows]) & (e < best[rows]))
            best[rows[won]], least[rows[won]] = e, d[won]
    return best, least


def _assigner(books: list[np.ndarray], length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = integers(b.column("vector"), length)
            old = np.frombuffer(b"".join(b.column("codes").to_pylist()), np.uint8).reshape(-1, PARTS).astype(np.int64)
            codes, error = np.zeros_like(old), np.zeros(len(x), object)
            for p, cut in enumerate(cuts(length)):
                codes[:, p], d = ball_assign(x[:, cut], books[p], old[:, p])
                error = error + d.astype(object)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), b.column("vector"),
                 pa.array([r.tobytes() for r in codes.astype(np.uint8)], pa.binary()),
                 pa.array([min(int(e), LONGEST) for e in error], pa.int64())],
                ["vec_id", "label", "vector", "codes", "error"])
    return run


def _summer(sizes: list[int], length: int):
    wide = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        counts: dict[tuple[int, int], int] = {}
        for b in batches:
            if not b.num_rows:
                continue
            x = integers(b.column("vector"), length)
            codes = np.frombuffer(b"".join(b.column("codes").to_pylist()), np.uint8).reshape(-1, PARTS)
            for p, cut in enumerate(cuts(length)):
                order = np.argsort(codes[:, p], kind="stable")
                used, starts = np.unique(codes[order, p], return_index=True)
                part = np.add.reduceat(x[order][:, cut], starts, axis=0).astype(object)
                for e, s, n in zip(used.tolist(), part, np.diff([*starts, len(x)]).tolist()):
                    sums[p, e] = sums.get((p, e), 0) + s
                    counts[p, e] = counts.get((p, e), 0) + n
        rows = [(p, e, i, int(v), counts[p, e]) for (p, e), s in sums.items() for i, v in enumerate(s)]
        if rows:
            p, e, i, v, n = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(i, pa.int32()),
                 pa.array([Decimal(k) for k in v], wide), pa.array(n, pa.int64())], ["part", "entry", "place", "total", "n"])
    return run


def _as_book(rows: np.ndarray) -> np.ndarray:
    small = not rows.size or max(abs(int(v)) for v in rows.flat) < EXACT
    return rows.astype(np.int64 if small else object)


def next_books(coded: DataFrame, books: list[np.ndarray], length: int) -> list[np.ndarray]:
    """The codebooks after one round; entries without parts stay."""
    sums = coded.select("vector", "codes").mapInArrow(
        _summer([len(b) for b in books], length), "part int, entry int, place int, total decimal(38,0), n long")
    total = sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("t"), F.sum("n").alias("n")).collect()
    new = [b.astype(object) for b in books]
    for r in total:
        new[r.part][r.entry, r.place] = int(r.t) // int(r.n)
    return [_as_book(b) for b in new]


def kept_vectors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vec_id, label, vector) of the rows whose vector is whole and finite,
    and the first ``ENTRIES`` of them by id."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                     v.alias("vector")).where(F.col("vector").isNotNull() & ~bad)
    return rows, rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES)


class Codes:
    """Codebooks of a table of vectors and its rows' codes."""

    def __init__(self, df: DataFrame):
        rows, first = kept_vectors(df)
        seeds = first.toArrow()
        lengths = [len(v) for v in seeds["vector"]]
        self.length = length = lengths[0] if lengths else 0
        if any(n != length for n in lengths):  # the first ones of the right length
            seeds = rows.where(F.size("vector") == length).orderBy(
                F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).toArrow()
        x = integers(seeds["vector"].combine_chunks(), length) if len(lengths) else np.zeros((0, 0), np.int64)
        self.books = [_as_book(x[:, cut]) for cut in cuts(length)]
        coded = rows.where(F.size("vector") == length).select(
            "*", F.lit(bytes(PARTS)).alias("codes"))
        for _ in range(ROUNDS):
            coded = store(self._assigned(coded), "codes-round")
            self.books = next_books(coded, self.books, length)
        self.rows = store(self._assigned(coded).drop("vector"), "codes")

    def _assigned(self, coded: DataFrame) -> DataFrame:
        return coded.select("vec_id", "label", "vector", "codes").mapInArrow(_assigner(self.books, self.length), _CODED)

    def digest(self) -> str:
        """SHA-256 of all entries' components by part, entry and place."""
        flat = [str(int(v)) for b in self.books for row in b for v in row]
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


def code_report(df: DataFrame) -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error, codebooks_sha256."""
    c = Codes(df)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(Decimal(LONGEST)).cast("decimal(38,0)"))
    by_label = c.rows.groupBy(F.col("label").alias("_label")).agg(total.cast("long").alias("label_error"))
    return (c.rows.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
                    F.lit(c.digest()).alias("codebooks_sha256")))


def oracle() -> str:
    """DuckDB SQL for ``code_report``: every distance of every part."""
    def assign(n: int) -> str:
        return f"""
a{n} AS (
  SELECT vec_id, part, arg_min(entry, d * {ENTRIES} + entry) AS entry, min(d) AS d
  FROM (SELECT v.vec_id, v.part, c.entry,
               CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM v JOIN c{n} c USING (part)) GROUP BY vec_id, part)"""

    def update(n: int) -> str:
        return f"""
s{n} AS (
  SELECT part, entry, list(m ORDER BY place) AS x FROM (
    SELECT part, entry, place, CAST(floor(sum(val)::DECIMAL(38,0) / count(*)) AS BIGINT) AS m FROM (
      SELECT part, entry, unnest(range(1, len(x) + 1)) AS place, unnest(x) AS val FROM v JOIN a{n - 1} USING (vec_id, part))
    GROUP BY part, entry, place) GROUP BY part, entry),
c{n} AS (
  SELECT c.part, c.entry, coalesce(s.x, c.x) AS x FROM c{n - 1} c LEFT JOIN s{n} s ON s.part = c.part AND s.entry = c.entry)"""
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (
  SELECT vec_id, label, part, x[part * (len(x) // {PARTS}) + 1:(part + 1) * (len(x) // {PARTS})] AS x
  FROM kept, range({PARTS}) t(part)),
ids AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {ENTRIES}),
c0 AS (SELECT part, entry, x FROM v JOIN ids USING (vec_id)),{assign(0)},{update(1)},{assign(1)},{update(2)},{assign(2)},
book AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2),
code AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a2 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM code JOIN kept USING (vec_id), book
"""
