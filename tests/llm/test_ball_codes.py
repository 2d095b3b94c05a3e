"""Product codes against a search of all entries."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalbox.llm import ball_codes
from tools.oracle_check import duck, rows_of

VEC = "vec_id long, embedding array<float>, label int"
SMALL = "/root/testdata/sf0.01"


def brute(rows, parts=16, entries=64):
    """Python integers; every entry is tried."""
    f32 = lambda x: float(np.float32(x))
    kept = [(i, [math.floor(256 * f32(x)) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(f32(x)) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    n = len(kept[0][1]) if kept else 0
    sizes = [n // parts + (p < n % parts) for p in range(parts)]
    cut = lambda v, p: v[sum(sizes[:p]):sum(sizes[:p + 1])]
    books = [[cut(r[1], p) for r in kept[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(2):
        codes = [[nearest(cut(r[1], p), books[p])[1] for p in range(parts)] for r in kept]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(r[1], p) for r, c in zip(kept, codes) if c[p] == e]
                if own:
                    books[p][e] = [sum(col) // len(own) for col in zip(*own)]
    out = []
    for i, v, label in kept:
        best = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append([i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label])
    sums = {}
    for r in out:
        sums[r[3]] = sums.get(r[3], 0) + r[2]
    top = (1 << 63) - 1
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, c, min(e, top), min(sums[label], top), digest) for i, c, e, label in out]


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def check(spark, rows):
    assert order(ball_codes.code_report(spark.createDataFrame(rows, VEC)).collect()) == order(brute(rows))


def test_sql(spark):
    df = ball_codes.code_report(spark.read.parquet(f"{SMALL}/embeddings.parquet"))
    res = duck(SMALL).execute(ball_codes.oracle())
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


def test_ties_repeats_and_bad_vectors(spark):
    r = random.Random(2)
    few = [-0.01, 0.0, 0.004, 0.5]                      # many equal distances
    rows = [(i, [r.choice(few) for _ in range(32)], r.choice([None, 1, 2])) for i in range(150)]
    rows += rows[:20] + [(200, None, 1), (-1, [0.1] * 31 + [None], 1), (201, [float("nan")] * 32, 1),
                         (202, [float("inf")] * 32, None), (None, [0.25] * 32, 2), (None, None, None)]
    check(spark, rows)


def test_other_lengths_and_few_rows(spark):
    check(spark, [(3, [0.5, -0.7, 1.0], None), (4, [0.25, 0.0, 9.0], None), (5, [1.0], 1)])
    check(spark, [(i, [i / 3] * 20, i % 2) for i in range(70)])
    check(spark, [(1, [], 1), (2, [], None)])
    assert ball_codes.code_report(spark.createDataFrame([], VEC)).count() == 0
    assert ball_codes.code_report(spark.createDataFrame([(1, None, 1)], VEC)).count() == 0


def test_huge_components(spark):
    check(spark, [(1, [1e15] * 16, 1), (2, [-3e10] * 16, 1), (3, [5.0] * 16, 1)])


def test_clashing_columns(spark):
    rows = [(i, [i / 7] * 16, i % 3) for i in range(30)]
    df = spark.createDataFrame(rows, VEC)
    clash = df.withColumns({c: F.lit("x") for c in ("code", "codes", "error", "vector", "label_error", "_label")})
    assert order(ball_codes.code_report(clash).collect()) == order(brute(rows))


@pytest.mark.parametrize("seed", range(6))
def test_balls_leave_out_no_nearer_entry(seed):
    """From any earlier assignment, near or random."""
    r = np.random.default_rng(seed)
    x = r.integers(-40, 40, (500, 1 + seed % 4))
    entries = r.integers(-40, 40, (24, x.shape[1]))
    entries[5] = entries[2]
    d = ((x[:, None, :] - entries[None]) ** 2).sum(2)
    for old in (np.zeros(500, np.int64), r.integers(0, 24, 500), d.argmin(1)):
        best, least = ball_codes.ball_assign(x, entries, old)
        assert (best == d.argmin(1)).all() and (least == d.min(1)).all()


def test_stable_cores_measure_no_other_entry():
    x = np.array([[0], [1], [100], [101]])
    entries = np.array([[0], [100]])
    tried = []

    class Entries(np.ndarray):
        def __getitem__(self, k):
            if isinstance(k, int) and self.shape == (2, 1):
                tried.append(k)
            return super().__getitem__(k)
    ball_codes.ball_assign(x, entries.view(Entries), np.array([0, 0, 1, 1]))
    assert tried == []
