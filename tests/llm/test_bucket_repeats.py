"""Repeated strings against a table of all strings of 100 bytes."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalbox.llm import bucket_repeats
from tools.oracle_check import duck, rows_of

DOC = "doc_id long, text string"
SMALL = "/root/testdata/sf0.01"


def brute(rows, n=100):
    """Rows of different ids; the smallest id first, null last."""
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - n + 1):
            x = b[s:s + n]
            if x in seen:
                gone[s:s + n] = [True] * n
            seen.add(x)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0))


def check(spark, rows):
    assert order(bucket_repeats.repeat_report(spark.createDataFrame(rows, DOC)).collect()) == order(brute(rows))


def test_whole_table(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    check(spark, [tuple(r) for r in df.collect()])


def test_sql(spark):
    df = bucket_repeats.repeat_report(spark.read.parquet(f"{SMALL}/documents.parquet"))
    res = duck(SMALL).execute(bucket_repeats.oracle())
    cols = [d[0] for d in res.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


def noise(r, n, letters="abcdefghij é"):
    return "".join(r.choice(letters) for _ in range(n))


def planted(r):
    """Copies, overlaps, periods, edges of 99 to 101 bytes, edits."""
    a, b = noise(r, 700), noise(r, 300)
    texts = [a, b, a, a[:350] + "X" + a[351:], a[100:199] + b[:100], a[100:200] + noise(r, 50) + b[50:151],
             "ab" * 300, "z" * 450, "z" * 99, "z" * 100, "", None, a + a, noise(r, 40) + b + b[:120] + noise(r, 40),
             "é" * 200, "x" + "é" * 120]
    texts += [noise(r, 60) + a[200:330] + noise(r, 60) for _ in range(40)]
    texts += [a[:i] + noise(r, 3) + a[i:] for i in range(0, 700, 37)]
    r.shuffle(texts)
    return [(7 * i - 50, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_planted(spark, seed):
    rows = planted(random.Random(seed))
    check(spark, [*rows[1:], (None, rows[0][1])])


def test_crowded_buckets_and_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(bucket_repeats, "CROWD", 3)
    check(spark, planted(random.Random(4)))


def test_pieces_and_chunks_change_nothing(monkeypatch):
    r = random.Random(9)
    text = noise(r, 900) * 2 + "q" * 500
    whole = bucket_repeats.runs(text.encode(), 100)
    covered = sum((z - a + 1).sum() for a, z, _ in [whole])
    assert covered == len(text.encode()) - 99
    monkeypatch.setattr(bucket_repeats, "PIECE", 257)
    parts = [(a + x, a + y) for a, p in bucket_repeats._pieces(text, 100) for x, y in zip(*bucket_repeats.runs(p, 100)[:2])]
    starts = [s for x, y in parts for s in range(x, y + 1)]
    assert starts == list(range(len(text.encode()) - 99))


@pytest.mark.parametrize("length", [40, 64, 100, 130])
def test_refinement_is_a_sort_of_all_starts(length):
    r = random.Random(length)
    base = noise(r, 300).encode()
    bodies = [base[i:i + length + r.randrange(60)] for i in range(0, 150, 9)] + [b"y" * (length + 20)]
    seen, want = set(), []
    for x in bodies:
        again = []
        for s in range(len(x) - length + 1):
            if x[s:s + length] in seen:
                again.append(s)
            seen.add(x[s:s + length])
        want.append(again)
    assert [list(x) for x in bucket_repeats.refined(bodies, length)] == want


def test_equal_strings_have_equal_grams():
    r = random.Random(3)
    shared = noise(r, 150).encode()
    for pre in (0, 1, 33, 200):
        text = noise(r, pre).encode() + shared + noise(r, 90).encode()
        lo, hi, q = bucket_repeats.runs(text, 100)
        inside = {(s - len(text) + 90): q[np.searchsorted(lo, s, side="right") - 1] for s in range(len(lo) and hi[-1] + 1)}
        at = text.index(shared)
        got = [q[np.searchsorted(lo, at + s, side="right") - 1] for s in range(51)]
        if pre == 0:
            first = got
        assert got == first and inside


def test_ids_that_repeat_and_other_columns(spark):
    r = random.Random(8)
    a, b = noise(r, 300), noise(r, 300)
    rows = [(1, a), (1, a), (2, a), (3, b), (3, b + "x"), (None, b), (None, None)]
    df = spark.createDataFrame(rows, DOC)
    got = bucket_repeats.repeat_report(df).collect()
    assert len(got) == len(rows)
    by = {}
    for x in got:
        by.setdefault(x.doc_id, []).append(x.n_removed)
    n = len(a.encode())
    assert by[1] == [0, 0] and by[2] == [n] and sorted(by[None]) == [0, len(b.encode())]
    assert 0 in by[3] and max(by[3]) >= len(b.encode())     # one of the two texts comes first
    clash = df.withColumns({c: F.lit("x") for c in ("dk", "th", "lo", "hi", "q", "u", "n", "spans", "kept", "n_removed")})
    assert sorted(map(str, bucket_repeats.repeat_report(clash).collect())) == sorted(map(str, got))
    kept = bucket_repeats.cut(clash).collect()
    assert {k._row.dk for k in kept} == {"x"} and sum(k.n_removed for k in kept) == sum(x.n_removed for x in got)


def test_empty_table(spark):
    assert bucket_repeats.repeat_report(spark.createDataFrame([], DOC)).count() == 0
    check(spark, [(1, None), (2, ""), (3, "short")])
