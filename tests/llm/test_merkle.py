"""The Merkle manifest against a plain recursion over all leaves."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from signalbox.llm import merkle
from tools.oracle_check import duck, rows_of

DOC = "doc_id long, source string, lang string, n_chars long, text string"
SMALL = "/root/testdata/sf0.01"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def lower(t):
    return None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def brute(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        own = sorted(sources[s], key=lambda r: (r[0] is None, r[0] or 0, leaf(r, r[4])))
        trees[s] = own, levels_of([leaf(r, r[4]) for r in own])
    top = levels_of([trees[s][1][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        own, levels = trees[s]
        for i, r in enumerate(own):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            digest, siblings = leaf(r, lower(r[4]) if tampered else r[4]), []
            for level, at in ((levels, i), (top, k)):
                for nodes in level[:-1]:
                    run = nodes[at // 16 * 16:at // 16 * 16 + 16]
                    left, right = run[:at % 16], run[at % 16 + 1:]
                    siblings += left + right
                    digest = h(*left, digest, *right)
                    at //= 16
            out.append((r[0], leaf(r, r[4]), levels[-1][0], top[-1][0], h(*siblings), digest, digest == top[-1][0]))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def check(spark, rows):
    got = [tuple(r) for r in merkle.manifest_report(spark.createDataFrame(rows, DOC)).collect()]
    assert order(got) == order(brute(rows))


def test_whole_table(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    check(spark, [tuple(r) for r in df.collect()])


def test_sql(spark):
    df = merkle.manifest_report(spark.read.parquet(f"{SMALL}/documents.parquet"))
    res = duck(SMALL).execute(merkle.oracle())
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


@pytest.mark.parametrize("n", [1, 2, 16, 17, 255, 256, 257, 4095, 4096, 4097, 4113, 8193])
def test_sizes_of_a_source(spark, n):
    check(spark, [(i, "a", "en", i, f"Text {i}") for i in range(n)] + [(n + 1, "b", None, None, "Z")])


def test_nulls_ties_repeats_and_many_sources(spark):
    r = random.Random(5)
    rows = [(r.choice([None, *range(40)]), r.choice([None, "", "é", "z", *[f"s{i}" for i in range(300)]]),
             r.choice([None, "de"]), r.choice([None, 3]), r.choice([None, "", "Ünï AB", "long " * 9000]))
            for _ in range(1500)]
    check(spark, rows + rows[:50])


def test_empty_and_extra_columns(spark):
    assert merkle.manifest_report(spark.createDataFrame([], DOC)).count() == 0
    df = spark.createDataFrame([(5, "a", "en", 1, "X"), (6, "a", "en", 1, "Y")], DOC)
    clash = df.withColumns({c: F.lit("x") for c in ("leaf", "root", "digest", "idx", "has", "path", "chosen", "items")})
    assert order(merkle.manifest_report(clash).collect()) == order(merkle.manifest_report(df).collect())


def test_folding_hashes_nothing_left_of_the_slot():
    children = [h(str(i)) for i in range(16)]
    node = merkle.Node(children)
    for i in range(16):
        assert node.fold(i, children[i]) == node.digest == h(*children)
        assert node.fold(i, h("x")) == h(*children[:i], h("x"), *children[i + 1:])
    node.children[:9] = [b""] * 9          # only states stand for what is left of a slot
    assert node.fold(9, children[9]) == node.digest


def test_another_change_is_seen(spark):
    df = spark.createDataFrame([(i, "a", "en", 1, f"t{i}") for i in range(40)], DOC)
    out = merkle.manifest(df, F.col("doc_id") == 7, str.upper).collect()
    assert {r.doc_id for r in out if r.folded_root != r.root} == {7}
