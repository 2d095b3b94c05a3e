"""Near-duplicates and decontamination against brute force."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from signalbox.llm import common, decontamination, near_dups
from signalbox.llm.components import components

SMALL = "/root/testdata/sf0.01"
DOC = "doc_id long, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))


def shingles(t):
    w = words(t)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    """doc_id -> least doc_id reachable, over all pairs."""
    sets, root = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    by_shingle = {}
    for i, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    pairs = {p for v in by_shingle.values() for p in itertools.combinations(sorted(v), 2)}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sets, {i: find(i) for i in sets}


def check(spark, rows):
    got = near_dups.duplicate_report(spark.createDataFrame(rows, DOC)).collect()
    sets, want = brute_components(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id), r


def test_whole_table(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    check(spark, [tuple(r) for r in df.collect()])


def edited(r, w, n):
    w = list(w)
    for _ in range(n):
        w[r.randrange(len(w))] = f"x{r.randrange(10**9)}"
    return " ".join(w)


def test_groups_chains_and_shared_passages(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 16)
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(4000)]
    text = lambda n: [r.choice(vocabulary) for _ in range(n)]
    out = []
    for n in (8, 30, 90, 400):                    # groups of edited copies around the threshold
        base = text(n)
        out += [edited(r, base, k) for k in (0, 0, 1, 1, 2, 3, max(1, n // 60), max(1, n // 50), max(1, n // 40))]
    chain = text(300)                             # each near the next, the ends far apart
    for i in range(25):
        out.append(" ".join(chain))
        chain = chain[8:] + text(8)
    passage = text(120)                           # most of many texts, yet these are not near
    out += [" ".join(passage + text(40 + i % 5)) for i in range(60)]
    out += [edited(r, passage + text(20), 1) for _ in range(10)]
    base = text(200)                              # one large group of near copies
    out += [edited(r, base, r.randrange(4)) for _ in range(80)]
    out += ["", "a", "a", "one two three", "One TWO\tthree", "É é", "é é"]
    rows = list(enumerate(out))
    r.shuffle(rows)
    check(spark, rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(40000))
    rows = [(1, None), (2, ""), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, None), (9, long), (8, long + " x"),
            (None, "only null ids have this text"), (7, "zz")]
    df = spark.createDataFrame(rows, DOC).withColumns({c: F.lit(1) for c in ("rid", "n", "sketch", "cid", "kept", "root")})
    got = near_dups.duplicate_report(df).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.n_shingles): r for r in got}
    assert by[3, 2].component_id == 3 and by[3, 2].kept
    # two texts of null ids have two shingles each, in no particular order
    nulls = {(r.component_id, r.kept) for r in got if r.doc_id is None and r.n_shingles == 2}
    assert nulls == {(3, False), (None, True)}
    assert by[9, 39996].component_id == 8 and by[1, 0].kept and by[None, 0].kept
    kept = near_dups.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1, (r.text or "")[:3]) for r in kept.collect()) == [
        (-1, ""), (-1, "onl"), (1, ""), (2, ""), (3, "a b"), (7, "zz"), (8, "w0 ")]
    assert near_dups.duplicate_report(df.where("false")).count() == 0


def test_texts_of_one_id_are_told_apart(spark):
    rows = [(1, "one two three four five six"), (1, "other words stand in this text"), (1, "other words stand in this text"),
            (2, "One two three four five six"), (3, "a third text of some words"), (3, "A THIRD text of some words")]
    got = near_dups.keep_one(spark.createDataFrame(rows, DOC)).collect()
    assert sorted((r.doc_id, r.text.lower()) for r in got) == [
        (1, "one two three four five six"), (1, "other words stand in this text"), (3, "a third text of some words")]


def test_only_rows_that_may_go_are_joined(spark):
    """The join that takes out the copies gets the rows that the bit table lets through, not all."""
    rows = [(i, f"one two three four five six seven {'eight' if i < 3 else i}") for i in range(9)] + [(None, None), (20, ""), (20, "")]
    out = near_dups.keep_one(spark.createDataFrame(rows, DOC))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and re.search(r"Join LeftAnti(?s:.*)Filter pythonUDF", plan), plan
    assert {(r.doc_id, r.text) for r in out.collect()} == {(None, None), (20, ""), (0, rows[0][1]), *rows[3:9]}
    gone = spark.createDataFrame([(i, i) for i in range(0, 300, 3)], "a long, b long")
    left = near_dups._without(spark.range(300).selectExpr("id as a", "id as b", "id as x"), gone, ["a", "b"])
    assert sorted(r.x for r in left.collect()) == [i for i in range(300) if i % 3]


def test_components_of_chains_and_cycles(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000 + i, 1000 + (i + 1) % 40) for i in range(40)]
    edges += [(2000, 2000 + i) for i in range(1, 200)] + [(2150, 50000)] + [(5, 5)]
    r.shuffle(edges)
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(40)} | {2000 + i: 2000 for i in range(200)} | {50000: 2000}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_hot_key_is_dealt_to_copies(spark, monkeypatch):
    monkeypatch.setattr(common, "ROWS_PER_COPY", 10)
    rows = spark.createDataFrame([(0, i) for i in range(300)] + [(k, k) for k in range(1, 40)] + [(99, 1)], "k long, x long")
    table = spark.createDataFrame([(k, f"v{k}") for k in range(30)], "k long, y string")
    counts = common.store(rows.groupBy("k").agg(F.count(F.lit(1)).alias("m")), "counts")
    for how in ("inner", "left"):
        got = common.spread_join(rows, table, ["k"], F.xxhash64("x"), counts, how)
        assert got.columns == ["k", "x", "y"]
        assert sorted(got.collect()) == sorted(rows.join(table, "k", how).collect())
    assert "_copies" in got._jdf.queryExecution().toString()
    empty = counts.where("false")
    assert common.spread_join(rows.where("false"), table, ["k"], F.xxhash64("x"), empty).count() == 0


@pytest.mark.parametrize("block", [2, 5, 512])
def test_blocks_meet_as_all_pairs_do(spark, monkeypatch, block):
    monkeypatch.setattr(near_dups, "BLOCK", block)
    r = random.Random(block)
    rows = [(v, cid, r.choice([6, 7, 20, 22, 23, 40, 47, 48, 300]), r.randrange(4), r.randrange(3))
            for v in range(4) for cid in r.sample(range(1000), 40)] + [(9, 1, 20, 5, 0), (9, 2, 20, 5, 0)]
    want = set()
    for v, a, n, x, p in rows:
        for w, b, m, y, q in rows:
            most = min(n - p, m - q)
            if v == w and a < b and x != y and 100 * min(n, m) >= 85 * max(n, m) and most * 185 >= (n + m) * 85:
                want.add((a, b))
    got = near_dups._meetings(spark.createDataFrame(rows, "v long, cid long, n int, root long, pos int"))
    assert sorted(tuple(x) for x in got.collect()) == sorted(want)


def test_hot_lists_hubs_and_copies_give_the_same_components(spark, monkeypatch):
    """A passage that most texts share, many copies of one text, a hub of near copies: all joins split."""
    monkeypatch.setattr(common, "ROWS_PER_COPY", 3)
    monkeypatch.setattr(near_dups, "BLOCK", 3)
    r = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    shared = " ".join(f"s{i}" for i in range(12))
    texts = [" ".join(base)] * 20 + [" ".join([*base[:58], f"x{i}", f"y{i}"]) for i in range(20)]
    texts += [shared + " " + " ".join(f"t{r.randrange(9)}" for _ in range(4)) for _ in range(40)] + ["", None, "one two"] * 5
    check(spark, list(enumerate(texts)))


def brute_contained(rows, items):
    out = set()
    sets = {i: shingles(t) for i, t in rows}
    for k, t in items:
        s = shingles(t)
        out |= {(i, k, len(s), len(s & d)) for i, d in sets.items() if s and len(s & d) >= decontamination.CONTAINED * len(s)}
    return out


def found(df, bench):
    return {tuple(r)[:4] for r in decontamination.contamination_report(df, bench).collect()}


def test_decontamination_whole_table(spark):
    df, bench = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    rows, items = [tuple(r) for r in df.select("doc_id", "text").collect()], [tuple(r) for r in bench.collect()]
    want = brute_contained(rows, items)
    assert want and found(df, bench) == want
    clean = decontamination.drop_contaminated(df, bench)
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - {w[0] for w in want}


def test_decontamination_of_every_size(spark):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(text(n))) for k, n in enumerate([1, 3, 4, 5, 6, 9, 12, 20, 33, 64, 70, 130, 300, 900])]
    items += [(90, None), (91, ""), (None, " ".join(text(15))), (92, items[7][1])]
    rows = []
    for k, t in items:
        if t:
            w = t.split()
            for at in (0, 1, 37, 500, 20000):
                rows.append(" ".join(text(at) + w + text(at)))
            rows.append((" ".join(text(50) + w[:len(w) // 2] + text(200) + w[len(w) // 2:])).upper())
            rows.append(" ".join(text(50) + w[:-max(1, len(w) // 10)] + text(60)))
            rows.append(" ".join(text(50) + w[:len(w) * 6 // 10] + text(60)))
    rows = [*enumerate(rows), (9000, None), (9001, ""), (9002, items[1][1])]
    df = spark.createDataFrame(rows, DOC).withColumns({c: F.lit(1) for c in ("item_id", "n", "k1", "hits", "class")})
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_contained(rows, items)
    assert found(df, bench) == want
    assert decontamination.contamination_report(df, bench.where("false")).count() == 0
    assert decontamination.contamination_report(df.where("false"), bench).count() == 0
    assert decontamination.drop_contaminated(df, bench.where("false")).count() == len(rows)
    again = spark.createDataFrame([(1, items[8][1])] * 2 + [(None, items[8][1])], DOC)
    assert len(decontamination.contamination_report(again, bench).collect()) == 2
    assert decontamination.drop_contaminated(again, bench).count() == 0



def test_a_linked_pair_is_missed_less_than_once_in_a_hundred_thousand():
    """The bound behind LEAST: of K values of the union's sketch, each is shared with probability 0.85."""
    from math import comb
    miss = sum(comb(near_dups.K, i) * 0.85 ** i * 0.15 ** (near_dups.K - i) for i in range(near_dups.LEAST))
    assert miss < 1e-5


def test_an_item_in_distant_pieces_is_found(spark):
    item = [f"item{i}" for i in range(59)]
    fill = lambda k: [f"fill{k}x{i}" for i in range(400)]
    pieces = [*fill(0), *item[:20], *fill(1), *item[20:40], *fill(2), *item[40:], *fill(3)]
    half = [*fill(4), *item[:20], *fill(5), *item[40:]]
    long = [f"long{i}" for i in range(1000)]
    spread = [w for k in range(10) for w in [*long[100 * k:100 * k + 100], *fill(10 + k), *fill(20 + k), *fill(30 + k), *fill(40 + k), *fill(50 + k), *fill(60 + k)]]
    df = spark.createDataFrame([(1, " ".join(pieces)), (2, " ".join(half)), (3, " ".join(spread))], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item)), (8, " ".join(long))], "item_id long, text string")
    got = {tuple(r)[:4] for r in decontamination.contamination_report(df, bench).collect()}
    assert got == {(1, 7, 55, 47), (3, 8, 996, 960)}
    assert [r.doc_id for r in decontamination.drop_contaminated(df, bench).collect()] == [2]


def test_candidates_come_from_the_partitions_alone(spark, monkeypatch):
    item = [f"item{i}" for i in range(40)]
    fill = lambda k: [f"fill{k}x{i}" for i in range(300)]
    df = spark.createDataFrame([(1, " ".join([*fill(0), *item, *fill(1)])), (2, " ".join([*item[:20], *fill(2), *item[19:]]))], DOC)
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    assert {r.doc_id for r in decontamination.contamination_report(df, bench).collect()} == {1, 2}
    real = decontamination.store
    no_windows = lambda x: x.withColumn("windows", F.filter("windows", lambda w: F.lit(False)))
    monkeypatch.setattr(decontamination, "store", lambda x, label: real(no_windows(x) if label == "bench-hits" else x, label))
    assert decontamination.contamination_report(df, bench).count() == 0
