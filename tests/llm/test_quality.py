"""The classifier: gradients, held-out accuracy, whole texts."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalbox.llm import quality_cnn as Q
from signalbox.llm.ship import ship

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    ship(spark)
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def test_gradient_matches_differences():
    net = Q.Net(*[p.astype(np.float64) for p in Q.Net.start(3)])
    texts = [Q.cells_of(t) for t in (b"some words " * 60, b"", b"### !!" * 20, b"a")]
    y = np.array([1.0, 0.0, 0.0, 1.0])

    def loss(n):
        cells = np.concatenate(texts)
        z, _ = Q._head(n, Q.responses(n, cells).max(1), np.array([len(t) for t in texts]))
        return float(np.sum(np.logaddexp(0, z) - y * z))
    grads, r = Q._gradient(net, texts, y), np.random.default_rng(0)
    for k, g in enumerate(grads):
        for _ in range(4):
            at = tuple(r.integers(0, s) for s in g.shape)
            if k == 0:
                at = (ord("some #!"[r.integers(0, 7)]), at[1])
            up, down = ([p.copy() for p in net] for _ in range(2))
            up[k][at] += 1e-3
            down[k][at] -= 1e-3
            assert abs((loss(Q.Net(*up)) - loss(Q.Net(*down))) / 2e-3 - g[at]) < 8e-3


def test_scores_do_not_depend_on_grouping_and_cover_the_whole_text():
    net = Q.Net.start(1)
    texts = ["", "a", "word " * 40000, "é" * 300, *[f"text {i} " * (i % 50) for i in range(600)]]
    every = Q.score_texts(net, texts)
    assert np.allclose(every, [Q.score_texts(net, [t])[0] for t in texts], atol=1e-5)
    assert ((every >= 0) & (every <= 1)).all()
    assert Q.score_texts(net, ["word " * 40000 + "\x01\x02\x03 #"])[0] != every[2]


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    got = Q.quality_report(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    own = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    good, bad = own[own.quality == 1], own[own.quality == 0]
    assert len(bad) > 50 and good.predicted.mean() > 0.97 and bad.predicted.mean() < 0.15


def test_labels_of_held_out_rows_are_never_learned(spark, tables):
    docs, labels = tables
    flipped = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.training_sample(docs, labels), Q.training_sample(docs, flipped)
    assert a[0] == b[0] and (a[1] == b[1]).all() and len(a[0]) <= Q.MAX_ROWS


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, None, 1), (1, "", 1), (1, "", 1), (2, "x" * 300000, 1)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    ship(spark)
    got = Q.quality_report(df, none).collect()
    assert len(got) == 4 and all(r.score == 0.5 for r in got)
    odd = spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 7, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert Q.train(df, odd) == 0.5
    kept = Q.keep_good(df, none)
    assert kept.columns == df.columns and kept.count() == 4
    assert Q.quality_report(df.where("false"), none).count() == 0
