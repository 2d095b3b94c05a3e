"""The pipeline: every stage's decisions against brute force, and the whole run."""

import re

import corpus_pipeline
import pytest

from signalbox.llm import mixing, quality_cnn
from signalbox.llm.common import release, store, work_root
from signalbox.llm.queries import oracle_sql, queries

from .test_near_dups import brute_components, brute_contained
from .test_tokens import expected, rows_of

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark):
    """The documents after each stage but the last, as run() makes them."""
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, DATA), f"test-{name}")
        out.append(docs)
    return out


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_columns_stay(spark, kept):
    names = spark.read.parquet(f"{DATA}/documents.parquet").dtypes
    assert all(k.dtypes == names for k in kept)


def test_quality_keeps_what_scores_high(spark, kept):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    want = {r.doc_id for r in quality_cnn.quality_report(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept[0].collect()} == want
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(good & want) > 0.95 * len(good & {r.doc_id for r in docs.collect()})


def test_one_of_each_group_stays(kept):
    _, root = brute_components([(r.doc_id, r.text) for r in kept[0].collect()])
    assert sorted(r.doc_id for r in kept[1].collect()) == sorted(set(root.values()))


def test_no_benchmark_item_stays(spark, kept):
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in kept[1].collect()]
    bad = {x[0] for x in brute_contained(rows, items)}
    assert bad and {r.doc_id for r in kept[2].collect()} == {i for i, _ in rows} - bad


def test_mix_takes_what_the_report_says(kept):
    taken = {r.doc_id: r.taken for r in mixing.mix_report(kept[2]).collect()}
    words = dict.fromkeys(taken, 0)
    for r in kept[3].collect():
        words[r.doc_id] += len(r.text.split())
    assert words == taken


def test_run_ends_in_the_tokens_of_the_mix(spark, kept):
    from signalbox.llm.wavelet import TextEncoder
    want = expected(TextEncoder().tokenizer, [(r.doc_id, r.text) for r in kept[3].collect()])
    assert rows_of(corpus_pipeline.run(spark, DATA)) == want


def test_empty_table(spark, kept):
    empty = spark.read.parquet(f"{DATA}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, DATA)
        assert out.count() == 0, name


def test_registered_queries():
    names = list(queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(oracle_sql()) <= set(names)



def test_stages_leave_no_large_working_tables(spark):
    from signalbox.llm import decontamination, near_dups
    from signalbox.session import children
    rows = [(i, f"one two three four five six seven {'eight' if i < 3 else i}") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id long, text string")

    def left(stage):
        before = set(children(spark, work_root(spark)))
        out = stage()
        return out, sorted(n.rsplit("-", 1)[0] for n in set(children(spark, work_root(spark))) - before)
    out, names = left(lambda: near_dups.keep_one(df))
    assert names == ["near-gone"] and sorted(r.doc_id for r in out.collect()) == [0, 3, 4, 5]
    out, names = left(lambda: decontamination.drop_contaminated(df, items))
    assert names == ["contaminated"] and sorted(r.doc_id for r in out.collect()) == [3, 4, 5]


def test_mix_carries_a_text_once(spark):
    df = spark.createDataFrame([(i, f"a{i} b c d", "en" if i % 2 else None) for i in range(9)], "doc_id long, text string, source string")
    out = mixing.mix_documents(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "AS _row#" in plan and not re.search(r"AS _row#\d+, text#", plan)
    got = out.collect()
    assert got and all(f"a{r.doc_id} b c d".startswith(r.text) for r in got)


def test_release_deletes_the_working_tables(spark):
    from signalbox.session import path_exists
    df = store(spark.range(3).toDF("x"), "to-be-released")
    assert df.count() == 3 and path_exists(spark, df.inputFiles()[0].rsplit("/", 1)[0].replace("file://", "file:"))
    root = work_root(spark)
    release(spark)
    assert not path_exists(spark, root)
