"""Stages of the pipeline on awkward tables, and the bounds of what a Python worker keeps."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from foretell.llm import common
from foretell.llm.learning import labelled_sample
from foretell.llm.vocabulary import LONG, Memo

FOLDER = "/root/testdata/sf0.001"
NAMES = ("key", "_key", "said", "_said", "Number", "label", "score", "hash", "doc_reading", "component_id")


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, long and repeated texts, rows without id, and names that stages might want."""
    texts = [None, "", "a clean little text of some length, with ten words at least", "word " * 30_000, "x" * 200_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[2]), (None, None), (2, texts[2]), (0, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kinds = dict(common.table(spark, FOLDER, "documents").dtypes)
    for name in ("lang", "source", "n_chars"):
        df = df.withColumn(name, F.lit(None).cast(kinds[name]))
    return df.withColumns({name: F.lit(name) for name in NAMES}).withColumn("mine", F.monotonically_increasing_id())


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_columns_and_survive_odd_rows(spark, odd, stage):
    name, work = corpus_pipeline.STAGES[stage]
    out = work(spark, odd, FOLDER)
    assert out.columns == odd.columns
    rows = out.collect()
    assert rows and all(r[n] == n for r in rows for n in NAMES)
    assert len({r.mine for r in rows}) == len(rows)
    if name != "quality":
        assert any(r.doc_id is None for r in rows) and {0, 1} <= {r.doc_id for r in rows}
    assert work(spark, odd.limit(0), FOLDER).count() == 0


def test_last_stage_encodes_every_row(spark, odd):
    work = corpus_pipeline.STAGES[-1][1]
    assert work(spark, odd, FOLDER).count() == odd.count() and work(spark, odd.limit(0), FOLDER).count() == 0


def test_labelled_sample_takes_one_row_of_an_id(spark):
    docs = spark.range(5000).select(F.lit(7).cast("bigint").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(8, "other"), (9, ""), (None, "x")], "doc_id bigint, text string"))
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 0), (9, 1), (10, 1), (None, 1), (8, None)], "doc_id bigint, toxic int")
    for bound in (2, 10):
        rows = labelled_sample(docs, labels, "toxic", F.lit(True), bound).collect()
        assert len(rows) <= bound and len({r.doc_id for r in rows}) == len(rows)
    assert {(r.doc_id, r.label) for r in rows} == {(7, 1), (8, 0), (9, 1)}
    again = labelled_sample(docs.orderBy(F.rand()), labels, "toxic", F.lit(True), 10).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_memo_is_bounded_by_bytes():
    calls = []
    memo = Memo(lambda word: calls.append(word) or word * 2, 100_000)
    for n in range(5_000):
        assert memo[f"{n:0100d}"] == f"{n:0100d}" * 2
    assert len(memo) + len(memo.before) < 2 * 100_000 / 300 and memo.used <= 100_000
    assert memo["4999".zfill(100)] and len(calls) == 5_000
    long = "x" * LONG
    assert memo[long] == memo[long] == long * 2 and long not in memo
    memo.forget()
    assert not memo and not memo.before and memo["a"] == "aa"


def test_batches_are_cut_by_bytes():
    texts = ["a" * 10, None, "b" * 100, "", "c" * 5, "d" * 5]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["i", "t"])
    parts = [p.column(1).to_pylist() for p in common.slices(batch, 1, 12)]
    assert parts == [["a" * 10, None], ["b" * 100], ["", "c" * 5, "d" * 5]]
    assert list(common.slices(batch.slice(0, 0), 1)) == []
