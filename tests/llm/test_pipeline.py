"""The pipeline's stages against plain versions, on the smallest tables."""

import os

import pytest

import corpus_pipeline
from fleetmill.llm import decontamination
from fleetmill.llm.common import written

from test_llm_operators import brute_jaccard


def test_stages(spark, sf):
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    by = dict(corpus_pipeline.STAGES)
    clean = written(by["toxicity"](spark, docs, sf), "t")
    assert clean.columns == columns and 0.8 * docs.count() < clean.count() <= docs.count()
    one = written(by["jaccard join"](spark, clean, sf), "t")
    kept = {r.doc_id for r in one.collect()}
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    assert one.columns == columns and kept == {i for i, _, c in brute_jaccard(rows) if i == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    left = written(by["decontamination"](spark, one, sf), "t")
    want = {x[0] for x in decontamination.brute_force([r for r in rows if r[0] in kept], items) if not x[5]}
    assert left.columns == columns and {r.doc_id for r in left.collect()} == want
    packed = by["packing"](spark, left, sf).collect()
    assert {r.doc_id for r in packed} == want
    assert corpus_pipeline.ORACLE_SQL is None


def test_one_of_each_group_tells_rows_apart(spark):
    """Null and repeated ids: only near copies go, whatever their ids, and other texts stay."""
    a, b, c, d, e = (" ".join(f"{x}{k}" for k in range(60)) for x in "abcde")
    near = a + " more"
    rows = [(1, a), (2, near), (2, b), (3, c), (3, d), (None, e), (None, e + " more"), (None, "alone"), (None, a), (4, ""), (4, None), (None, None), (5, "same text twice here"), (5, "same text twice here")]
    docs = spark.createDataFrame([(*r, "own") for r in rows], "doc_id bigint, text string, source string")
    got = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert got.columns == docs.columns
    left = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    want = [(1, a), (2, b), (3, c), (3, d), (None, "alone"), (4, ""), (4, None), (None, None), (5, "same text twice here")]
    assert [x for x in left if x[1] not in (e, e + " more")] == sorted(want, key=str)
    assert len(left) == len(want) + 1
