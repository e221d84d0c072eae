"""Every query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from fleetmill import registry

TABLES = "region nation customer supplier part orders lineitem events".split()


def rows_of(frame):
    def plain(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "null"
        if isinstance(v, float):
            return f"{v:.5f}" if v else "0.00000"
        return str(v)

    return sorted(tuple(plain(v) for v in r) for r in frame)


@pytest.fixture(scope="module")
def duck(sf):
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, sf, duck, name):
    ours = registry.QUERIES[name](spark, sf)
    theirs = duck.execute(registry.ORACLE_SQL[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(columns) == sorted(ours.columns)
    order = sorted(columns)
    got = [tuple(r[c] for c in order) for r in ours.collect()]
    want = [tuple(r[columns.index(c)] for c in order) for r in theirs.fetchall()]
    assert rows_of(got) == rows_of(want)


def test_lineage_split_keeps_groups_whole(spark, sf):
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    rows = registry.QUERIES["lineage_split"](spark, sf).collect()
    assert len({r.lineage_group_id for r in rows}) == len(rows)
    assert {r.split for r in rows} == {"train", "validation", "test"}


def test_digest_ignores_order_and_partitions(spark):
    from fleetmill.operators.merge import digest

    rows = spark.createDataFrame([(i, float(i), None if i % 3 else "x") for i in range(50)], "k bigint, v double, s string")
    a = digest(rows, ["k"]).first()
    b = digest(rows.repartition(7, "v").select("s", "v", "k"), ["k"]).first()
    assert a == b and a["rows"] == 50
    assert digest(rows.where("k < 49"), ["k"]).first().digest != a.digest


def test_rul_fit_score_fits_and_chooses(spark, sf):
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    rows = {r.split: r for r in registry.QUERIES["rul_fit_score"](spark, sf).collect()}
    assert set(rows) == {"train", "validation", "test"} and len({r.model for r in rows.values()}) == 1
    assert all(0 < r.mae <= r.rmse < 10 for r in rows.values())


def test_the_grid(spark):
    from fleetmill.operators import models

    found = models.candidates(100)
    assert sum(n.startswith("ridge") for n in found) == 2
    forests = {(m.getNumTrees(), m.getMaxDepth(), m.getMinInstancesPerNode()) for n, m in found.items() if n.startswith("forest")}
    boosted = {(m.getMaxIter(), m.getMaxDepth(), m.getStepSize()) for n, m in found.items() if n.startswith("boosted")}
    assert forests == {(200, 8, 1), (200, 30, 2)} and boosted == {(200, 6, 0.05), (300, 4, 0.05)}
