"""The outlet, published tables and JDBC."""

import pytest

from fleetmill.operators.outlet import Outlet
from fleetmill.sources.store import Published, load_jdbc, read_jdbc

KIND = "asset_id bigint, cycle_index bigint, x double"


def test_outlet_appends_once_and_refuses_changes(spark, tmp_path):
    outlet = Outlet(spark, str(tmp_path))
    first = spark.createDataFrame([(1, 1, 1.0), (1, 2, None)], KIND)
    assert outlet.append(first, 1) == 2
    assert outlet.append(first.repartition(3), 1) == 0
    assert outlet.append(first.unionByName(spark.createDataFrame([(2, 1, 5.0)], KIND)), 2) == 1
    assert outlet.rows().where("generation_id <= 1").count() == 2 and outlet.rows().count() == 3
    with pytest.raises(ValueError):
        outlet.append(spark.createDataFrame([(1, 2, 7.0)], KIND), 2)
    with pytest.raises(ValueError):
        outlet.append(first.withColumnRenamed("x", "y"), 2)
    assert outlet.faults().count() == 0
    spark.createDataFrame([(1, 1, 9.0)], KIND).write.parquet(f"{tmp_path}/rows/generation_id=0/segment=stray")
    assert {r.fault for r in outlet.faults().collect()} == {"duplicate keys", "generation below 1", "ledger differs"}


def test_publish_is_idempotent(spark, tmp_path):
    table = Published(spark, str(tmp_path))
    rows = spark.range(3)
    assert table.latest() is None
    assert table.publish(rows, "a", "h1") and not table.publish(rows, "a", "h1")
    with pytest.raises(ValueError):
        table.publish(rows, "a", "h2")
    assert table.publish(spark.range(5), "b", "h3") and table.latest().count() == 5


def test_jdbc_round_trip(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    rows = spark.createDataFrame([(1, 2.0), (2, None)], "k bigint, v double")
    try:
        left = load_jdbc(rows, url, "t", ["k"], driver="org.apache.derby.jdbc.EmbeddedDriver")
    except Exception as e:
        pytest.skip(f"no JDBC driver here: {str(e)[:80]}")
    assert left.count() == 0
    assert read_jdbc(spark, url, 'select "k" from t where "k" > 1', driver="org.apache.derby.jdbc.EmbeddedDriver").count() == 1
