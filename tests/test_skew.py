"""The catalogue on a skewed copy of the tables: a third of all events are copies of one,
half of them belong to one user, and tables are folders of several files."""

import duckdb
import pytest
from pyspark.sql import functions as F

from compare import difference
from eventflow.operators import running
from eventflow.plans import derived
from eventflow.plans.catalogue import QUERIES
from eventflow.plans.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    events = derived.events(spark, SF_DIR)
    copies = events.filter("event_id = 42").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(events.count() // 2))))
    hot = events.withColumn("user_id", F.when(F.col("event_id") % 2 == 0, 7).otherwise(F.col("user_id")))
    hot.unionByName(copies.drop("n")).repartition(4).write.parquet(f"{folder}/events.parquet")
    for name in ("lineitem", "orders"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def duck(skewed):
    con = duckdb.connect()
    for name in ("events", "lineitem", "orders"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{skewed}/{name}.parquet/*.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, skewed, duck, monkeypatch, name):
    monkeypatch.setattr(running, "BLOCK_BITS", 6)
    monkeypatch.setattr(running, "COPIES_PER_ROW", 50)
    assert difference(QUERIES[name](spark, skewed), duck.sql(ORACLES[name])) is None
