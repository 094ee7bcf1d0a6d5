import pytest
from conftest import rows
from pyspark.sql import functions as F

from serpscope.session import scratch_path
from serpscope.sources import clustered as C

FILES = 12


@pytest.fixture(scope="module")
def stored(spark):
    table = spark.range(30_000).select(F.md5(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    path = scratch_path(spark, "clustered")
    C.write_clustered(table, path, "k", FILES, row_group=64 << 10)
    return table, path


def _scan(found):
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_few_keys_read_few_rows(spark, stored):
    table, path = stored
    keys = [r.k for r in table.where("v % 9973 = 1").collect()]
    found = C.rows_of_keys(spark, path, table.schema, "k", keys)
    assert rows(found) == rows(table.where(F.col("k").isin(keys)))
    assert 0 < _scan(found) < table.count() / 3
    # Keys that no row has, within the range of each file.
    none = C.rows_of_keys(spark, path, table.schema, "k", [k[:-1] + "x" for k in keys])
    assert none.collect() == [] and _scan(none) < table.count() / 8


@pytest.mark.parametrize("limit", [0, 1000])
def test_lookups_by_values_and_by_join(spark, stored, monkeypatch, limit):
    table, path = stored
    monkeypatch.setattr(C, "LOOKUP_IDS", limit)
    asked = table.where("v % 3000 = 7").select("k", F.lit(1).alias("n"))
    asked = asked.union(asked).unionByName(spark.sql("SELECT 'none' AS k, 2 AS n UNION ALL SELECT NULL, 3"))
    got = C.lookup_clustered(asked, path, table.schema, "k", ["v"])
    assert rows(got) == rows(asked.join(table, "k", "left").select("k", "n", "v"))


def test_empty_table_and_no_requests(spark, stored):
    table, path = stored
    empty = scratch_path(spark, "clustered")
    C.write_clustered(table.limit(0), empty, "k")
    asked = spark.createDataFrame([("a",)], "k string")
    assert C.lookup_clustered(asked, empty, table.schema, "k", ["v"]).collect() == [("a", None)]
    assert C.lookup_clustered(asked.limit(0), path, table.schema, "k", ["v"]).count() == 0
