"""Every registered query against its DuckDB counterpart, and that the entry points hold together."""

import pytest

from maskwright import registry


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_oracle(name, same):
    same(registry.queries()[name], registry.oracles()[name])


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracles())))
def test_runs(name, spark):
    assert registry.queries()[name](spark, "/root/testdata/sf0.001").count() >= 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 200
    assert set(registry.queries()) <= set(e.queries())


@pytest.mark.parametrize("split", ["128m", "8k"])
def test_composite_means_at_halves(spark, tmp_path, split):
    import duckdb

    con, file = duckdb.connect(), f"{tmp_path}/lineitem.parquet"
    con.sql("SET threads = 1")
    con.sql(f"""COPY (SELECT CAST(i % 4000 AS BIGINT) AS l_orderkey, CAST(5 - i // 4000 AS INT) AS l_linenumber, CAST((i * 7919 + i * i % 1009 * 31) % 320 * 2 AS BIGINT) AS l_partkey, CAST(1 AS BIGINT) AS l_suppkey,
      2.0::DOUBLE AS l_quantity, 1.0::DOUBLE AS l_extendedprice, 0.0::DOUBLE AS l_discount, 'A' AS l_returnflag FROM range(4000 * 4) r(i) WHERE i // 4000 < 2 + i % 3 ORDER BY i) TO '{file}' (FORMAT parquet, ROW_GROUP_SIZE 2048)""")
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{file}'")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        a = registry.queries()["composite_statistics"](spark, str(tmp_path)).toPandas()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    b, key = con.sql(registry.oracles()["composite_statistics"]).df(), ["image_id", "mean_iou", "mean_coverage"]
    assert sorted(a[key].values.tolist()) == sorted(b[key].values.tolist())
