from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from raceway import sources
from raceway.operators import ContractError


@pytest.fixture
def names():
    return f"fact_{uuid4().hex}", f"dim_{uuid4().hex}"


def test_a_hot_key_is_spread_and_nothing_is_shuffled(spark, tmp_path, names):
    # Key 1 holds a third of the rows, all alike; NULL holds a sixth; 90 and more have no match.
    key = F.when(F.col("id") < 400, 1).when(F.col("id") < 600, None).otherwise(F.col("id") % 100)
    fact = spark.range(1200).select(key.alias("car"), F.when(F.col("id") >= 400, F.col("id")).alias("lap"))
    dim = spark.range(90).select(F.col("id").alias("car"), F.concat(F.lit("t"), "id").alias("team"))
    dim = dim.union(dim).union(spark.createDataFrame([(None, "none")], "car long, team string"))
    sources.store_fact(fact, ["car"], names[0], str(tmp_path), 8)
    sources.store_dimension(dim, ["car"], *names, str(tmp_path), 8)
    got = sources.lookup_stored(spark, *names, ["car"], ["team"])
    expected = fact.join(dim.dropna().distinct(), "car", "left").select("car", "lap", "team")
    assert got.columns == expected.columns and got.count() == 1200
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()

    sizes = [r["count"] for r in spark.table(names[0]).groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 400 and len(sizes) <= 8
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = sources.lookup_stored(spark, *names, ["car"], ["team"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_empty_tables_and_two_key_columns(spark, tmp_path, names):
    fact = spark.createDataFrame([], "a int, b string, v int")
    dim = spark.createDataFrame([(1, "x", 5)], "a int, b string, w int")
    sources.store_fact(fact, ["a", "b"], names[0], str(tmp_path), 4)
    sources.store_dimension(dim, ["a", "b"], *names, str(tmp_path), 4)
    assert sources.lookup_stored(spark, *names, ["a", "b"], ["w"]).collect() == []
    more = f"{names[0]}_more"
    sources.store_fact(spark.createDataFrame([(1, "x", 2), (1, "y", 3)], fact.schema), ["a", "b"], more, str(tmp_path), 4)
    sources.store_dimension(dim, ["a", "b"], more, f"{names[1]}_more", str(tmp_path), 4)
    rows = sources.lookup_stored(spark, more, f"{names[1]}_more", ["a", "b"], ["w"]).collect()
    assert sorted(map(tuple, rows)) == [(1, "x", 2, 5), (1, "y", 3, None)]


def test_a_key_with_two_rows_is_refused(spark, tmp_path, names):
    sources.store_fact(spark.createDataFrame([(1, 2)], "a int, v int"), ["a"], names[0], str(tmp_path), 4)
    with pytest.raises(ContractError):
        sources.store_dimension(
            spark.createDataFrame([(1, "x"), (1, "y")], "a int, w string"), ["a"], *names, str(tmp_path), 4
        )
    with pytest.raises(ValueError, match="taken"):
        sources.store_fact(spark.createDataFrame([(1, 2)], "a int, is_hot int"), ["a"], "f", str(tmp_path), 4)
