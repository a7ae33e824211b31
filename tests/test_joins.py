from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratelab.operators.joins import hot_keys, skew_join


def facts(spark):
    """A third of the rows share one key, and are copies of each other."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("bigint").alias("k"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"),
    )
    return rows.repartition(4)


def counted(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("how", ["inner", "left"])
def test_sliced_join_equals_plain_join(spark, how):
    left = facts(spark)
    right = spark.createDataFrame([(i, f"name{i}") for i in range(0, 45)], "k bigint, name string")
    plain = counted(left.join(right, ["k"], how))
    sliced = skew_join(left, right, ["k"], how, rows_per_slice=100)
    assert "slice" not in sliced.columns
    assert counted(sliced) == plain


def test_left_join_keeps_rows_without_a_key(spark):
    left = facts(spark).withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    right = spark.createDataFrame([(1, "a")], "k bigint, name string")
    sliced = skew_join(left, right, ["k"], "left", rows_per_slice=100)
    assert counted(sliced) == counted(left.join(right, ["k"], "left"))


def test_hot_rows_spread_over_slices(spark):
    left = facts(spark)
    (hot,) = hot_keys(left, ["k"], rows_per_slice=100)
    assert hot.rows == 3000
    assert max(hot.slices.values()) >= 10
    right = spark.createDataFrame([(7, "x")], "k bigint, name string")
    joined = skew_join(left, right, ["k"], hot=hot, hint="merge")
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "slice" in text and "SortMergeJoin" in text


def test_no_hot_key_means_a_plain_join(spark):
    left = facts(spark)
    (hot,) = hot_keys(left, ["k"])
    assert not hot.slices
    right = spark.createDataFrame([(7, "x")], "k bigint, name string")
    text = skew_join(left, right, ["k"], hot=hot)._jdf.queryExecution().executedPlan().toString()
    assert "slice" not in text


def test_hot_keys_of_an_empty_table(spark):
    (hot,) = hot_keys(facts(spark).limit(0), ["k"])
    assert hot.slices == {} and hot.rows == 0


def test_join_columns_must_share_a_type(spark):
    right = spark.createDataFrame([(7, "x")], "k int, name string")
    with pytest.raises(ValueError, match="differs in type"):
        skew_join(facts(spark), right, ["k"])
