from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketloom.operators.joins import heavy_keys, join_row_loss, lookup_join

ROWS = 6000


@pytest.fixture
def skewed(spark):
    """A third of the rows has key 'hot', a sixth has none, the rest are spread."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 6 == 1, None)
        .otherwise((F.col("id") % 500).cast("string"))
    )
    return spark.range(ROWS).select("id", key.alias("k"))


@pytest.fixture
def lookup(spark):
    numbered = spark.range(400).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    return numbered.unionByName(spark.createDataFrame([("hot", -1), ("absent", -2)], "k string, v long"))


def given(spark, **buckets):
    return spark.createDataFrame(list(buckets.items()), "k string, _buckets int")


def test_heavy_keys_are_found(skewed):
    found = {row["k"]: row["_buckets"] for row in heavy_keys(skewed, "k").collect()}
    assert found == {"hot": 43}  # a third of the rows in shares of an eighth, 16 buckets each
    assert heavy_keys(skewed, "id").collect() == []


def test_heavy_keys_of_an_empty_table(spark):
    assert heavy_keys(spark.createDataFrame([], "k string"), "k").collect() == []


def test_nothing_runs_while_a_join_is_planned(spark, skewed, lookup):
    def jobs():
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))

    before = jobs()
    lookup_join(skewed, lookup, "k", "left", heavy_keys(skewed, "k"), ["id"])
    assert jobs() == before


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("heavy", [{}, {"hot": 5}, {"hot": 3, "7": 2, "gone": 2}, None])
def test_spreading_changes_no_row(spark, skewed, lookup, how, heavy):
    plain = skewed.join(lookup, "k", how)
    buckets = heavy_keys(skewed, "k") if heavy is None else given(spark, **heavy)
    spread = lookup_join(skewed, lookup, "k", how, buckets, ["id"])
    assert spread.columns == plain.columns
    assert Counter(map(tuple, spread.collect())) == Counter(map(tuple, plain.collect()))


@pytest.fixture
def shuffled_joins(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def largest_partition(df):
    sizes = df.groupBy(F.spark_partition_id().alias("p")).count()
    return max(row["count"] for row in sizes.collect())


def test_hot_and_missing_keys_meet_many_tasks(skewed, lookup, shuffled_joins):
    assert largest_partition(skewed.join(lookup, "k", "left")) > ROWS / 3
    spread = lookup_join(skewed, lookup, "k", "left", heavy_keys(skewed, "k"), ["id"])
    assert largest_partition(spread) < 2 * ROWS / 8


def test_row_loss(spark):
    items = spark.createDataFrame([("1", "o1"), ("2", "o1"), ("1", "o3")], "item string, order_id string")
    orders = spark.createDataFrame([("o1",), ("o2",)], "order_id string")
    assert tuple(join_row_loss(items, orders).first()) == (3, 2, 1)
    assert tuple(join_row_loss(items.limit(0), orders).first()) == (0, 0, 0)


@pytest.mark.parametrize("partitions", ["8", "100"])
def test_heavy_keys_are_found_without_a_shuffle_by_key(spark, partitions):
    """By summaries merged at once and in two steps; also where there are no rows or no keys."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        key = "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 > 0 THEN CAST(id AS string) END AS k"
        rows = spark.range(0, 30_000, 1, 20).selectExpr(key)
        heavy = heavy_keys(rows, "k")
        found = {row["k"]: row["_buckets"] for row in heavy.collect()}
        assert list(found) == ["hot"] and found["hot"] >= 16 * int(partitions) // 3
        plan = heavy._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(k" not in plan and "hashpartitioning(key" not in plan
        assert heavy_keys(rows.limit(0), "k").collect() == []
        assert heavy_keys(rows.selectExpr("CAST(NULL AS string) AS k"), "k").collect() == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
