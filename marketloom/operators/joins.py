"""Lookup joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

# A heavy key gets so many buckets per fair share of rows it holds: small enough buckets
# that some of them meeting in one partition do not matter.
_BUCKETS_PER_SHARE = 16
# Keys that a summary follows, per shuffle partition: its counts are then off by less than
# half a fair share.  The function takes a million at most.
_TRACKED_PER_PARTITION = 8
_TRACKED_AT_MOST = 1_000_000
# With more shuffle partitions than this the tasks' summaries are merged in two steps.
_MERGED_AT_ONCE = 64


def heavy_keys(df: DataFrame, column: str) -> DataFrame:
    """(column, _buckets): keys with more than one shuffle partition's fair share of the rows.

    A part of the plan that uses it: nothing runs before the plan does.  Each map task
    keeps a frequent-items summary of bounded size, whatever the number of keys, and the
    summaries are merged, in two steps where there are many.  No row is shuffled by key.
    There are fewer heavy keys than shuffle partitions, whatever the data size.  They steer
    only the balance of a join, so a summary's error cannot change a result, and they may
    be counted on rows as delivered, before these are cleaned.
    """
    partitions = _shuffle_partitions(df)
    kind = df.schema[column].dataType
    tracked = min(_TRACKED_PER_PARTITION * partitions, _TRACKED_AT_MOST)
    rows = df.select(F.col(column).alias("key"))
    if partitions > _MERGED_AT_ONCE:
        merger = F.pmod(F.spark_partition_id(), F.lit(isqrt(partitions))).alias("merger")
        rows = _summaries(rows.select("*", merger).groupBy("merger"), "accumulate(key", tracked)
        total = F.sum("n")
        merged = "combine(summary"
    else:
        total = F.count(F.lit(1))
        merged = "accumulate(key"
    # Grouped, since the functions fail on a partition without rows otherwise.
    whole = _summaries(rows.groupBy(F.lit("all")), merged, tracked, total)
    found = F.expr(f"approx_top_k_estimate(summary, {min(partitions, tracked)})")
    counts = whole.select((F.col("n") / partitions).alias("share"), F.explode(found).alias("found"))
    buckets = F.ceil(_BUCKETS_PER_SHARE * F.col("found.count") / F.col("share")).cast("int")
    heavy = (F.col("found.count") > F.col("share")) & F.col("found.item").isNotNull()
    item = F.col("found.item").cast(kind)
    return counts.filter(heavy).select(item.alias(column), buckets.alias("_buckets"))


def _summaries(
    groups: GroupedData, function: str, tracked: int, rows: Column | None = None
) -> DataFrame:
    n = F.count(F.lit(1)) if rows is None else rows
    return groups.agg(F.expr(f"approx_top_k_{function}, {tracked})").alias("summary"), n.alias("n"))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    heavy: DataFrame,
    spread_by: Sequence[str],
    hint: str | None = None,
) -> DataFrame:
    """Join ``left`` to the ``right`` row of the same key; ``right`` is unique on ``key``.

    ``how`` is "left" or "inner".  The left rows of each heavy key are spread over its
    buckets by a hash of ``spread_by``, and the one right row is repeated per bucket; rows
    without a key, which match nothing, are spread as well; all other rows stay in
    bucket 0.  The buckets of all heavy keys add up to
    a few times the number of shuffle partitions, so the repeated rows do not grow with
    the data.  The hash, unlike a random salt, gives the same bucket when a lost task is
    run again.  The plan is the same whether or not there are heavy keys.  ``hint`` names
    a join strategy for ``right``; without one Spark chooses.
    """
    bucket = "_bucket"
    spread = F.broadcast(heavy)  # fewer rows than shuffle partitions
    hashed = F.xxhash64(*spread_by)
    keyless = F.when(F.col(key).isNull(), F.lit(_BUCKETS_PER_SHARE * _shuffle_partitions(left)))
    left_bucket = F.pmod(hashed, F.coalesce(keyless, F.col("_buckets"), F.lit(1)))
    last_bucket = F.coalesce("_buckets", F.lit(1)) - 1
    spread_left = left.join(spread, key, "left").withColumn(bucket, left_bucket.cast("int"))
    spread_right = right.join(spread, key, "left").withColumn(
        bucket, F.explode(F.sequence(F.lit(0), last_bucket))
    )
    found = spread_right.drop("_buckets")
    found = found.hint(hint) if hint else found
    joined = spread_left.drop("_buckets").join(found, [key, bucket], how)
    return joined.drop(bucket)


def join_row_loss(items: DataFrame, orders: DataFrame) -> DataFrame:
    """How many item rows an inner join to the orders would keep and lose.

    Items are counted per order before the join, so one huge order is one row.
    """
    per_order = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    known = orders.select("order_id", F.lit(True).alias("known"))
    matched: Column = F.when(F.col("known"), F.col("n")).otherwise(0)
    return (
        per_order.join(known, "order_id", "left")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("item_rows"),
            F.coalesce(F.sum(matched), F.lit(0)).alias("joined_rows"),
        )
        .withColumn("lost_rows", F.col("item_rows") - F.col("joined_rows"))
    )


def _shuffle_partitions(df: DataFrame) -> int:
    conf = df.sparkSession.conf
    initial = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or conf.get("spark.sql.shuffle.partitions"))
