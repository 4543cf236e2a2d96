"""Shared tables, lookups that survive hot keys, and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.sources.tables import shared_path

SALTS = 16
#: Rows of a lookup that is broadcast, at most.
BROADCAST_ROWS = 50_000


class Scratch:
    """A folder of its own for intermediate tables, in the folder that the cluster shares."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = shared_path(spark, "llm")
        self._tables = 0

    def path(self) -> str:
        """A path that nothing has used yet."""
        self._tables += 1
        return f"{self.folder}/{self._tables:04d}"

    def table(self, df: DataFrame) -> DataFrame:
        """The same rows, written once and read back: nothing before is computed again."""
        path = self.path()
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def extended(schema: T.StructType, added: str) -> T.StructType:
    """A schema with more fields, given as DDL; the schema itself stays as it is."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(added).fields])


def salt(*columns: Column | str, salts: int = SALTS) -> Column:
    """A number from 0 to salts - 1 that follows from the columns' values."""
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: list[str],
    by: list[str],
    how: str = "inner",
    salts: int = SALTS,
    hint: str | None = None,
) -> DataFrame:
    """Join with a lookup that has one row for each key, a hot key dealt to several tasks.

    Each key of the lookup is repeated once per salt, and the columns `by` spread the rows of
    one key over the salts. The key is compared with equality: null keys find nothing. The lookup
    is one still to be computed, which Spark broadcasts only if it measures it to be small.
    """
    spread = lookup.withColumn("_salt", F.explode(F.lit(list(range(salts)))))
    if hint:
        spread = spread.hint(hint)
    salted = rows.withColumn("_salt", salt(*by, salts=salts))
    return salted.join(spread, [*on, "_salt"], how).drop("_salt")


def table_join(
    rows: DataFrame,
    table: DataFrame,
    on: list[str],
    by: list[str],
    how: str = "inner",
) -> DataFrame:
    """Join with a lookup that is a written table, with one row for each key.

    Its rows are counted, which reads the files' footers. Up to BROADCAST_ROWS it is broadcast,
    and the rows stay where they are; a larger one is shuffled and a hot key's rows are dealt to
    several tasks.
    """
    if table.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), on, how)
    return salted_join(rows, table, on, by, how, hint="merge")


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """Connected components of links (a long, b long): (node, root), root the smallest node.

    Alternating large-star and small-star steps [Kiveris et al. 2014] until nothing changes.
    Each step's links are a written table. Only nodes with a link to another one appear; links
    with a null end or to the node itself are ignored.
    """
    edges = (
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("a is not null and b is not null and u <> v")
        .distinct()
    )
    edges = scratch.table(edges)
    seen = _digest(edges)
    while seen[0]:
        edges = scratch.table(_small_star(_large_star(edges)))
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select("v", "v").distinct()
    )


def _digest(edges: DataFrame) -> tuple:
    """Number of links and a sum over them that changes with any link."""
    return tuple(
        edges.select(F.xxhash64("u", "v").cast("decimal(20,0)").alias("h"))
        .agg(F.count("*"), F.sum("h"))
        .first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest one around the node."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        salted_join(both, least, ["u"], ["v"])
        .where("v > u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = salted_join(edges, least, ["u"], ["v"])
    return (
        joined.where("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v")))
        .distinct()
    )
