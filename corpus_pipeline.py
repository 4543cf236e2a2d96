"""A corpus pipeline: quality, near-duplicates, secrets, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. `run` writes each result as
Parquet in the shared folder and reads it back as the next stage's documents. All but the last
return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import mixing, packing, quality, secrets, simhash
from marketloom.llm.common import Scratch, table_join
from marketloom.llm.queries import BUDGET_PERCENT, WEIGHTS, domain
from marketloom.llm.shipping import prepare
from marketloom.operators.joins import heavy_keys, lookup_join


def _packed(docs: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def _unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("row").getField(c).alias(c) for c in columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Each row is judged by its text alone, of any length; null and empty texts have a score too.
    Repeated rows share their fate, and an empty table stays empty.
    """
    prepare(spark)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _unpacked(
        quality.classify(docs, model, keep=True).where("predicted = 1"), docs.columns
    )


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: that with the smallest doc_id.

    A row goes by its own text's group: of two unlike texts that share a doc_id both may stay.
    Rows without a doc_id come after all others, and one of them stays for a group of only
    such rows. Rows that tie by doc_id are taken by the hash of id and text, equal ones of these
    by their other columns. A null text counts as empty, and texts without a word are one group.
    Very long texts are read whole. An empty table stays empty.
    """
    prepare(spark)
    scratch = Scratch(spark)
    doc_id = F.col("doc_id").cast("long")
    name = F.md5(
        F.concat(
            F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), F.coalesce("text", F.lit(""))
        ).cast("binary")
    )
    found = scratch.table(simhash.near_duplicates(docs, name=name))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "name")
    groups = found.groupBy("root").agg(F.min(first).alias("first"), F.count("*").alias("rows"))
    shared = groups.where("rows > 1").select("root", F.col("first.name").alias("first"))
    members = lookup_join(
        found.select("root", "name"), shared, "root", "inner", heavy_keys(found, "root"), ["name"]
    )
    told = members.select("name", (F.col("name") == F.col("first")).alias("stays")).distinct()
    rows = docs.select(name.alias("name"), _packed(docs))
    joined = table_join(rows, scratch.table(told), ["name"], ["name"], "left")
    alone = joined.where("stays is null").select("row")
    one = joined.where("stays").groupBy("name").agg(F.min("row").alias("row")).select("row")
    return _unpacked(alone.union(one), docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark, and n_chars counted anew where one was.

    All rows stay. Null and empty texts have no secrets; texts of any length are scanned whole.
    Documents without a column n_chars keep their columns too.
    """
    found = secrets.scan(docs, keep=True).select(
        "row",
        secrets.redacted(F.col("row.text"), F.col("found")).alias("text"),
        (F.size("found") > 0).alias("hit"),
    )
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("hit"), counted).otherwise(F.col("row.n_chars"))
    return found.select(
        *[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as its copies.

    Null sources and languages are leaves of their own, null and empty texts have no tokens.
    Rows that tie in a leaf's order are taken as `mixing.mix` states; long texts count whole.
    """
    chosen = mixing.mix(docs, domain(), WEIGHTS, BUDGET_PERCENT, keep=True)
    copies = chosen.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return _unpacked(copies, docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences.

    A null or empty text is its end id alone; a long one is cut into full windows first.
    Repeated rows are packed as often as they come.
    """
    prepare(spark)
    return packing.pack(docs, special_as_text=False)


STAGES = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", keep_one_of_each),
    ("secret scans", hide_secrets),
    ("source mix", mix_sources),
    ("packing", pack),
]

#: SQL cannot express the classifier, the fingerprints and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir))
    return docs
