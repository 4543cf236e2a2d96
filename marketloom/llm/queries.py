"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import (
    alignment,
    ann,
    langid,
    lines,
    mixing,
    neardup,
    oracle,
    packing,
    quality,
    runs,
    secrets,
    simhash,
    substrings,
    warc,
)
from marketloom.llm.shipping import prepare

#: The mix: domains, to which sources belong by number, and weights by level and name.
DOMAINS = ("web", "reference", "forum", "news")
WEIGHTS = {
    "domain": {"web": 5, "reference": 3, "forum": 1, "news": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {"src0": 2, "src5": 3},
}
BUDGET_PERCENT = 60


def domain() -> Column:
    """The domain of a document's source; null where the source has no number."""
    number = F.expr("try_cast(substring(source, 4) as int)")
    return F.element_at(F.lit(list(DOMAINS)), F.pmod(number, F.lit(len(DOMAINS))) + 1)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_table(spark, sf_dir, "pages")).drop("intact")


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), domain(), WEIGHTS, BUDGET_PERCENT)


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents")).drop("found")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), special_as_text=False)


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.expr("vec_id % 20 = 0"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_counts(_table(spark, sf_dir, "documents"))


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_common_lines(_table(spark, sf_dir, "documents"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.collapse_runs(_table(spark, sf_dir, "documents"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_neardup": op2_neardup,
    "op3_mixing": op3_mixing,
    "op4_substrings": op4_substrings,
    "op5_secrets": op5_secrets,
    "op6_simhash": op6_simhash,
    "op7_packing": op7_packing,
    "op8_ann": op8_ann,
    "op9_quality": op9_quality,
    "op10_langid": op10_langid,
    "op11_alignment": op11_alignment,
    "op12_lines": op12_lines,
    "op13_runs": op13_runs,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return query(spark, sf_dir)

        return run

    return {name: bind(query) for name, query in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": oracle.WARC,
        "op3_mixing": oracle.mixing(DOMAINS, WEIGHTS, BUDGET_PERCENT),
        "op5_secrets": oracle.secrets(),
        "op8_ann": oracle.nearest(ann.K),
        "op12_lines": oracle.lines(lines.LEAST_DOCS, lines.LEAST_CHARS),
    }
