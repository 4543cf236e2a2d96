import os
import subprocess
import sys
import threading
import time
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketloom.operators import publish
from marketloom.operators.quality import (
    WAREHOUSE_CHECKS,
    KnownKeys,
    MinRows,
    NoNulls,
    QualityError,
)
from marketloom.plans import daily
from marketloom.schemas import GOLD, SILVER, stored
from marketloom.sources import manifest
from marketloom.sources.standins import SQL, Standins
from marketloom.sources.tables import write_raw_csv

RUN_TS = datetime(2024, 1, 1, 2)
CHECKS = (MinRows("fact_orders", 1000), NoNulls("fact_orders", "product_id"), MinRows("dim_date", 1400))


@pytest.fixture(scope="module")
def delivered(spark, tmp_path_factory):
    """Raw CSV files of the smallest data, under the names the run expects."""
    root = tmp_path_factory.mktemp("raw")
    standins = Standins(spark, "/root/testdata/sf0.001")
    for name in SQL:
        write_raw_csv(standins.raw(name), f"{root}/{daily.RAW_FILES[name].replace('*', 'shop')}")
    return str(root)


def shuffle_files(spark):
    environment = spark._jvm.org.apache.spark.SparkEnv.get()
    folders = environment.blockManager().diskBlockManager().localDirs()
    return {file for folder in folders for file in Path(folder.getPath()).rglob("shuffle_*")}


def left_by(spark, step):
    """Shuffle files that the step leaves; they are removed in the background."""
    before, until = shuffle_files(spark), time.monotonic() + 20
    step()
    while (left := shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    return left


def snapshot(spark, lake):
    root = daily.gold_root(str(lake))
    tables = {t: publish.published(spark, root, t) for t in GOLD}
    return {t: sorted(map(repr, df.collect())) for t, df in tables.items()}


def test_the_run_publishes_every_table_and_reruns_agree(spark, delivered, tmp_path):
    report = daily.run(
        spark, delivered, str(tmp_path), RUN_TS, minima={}, checks=CHECKS, database="daily_a"
    )
    assert set(report.silver_rows) == set(SILVER)
    assert set(report.gold_rows) == set(GOLD)
    first = snapshot(spark, tmp_path)
    assert {t: len(rows) for t, rows in first.items()} == report.gold_rows
    assert len(report.checks) == len(GOLD) + len(CHECKS)
    views = {t: sorted(map(repr, spark.table(f"daily_a.{t}").collect())) for t in GOLD}
    assert views == first
    for table in GOLD:
        found = publish.published(spark, daily.gold_root(str(tmp_path)), table)
        assert [(f.name, f.dataType) for f in found.schema] == [
            (f.name, f.dataType) for f in stored(GOLD[table])
        ]

    again = daily.run(
        spark, delivered, str(tmp_path), RUN_TS, minima={}, checks=CHECKS, database="daily_a"
    )
    assert again == report
    assert snapshot(spark, tmp_path) == first

    with pytest.raises(QualityError, match="dim_sellers min_rows"):
        daily.run(spark, delivered, str(tmp_path), RUN_TS, checks=CHECKS, database="daily_a")
    assert snapshot(spark, tmp_path) == first


def test_failed_checks_after_publishing_are_reported(spark, delivered, tmp_path):
    checks = (NoNulls("fact_orders", "customer_unique_id"), MinRows("dim_customers", 10**9))
    with pytest.raises(QualityError) as error:
        daily.run(
            spark, delivered, str(tmp_path), RUN_TS, minima={}, checks=checks, database="daily_b"
        )
    assert "nulls_in_customer_unique_id" in str(error.value)
    assert "dim_customers min_rows" in str(error.value)


def test_another_process_finds_and_checks_what_was_published(spark, delivered, tmp_path):
    daily.run(spark, delivered, str(tmp_path), RUN_TS, minima={}, checks=CHECKS, database=None)
    expected = spark.read.parquet(f"{tmp_path}/gold/fact_orders").count()
    script = f"""
from pyspark.sql import SparkSession
from marketloom.operators import publish
from marketloom.operators.quality import MinRows
from marketloom.plans import daily
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print(daily.check(spark, {str(tmp_path)!r}, [MinRows("fact_orders", 1000)]))
root = daily.gold_root({str(tmp_path)!r})
print("rows", publish.published(spark, root, "fact_orders").count())
"""
    repo = Path(__file__).resolve().parent.parent
    found = subprocess.run(
        [sys.executable, "-c", script],
        cwd=tmp_path,
        env=os.environ | {"PYTHONPATH": str(repo)},
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert f"rows {expected}" in found.stdout, found.stderr[-2000:]
    assert "fact_orders min_rows: observed" in found.stdout


def test_the_calendar_reaches_every_purchase(spark, delivered, tmp_path):
    check = KnownKeys("fact_orders", "order_date_key", "dim_date", "date_key")
    assert check in WAREHOUSE_CHECKS
    report = daily.run(
        spark, delivered, str(tmp_path), RUN_TS, minima={}, checks=(check,), database=None,
        first_day=date(2000, 1, 1), last_day=date(2030, 12, 31),
    )
    assert "observed 0" in report.checks[-1]
    days = publish.published(spark, daily.gold_root(str(tmp_path)), "dim_date")
    keys = sorted(row["date_key"] for row in days.select("date_key").collect())
    assert keys[0] < 20000101 and keys[-1] == 20301231


def test_two_deliveries_of_one_table_are_refused(spark, delivered, tmp_path):
    write_raw_csv(
        Standins(spark, "/root/testdata/sf0.001").raw("sellers"),
        f"{tmp_path}/old_sellers_dataset.csv",
    )
    write_raw_csv(
        Standins(spark, "/root/testdata/sf0.001").raw("sellers"),
        f"{tmp_path}/shop_sellers_dataset.csv",
    )
    with pytest.raises(ValueError, match="more than one delivery"):
        daily.to_silver(
            spark, str(tmp_path), str(tmp_path), "r1", RUN_TS, {"sellers": daily.RAW_FILES["sellers"]}
        )


def test_a_write_that_fails_half_way_leaves_silver_readable(spark, tmp_path):
    """The sellers' write fails in its last task; every table keeps its version."""
    standins = Standins(spark, "/root/testdata/sf0.001")
    raw = {name: standins.raw(name) for name in SQL}
    root = daily.silver_root(str(tmp_path))
    rows = daily.write_silver(spark, raw, root, "r1", RUN_TS)
    broken = F.expr("if(seller_id > '5', raise_error('lost'), seller_city)")
    with pytest.raises(Exception, match="lost"):
        daily.write_silver(
            spark, raw | {"sellers": raw["sellers"].withColumn("seller_city", broken)},
            root, "r2", RUN_TS,
        )
    assert {name: df.count() for name, df in daily.read_silver(spark, root).items()} == rows
    assert daily.write_silver(spark, raw, root, "r3", RUN_TS) == rows
    assert set(manifest.versions(spark, root).values()) == {"r3"}


def test_silver_must_have_been_published(spark, tmp_path):
    with pytest.raises(LookupError, match="orders"):
        daily.read_silver(spark, f"{tmp_path}/silver")


def test_large_tables_are_written_two_at_a_time(spark):
    """Shuffle files of two of them at most are on the disks; small ones do not wait for them."""
    lock, running, most = threading.Lock(), set(), []

    def write(name, number):
        with lock:
            running.add(name)
            most.append({n for n in running if n.startswith("fact") or n in LARGE})
        time.sleep(0.2)
        with lock:
            running.remove(name)
        return number

    LARGE = ("orders", "customers", "order_items", "payments", "seller_performance")
    tables = {name: n for n, name in enumerate(("fact_orders", "dim_sellers", *LARGE))}
    assert daily._write_together(spark, tables, write) == tables
    assert max(map(len, most)) == 2

    def fail(name, number):
        raise ValueError(name)

    with pytest.raises(ValueError, match="fact_orders"):
        daily._write_together(spark, tables, fail)


def test_no_step_leaves_its_shuffle_files(spark, delivered, tmp_path):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)

    def run():
        daily.run(spark, delivered, str(tmp_path), RUN_TS, minima={}, checks=CHECKS, database=None)

    def gold_alone():
        silver = daily.read_silver(spark, daily.silver_root(str(tmp_path)))
        daily.stage_gold(spark, silver, f"{tmp_path}/again", "r", RUN_TS)

    assert not left_by(spark, run)
    assert not left_by(spark, gold_alone)
    assert spark.conf.get(setting) == before
