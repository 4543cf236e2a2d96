from datetime import datetime

import pytest
from frames import columns, silver
from pyspark.sql import functions as F

from marketloom.operators import quality
from marketloom.plans import daily
from marketloom.schemas import BY_MONTH, RAW, SILVER
from marketloom.sources.standins import SQL, Standins
from marketloom.sources.tables import (
    MALFORMED,
    read_raw_csv,
    read_table,
    shared_path,
    write_raw_csv,
    write_table,
)


def csv(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_csv_is_read_as_strings_by_header_name(spark, tmp_path):
    path = csv(tmp_path, "a.csv", 'b,a,extra\n1.50,,x\n"1,2","",y\n')
    df = read_raw_csv(spark, path, ["a", "b"])
    assert df.dtypes == [("b", "string"), ("a", "string"), ("extra", "string")]
    assert columns(df, "a", "b", "extra") == [(None, "1,2", "y"), (None, "1.50", "x")]


def test_csv_with_missing_column_is_rejected(spark, tmp_path):
    with pytest.raises(ValueError, match="seller_id"):
        read_raw_csv(spark, csv(tmp_path, "a.csv", "x\n1\n"), ["seller_id"])


def test_csv_files_must_agree_on_the_header(spark, tmp_path):
    csv(tmp_path, "1.csv", "a,b\n1,2\n")
    csv(tmp_path, "2.csv", "b,a\n3,4\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_raw_csv(spark, str(tmp_path / "*.csv")).collect()


def test_csv_roundtrip_keeps_padding(spark, tmp_path):
    df = spark.createDataFrame([("  a ", None), ('q"uo,te', "ü")], "x string, y string")
    write_raw_csv(df, str(tmp_path / "out"))
    back = read_raw_csv(spark, str(tmp_path / "out"), ["x", "y"])
    assert columns(back, "x", "y") == columns(df, "x", "y")


def test_csv_is_written_compressed_and_in_bounded_files(spark, tmp_path):
    """A task reads a compressed file whole, so a large partition becomes several files."""
    df = spark.range(0, 600_000, numPartitions=1).selectExpr(
        "cast(id as string) AS order_id", "concat(id % 97, '.50') AS price"
    )
    write_raw_csv(df, str(tmp_path / "out"))
    files = list((tmp_path / "out").glob("part-*"))
    assert len(files) == 3 and all(file.name.endswith(".csv.gz") for file in files)
    text = df.selectExpr("sum(length(order_id) + length(price) + 2) AS n").first()["n"]
    assert sum(file.stat().st_size for file in files) < text / 2
    back = read_raw_csv(spark, str(tmp_path / "out"), ["order_id", "price"])
    assert back.count() == 600_000 and back.exceptAll(df).isEmpty()


def test_partitioned_table_roundtrip(spark, tmp_path):
    rows = [
        {"order_id": f"o{i}", "purchase_year": 2018, "purchase_month": 1 + i % 3,
         "order_purchase_timestamp": datetime(2018, 1 + i % 3, 1, 5)}
        for i in range(30)
    ]
    df = silver(spark, "orders", *rows, {"order_id": "undated"})
    path = str(tmp_path / "orders")
    assert write_table(df, path, BY_MONTH) == 31
    back = read_table(spark, path, SILVER["orders"])
    assert back.schema.fieldNames() == SILVER["orders"].fieldNames()
    assert columns(back, *back.columns) == columns(df, *df.columns)
    pruned = back.filter("purchase_month = 2").select("order_id")
    assert pruned.count() == 10


def test_a_partition_of_nulls_stays_typed(spark, tmp_path):
    write_table(silver(spark, "orders", {"order_id": "undated"}), str(tmp_path / "o"), BY_MONTH)
    back = read_table(spark, str(tmp_path / "o"), SILVER["orders"])
    assert dict(back.dtypes)["purchase_year"] == "int"
    assert back.first()["purchase_year"] is None


def test_a_hot_month_is_split_over_files(spark, tmp_path):
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        df = spark.range(0, 200_000, numPartitions=8).select(
            F.lit(2018).alias("purchase_year"),
            F.when(F.col("id") % 10 == 0, 1 + F.col("id") % 12).otherwise(5).alias("purchase_month"),
            F.sha2(F.col("id").cast("string"), 256).alias("text"),
        )
        assert write_table(df, str(tmp_path / "t"), BY_MONTH) == 200_000
    finally:
        for name in settings:
            spark.conf.unset(name)
    month = tmp_path / "t" / "purchase_year=2018" / "purchase_month=5"
    assert len(list(month.glob("*.parquet"))) > 3


def test_overwrite_replaces_the_whole_table(spark, tmp_path):
    path = str(tmp_path / "s")
    write_table(silver(spark, "sellers", {"seller_id": "a"}, {"seller_id": "b"}), path)
    assert write_table(silver(spark, "sellers", {"seller_id": "c"}), path) == 1
    assert columns(read_table(spark, path, SILVER["sellers"]), "seller_id") == [("c",)]


def test_shared_paths_are_fresh_and_under_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_path(spark, "x"), shared_path(spark, "x")
    assert first != second and first.startswith(folder) and second.startswith(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_standins_have_the_raw_columns_as_strings(spark, name):
    df = Standins(spark, "/root/testdata/sf0.001").raw(name)
    assert df.dtypes == [(column, "string") for column in RAW[name]]
    assert not df.isEmpty()


def test_malformed_lines_are_counted(spark, tmp_path):
    """Short and long lines, in any file; quoted commas and empty fields fit."""
    path = tmp_path / "sellers.csv"
    path.mkdir()
    header = "seller_id,seller_zip_code_prefix,seller_city,seller_state"
    (path / "a.csv").write_text(header + '\n1,2,"a, b",c\n2,,,\n3,4\n')
    (path / "b.csv").write_text(header + "\n5,6,d,e,extra\n7,8,f,g\n")
    raw = read_raw_csv(spark, str(path), malformed=True)
    told = {row["seller_id"]: row[MALFORMED] for row in raw.collect()}
    assert told == {"1": None, "2": None, "3": "3,4", "5": "5,6,d,e,extra", "7": None}
    (row,) = quality.run_checks({"sellers": raw}, [quality.WellFormed("sellers")]).collect()
    assert (row["observed"], row["passed"]) == (2, False)
    assert read_raw_csv(spark, str(path)).columns == header.split(",")
    with pytest.raises(quality.QualityError, match="sellers malformed_rows: observed 2"):
        daily.check_delivery(
            spark, str(tmp_path), {"sellers": "sellers.csv"}, [quality.WellFormed("sellers")]
        )
