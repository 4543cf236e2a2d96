import math
import threading
from concurrent.futures import ThreadPoolExecutor
from unittest import mock

import pytest
from frames import columns
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType, VarcharType

from marketloom.operators import publish, quality
from marketloom.operators.conform import conform, integral_columns, nan_to_null, narrow_integral
from marketloom.operators.quality import MinRows, NoNulls
from marketloom.schemas import GOLD, stored
from marketloom.sources import manifest, metrics

LAYOUT = StructType(
    [
        StructField("code", VarcharType(3)),
        StructField("size", IntegerType()),
        StructField("price", DoubleType()),
    ]
)


def test_conform_selects_by_name_and_casts(spark):
    df = spark.createDataFrame([("1.5", 9, "abc", 7)], "price string, extra int, code string, size long")
    fitted = conform(df, LAYOUT)
    assert fitted.dtypes == [("code", "string"), ("size", "int"), ("price", "double")]
    assert fitted.first() == ("abc", 7, 1.5)


def test_conform_rejects_missing_columns_and_wide_strings(spark):
    df = spark.createDataFrame([("abcd", 1)], "code string, size int")
    with pytest.raises(ValueError, match="price"):
        conform(df, LAYOUT)
    with pytest.raises(PySparkException, match="longer than 3"):
        conform(df.selectExpr("*", "1D AS price"), LAYOUT).collect()


def test_nan_and_integral_columns(spark):
    rows = [
        (1.0, 1.5, None, math.nan, 1e30),
        (math.nan, 2.0, None, 3.0, 2.0),
        (None, 2.0, None, 4.0, None),
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    assert columns(nan_to_null(df), "a") == [(1.0,), (None,), (None,)]
    assert dict(map(tuple, integral_columns(df).collect())) == {
        "a": True,
        "b": False,
        "c": False,
        "d": True,
        "e": False,
    }
    narrow = narrow_integral(df)
    assert narrow.dtypes == [("a", "bigint"), ("b", "double"), ("c", "double"), ("d", "bigint"),
                             ("e", "double")]
    assert narrow_integral(df, ["d"]).dtypes[0] == ("a", "double")
    assert columns(narrow, "a", "d") == [(1, None), (None, 3), (None, 4)]


@pytest.fixture
def tables(spark):
    return {
        "t": spark.createDataFrame([("x",), (None,)], "k string"),
        "u": spark.createDataFrame([], "k string"),
    }


def test_checks_come_back_as_rows(tables):
    checks = [MinRows("t", 2), NoNulls("t", "k"), MinRows("u", 1), NoNulls("u", "k")]
    assert sorted(map(tuple, quality.run_checks(tables, checks).collect())) == [
        ("t", "min_rows", 2, 2, True),
        ("t", "nulls_in_k", 1, 0, False),
        ("u", "min_rows", 0, 1, False),
        ("u", "nulls_in_k", 0, 0, True),
    ]


def test_every_failure_is_named_in_one_error(tables):
    with pytest.raises(quality.QualityError) as error:
        quality.enforce(quality.run_checks(tables, [NoNulls("t", "k"), MinRows("t", 1), MinRows("u", 1)]))
    message = str(error.value)
    assert "t nulls_in_k: observed 1, expected 0" in message
    assert "u min_rows: observed 0, expected 1" in message
    assert "t min_rows" not in message
    passed = quality.enforce(quality.run_checks(tables, [MinRows("t", 1)]))
    assert passed == ["t min_rows: observed 2, expected 1"]


def test_keys_without_a_row_in_the_other_table(spark):
    tables = {
        "f": spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int"),
        "d": spark.createDataFrame([(1,), (3,)], "k int"),
    }
    checks = [quality.KnownKeys("f", "k", "d", "k"), MinRows("f", 1)]
    assert sorted(map(tuple, quality.run_checks(tables, checks).collect())) == [
        ("f", "k_without_d", 2, 0, False),
        ("f", "min_rows", 4, 1, True),
    ]


def test_all_checks_of_a_table_share_one_pass(spark, tmp_path):
    path = str(tmp_path / "f")
    rows = [(1, 7, "a"), (2, 8, None), (2, None, None), (None, 9, "b")]
    spark.createDataFrame(rows, "k int, k2 long, v string").write.parquet(path)
    tables = {
        "f": spark.read.parquet(path),
        "d": spark.createDataFrame([(1,), (1,), (3,)], "k int"),
        "e": spark.createDataFrame([(8,), (9,), (None,)], "k2 long"),
    }
    checks = [
        quality.KnownKeys("f", "k", "d", "k"),
        NoNulls("f", "v"),
        quality.KnownKeys("f", "k2", "e", "k2"),
        MinRows("f", 4),
        MinRows("f", 5),
    ]
    found = quality.run_checks(tables, checks)
    assert sorted(map(tuple, found.collect())) == [
        ("f", "k2_without_e", 1, 0, False),
        ("f", "k_without_d", 2, 0, False),
        ("f", "min_rows", 4, 4, True),
        ("f", "min_rows", 4, 5, False),
        ("f", "nulls_in_v", 2, 0, False),
    ]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
    tables["f"] = tables["f"].limit(0)
    assert {row["observed"] for row in quality.run_checks(tables, checks).collect()} == {0}


def test_a_table_without_minimum_needs_one_row(tables):
    rows = quality.staging_checks(tables, {"t": 3}).collect()
    assert sorted(map(tuple, rows)) == [
        ("t", "min_rows", 2, 3, False),
        ("u", "min_rows", 0, 1, False),
    ]


def sellers(spark, *names):
    rows = [(name, "1", "City", "SP", None) for name in names]
    return spark.createDataFrame(rows, stored(GOLD["dim_sellers"]))


def test_a_failed_validation_leaves_the_published_version_alone(spark, tmp_path):
    root, minima = str(tmp_path / "gold"), {"dim_sellers": 2}

    def seen():
        assert columns(spark.table("shop_a.dim_sellers"), "seller_id") == columns(
            publish.published(spark, root, "dim_sellers"), "seller_id"
        )
        return columns(publish.published(spark, root, "dim_sellers"), "seller_id")

    with pytest.raises(LookupError):
        publish.published(spark, root, "dim_sellers")
    publish.publish(spark, {"dim_sellers": sellers(spark, "a", "b")}, root, "r1", minima, "shop_a")
    assert seen() == [("a",), ("b",)]
    with pytest.raises(quality.QualityError, match="dim_sellers min_rows"):
        publish.publish(spark, {"dim_sellers": sellers(spark, "c")}, root, "r2", minima, "shop_a")
    assert seen() == [("a",), ("b",)]
    publish.publish(spark, {"dim_sellers": sellers(spark, "d", "e")}, root, "r3", minima, "shop_a")
    assert seen() == [("d",), ("e",)]


def test_a_publication_keeps_the_other_tables(spark, tmp_path):
    root = str(tmp_path)
    assert publish.versions(spark, root) == {}
    publish.announce(spark, root, ["dim_sellers", "dim_date"], "r1")
    publish.announce(spark, root, ["dim_date"], "r2")
    assert publish.versions(spark, root) == {"dim_sellers": "r1", "dim_date": "r2"}


def test_metrics_of_a_staged_version(spark, tmp_path):
    root = str(tmp_path)
    nan = float("nan")
    rows = [("p1", 2.0, 0.5), ("p2", nan, 1.0), (None, 4.0, None)]
    given = spark.createDataFrame(rows, "product_id string, product_weight_g double, x double")
    fields = [f for f in stored(GOLD["dim_products"]).fields if f.name not in given.columns]
    df = given.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    assert publish.stage(df, root, "dim_products", "r1") == 3
    found = metrics.written(spark, root, "r1").first()
    assert (found["rows"], found["nulls"]["product_id"]) == (3, 1)
    assert found["nulls"]["product_weight_g"] == 1  # NaN is stored as NULL
    assert found["whole"] == ["product_weight_g"]
    assert set(found["nulls"]) == set(GOLD["dim_products"].fieldNames())
    narrow = publish.narrowed(spark, root, "dim_products", "r1")
    want = narrow_integral(publish.staged(spark, root, "dim_products", "r1"))
    assert narrow.dtypes == want.dtypes and dict(narrow.dtypes)["product_weight_g"] == "bigint"
    assert sorted(map(str, narrow.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(quality.QualityError, match="nulls_in_product_id: observed 1"):
        publish.validate(
            spark, root, ["dim_products"], "r1", {}, [NoNulls("dim_products", "product_id")]
        )
    publish.validate(spark, root, ["dim_products"], "r1", {}, [NoNulls("dim_sellers", "city")])


@pytest.mark.parametrize("damage", ["cut short", "one lost", "one more", "no metrics"])
def test_a_damaged_version_fails_validation(spark, tmp_path, damage):
    root = str(tmp_path)
    publish.stage(sellers(spark, "a", "b").repartition(2, "seller_id"), root, "dim_sellers", "r1")
    assert len(publish.validate(spark, root, ["dim_sellers"], "r1", {})) == 1
    file = next((tmp_path / "dim_sellers" / "v=r1").glob("*.parquet"))
    if damage == "cut short":
        file.write_bytes(file.read_bytes()[:-9])
        file.with_name(f".{file.name}.crc").unlink()
    elif damage == "one lost":
        file.unlink()
    elif damage == "one more":
        (file.parent / "part-x.parquet").write_bytes(b"PAR1")
    else:
        (tmp_path / "_metrics" / "v=r1" / "dim_sellers").rename(tmp_path / "elsewhere")
    with pytest.raises((quality.QualityError, PySparkException), match="stored_bytes|min_rows"):
        publish.validate(spark, root, ["dim_sellers"], "r1", {"dim_sellers": 0})


def test_an_empty_version_has_metrics(spark, tmp_path):
    root, table = str(tmp_path), "revenue_by_category"
    assert publish.stage(spark.createDataFrame([], stored(GOLD[table])), root, table, "r1") == 0
    lines = publish.validate(spark, root, [table], "r1", {table: 0})
    assert lines == [f"{table} min_rows: observed 0, expected 0"]
    with pytest.raises(quality.QualityError, match="min_rows: observed 0, expected 1"):
        publish.validate(spark, root, [table], "r1", {})


def test_a_version_is_never_overwritten(spark, tmp_path):
    publish.stage(sellers(spark, "a"), str(tmp_path), "dim_sellers", "r1")
    with pytest.raises(PySparkException, match="already exists"):
        publish.stage(sellers(spark, "b"), str(tmp_path), "dim_sellers", "r1")


def test_views_keep_declared_types_and_order(spark, tmp_path):
    names = GOLD["revenue_by_category"].fieldNames()
    row = {"purchase_year": None, "purchase_month": None, "category_english": "toys", "order_count": 1}
    df = spark.createDataFrame(
        [tuple(row.get(n) for n in names)], stored(GOLD["revenue_by_category"])
    )
    publish.publish(spark, {"revenue_by_category": df}, str(tmp_path), "r1", {}, "shop_b")
    found = publish.published(spark, str(tmp_path), "revenue_by_category")
    assert found.columns == names and dict(found.dtypes)["purchase_year"] == "int"
    view = spark.table("shop_b.revenue_by_category")
    assert view.columns == names
    assert dict(view.dtypes)["purchase_year"] == "int"
    assert view.first()["category_english"] == "toys"


def test_publishers_at_once_all_show_up(spark, tmp_path):
    """Each has read the manifest before any of them writes."""
    root = str(tmp_path)
    publish.announce(spark, root, ["shared"], "r0")
    names = [f"table{n}" for n in range(6)]
    barrier = threading.Barrier(len(names))
    latest = manifest._latest

    def waits(*args):
        found = latest(*args)
        barrier.wait(60)
        return found

    with mock.patch.object(manifest, "_latest", waits), ThreadPoolExecutor(len(names)) as pool:
        list(pool.map(lambda name: publish.announce(spark, root, [name, "both"], name), names))
    found = publish.versions(spark, root)
    assert {name: found[name] for name in names} == {name: name for name in names}
    assert found["shared"] == "r0" and found["both"] in names
    assert publish.versions(spark, root) == found
    publish.announce(spark, root, ["both"], "later")
    assert publish.versions(spark, root)["both"] == "later"
