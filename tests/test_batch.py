"""The daily batch: raw JSON to marts, run again, and stopped by its gate."""

import datetime as dt
import uuid

import pytest

from martworks.operators import quality
from martworks.operators.project import packed, unpacked
from martworks.operators.quality import QualityError
from martworks.plans import batch
from martworks.sources import raw, tables

DAY, NEXT = "2025-11-08", "2025-11-09"


@pytest.fixture
def lake(spark, tmp_path):
    run = uuid.uuid4().hex
    return batch.Lake(spark, str(tmp_path / "lake"), f"l1_{run}", f"l2_{run}").create()


def land(lake, ds, products=((1, "5.5"), (2, "2")), items='[{"productId": 1, "quantity": 2}, {"productId": 2, "quantity": 3}]'):
    spark = lake.spark
    feeds = {
        "products": spark.createDataFrame(
            [(str(i), f"item {i}", price, " Toys ") for i, price in products],
            "id string, title string, price string, category string",
        ),
        "carts": spark.createDataFrame(
            [("1", "1", "2025-01-02T00:00:00Z", items)], "id string, userId string, date string, products string"
        ),
        "users": spark.createDataFrame([("1", "ann", "ann@shop.org")], "id string, username string, email string"),
    }
    for name, records in feeds.items():
        raw.write_raw(records, lake.root, name, ds, "test")


def test_a_day_and_again(lake, rows, tmp_path):
    land(lake, DAY)
    for _ in range(2):
        report = batch.run_day(lake, DAY)
    assert set(rows(report, "status")) == {("pass",)}
    fact = lake.table("l2", "fact_sales")
    assert rows(fact.selectExpr("product_id", "category", "double(total_sales)", "load_ds")) == [
        (1, "toys", 11.0, dt.date(2025, 11, 8)), (2, "toys", 6.0, dt.date(2025, 11, 8)),
    ]
    assert lake.table("l1", "users").columns[:4] == ["user_id", "username", "email", "email_domain"]
    exported = lake.spark.read.option("header", True).csv(f"{lake.root}/exports/ds={DAY}/l2/fact_sales")
    assert exported.count() == 2
    assert not list(tmp_path.rglob("test_name=*"))


def test_a_second_day_repeats_products(lake, rows):
    land(lake, DAY)
    batch.run_day(lake, DAY)
    land(lake, NEXT, products=((1, "7"), (2, "2")))
    # Over the whole table a product of two days repeats its key, and the gate says so.
    with pytest.raises(QualityError, match="products_unique_product_id=2"):
        batch.run_day(lake, NEXT)
    report = batch.run_day(lake, NEXT, scope="batch")
    assert set(rows(report, "status")) == {("pass",)}
    assert lake.table("l1", "products").count() == 4
    assert rows(lake.table("l2", "fact_sales").selectExpr("product_id", "double(price)")) == [(1, 7.0), (2, 2.0)]
    batch.build(lake, latest_product=True)
    assert rows(lake.table("l2", "fact_sales").selectExpr("product_id", "double(price)")) == [
        (1, 7.0), (1, 7.0), (2, 2.0), (2, 2.0),
    ]
    batch.build(lake)
    assert lake.table("l2", "fact_sales").count() == 8


def test_gate_stops_the_load_and_keeps_the_rows(lake, rows):
    land(lake, DAY, products=((1, "0"), (1, "n/a")))
    with pytest.raises(QualityError, match="products_gt_zero_price=1"):
        batch.run_day(lake, DAY)
    assert not tables.table_exists(lake.spark, f"{lake.l1}.products")
    held = lake.spark.read.parquet(f"{lake.root}/quarantine/staging/products/ds={DAY}")
    assert rows(held, "test_name", "product_id", "price", "n_records") == sorted([
        ("products_gt_zero_price", 1, 0.0, None), ("products_not_null_price", 1, None, None),
        ("products_unique_product_id", 1, None, 2), ("cfg_unique", 1, None, 2),
    ], key=repr)


@pytest.mark.parametrize("mode, expected", [
    ("replace_partition", [(1, 5.5), (1, 9.0), (2, 2.0), (3, 1.0)]),
    ("truncate_insert", [(1, 9.0), (3, 1.0)]),
    ("upsert", [(1, 9.0), (2, 2.0), (3, 1.0)]),
])
def test_load_modes(lake, rows, mode, expected):
    land(lake, DAY)
    land(lake, NEXT, products=((1, "9"), (3, "1")))
    for ds in (DAY, NEXT):
        batch.transform(lake, "products", ds)
        batch.load(lake, "products", ds, mode)
    assert rows(lake.table("l1", "products"), "product_id", "price") == expected


def test_unknown_mode(lake):
    with pytest.raises(ValueError):
        batch.load(lake, "products", DAY, "merge")


def test_keys_are_counted_once_and_lines_without_product_stay(lake, rows, monkeypatch):
    seen = []
    found = quality.key_violations
    monkeypatch.setattr(quality, "key_violations", lambda df, rule: seen.append(rule.name) or found(df, rule))
    items = '[{"productId": 1, "quantity": 2}, {"productId": 1, "quantity": 5}, {"quantity": 3}, {"quantity": 3}]'
    land(lake, DAY, items=items)
    report = batch.run_day(lake, DAY, gate=False)
    assert all(seen.count(name) == 1 for name in (
        "carts_unique_cart_id_product_id", "carts_compound_pk", "fact_sales_unique_transaction_id"))
    told = {r.test_name: r.failures for r in report.collect() if r.failures}
    assert told == {
        "carts_unique_cart_id_product_id": 2, "carts_compound_pk": 2, "fact_sales_unique_transaction_id": 2,
        "carts_not_null_product_id": 2, **{f"fact_sales_not_null_{c}": 2 for c in ("product_id", "price", "total_sales")},
    }
    kept = lake.spark.read.parquet(f"{lake.root}/quarantine/l2/fact_sales/ds={DAY}").where(
        "test_name = 'fact_sales_unique_transaction_id'")
    ids = [r[0] for r in lake.table("l2", "fact_sales").select("transaction_id").distinct().collect()]
    assert rows(kept, "transaction_id", "n_records") == sorted((i, 2) for i in ids)
    assert rows(lake.table("l2", "fact_sales"), "product_id", "product_name") == sorted(
        [(1, "item 1"), (1, "item 1"), (None, None), (None, None)], key=repr)


def test_landed_and_exported_files_are_compressed(lake, tmp_path):
    land(lake, DAY)
    batch.run_day(lake, DAY)
    assert list((tmp_path / "lake/raw").rglob("part-*.json.gz")) and not list((tmp_path / "lake/raw").rglob("part-*.json"))
    assert list((tmp_path / "lake/exports").rglob("part-*.csv.gz")) and not list((tmp_path / "lake").rglob("part-*.csv"))
    for resource in ("staging/carts", f"{lake.l1}/carts", f"{lake.l2}/fact_sales"):
        assert list((tmp_path / "lake" / resource).rglob("*.zstd.parquet"))


def test_packed_texts_come_back_in_their_order(spark):
    texts = [None, "", "0", "00", "0a", "0A", "ab", "abc", "abcd", "zz", "é", " ff", "ff\nff", "ff\n", "00ff" * 8, "00ff" * 8]
    df = spark.createDataFrame([(t, k) for k, t in enumerate(texts)], "t string, k int")
    small = packed(df)
    assert sorted(map(tuple, unpacked(small, df.schema).collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    assert small.where("t is not null").selectExpr("max(length(t))").first()[0] == 17
    assert small.groupBy("t").count().count() == len(set(texts))
    digests = ["00", "0a", "ab", "abcd", "00ff" * 8, "00ff" * 8]
    others = [t for t in texts if t is not None and t not in digests]
    assert [r.t for r in unpacked(small.orderBy("t"), df.schema).collect()] == [
        None, *sorted(digests), *sorted(others, key=lambda t: t.encode())]
