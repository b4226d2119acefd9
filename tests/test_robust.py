"""Records, names, values and days that must not get lost."""

import datetime as dt
import json
import subprocess
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martworks.functions.scalars import PRICE, cast_changes
from martworks.plans import batch
from martworks.plans.resources import RAW_SCHEMAS
from martworks.sources import exports, raw, tables

DAYS = ("2031-04-05", "2031-04-06")
USER = {"id": 41, "email": "kim@mail.test", "username": "kim", "phone": "9", "password": "x",
        "name": {"firstname": "kim", "lastname": "ode"},
        "address": {"city": "oslo", "street": "low", "number": 7, "zipcode": "1", "geolocation": {"lat": "1.5", "long": "2.5"}}}
PRODUCT = {"id": 5, "title": "Cup ", "price": 3.75, "description": "d", "category": "Home", "image": "i",
           "rating": {"rate": 3.5, "count": 12}}
CART = {"id": 90, "userId": 41, "date": "2031-04-01T00:00:00.000Z", "products": [{"productId": 5, "quantity": 2}]}


def land(root, day, **lines):
    for resource, rows in lines.items():
        folder = Path(raw.day_path(str(root), "raw", resource, day))
        folder.mkdir(parents=True, exist_ok=True)
        for old in folder.glob("*"):
            old.unlink()
        (folder / "part.json").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))


def test_records_without_a_known_field_stay(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"id":"1"}\n{"other":5}\n{"id":null}\n{"meta":{"count":0},"data":null}')
    assert raw.read_json(spark, str(tmp_path), RAW_SCHEMAS["users"]).count() == 3


def test_odd_values_are_null_and_broken_lines_told_apart(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"id":"1","rating":"n/a","title":"t"}\n{"id": \n{"id":"2","rating":{"rate":"4"}}')
    records = raw.read_json(spark, str(tmp_path), RAW_SCHEMAS["products"], lenient=True)
    assert sorted((r.id, r.rating and r.rating.rate) for r in raw.readable(records).collect()) == [("1", None), ("2", "4")]
    assert [r[0] for r in raw.malformed(records).collect()] == ['{"id": ']


def test_names_that_differ_in_case(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS case_names")
    spark.sql("DROP TABLE IF EXISTS case_names.t")
    tables.append_rows(spark.sql("select 1 id, 2.5D price"), "case_names.t", None)
    tables.append_rows(spark.sql("select 2 ID, 9.5D Price"), "case_names.t", None)
    tables.upsert(spark.sql("select 1 Id, 7.5D PRICE"), "case_names.t", ["Id"], None)
    assert sorted(map(tuple, spark.table("case_names.t").collect())) == [(1, 7.5), (2, 9.5)]
    with pytest.raises(ValueError):
        tables.append_rows(spark.createDataFrame([(1, 2)], "a int, b int").toDF("x", "X"), "case_names.t", None)
    spark.sql("DROP DATABASE case_names CASCADE")


def test_csv_gives_values_back(spark, tmp_path, rows):
    values = [(1, 'Mens "X" shirt '), (2, "a\nb"), (3, " lead"), (4, ""), (5, None), (6, "a,b\\"), (7, '"')]
    df = spark.createDataFrame(values, "id int, t string")
    exports.write_csv(df, str(tmp_path / "csv"))
    assert rows(exports.read_csv(spark, str(tmp_path / "csv"), df.schema)) == sorted(values, key=repr)


def test_cast_changes(spark):
    df = spark.sql("select explode(array(1.5D, 0.000000001D, 1e20D, cast(null as double))) as p")
    assert df.agg(cast_changes(F.col("p"), PRICE).alias("n")).first().n == 2


ONE_DAY = """
import sys
from martworks import session
from martworks.plans.batch import Lake, run_day
spark = session.build("day", "local[2]", 2)
lake = Lake(spark, sys.argv[1]).create()
run_day(lake, sys.argv[2], gate=False)
for name in ("products", "carts", "users"):
    print("L1", name, sorted(str(r[0]) for r in lake.table("l1", name).select("ds").distinct().collect()))
print("FACT", lake.table("l2", "fact_sales").count(), lake.table("l2", "dim_product").count())
"""


def test_two_days_in_two_processes(tmp_path):
    out = []
    for day in DAYS:
        land(tmp_path / "lake", day, products=[PRODUCT], carts=[CART], users=[USER])
        done = subprocess.run([sys.executable, "-c", ONE_DAY, str(tmp_path / "lake"), day], capture_output=True, text=True,
                              cwd=Path(__file__).resolve().parents[1], timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
        out = done.stdout
    assert out.count(str(list(DAYS))) == 3 and "FACT 1 1" in out


def test_a_day_without_records_changes_nothing(spark, tmp_path):
    lake = batch.Lake(spark, str(tmp_path / "lake"), "l1_empty", "l2_empty").create()
    for day, users in zip(DAYS, ([], [USER]), strict=True):
        land(tmp_path / "lake", day, products=[PRODUCT], carts=[CART, '{"id": '], users=users)
        batch.run_day(lake, day, gate=False)
        assert lake.table("l1", "users").count() == len(users)
    land(tmp_path / "lake", DAYS[1], products=[PRODUCT], carts=[CART], users=[])
    batch.transform(lake, "users", DAYS[1])
    assert raw.read_staging(spark, lake.root, "users", DAYS[1]).count() == 0
    assert spark.read.text(f"{lake.root}/quarantine/raw/carts/ds={DAYS[0]}").count() == 1
    for name in ("l1_empty", "l2_empty"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_scratch_is_empty_after_rewrites(spark, tmp_path, monkeypatch):
    scratch = tmp_path / "scratch"
    monkeypatch.setattr(tables, "scratch_dir", lambda spark, purpose: f"{scratch}/{purpose}-{uuid.uuid4().hex}")
    spark.sql(f"CREATE DATABASE rewrites LOCATION '{tmp_path}/db'")
    day = dt.date(2031, 1, 1)
    df = spark.createDataFrame([(k, k, day) for k in range(20)], "id int, v int, ds date")
    tables.replace_partition(df, "rewrites.t")
    tables.upsert(df.where("id < 5").withColumn("v", F.lit(0)), "rewrites.t", ["id"])
    tables.delete_where(spark, "rewrites.t", {"ds": day, "id": 7})
    assert spark.table("rewrites.t").agg(F.sum("v")).first()[0] == sum(range(5, 20)) - 7
    left = list(scratch.iterdir())
    assert len(left) > 2 and all(spark.read.parquet(str(p)).count() == 0 for p in left)
    tables.delete_where(spark, "rewrites.t", {"ds": day})
    assert spark.table("rewrites.t").count() == 0
    spark.sql("DROP DATABASE rewrites CASCADE")
