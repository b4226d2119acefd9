import datetime as dt
import json

import pytest

from martworks.operators.project import apply_config
from martworks.plans.batch import to_columns
from martworks.plans.resources import CONFIGS, RAW_SCHEMAS
from martworks.sources import exports, pick, raw

DAY = "2025-11-08"

USER = {
    "id": 8, "email": "ann@shop.org", "username": "ann", "password": "pw", "phone": "1-2",
    "name": {"firstname": "ann", "lastname": "lee"},
    "address": {"city": "bonn", "street": "hill", "number": 12, "zipcode": "53",
                "geolocation": {"lat": "12.25", "long": "-48.5"}},
    "__v": 0,
}
CARTS = [
    {"id": 1, "userId": 3, "date": "2031-06-09T00:00:00.000Z",
     "products": [{"productId": 1, "quantity": 6}, {"productId": 2, "quantity": 1}], "__v": 0},
    {"id": 2, "userId": 3, "date": "junk", "products": [], "__v": 0},
    {"id": 3, "userId": 4, "date": None, "products": "[{'productId': 5, 'quantity': None}]"},
]
PRODUCT = {
    "id": 7, "title": "Lamp ", "price": 18.6, "description": None, "category": None, "image": "u",
    "rating": {"rate": 2.7, "count": 33},
}


def envelope(records):
    return {"meta": {"source": "here", "fetched_at": "2025-11-08T07:11:02Z", "count": len(records)}, "data": records}


def landed(tmp_path, resource, document):
    path = tmp_path / raw.object_path("raw", resource, DAY, "json")
    path.parent.mkdir(parents=True)
    path.write_text(json.dumps(document, indent=1))
    return str(path)


def test_object_path():
    assert raw.object_path("raw", "carts", DAY, "json") == "raw/carts/2025/11/08/carts_2025-11-08.json"
    with pytest.raises(ValueError):
        raw.object_path("raw", "carts", "2025-1-8", "json")


def test_carts_envelope_to_columns(spark, tmp_path, rows):
    path = landed(tmp_path, "carts", envelope(CARTS))
    records = raw.read_json(spark, path, RAW_SCHEMAS["carts"], lines=False)
    out = to_columns("carts", records, DAY)
    assert out.columns == ["cart_id", "user_id", "order_date", "product_id", "quantity", "ds"]
    day, at = dt.date(2025, 11, 8), dt.datetime(2031, 6, 9)
    assert rows(out) == sorted([
        (1, 3, at, 1, 6, day), (1, 3, at, 2, 1, day), (2, 3, None, None, None, day), (3, 4, None, 5, None, day),
    ], key=repr)


def test_inferred_envelope_gives_the_same(spark, tmp_path, rows):
    path = landed(tmp_path, "carts", envelope(CARTS[:2]))
    typed = to_columns("carts", raw.read_json(spark, path, RAW_SCHEMAS["carts"], lines=False), DAY)
    inferred = to_columns("carts", raw.read_json(spark, path, lines=False), DAY)
    assert rows(inferred) == rows(typed)


def test_users_and_products(spark, tmp_path, rows):
    users = raw.read_json(spark, landed(tmp_path, "users", envelope([USER])), RAW_SCHEMAS["users"], lines=False)
    out = apply_config(users, CONFIGS["users"])
    assert "password" not in users.columns and "password" not in out.columns
    assert out.first().asDict() == {
        "user_id": 8, "username": "ann", "email": "ann@shop.org", "email_domain": "shop.org", "phone": "1-2",
        "first_name": "ann", "last_name": "lee", "full_name": "ann lee", "address_street": "hill",
        "address_number": 12, "address_city": "bonn", "address_zip": "53", "geo_lat": 12.25, "geo_lng": -48.5,
    }
    path = landed(tmp_path, "products", envelope([PRODUCT]))
    product = apply_config(raw.read_json(spark, path, RAW_SCHEMAS["products"], lines=False), CONFIGS["products"])
    assert rows(product) == [(7, "Lamp ", "", 18.6, "unknown", "u", 2.7, 33, 5)]


def test_document_without_data_is_one_record(spark, tmp_path, rows):
    path = landed(tmp_path, "users", USER)
    assert rows(raw.read_json(spark, path, RAW_SCHEMAS["users"], lines=False), "id") == [("8",)]
    assert rows(raw.read_json(spark, path, lines=False), "id") == [(8,)]
    empty = tmp_path / "empty.json"
    empty.write_text(json.dumps(envelope([])))
    assert raw.read_json(spark, str(empty), RAW_SCHEMAS["users"], lines=False).count() == 0


def test_broken_json_fails(spark, tmp_path):
    path = tmp_path / "broken.json"
    path.write_text('{"data": [')
    with pytest.raises(Exception):
        raw.read_json(spark, str(path), RAW_SCHEMAS["users"], lines=False).collect()


def test_write_raw_counts_in_the_writing_job(spark, tmp_path, rows):
    records = spark.range(1000).selectExpr("cast(id as string) id", "'e' email")
    root = str(tmp_path / "lake")
    at = dt.datetime(2025, 11, 8, 1, 2, 3)
    assert raw.write_raw(records, root, "users", DAY, "gen", at) == 1000
    assert rows(raw.read_meta(spark, root, "users", DAY)) == [("gen", "2025-11-08T01:02:03Z", 1000)]
    assert raw.read_raw(spark, root, "users", DAY, RAW_SCHEMAS["users"]).count() == 1000


def test_staging_replaces_only_its_days(spark, tmp_path, rows):
    root = str(tmp_path / "lake")
    schema = "k int, ds date"
    day1, day2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    raw.write_staging(spark.createDataFrame([(1, day1), (2, day2)], schema), root, "x")
    raw.write_staging(spark.createDataFrame([(3, day2)], schema), root, "x")
    raw.write_staging(spark.createDataFrame([], schema), root, "x")
    assert rows(raw.read_staging(spark, root, "x", "2025-01-01"), "k") == [(1,)]
    assert rows(raw.read_staging(spark, root, "x", "2025-01-02"), "k") == [(3,)]


def test_pick_source(spark, tmp_path):
    root = str(tmp_path)
    prefixes = pick.candidate_prefixes(root, "raw", "users", DAY, "shop")
    assert pick.pick_source(spark, prefixes, ".json", DAY) is None
    second = tmp_path / "shop" / "users" / f"ds={DAY}"
    for name in ("z.json", "deep/b.json", "skip.parquet"):
        (second / name).parent.mkdir(parents=True, exist_ok=True)
        (second / name).write_text("{}")
    assert pick.pick_source(spark, prefixes, ".json", DAY).endswith("deep/b.json")
    (second / f"zz_{DAY}.json").write_text("{}")
    assert pick.pick_source(spark, prefixes, ".json", DAY).endswith(f"zz_{DAY}.json")
    first = tmp_path / "raw" / "users" / "2025" / "11" / "08"
    first.mkdir(parents=True)
    (first / "note.txt").write_text("x")
    assert pick.pick_source(spark, prefixes, ".json", DAY).endswith(f"zz_{DAY}.json")
    (first / "plain.json").write_text("{}")
    assert pick.pick_source(spark, prefixes, ".json", DAY).endswith("plain.json")


def test_exports(spark, tmp_path, rows):
    dim = spark.sql("""select 2 product_id, 'b' product_name, 'c' category, 1.0 price, date'2025-11-08' last_ingested_ds
                       union all select 1, 'a', 'c', 2.0, date'2025-11-07'
                       union all select null, 'n', 'c', 2.0, date'2025-11-07'""")
    assert [r[0] for r in exports.export_dim(dim, DAY).collect()] == [2]
    assert [r[0] for r in exports.export_dim(dim, "2030-01-01").collect()] == [1, 2, None]
    assert [r[0] for r in exports.export_dim(dim.drop("last_ingested_ds"), DAY).collect()] == [1, 2, None]
    fact = spark.sql("""select 'k1' transaction_id, 2 product_id, timestamp_ntz'2025-01-01' transaction_date,
                               timestamp_ntz'2025-11-08 00:00:00' load_ds
                        union all select 'k2', null, timestamp_ntz'2025-01-01', timestamp_ntz'2025-11-08 00:00:00'
                        union all select 'k3', 1, null, timestamp_ntz'2025-11-08 00:00:00'
                        union all select 'k4', 1, timestamp_ntz'2025-01-01', timestamp_ntz'2025-11-09 00:00:00'""")
    ordered = exports.export_fact(fact, DAY)
    assert [r[0] for r in ordered.collect()] == ["k1", "k2", "k3"]
    exports.write_csv(ordered, str(tmp_path / "csv"))
    assert rows(exports.read_csv(spark, str(tmp_path / "csv"), ordered.schema)) == rows(ordered)


def test_catalog(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(exports.catalog_columns({"t": df, "u": df.select("a")})) == [
        ("t", "a", 1, "int", 2, 0), ("t", "b", 2, "string", 2, 1), ("u", "a", 1, "int", 2, 0),
    ]
    assert rows(exports.catalog_columns({"t": df}, counts=False)) == [("t", "a", 1, "int"), ("t", "b", 2, "string")]
