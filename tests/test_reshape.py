import json

import pytest
from pyspark.sql import functions as F

from martworks.functions.paths import lookup, resolve, resolve_name
from martworks.operators import project, reshape


@pytest.fixture
def nested(spark):
    return spark.sql("""
        select 1L id, named_struct('rate', 3.5D, 'by', named_struct('n', 7)) rating, array(1, 2) codes
        union all select 2L, null, null""")


def test_flatten(nested, rows):
    flat = reshape.flatten(nested)
    assert flat.columns == ["id", "rating_rate", "rating_by_n", "codes"]
    assert rows(flat, "id", "rating_rate", "rating_by_n") == [(1, 3.5, 7), (2, None, None)]


def test_flatten_struct_goes_last_and_takes_a_prefix(nested):
    assert reshape.flatten_struct(nested, "rating", "r").columns == ["id", "codes", "r_rate", "r_by_n"]
    assert reshape.flatten_struct(nested, "id") is nested
    assert reshape.flatten_struct(nested, "absent") is nested


def test_auto_flatten(nested):
    assert reshape.auto_flatten(nested).columns == ["id", "codes", "rating_rate", "rating_by_n"]
    assert reshape.auto_flatten(nested, 0).columns == nested.columns


def test_flatten_reports_a_clash(spark):
    df = spark.sql("select named_struct('b', 1) a, 2 a_b")
    with pytest.raises(ValueError, match="a_b"):
        reshape.flatten(df)


def test_lookup(nested, rows):
    def value(path):
        found = lookup(nested, path)
        return None if found is None else [r[0] for r in nested.select(found.column).collect()]

    assert value("rating.by.n") == [7, None]
    assert value("codes.1") == [2, None]
    assert value("codes.5") == [None, None]
    for dead in ("codes.-1", "codes.x", "rating.0", "rating.none", "none"):
        assert value(dead) is None


def test_resolve_spellings(spark):
    df = spark.createDataFrame([(1, 2)], "a_b int, `c.d` int").withColumn("s", F.struct(F.lit(3).alias("t")))
    assert resolve_name(df, "a.b") == "a_b"
    assert resolve_name(df, "c_d") == "c.d"
    assert resolve_name(df, "x") is None
    assert resolve(df, "s") is None
    assert df.select(resolve(df, "s_t").column).first()[0] == 3
    assert df.select(resolve(df, "c_d").column).first()[0] == 2


def test_copy_paths(nested, rows):
    out = reshape.copy_paths(nested, {"codes.0": "first", "rating.rate": "id", "none.x": "gone"})
    assert rows(out, "id", "first", "gone") == [(1, 1, None), (2, None, None)]


def test_explode_column(spark, rows):
    df = spark.sql("select 1 id, array(5, 6) v union all select 2, array() union all select 3, null")
    assert rows(reshape.explode_column(df, "v")) == [(1, 5), (1, 6), (2, None), (3, None)]
    assert reshape.explode_column(df, "v").columns == ["id", "v_value"]
    assert rows(reshape.explode_column(spark.sql("select 1 id, 9 v"), "v")) == [(1, 9)]
    assert reshape.explode_column(df, "absent") is df
    objects = spark.sql("select 1 id, array(named_struct('a', 1, 'b', named_struct('c', 2)), null) v")
    out = reshape.explode_column(objects, "v")
    assert out.columns == ["id", "v_a", "v_b_c"]
    assert rows(out) == [(1, 1, 2), (1, None, None)]


ITEMS = [
    ('[{"productId": 1, "quantity": 4}, {"productId": 2, "quantity": "1"}]', [(1, 4.0), (2, 1.0)]),
    ('{"productId": 3, "quantity": 2.5}', [(3, 2.5)]),
    ("[{'productId': 4, 'quantity': None}, {'quantity': 6, 'gift': True}]", [(4, None), (None, 6.0)]),
    ("{'productId': 5, 'quantity': 1,}", [(5, 1.0)]),
    ('[{"productId": 6}, 5, null, "x"]', [(6, None), (None, None), (None, None), (None, None)]),
    (json.dumps(['{"productId": 7, "quantity": 1}', "{'productId': 8}"]), [(7, 1.0), (8, None)]),
    ('[{"productId": "9", "quantity": "many", "note": "None, True]"}]', [(9, None)]),
    ("[]", [(None, None)]),
    ("null", [(None, None)]),
    ("junk", [(None, None)]),
    ("", [(None, None)]),
    ("5", [(None, None)]),
    (None, [(None, None)]),
]


@pytest.mark.parametrize("text, expected", ITEMS)
def test_explode_items_from_text(spark, rows, text, expected):
    df = spark.createDataFrame([(10, text)], "id int, products string")
    out = reshape.explode_items(df)
    assert out.columns == ["id", "products_productId", "products_quantity"]
    assert rows(out) == sorted(((10, *e) for e in expected), key=repr)


def test_explode_items_from_structs(spark, rows):
    listed = spark.sql("select 1 id, array(named_struct('productId', 2L, 'quantity', 3L), null) products")
    assert rows(reshape.explode_items(listed)) == [(1, 2, 3.0), (1, None, None)]
    lone = spark.sql("select 1 id, named_struct('productId', 2L) products")
    assert rows(reshape.explode_items(lone)) == [(1, 2, None)]
    texts = spark.sql("""select 1 id, array('{"productId": 2, "quantity": 1}', 'x', null) products""")
    assert rows(reshape.explode_items(texts)) == [(1, 2, 1.0), (1, None, None), (1, None, None)]
    numbers = spark.sql("select 1 id, array(1, 2) products")
    assert rows(reshape.explode_items(numbers)) == [(1, None, None), (1, None, None)]
    none = spark.sql("select 1 id, cast(array() as array<struct<productId: int>>) products")
    assert rows(reshape.explode_items(none)) == [(1, None, None)]
    assert reshape.explode_items(numbers.drop("products")).columns == ["id"]


def test_select_config(spark, rows):
    df = spark.sql("""select '7' id, ' x ' title, 'bad' price, named_struct('rate', '4.5') rating, null category
                      union all select 'q', null, '2', null, 'toys'""")
    config = {
        "select": {
            "key": {"path": "id", "type": "int", "default": -1},
            "title": {"type": "string"},
            "price": {"type": "float", "default": 0.5},
            "rate": {"path": "rating.rate", "type": "float"},
            "category": {"type": "string"},
            "stock": {"path": "stock.count", "type": "int", "default": 3},
            "plain": None,
        },
        "derive": {
            "n": {"op": "len", "args": ["title"]},
            "m": {"op": "len", "args": ["rating.rate"]},
            "both": {"op": "concat_ws", "args": ["-", "title", "category"]},
            "odd": {"op": "reverse", "args": ["title"]},
        },
        "fillna": {"category": "none", "n": 0, "absent": 1},
        "order": ["price", "absent", "key"],
    }
    out = project.apply_config(df, config)
    assert out.columns == ["price", "key", "title", "rate", "category", "stock", "plain", "n", "m", "both"]
    assert rows(out) == sorted([
        (0.5, 7, " x ", 4.5, "none", 3, None, 3, 3, " x "),
        (2.0, -1, None, None, "toys", 3, None, 0, None, "toys"),
    ], key=repr)


def test_flat_config_order(spark, rows):
    df = spark.sql("select 1 id, 2 products_productId, 'x' note")
    config = {
        "_config": {"order": ["note"]},
        "cart_id": {"mapping": "id", "data_type": " INTEGER "},
        "product_id": {"mapping": "products.productId", "data_type": "INTEGER"},
        "note": {},
        "skipped": "text",
    }
    assert project.apply_config(df, config).columns == ["note", "cart_id", "product_id"]
    del config["_config"]
    config = {"note": {"mapping": "note"}, **config}
    assert project.apply_config(df, config).columns == ["cart_id", "product_id", "note"]


def test_legacy_config(spark, rows):
    df = spark.sql("select 1 id, array(named_struct('p', '5'), named_struct('p', 'z')) items, 'b' `a.b`")
    config = {
        "explode": ["items", "absent"],
        "rename": {"id": "key"},
        "select": ["id", "items.p", "a_b"],
        "casts": {"items_p": "int", "gone": "int"},
        "fillna": {"items_p": 0},
    }
    out = project.apply_config(df, config)
    assert out.columns == ["key", "items_p", "a.b"]
    assert rows(out) == [(1, 0, "b"), (1, 5, "b")]
    assert project.select_columns(df, ["nothing"]) is df


def test_stamp_ds_replaces(spark):
    out = project.stamp_ds(spark.sql("select 'old' ds, 1 a"), "2025-11-08")
    assert str(out.first()["ds"]) == "2025-11-08"
    assert dict(out.dtypes)["ds"] == "date"
