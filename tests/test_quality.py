import datetime as dt

import pytest

from martworks.operators import quality as dq

DAY = "2025-11-08"


@pytest.fixture
def carts(spark):
    return spark.createDataFrame(
        [(1, 10, 2), (1, 10, 0), (1, None, 1), (1, None, None), (2, 11, -1), (None, 10, 3)],
        "cart_id int, product_id int, quantity int",
    )


def test_null_counts(carts, rows):
    assert rows(dq.null_counts(carts)) == [("cart_id", 1), ("product_id", 2), ("quantity", 1)]
    assert rows(dq.null_counts(carts, ["product_id", "absent"])) == [("product_id", 2)]


def test_two_meanings_of_unique(carts, rows):
    keys = ("cart_id", "product_id")
    assert rows(dq.duplicate_count(carts, keys)) == [(2,)]
    assert rows(dq.key_violations(carts, dq.compound_key("k", *keys))) == [(1, 10, 2), (1, None, 2)]
    assert rows(dq.key_violations(carts, dq.unique("k", *keys))) == [(1, 10, 2)]
    assert rows(dq.duplicate_count(carts.where("false"), keys)) == [(0,)]


def test_row_rules_let_null_pass(carts, rows):
    wanted = [dq.above_zero("pos", "quantity"), dq.at_least("one", "quantity", 2), dq.between("mid", "quantity", 0, 2)]
    assert rows(dq.row_violations(carts, wanted), "test_name", "quantity") == sorted([
        ("pos", 0), ("pos", -1), ("one", 0), ("one", -1), ("one", 1), ("mid", -1), ("mid", 3),
    ], key=repr)


def test_total_matches(spark, rows):
    fact = spark.sql("""select 1 id, 2.0 quantity, 3.0 price, 6.0 total_sales union all select 2, 2.0, 3.0, 6.1
                        union all select 3, 2.0, null, 7""")
    assert rows(dq.row_violations(fact, [dq.total_matches("t", "total_sales", "quantity", "price")]), "id") == [(2,)]


def test_references(spark, carts, rows):
    parents = spark.createDataFrame([(10,), (None,)], "id int")
    rule = dq.references("ref", "product_id", parents, "id")
    assert rows(dq.reference_violations(carts, rule)) == [(11, 1)]


def test_report_skips_and_counts(spark, carts, rows):
    parents = spark.createDataFrame([(10,)], "id int")
    wanted = [
        dq.not_null("nn", "product_id"), dq.above_zero("pos", "quantity"), dq.not_null("gone", "absent"),
        dq.no_duplicates("dup", "cart_id", "product_id"), dq.unique("uni", "cart_id", "product_id"),
        dq.references("ref", "product_id", parents, "id"), dq.unique("part", "cart_id", "absent"),
        dq.at_least("fine", "quantity", -5),
    ]
    found = dq.report(carts, wanted, "l1", "carts", DAY)
    day = dt.date(2025, 11, 8)
    assert rows(found) == sorted([
        ("nn", "l1", "carts", day, "fail", 2), ("pos", "l1", "carts", day, "fail", 2),
        ("gone", "l1", "carts", day, "skipped", None), ("dup", "l1", "carts", day, "fail", 2),
        ("uni", "l1", "carts", day, "fail", 1), ("ref", "l1", "carts", day, "fail", 1),
        ("part", "l1", "carts", day, "skipped", None), ("fine", "l1", "carts", day, "pass", 0),
    ], key=repr)
    assert rows(dq.status_counts(found)) == [("fail", 5), ("pass", 1), ("skipped", 2)]
    assert {r.name for r in dq.failed_rules(found, wanted)} == {"nn", "pos", "dup", "uni", "ref"}
    with pytest.raises(dq.QualityError, match="carts.dup=2"):
        dq.enforce(found)
    dq.enforce(found.where("status <> 'fail'"))


def test_report_on_no_rows_and_no_usable_rules(carts, rows):
    found = dq.report(carts.where("false"), dq.basic_checks("carts"), "l1", "carts", DAY)
    assert set(rows(found, "status", "failures")) == {("pass", 0)}
    only_skipped = dq.report(carts, [dq.not_null("gone", "absent")], "l1", "carts", DAY)
    assert rows(only_skipped, "status") == [("skipped",)]


def test_basic_checks_follow_resource_and_config():
    def names(*args):
        return [r.name for r in dq.basic_checks(*args)]

    assert names("carts") == ["carts_gt_zero_quantity", "carts_unique_cart_id_product_id"]
    assert names("users", {"validations": {"not_null": ["a"], "unique": ["a", "b"]}})[2:] == [
        "cfg_not_null_a", "cfg_unique",
    ]
    assert names("other", {"validations": {"unique": [["a"], ["b", "c"]]}}) == ["cfg_unique_1", "cfg_unique_2"]


def test_write_report_replaces_its_own_day(carts, tmp_path, rows):
    wanted = dq.basic_checks("carts")
    path = str(tmp_path / "r")
    for _ in range(2):
        stored = dq.write_report(dq.report(carts, wanted, "l1", "carts", DAY), path, "l1", "carts", DAY)
    other = dq.write_report(dq.report(carts, wanted, "l1", "carts", "2025-11-09"), path, "l1", "carts", "2025-11-09")
    assert stored.count() == other.count() == 2
    assert rows(stored) == rows(dq.report(carts, wanted, "l1", "carts", DAY))
    assert carts.sparkSession.read.parquet(path).count() == 4


def test_quarantine_replaces_what_an_earlier_run_left(spark, carts, tmp_path, rows):
    wanted = [dq.not_null("nn", "product_id"), dq.compound_key("pk", "cart_id", "product_id")]
    path = str(tmp_path / "q")
    assert dq.quarantine(carts, wanted, path, "l1", "carts", DAY) == 2
    stored = spark.read.parquet(f"{path}/l1/carts")
    assert rows(stored, "test_name", "cart_id", "product_id", "n_records") == sorted([
        ("nn", 1, None, None), ("nn", 1, None, None), ("pk", 1, 10, 2), ("pk", 1, None, 2),
    ], key=repr)
    assert dq.quarantine(carts, wanted[:1], path, "l1", "carts", DAY) == 1
    assert rows(spark.read.parquet(f"{path}/l1/carts").select("test_name").distinct()) == [("nn",)]
    assert dq.quarantine(carts, [], path, "l1", "carts", DAY) == 0
    assert not list((tmp_path / "q").rglob("test_name=*"))
