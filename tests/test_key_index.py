import datetime as dt
import uuid

import pytest

from martworks.session import setting
from martworks.sources import key_index, tables
from martworks.sources.key_index import KeyIndex

D1, D2, D3 = dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 1, 3)
SCHEMA = "k bigint, v string, ds date"


@pytest.fixture
def index(spark, tmp_path):
    database = f"k_{uuid.uuid4().hex}"
    tables.ensure_database(spark, database, str(tmp_path / "db"))
    table = f"{database}.items"
    rows = [(1, "a", D1), (2, "b", D1), (2, "c", D2), (None, "n", D2), (None, "n", D2)]
    tables.append_rows(spark.createDataFrame(rows, SCHEMA), table)
    return KeyIndex(spark, table, ["k"], buckets=4).open()


def exchanges(df):
    with setting(df.sparkSession, "spark.sql.adaptive.enabled", "false"):
        df = df.select("*")
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_counts_keys_by_day_without_nulls(index, rows):
    assert rows(index.rows(), "k", "__n", "ds") == [(1, 1, D1), (2, 1, D1), (2, 1, D2)]
    assert rows(index.repeated()) == [(2, 2)]


def test_replaced_and_emptied_days_are_counted_again(spark, index, rows):
    key_index.load(spark.createDataFrame([(5, "x", D2), (5, "y", D2)], SCHEMA), [index])
    assert rows(index.repeated()) == [(5, 2)]
    with index.changing([D2]):
        tables.delete_where(spark, index.table, {"ds": D2})
    assert rows(index.rows(), "k", "ds") == [(1, D1), (2, D1)]
    key_index.load(spark.createDataFrame([(None, "x", D1)], SCHEMA), [index])
    assert rows(index.rows()) == []
    key_index.load(spark.createDataFrame([], SCHEMA), [index])
    assert index.open_days() == []


def test_a_lost_driver_leaves_noted_days_that_opening_counts(spark, index, rows):
    with pytest.raises(RuntimeError), index.changing([D1]):
        tables.replace_partition(spark.createDataFrame([(9, "z", D1)], SCHEMA), index.table)
        raise RuntimeError("lost")
    assert index.open_days() == [D1]
    spark.sql(f"DROP TABLE {index.name}")  # a catalogue that ends with its session
    again = KeyIndex(spark, index.table, ["k"], buckets=4).open()
    assert rows(again.rows(), "k", "ds") == [(2, D2), (9, D1)]
    tables.append_rows(spark.createDataFrame([(7, "new", D3)], SCHEMA), index.table)  # a new day is seen by itself
    assert rows(again.open().rows(), "k", "ds") == [(2, D2), (7, D3), (9, D1)]


def test_upsert_equals_the_plain_one(spark, index, rows):
    plain = f"{index.table}_plain"
    start = [(1, "a", D1), (3, "c", D2), (None, "n", D2)]
    batch = spark.createDataFrame([(1, "A", D3), (4, "D", D2), (None, "N", D1)], SCHEMA)
    for load in (lambda df: key_index.load(df, [index]), lambda df: tables.replace_partition(df, plain)):
        load(spark.createDataFrame(start, SCHEMA))
    key_index.upsert(batch, index)
    tables.upsert(batch, plain, ["k"])
    assert rows(spark.table(index.table)) == rows(spark.table(plain))
    assert rows(index.rows(), "k", "ds") == [(1, D3), (3, D2), (4, D2)]


def test_keys_stored_on_another_day_are_refused(spark, index, rows):
    batch = spark.createDataFrame([(1, "x", D2), (2, "y", D2), (8, "z", D2)], SCHEMA)
    assert rows(index.conflicts(batch)) == [(1, D2, D1), (2, D2, D1)]
    assert rows(index.conflicts(batch, replacing=False)) == [(1, D2, D1), (2, D2, D1), (2, D2, D2)]
    before = rows(spark.table(index.table))
    with pytest.raises(tables.DuplicateKeys):
        key_index.load_unique(batch, index)
    assert rows(spark.table(index.table)) == before
    key_index.load_unique(batch.where("k = 8"), index)
    assert rows(index.rows(), "k", "ds") == [(1, D1), (2, D1), (8, D2)]


def test_rows_without_a_day_are_refused(spark, index):
    with pytest.raises(ValueError, match="without ds"):
        key_index.load(spark.createDataFrame([(1, "x", None)], SCHEMA), [index])


def test_stored_keys_are_not_shuffled(spark, index, rows):
    parent = KeyIndex(spark, index.table, ["k"], buckets=4)
    batch = spark.range(3).selectExpr("id as k", "'x' as v", "date'2025-01-02' as ds")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        assert exchanges(index.repeated()) == 0
        assert exchanges(index.orphans(parent)) == 0
        assert exchanges(index.matched(batch)) == 1
        assert rows(index.orphans(parent)) == []
        assert rows(index.matched(batch)) == [(1, D1), (2, D1), (2, D2)]
    scan = index.repeated()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:bigint,__n:bigint>" in scan
