import datetime as dt
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from martworks.sources import tables

D1, D2, D3 = dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 1, 3)


@pytest.fixture
def table(spark, tmp_path):
    database = f"t_{uuid.uuid4().hex}"
    tables.ensure_database(spark, database, str(tmp_path / "db"))
    tables.ensure_database(spark, database)
    return f"{database}.items"


def frame(spark, values, schema="k bigint, v string, n double, ds date"):
    return spark.createDataFrame(values, schema)


def test_create_and_evolve(spark, table, rows):
    assert not tables.table_exists(spark, table)
    tables.append_rows(frame(spark, [(1, "a", D1)], "k int, v string, ds date"), table)
    assert tables.table_exists(spark, table)
    assert tables.table_columns(spark, table) == ["k", "v", "ds"]
    assert tables.partition_columns(spark, table) == ["ds"]
    tables.append_rows(frame(spark, [(2, 0.5, D2)], "k int, n float, ds date"), table)
    assert rows(spark.table(table), "k", "v", "n", "ds") == [(1, "a", None, D1), (2, None, 0.5, D2)]
    assert dict(spark.table(table).dtypes) == {"k": "bigint", "v": "string", "n": "double", "ds": "date"}


def test_storage_types(spark):
    df = spark.sql("select 1Y a, 1.5F b, double('nan') c, timestamp'2025-01-01' d, 1.5BD e, binary('x') f, null g")
    stored = tables.storable(df)
    assert [d for _, d in stored.dtypes] == [
        "bigint", "double", "double", "timestamp_ntz", "decimal(2,1)", "string", "string",
    ]
    assert stored.first()["c"] is None
    for nested in (T.ArrayType(T.LongType()), T.StructType(), T.MapType(T.StringType(), T.StringType())):
        with pytest.raises(TypeError):
            tables.storage_type(nested)


def test_replace_partition(spark, table, rows):
    tables.replace_partition(frame(spark, [(1, "a", 1.0, D1), (2, "b", 2.0, D2)]), table, many_days=True)
    batch = frame(spark, [(3, "c", 3.0, D2)])
    for _ in range(2):
        tables.replace_partition(batch, table)
    tables.replace_partition(batch.where("k < 0"), table)
    assert rows(spark.table(table), "k", "ds") == [(1, D1), (3, D2)]


def test_days_are_rebalanced_for_writing(spark):
    plan = tables.by_day(frame(spark, [(1, "a", 1.0, D1)]))._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_truncate_insert(spark, table, rows):
    tables.truncate_insert(frame(spark, [(1, "a", 1.0, D1), (2, "b", 2.0, D2)]), table)
    tables.truncate_insert(frame(spark, [(3, "c", 3.0, D3)]), table)
    tables.truncate_insert(frame(spark, []), table)
    assert rows(spark.table(table), "k", "ds") == [(3, D3)]


def test_delete_where(spark, table, rows):
    tables.append_rows(
        frame(spark, [(1, "a", 1.0, D1), (2, "b", 2.0, D1), (3, None, 2.0, D2), (4, "b", 9.0, None)]), table
    )
    tables.delete_where(spark, table, {})
    tables.delete_where(spark, table, {"v": "zzz"})
    assert spark.table(table).count() == 4
    tables.delete_where(spark, table, {"v": "b", "n": 2})
    assert rows(spark.table(table), "k") == [(1,), (3,), (4,)]
    tables.delete_where(spark, table, {"ds": "2025-01-02"})
    tables.delete_where(spark, table, {"k": 4})
    assert rows(spark.table(table), "k") == [(1,)]


def test_delete_where_without_partitions(spark, table, rows):
    tables.append_rows(frame(spark, [(1, "a"), (2, None)], "k bigint, v string"), table)
    tables.delete_where(spark, table, {"v": "a"})
    assert rows(spark.table(table)) == [(2, None)]


def test_upsert_moves_keeps_and_inserts(spark, table, rows):
    tables.append_rows(
        frame(spark, [(1, "a", 1.0, D1), (2, "b", 2.0, D2), (3, "c", 3.0, D2), (None, "n", 0.0, D3)]), table
    )
    batch = frame(spark, [(1, None, D3), (3, "C", D2), (7, "new", D3), (None, "m", D3)], "k int, v string, ds date")
    tables.upsert(batch, table, ["k"])
    assert rows(spark.table(table), "k", "v", "n", "ds") == sorted([
        (1, None, 1.0, D3), (2, "b", 2.0, D2), (3, "C", 3.0, D2), (7, "new", None, D3), (None, "m", None, D3),
        (None, "n", 0.0, D3),
    ], key=repr)
    # Day 1 lost its only row, so a stale copy must not come back.
    assert spark.table(table).where("ds = date'2025-01-01'").count() == 0


def test_upsert_creates_evolves_and_repeats(spark, table, rows):
    first = frame(spark, [(1, "a", D1)], "k bigint, v string, ds date")
    tables.upsert(first, table, ["k"])
    second = frame(spark, [(1, "b", 5, D1)], "k bigint, v string, extra int, ds date")
    for _ in range(2):
        tables.upsert(second, table, ["k"])
    assert rows(spark.table(table), "k", "v", "extra", "ds") == [(1, "b", 5, D1)]
    tables.upsert(second.where("k < 0"), table, ["k"])
    assert spark.table(table).count() == 1


def test_upsert_without_the_day_column(spark, table, rows):
    tables.append_rows(frame(spark, [(1, "a", 1.0, D1), (2, "b", 2.0, D2)]), table)
    tables.upsert(frame(spark, [(1, "z"), (5, "e")], "k bigint, v string"), table, ["k"])
    assert rows(spark.table(table), "k", "v", "n", "ds") == sorted(
        [(1, "z", 1.0, D1), (2, "b", 2.0, D2), (5, "e", None, None)], key=repr
    )


def test_upsert_composite_key(spark, table, rows):
    schema = "a bigint, b bigint, v string, ds date"
    tables.append_rows(frame(spark, [(1, 1, "x", D1), (1, 2, "y", D1), (1, None, "z", D1)], schema), table)
    tables.upsert(frame(spark, [(1, 2, "Y", D1), (1, None, "Z", D1)], schema), table, ["a", "b"])
    assert rows(spark.table(table), "a", "b", "v") == sorted(
        [(1, 1, "x"), (1, 2, "Y"), (1, None, "z"), (1, None, "Z")], key=repr
    )


def test_upsert_rejects_repeated_keys(spark, table):
    with pytest.raises(tables.DuplicateKeys):
        tables.upsert(frame(spark, [(1, "a", 1.0, D1), (1, "b", 1.0, D1)]), table, ["k"])


def test_text_does_not_fit_a_number_column(spark, table):
    tables.append_rows(frame(spark, [(1, "a", 1.0, D1)]), table)
    with pytest.raises(Exception):
        tables.append_rows(frame(spark, [("x", D1)], "k string, ds date"), table)


def test_no_path_is_read_while_overwritten(spark, table):
    tables.append_rows(frame(spark, [(1, "a", 1.0, D1)]), table)
    with pytest.raises(AnalysisException):
        tables.truncate_insert(spark.table(table), table)


def test_materialize(spark, table, rows):
    df = frame(spark, [(1, "a", 1.0, D1), (2, "b", 1.0, D2)])
    for _ in range(2):
        tables.materialize_table(df, table, partition_by="ds")
    assert rows(spark.table(table), "k") == [(1,), (2,)]
    tables.materialize_table(df.where("k = 1"), table, partition_by="ds", many_days=True)
    assert rows(tables.read_sql(spark, f"select k from {table} where k < :top", top=9)) == [(1,)]
    assert rows(tables.materialize_view(df, "items_view"), "k") == [(1,), (2,)]
