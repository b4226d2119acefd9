import datetime as dt

import pytest

from martworks.operators.quality import QualityError, at_least
from martworks.plans.batch import Lake, load_gated
from martworks.queries.loading import fresh_table
from martworks.sources import publish, tables

DAY1, DAY2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)


def positive():
    return [at_least("positive", "quantity", 1)]


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "cart_id long, quantity long, ds date")


def content(spark, table):
    return sorted(tuple(r) for r in spark.table(table).select("cart_id", "quantity", "ds").collect())


def put(spark, table, df):
    folders = publish.stage(df, table)
    publish.publish(spark, table, folders)
    return folders


def test_nothing_is_visible_before_it_is_published(spark):
    table = fresh_table(spark, "carts")
    folders = publish.stage(batch(spark, (1, 2, DAY1), (2, 3, DAY2)), table)
    assert content(spark, table) == [] and publish.published(spark, table) == {}
    assert sorted(r.cart_id for r in publish.staged_rows(spark, table, folders).collect()) == [1, 2]
    publish.publish(spark, table, folders)
    assert content(spark, table) == [(1, 2, DAY1), (2, 3, DAY2)]
    put(spark, table, batch(spark, (9, 9, DAY2)))
    assert content(spark, table) == [(1, 2, DAY1), (9, 9, DAY2)]


def test_a_failed_gate_leaves_the_day_as_it_was(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), l1=fresh_table(spark, "x").partition(".")[0])
    table = f"{lake.l1}.carts"
    load_gated(lake, "carts", DAY1, batch(spark, (1, 2, DAY1)), positive())
    with pytest.raises(QualityError):
        load_gated(lake, "carts", DAY1, batch(spark, (1, 0, DAY1), (5, 5, DAY1)), positive())
    assert content(spark, table) == [(1, 2, DAY1)]
    out = spark.read.parquet(f"{tmp_path}/quarantine/l1_candidate/carts/ds={DAY1}").collect()
    assert [(r.cart_id, r.quantity, r.test_name) for r in out] == [(1, 0, "positive")]
    load_gated(lake, "carts", DAY1, batch(spark, (1, 0, DAY1)), positive(), gate=False)
    assert content(spark, table) == [(1, 0, DAY1)]


@pytest.mark.parametrize("lost", ["before the commit", "after the commit", "between the partitions"])
def test_a_lost_driver_leaves_the_table_before_or_after(spark, monkeypatch, lost):
    table = fresh_table(spark, "carts")
    put(spark, table, batch(spark, (1, 1, DAY1), (2, 2, DAY2)))
    before, after = content(spark, table), [(10, 10, DAY1), (20, 20, DAY2)]
    folders = publish.stage(batch(spark, (10, 10, DAY1), (20, 20, DAY2)), table)
    point = publish._point

    def stopped(spark, table, folders, partition):
        if lost == "between the partitions":
            point(spark, table, dict([min(folders.items())]), partition)
        raise RuntimeError("lost")

    if lost != "before the commit":
        with monkeypatch.context() as m:
            m.setattr(publish, "_point", stopped)
            with pytest.raises(RuntimeError):
                publish.publish(spark, table, folders)
    spark.sql(f"DROP TABLE {table}")  # the catalogue of the lost driver is gone, the files stay
    tables.reopen_table(spark, table)
    publish.recover(spark, table)
    assert content(spark, table) == (before if lost == "before the commit" else after)


def test_other_loads_and_new_columns_go_on_with_published_days(spark):
    table = fresh_table(spark, "carts")
    put(spark, table, batch(spark, (1, 1, DAY1), (2, 2, DAY2)))
    tables.replace_partition(batch(spark, (3, 3, DAY1)), table)
    tables.upsert(batch(spark, (2, 7, DAY2)), table, ["cart_id"])
    publish.publish(spark, table, publish.stage(spark.createDataFrame([(4, 4, DAY2, "new")], "cart_id long, quantity long, ds date, note string"), table))
    spark.sql(f"DROP TABLE {table}")
    publish.recover(spark, table)
    assert content(spark, table) == [(3, 3, DAY1), (4, 4, DAY2)]
    assert [r.note for r in spark.table(table).where("cart_id = 4").collect()] == ["new"]
    folders = publish.stage(batch(spark, (5, 5, DAY1)), table)
    assert sorted(r.cart_id for r in publish.table_with(spark, table, folders).collect()) == [4, 5]


def test_rows_without_a_day_and_nothing(spark):
    table = fresh_table(spark, "carts")
    with pytest.raises(ValueError):
        publish.stage(batch(spark, (1, 1, None)), table)
    assert publish.stage(batch(spark, (1, 1, DAY1)).where("false"), table) == {}
    publish.publish(spark, table, {})
    publish.recover(spark, table)
    assert content(spark, table) == []


def test_rewrites_change_all_days_at_once(spark, monkeypatch):
    table = fresh_table(spark, "carts")
    tables.append_rows(batch(spark, (1, 1, DAY1), (2, 2, DAY1), (3, 3, DAY2)), table)
    before = content(spark, table)
    steps = []
    with monkeypatch.context() as m:
        m.setattr(publish, "_point", lambda spark, table, folders, partition: steps.append(sorted(folders)))
        tables.upsert(batch(spark, (3, 30, DAY1), (4, 40, DAY1)), table, ["cart_id"])
        assert content(spark, table) == before  # committed, but no partition was moved yet
    assert steps == [[str(DAY1), str(DAY2)]]
    spark.sql(f"DROP TABLE {table}")
    tables.reopen_table(spark, table)
    publish.recover(spark, table)
    after = [(1, 1, DAY1), (2, 2, DAY1), (3, 30, DAY1), (4, 40, DAY1)]
    assert content(spark, table) == after
    tables.delete_where(spark, table, {"quantity": 2})
    tables.append_rows(batch(spark, (5, 5, DAY2)), table)  # the emptied day takes rows again, and no old ones come back
    assert content(spark, table) == [after[0], *after[2:], (5, 5, DAY2)]
    tables.delete_where(spark, table, {"ds": DAY1})
    assert content(spark, table) == [(5, 5, DAY2)]


def test_an_overwritten_table_forgets_published_days(spark):
    table = fresh_table(spark, "carts")
    put(spark, table, batch(spark, (1, 1, DAY1), (2, 2, DAY2)))
    tables.truncate_insert(batch(spark, (3, 3, DAY2)), table)
    tables.append_rows(batch(spark, (4, 4, DAY1)), table)
    for _ in range(2):
        assert content(spark, table) == [(3, 3, DAY2), (4, 4, DAY1)]
        spark.sql(f"DROP TABLE {table}")
        publish.recover(spark, table)
