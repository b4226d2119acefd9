"""Lake tables: partitioned Parquet tables in the Spark catalog, with additive schema evolution.

Loads are append, truncate-and-insert, replace-partition, delete-where and upsert. Rewrites of existing rows first land
in the shared scratch folder, so no path is read while it is overwritten, and they touch only the day partitions that
hold affected rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager, nullcontext
from functools import reduce
from operator import and_
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.functions.paths import is_nested, quoted
from martworks.session import TABLE_CODEC, scratch_dir, setting

PARTITION = "ds"


class DuplicateKeys(ValueError):
    """A batch holds the same upsert key more than once."""


def sql_name(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


# -- catalog -----------------------------------------------------------------------------------------------------------

def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {sql_name(name)}{at}")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def table_columns(spark: SparkSession, table: str) -> list[str]:
    return spark.table(table).columns


def storage_type(dtype: T.DataType) -> T.DataType:
    """Table type of a frame type: whole numbers are bigint, fractions double, times without zone, the rest text."""
    if isinstance(dtype, (T.BooleanType, T.DecimalType, T.DateType, T.StringType)):
        return dtype
    if isinstance(dtype, T.IntegralType):
        return T.LongType()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return T.TimestampNTZType()
    if is_nested(dtype):
        raise TypeError(f"flatten or explode a {dtype.simpleString()} before storing it")
    return T.StringType()


def storable(df: DataFrame) -> DataFrame:
    """Frame with table types; NaN is stored as null."""
    changed = {}
    for field in df.schema.fields:
        target = storage_type(field.dataType)
        if isinstance(target, T.DoubleType):
            changed[field.name] = F.nanvl(quoted(field.name).cast(target), F.lit(None).cast(target))
        elif target != field.dataType:
            changed[field.name] = quoted(field.name).cast(target)
    return df.withColumns(changed) if changed else df


def typed_as(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Frame whose columns have the types they have in ``schema``."""
    changed = {
        f.name: quoted(f.name).cast(schema[f.name].dataType)
        for f in df.schema.fields
        if f.dataType != schema[f.name].dataType
    }
    return df.withColumns(changed) if changed else df


def named_as(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Frame whose columns are spelled as in ``names`` where they differ in case only."""
    spelled = {name.lower(): name for name in names}
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) < len(lowered):
        raise ValueError(f"columns differ in case only: {sorted(c for c in df.columns if lowered.count(c.lower()) > 1)}")
    wanted = [spelled.get(c.lower(), c) for c in df.columns]
    return df if wanted == df.columns else df.toDF(*wanted)


def table_location(spark: SparkSession, table: str) -> str:
    """Folder of a table: below that of its database."""
    database, _, name = table.rpartition(".")
    base = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{base.rstrip('/')}/{name}"


def reopen_table(spark: SparkSession, table: str, partition_by: str | None = PARTITION) -> bool:
    """Make a table known that an earlier process left in its folder; False if there is nothing to reopen.

    A catalogue that lives in the session forgets its tables, their files stay. Columns are those of all files together,
    and the partitions are those of the folder.
    """
    if table_exists(spark, table):
        return True
    location = table_location(spark, table)
    try:
        schema = spark.read.option("mergeSchema", True).parquet(location).schema
    except AnalysisException:  # no such folder, or no file in it
        return False
    partitioned = partition_by in schema.names
    columns = ", ".join(f"{sql_name(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({sql_name(partition_by)})" if partitioned else ""
    spark.sql(f"CREATE TABLE {sql_name(table)} ({columns}) USING parquet{parts} LOCATION '{location}'")
    if partitioned:
        spark.sql(f"ALTER TABLE {sql_name(table)} RECOVER PARTITIONS")
    return True


def sync_table(spark: SparkSession, table: str, df: DataFrame, partition_by: str | None = PARTITION) -> None:
    """Create the table from the frame, or add the frame's new columns. Columns are never dropped or retyped.

    A table whose files an earlier process left is reopened first.
    """
    named_as(df, ())
    reopen_table(spark, table, partition_by)
    fields = {f.name: storage_type(f.dataType).simpleString() for f in df.schema.fields}
    if not table_exists(spark, table):
        columns = ", ".join(f"{sql_name(name)} {dtype}" for name, dtype in fields.items())
        parts = f" PARTITIONED BY ({sql_name(partition_by)})" if partition_by in fields else ""
        spark.sql(f"CREATE TABLE {sql_name(table)} ({columns}) USING parquet OPTIONS (compression '{TABLE_CODEC}'){parts} "
                  f"LOCATION '{table_location(spark, table)}'")
        return
    known = {name.lower() for name in table_columns(spark, table)}
    new = [f"{sql_name(name)} {dtype}" for name, dtype in fields.items() if name.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {sql_name(table)} ADD COLUMNS ({', '.join(new)})")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def read_sql(spark: SparkSession, text: str, **parameters: Any) -> DataFrame:
    """Rows of a query over the catalog's tables and views; ``:name`` marks a parameter."""
    return spark.sql(text, args=parameters)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize_table(
    df: DataFrame, table: str, partition_by: str | None = None, many_days: bool = False
) -> DataFrame:
    """Full rebuild of a mart; ``many_days`` gathers the rows by partition, which one batch does not need."""
    rows = by_day(df, partition_by) if partition_by and many_days else df
    writer = rows.write.mode("overwrite").format("parquet").options(
        path=table_location(df.sparkSession, table), compression=TABLE_CODEC)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


# -- inserts -----------------------------------------------------------------------------------------------------------

def aligned(df: DataFrame, table: str) -> DataFrame:
    """Frame in the table's column order and types; columns it lacks are null."""
    schema = df.sparkSession.table(table).schema
    ready = named_as(storable(df), schema.names)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in ready.columns}
    full = ready.withColumns(missing) if missing else ready
    return typed_as(full, schema).select(*map(quoted, schema.names))


def _insert(df: DataFrame, table: str, overwrite: str | None = None) -> None:
    mode = overwrite or "static"
    with setting(df.sparkSession, "spark.sql.sources.partitionOverwriteMode", mode):
        aligned(df, table).write.insertInto(table, overwrite=overwrite is not None)


def by_day(df: DataFrame, partition: str = PARTITION) -> DataFrame:
    """Rows of a day brought together for writing. AQE splits a big day over tasks and merges small ones."""
    return df.hint("rebalance", partition)


def append_rows(df: DataFrame, table: str, partition_by: str | None = PARTITION) -> None:
    sync_table(df.sparkSession, table, df, partition_by)
    _insert(df, table)


def truncate_insert(
    df: DataFrame, table: str, partition_by: str | None = PARTITION, many_days: bool = False
) -> None:
    """Replace all rows; an empty batch changes nothing. ``many_days`` gathers the rows by day first, in one shuffle."""
    if df.isEmpty():
        return
    sync_table(df.sparkSession, table, df, partition_by)
    if _publish().published(df.sparkSession, table):  # its days lie in folders that an overwrite would not clear
        _publish().replace_all(df, table, partition_by, many_days)
        return
    _insert(by_day(df, partition_by) if many_days else df, table, overwrite="static")


def replace_partition(df: DataFrame, table: str, partition_by: str = PARTITION, many_days: bool = False) -> None:
    """Replace the days that occur in ``df`` and no others; an empty batch changes nothing.

    A one-day batch is written where it is, without a shuffle; ``many_days`` gathers the rows by day first.
    """
    sync_table(df.sparkSession, table, df, partition_by)
    _insert(by_day(df, partition_by) if many_days else df, table, overwrite="dynamic")


# -- rewrites ----------------------------------------------------------------------------------------------------------

def _days(df: DataFrame, partition: str) -> list[Any]:
    """Distinct days of a frame. They are the table's partitions, a list the catalog holds anyway."""
    return [row[0] for row in df.select(partition).distinct().collect()]


def _within(partition: str, days: Sequence[Any]) -> Column:
    named = quoted(partition).isin([day for day in days if day is not None])
    return named | quoted(partition).isNull() if None in days else named


@contextmanager
def staged(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """The rows written to the scratch folder and read from there; the folder is emptied when the block ends well.

    After a failure they stay, since they may be the only copy of rows that were being moved.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    yield rows
    df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)


def _clear_day(spark: SparkSession, table: str, partition: str, day: Any) -> None:
    """Empty one partition: an overwrite that names it and inserts no row."""
    value = "null" if day is None else f"'{day}'"
    rest = ", ".join(
        f"CAST(null AS {f.dataType.simpleString()})" for f in spark.table(table).schema.fields if f.name != partition
    )
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
        spark.sql(
            f"INSERT OVERWRITE TABLE {sql_name(table)} PARTITION ({sql_name(partition)} = {value}) "
            f"SELECT {rest} FROM range(0)"
        )


def _publish():
    from martworks.sources import publish  # which builds on this module

    return publish


def _rewrite(
    spark: SparkSession, table: str, rows: DataFrame, partition: str | None = None, days: Sequence[Any] = ()
) -> None:
    """Make ``rows`` the content of the given days, or of the whole table when it has no partitions.

    Days are written once, to folders of their own, and all become visible by one commit. Rows without a day, which no
    folder can be named after, and tables without partitions are staged and overwritten.
    """
    if partition is not None and None not in days:
        publish = _publish()
        folders = publish.stage(rows, table, partition, many_days=True)
        publish.publish(spark, table, publish.empty(spark, table, days, partition) | folders, partition)
        return
    with staged(rows, "rewrite") as ready:
        if partition is None:
            _insert(ready, table, overwrite="static")
            return
        left = _days(ready, partition)
        if left:
            _insert(by_day(ready, partition), table, overwrite="dynamic")
        for day in days:
            if day not in left:
                _clear_day(spark, table, partition, day)


def delete_where(spark: SparkSession, table: str, where: Mapping[str, Any]) -> None:
    """Delete the rows equal to every given value; null never matches. An empty map deletes nothing."""
    if not where:
        return
    target = spark.table(table)
    match = reduce(and_, (quoted(c) == F.lit(v).cast(target.schema[c].dataType) for c, v in where.items()))
    keep = ~F.coalesce(match, F.lit(False))
    parts = partition_columns(spark, table)
    if not parts:
        _rewrite(spark, table, target.where(keep))
        return
    days = _days(target.where(match), parts[0])
    if set(where) == {parts[0]}:  # whole days: no row has to be read or kept
        _publish().publish(spark, table, _publish().empty(spark, table, days, parts[0]), parts[0])
        return
    if days:
        _rewrite(spark, table, target.where(_within(parts[0], days)).where(keep), parts[0], days)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys without nulls that occur more than once; equal rows are merged before the shuffle."""
    present = reduce(and_, (quoted(k).isNotNull() for k in keys))
    return df.where(present).groupBy(*map(quoted, keys)).count().where(F.col("count") > 1)


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    if not duplicate_keys(df, keys).isEmpty():
        raise DuplicateKeys(f"the batch repeats a key of {list(keys)}")


def merged_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows with the batch's values where the key matches; columns the batch lacks keep theirs.

    A left join: a small batch is broadcast and the target is not shuffled, a large one is joined by key.
    Null keys match nothing and are left in place.
    """
    values = [c for c in batch.columns if c not in keys]
    if not values:
        return target
    incoming = batch.select(
        *map(quoted, keys), F.struct(*map(quoted, values)).alias("__new")
    )
    joined = target.join(incoming, list(keys), "left")
    new = F.col("__new")
    return joined.select(
        *(
            (F.when(new.isNotNull(), new.getField(c)).otherwise(quoted(c)).alias(c) if c in values else quoted(c))
            for c in target.columns
        )
    )


def new_rows(batch: DataFrame, matched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key is not among the matched ones; rows with a null key are always new."""
    return batch.join(matched.select(*map(quoted, keys)), list(keys), "left_anti")


def upsert(
    batch: DataFrame, table: str, keys: Sequence[str], partition_by: str | None = PARTITION, known: DataFrame | None = None
) -> None:
    """Insert new keys, update the others' non-key columns. A batch of keys only inserts the new ones.

    The matched keys and their days are found first, by a semi join over the key columns; only those days and the
    days of the batch are read in full and rewritten. ``known`` gives them where an index has found them already.
    """
    with staged(storable(batch), "batch") as rows:  # read several times below, computed once
        _upsert(rows, table, keys, partition_by, known)


def _upsert(
    batch: DataFrame, table: str, keys: Sequence[str], partition_by: str | None, known: DataFrame | None
) -> None:
    spark = batch.sparkSession
    check_unique(batch, keys)
    sync_table(spark, table, batch, partition_by)
    target = spark.table(table)
    batch = typed_as(named_as(batch, target.columns), target.schema)
    keys = named_as(batch.select(*map(quoted, keys)), target.columns).columns
    parts = partition_columns(spark, table)
    key_rows = batch.select(*map(quoted, keys))
    found = target.select(*map(quoted, dict.fromkeys([*keys, *parts]))).join(key_rows, list(keys), "left_semi")
    with staged(found, "matched") if known is None else nullcontext(known) as matched:
        fresh = new_rows(batch, matched, keys)
        if len(keys) == len(batch.columns):
            _insert(fresh, table)
            return
        days = []
        if parts:
            days = set(_days(matched, parts[0]))
            if parts[0] in batch.columns:
                days.update(_days(batch, parts[0]))
            elif not fresh.isEmpty():
                days.add(None)
            target = target.where(_within(parts[0], list(days)))
        rows = merged_rows(target, batch, keys).unionByName(fresh, allowMissingColumns=True)
        _rewrite(spark, table, rows, parts[0] if parts else None, list(days))
