"""Days that become visible after their tests only, and all days of a change together.

A batch is written to a folder of its own beside the table, where no reader of the table sees it, and tested there. To
publish it, one row for each day is appended to the table's commits in a single write, and then each day's partition is
pointed to its folder, which moves no data. The commit decides: before it, a failed test or a lost driver leaves the table
as it was; after it, :func:`recover` (which opening a lake calls) points the partitions to what was committed. One writer
at a time is assumed, as for all loads.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.functions.paths import quoted
from martworks.sources import tables

# ``columns``: schema of the table when the day was published, as JSON.
_COMMITS = "commit bigint, day string, location string, columns string"


def versions_folder(spark: SparkSession, table: str) -> str:
    """Folder of the table's unpublished and published versions: beside that of the table, so no scan of it lists them."""
    return f"{tables.table_location(spark, table)}__versions"


def commits(spark: SparkSession, table: str) -> DataFrame:
    """``commit, day, location, columns`` of all that was ever published; no rows if nothing was."""
    try:
        return spark.read.schema(_COMMITS).parquet(f"{versions_folder(spark, table)}/commits")
    except AnalysisException:  # nothing was published yet
        return spark.createDataFrame([], _COMMITS)


def published(spark: SparkSession, table: str) -> dict[str, str]:
    """The folder of each day that was published, by the last commit that names it."""
    rows = commits(spark, table).groupBy("day").agg(F.max_by("location", "commit").alias("location")).collect()
    return {r.day: r.location for r in rows}


def stage(batch: DataFrame, table: str, partition: str = tables.PARTITION, many_days: bool = False) -> dict[str, str]:
    """Write the days of a batch to new folders; nothing of it can be seen in the table. Returns the folder of each day.

    The table is created, and gets the batch's new columns, which rows of other days read as null. Rows without a day raise.
    ``many_days`` gathers the rows by day first, in one shuffle.
    """
    spark = batch.sparkSession
    tables.sync_table(spark, table, batch, partition)
    base = f"{versions_folder(spark, table)}/v-{uuid.uuid4().hex}"
    rows = tables.aligned(batch, table)
    (tables.by_day(rows, partition) if many_days else rows).write.partitionBy(partition).parquet(base)
    written = spark.read.schema(rows.schema).parquet(base).select(quoted(partition)).distinct()
    days = [r[0] for r in written.collect()]  # partitions, a list the catalog holds anyway
    if None in days:
        raise ValueError(f"rows without {partition} cannot be published by day")
    return {str(day): f"{base}/{partition}={day}" for day in days}


def empty(spark: SparkSession, table: str, days: Iterable[dt.date], partition: str = tables.PARTITION) -> dict[str, str]:
    """Folders for days without rows. They need not exist: a partition of no folder has no rows, and inserts create it."""
    base = f"{versions_folder(spark, table)}/v-{uuid.uuid4().hex}"
    return {str(day): f"{base}/{partition}={day}" for day in days}


def staged_rows(spark: SparkSession, table: str, folders: Mapping[str, str], partition: str = tables.PARTITION) -> DataFrame:
    """The rows of staged days with the table's columns."""
    schema = spark.table(table).schema
    if not folders:
        return spark.table(table).where(F.lit(False))
    base = next(iter(folders.values())).rpartition("/")[0]  # the days of one call of stage
    return spark.read.schema(schema).option("basePath", base).parquet(*folders.values()).select(*map(quoted, schema.names))


def table_with(spark: SparkSession, table: str, folders: Mapping[str, str], partition: str = tables.PARTITION) -> DataFrame:
    """The table as it will be once the staged days are published."""
    others = spark.table(table).where(~F.coalesce(quoted(partition).isin([dt.date.fromisoformat(d) for d in folders]), F.lit(False)))
    return others.unionByName(staged_rows(spark, table, folders, partition))


def publish(spark: SparkSession, table: str, folders: Mapping[str, str], partition: str = tables.PARTITION) -> None:
    """Make staged days visible: one commit for all of them, then the partitions."""
    if not folders:
        return
    last = commits(spark, table).agg(F.max("commit")).first()[0] or 0
    columns = spark.table(table).schema.json()
    rows = [(last + 1, day, folder, columns) for day, folder in sorted(folders.items())]
    spark.createDataFrame(rows, _COMMITS).coalesce(1).write.mode("append").parquet(f"{versions_folder(spark, table)}/commits")
    _point(spark, table, folders, partition)


def _point(spark: SparkSession, table: str, folders: Mapping[str, str], partition: str) -> None:
    name, column = tables.sql_name(table), tables.sql_name(partition)
    new = " ".join(f"PARTITION ({column} = '{day}') LOCATION '{folder}'" for day, folder in sorted(folders.items()))
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {new}")
    for day, folder in sorted(folders.items()):
        spark.sql(f"ALTER TABLE {name} PARTITION ({column} = '{day}') SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def recover(spark: SparkSession, table: str, partition: str = tables.PARTITION) -> None:
    """Point the partitions of a table to what was committed; a change that was not committed is forgotten.

    A catalogue that ends with its session, and a driver lost between a commit and its partitions, are mended by this.
    """
    last = commits(spark, table).agg(F.max_by("columns", "commit")).first()[0]
    if last is not None:
        columns = T.StructType.fromJson(json.loads(last))
        tables.sync_table(spark, table, spark.createDataFrame([], columns), partition)
        _point(spark, table, published(spark, table), partition)


def replace_all(df: DataFrame, table: str, partition: str = tables.PARTITION, many_days: bool = False) -> None:
    """Make the days of ``df`` the whole table, by one commit."""
    spark = df.sparkSession
    folders = stage(df, table, partition, many_days)
    days = [r.partition.partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {tables.sql_name(table)}").collect()]
    publish(spark, table, empty(spark, table, days, partition) | folders, partition)
