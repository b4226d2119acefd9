"""A key index beside a table: which keys its days hold, and how often.

An index is a table of its own with one row for each key and day (``__n`` rows of the table), bucketed and sorted by the key
and partitioned by the day. Matching a batch, testing that keys are unique over all days and testing references read the
index alone: no wide column, no row of a day that did not change, and no shuffle of the stored side, since its buckets
already are the partitions that the join or the group wants. Two indexes with equally many buckets are joined without any
shuffle.

The index follows the table by days. Days that are about to change are noted beside the index first and struck off once they
are counted again, so after a lost driver :meth:`KeyIndex.open` counts just the days that are noted, new or gone. All loads
of an indexed table go through :func:`load`, :func:`load_unique` or :func:`upsert`; one writer at a time is assumed, as for
all loads. Rows with a null in the key are not in the index, and rows without a day are refused.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import ExitStack, contextmanager
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.functions.paths import quoted
from martworks.session import setting
from martworks.sources import tables

COUNT = "__n"
_CHANGES = "change bigint, day string, counted boolean"


class KeyIndex:
    """Index of ``table`` by ``keys``, in so many ``buckets``: about one for each 100 million keys of a day, or more."""

    def __init__(self, spark: SparkSession, table: str, keys: Sequence[str], buckets: int = 64,
                 partition: str = tables.PARTITION):
        self.spark, self.table, self.keys, self.buckets, self.partition = spark, table, list(keys), buckets, partition
        self.name = f"{table}__by_{re.sub(r'\W', '_', '_'.join(keys)).lower()}_{buckets}"

    def open(self) -> KeyIndex:
        """Create the index, or reopen what an earlier process left, and count the days that are not counted yet."""
        if not tables.table_exists(self.spark, self.name):
            columns = ", ".join(map(tables.sql_name, self.keys))
            schema = self.spark.table(self.table).schema
            typed = ", ".join(f"{tables.sql_name(k)} {schema[k].dataType.simpleString()}" for k in self.keys)
            day = tables.sql_name(self.partition)
            self.spark.sql(
                f"CREATE TABLE {tables.sql_name(self.name)} ({typed}, {COUNT} bigint, {day} date) USING parquet "
                f"PARTITIONED BY ({day}) CLUSTERED BY ({columns}) SORTED BY ({columns}) INTO {self.buckets} BUCKETS "
                f"LOCATION '{tables.table_location(self.spark, self.name)}'")
            if not self._changes().where("counted").isEmpty():  # an earlier process has written days
                self.spark.sql(f"ALTER TABLE {tables.sql_name(self.name)} RECOVER PARTITIONS")
        self.count_days(self.open_days())
        return self

    def rows(self) -> DataFrame:
        """The keys, the day and ``__n``: how many rows of that day have the key."""
        return self.spark.table(self.name).where(F.col(COUNT) > 0)

    # -- following the table -------------------------------------------------------------------------------------------

    @property
    def _changes_folder(self) -> str:
        return f"{tables.table_location(self.spark, self.name)}__changes"

    def _changes(self) -> DataFrame:
        try:
            return self.spark.read.schema(_CHANGES).parquet(self._changes_folder)
        except AnalysisException:  # nothing has changed yet
            return self.spark.createDataFrame([], _CHANGES)

    def _note(self, days: Iterable[dt.date], counted: bool) -> None:
        last = self._changes().agg(F.max("change")).first()[0] or 0
        rows = [(last + 1, str(day), counted) for day in days]
        self.spark.createDataFrame(rows, _CHANGES).coalesce(1).write.mode("append").parquet(self._changes_folder)

    def open_days(self) -> list[dt.date]:
        """Days that were noted and not counted since, and days that only the table or only the index has."""
        noted = self._changes().groupBy("day").agg(F.max_by("counted", "change").alias("counted"))
        days = {row.day for row in noted.where("not counted").collect()}
        days |= self._partitions(self.table) ^ self._partitions(self.name)
        return sorted(map(dt.date.fromisoformat, days))

    def _partitions(self, table: str) -> set[str]:
        found = self.spark.sql(f"SHOW PARTITIONS {tables.sql_name(table)}").collect()
        return {row.partition.partition("=")[2] for row in found} - {"__HIVE_DEFAULT_PARTITION__"}

    def count_days(self, days: Sequence[dt.date]) -> None:
        """Count these days of the table again, in one job. Only the key columns of these days are read."""
        if not days:
            return
        keys, day = [quoted(k) for k in self.keys], quoted(self.partition)
        whole = reduce(and_, (k.isNotNull() for k in keys))
        counted = (self.spark.table(self.table).where(tables._within(self.partition, days)).where(whole)
                   .groupBy(*keys, day).agg(F.count("*").alias(COUNT)))
        schema = self.spark.table(self.name).schema
        # A row without a key for each day, so that a day without rows is replaced too.
        marks = self.spark.createDataFrame([(d,) for d in days], f"`{self.partition}` date").select(
            *(F.lit(None).cast(schema[k].dataType).alias(k) for k in self.keys), F.lit(0).cast("long").alias(COUNT), day)
        rows = counted.select(*keys, COUNT, day).unionByName(marks).repartition(self.buckets, *keys)
        with setting(self.spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            rows.write.insertInto(self.name, overwrite=True)
        self._note(days, True)

    @contextmanager
    def changing(self, days: Sequence[dt.date]) -> Iterator[None]:
        """These days change within the block and are counted after it, or when the index is opened again."""
        self._note(days, False)
        yield
        self.count_days(days)

    # -- tests that read the index alone -------------------------------------------------------------------------------

    def repeated(self) -> DataFrame:
        """Keys that the whole table holds more than once, and how often: ``n_records``."""
        sizes = self.rows().groupBy(*map(quoted, self.keys)).agg(F.sum(COUNT).alias("n_records"))
        return sizes.where("n_records > 1")

    def orphans(self, parent: KeyIndex) -> DataFrame:
        """Keys that ``parent`` lacks, and how many rows have them: ``n_records``. Keys correspond by position."""
        own = self.rows().groupBy(*map(quoted, self.keys)).agg(F.sum(COUNT).alias("n_records"))
        known = parent.rows().select(*(quoted(k).alias(f"__parent_{i}") for i, k in enumerate(parent.keys)))
        return own.join(known, [quoted(k) == F.col(f"__parent_{i}") for i, k in enumerate(self.keys)], "left_anti")

    def matched(self, batch: DataFrame) -> DataFrame:
        """Stored keys that occur in the batch, with their days."""
        wanted = batch.select(*map(quoted, self.keys))
        return self.rows().join(wanted, self.keys, "left_semi").select(*map(quoted, [*self.keys, self.partition]))

    def conflicts(self, batch: DataFrame, replacing: bool = True) -> DataFrame:
        """Keys of a batch that are stored already: the keys, the batch's day and ``stored_<day>``.

        With ``replacing`` the days of the batch are about to be replaced, so keys stored on these are none, and the
        index of these days is not read.
        """
        day = quoted(self.partition)
        stored = self.rows().select(*map(quoted, self.keys), day.alias(f"stored_{self.partition}"))
        if replacing:
            stored = stored.where(~tables._within(f"stored_{self.partition}", _days_of(batch, self.partition)))
        both = batch.select(*map(quoted, [*self.keys, self.partition])).join(stored, self.keys)
        return both.select(*map(quoted, self.keys), day, f"stored_{self.partition}")


def _days_of(batch: DataFrame, partition: str) -> list[dt.date]:
    days = tables._days(batch, partition)
    if None in days:
        raise ValueError(f"rows without {partition} cannot be indexed")
    return days


def _fit(batch: DataFrame, table: str) -> DataFrame:
    """The batch spelled and typed as the table's columns, which get those that are new."""
    tables.sync_table(batch.sparkSession, table, batch)
    schema = batch.sparkSession.table(table).schema
    return tables.typed_as(tables.named_as(tables.storable(batch), schema.names), schema)


def load(batch: DataFrame, indexes: Sequence[KeyIndex],
         mode: Callable[[DataFrame, str], None] = tables.replace_partition) -> None:
    """Load a batch into the table of the ``indexes`` by a load mode that changes no other days than the batch's."""
    days = _days_of(batch, indexes[0].partition)
    if not days:
        return
    with ExitStack() as stack:
        for index in indexes:
            stack.enter_context(index.changing(days))
        mode(batch, indexes[0].table)


def load_unique(batch: DataFrame, index: KeyIndex, also: Sequence[KeyIndex] = ()) -> None:
    """Replace the batch's days unless the table would then hold a key twice: :class:`tables.DuplicateKeys`.

    The batch is tested by itself and against the keys of all other days; only the batch is shuffled.
    """
    with tables.staged(_fit(batch, index.table), "unique") as rows:
        tables.check_unique(rows, index.keys)
        if not index.conflicts(rows).isEmpty():
            raise tables.DuplicateKeys(f"keys of {index.keys} are stored on other days")
        load(rows, [index, *also])


def upsert(batch: DataFrame, index: KeyIndex, also: Sequence[KeyIndex] = ()) -> None:
    """:func:`tables.upsert` by the keys of ``index``: matched keys and their days are read from the index."""
    with tables.staged(_fit(batch, index.table), "upsert") as rows, tables.staged(index.matched(rows), "matched") as found:
        days = sorted({*tables._days(found, index.partition), *_days_of(rows, index.partition)})
        if not days:
            return
        with ExitStack() as stack:
            for each in (index, *also):
                stack.enter_context(each.changing(days))
            tables.upsert(rows, index.table, index.keys, index.partition, found)
