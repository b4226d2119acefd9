"""Raw layer: JSON records and ``{meta, data}`` envelopes, keyed by resource and batch day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.functions.paths import quoted
from martworks.functions.scalars import parse_ds
from martworks.session import FILE_RECORDS, TABLE_CODEC, TEXT_CODEC

META_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("fetched_at", T.StringType()),
    T.StructField("count", T.LongType()),
])


def object_path(layer: str, resource: str, ds: str | dt.date, suffix: str) -> str:
    """Path of a landed object: ``<layer>/<resource>/YYYY/MM/DD/<resource>_<ds>.<suffix>``."""
    day = parse_ds(ds)
    return f"{layer}/{resource}/{day:%Y/%m/%d}/{resource}_{day}.{suffix}"


def day_path(root: str, layer: str, resource: str, ds: str | dt.date) -> str:
    """Folder of one batch day in a partitioned dataset."""
    return f"{root}/{layer}/{resource}/ds={parse_ds(ds)}"


CORRUPT = "_corrupt_record"


def read_json(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None, lines: bool = True,
    lenient: bool = False,
) -> DataFrame:
    """Records of JSON lines, or of envelopes; without ``schema`` Spark infers one, at the price of another pass.

    ``lines=False`` reads one document per file. Such a file is one task's work, so keep it to what one fetch
    returned; volume belongs in JSON lines, which split. A line that cannot be read as the schema says fails the read;
    with ``lenient`` (and a schema) the values that cannot are null and the column ``_corrupt_record`` holds the line.
    """
    reader = spark.read.option("mode", "PERMISSIVE" if lenient else "FAILFAST").option("multiLine", not lines)
    if schema is not None:
        # An envelope carries the records in `data` beside `meta`; a bare document is itself the one record.
        own = {name.lower() for name in schema.names}
        extra = [T.StructField("data", T.ArrayType(schema)), T.StructField("meta", T.StringType())]
        fields = [*(f for f in extra if f.name not in own), *schema.fields]
        if lenient:
            fields.append(T.StructField(CORRUPT, T.StringType()))
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        reader = reader.schema(T.StructType(fields))
    return unwrap(reader.json(path))


def malformed(records: DataFrame) -> DataFrame:
    """Lines of a lenient read of which nothing could be read."""
    nothing = reduce(and_, (quoted(c).isNull() for c in records.columns if c != CORRUPT))
    return records.where(quoted(CORRUPT).isNotNull() & nothing).select(CORRUPT)


def readable(records: DataFrame) -> DataFrame:
    """Records of a lenient read without the malformed lines."""
    nothing = reduce(and_, (quoted(c).isNull() for c in records.columns if c != CORRUPT))
    return records.where(~(quoted(CORRUPT).isNotNull() & nothing)).drop(CORRUPT)


def unwrap(df: DataFrame) -> DataFrame:
    """Records of an envelope: ``data`` where it is present, else the document itself, even if all its fields are null.

    A document with ``meta`` and without ``data`` is an envelope that carries no record.
    """
    if "data" not in df.columns or not isinstance(df.schema["data"].dataType, T.ArrayType):
        return df
    records = quoted("data")
    element = df.schema["data"].dataType.elementType
    if not isinstance(element, T.StructType):
        return df
    if all(name in df.columns for name in element.names):
        own = [quoted(name) for name in element.names]
        single = F.array(F.struct(*(c.alias(n) for c, n in zip(own, element.names))).cast(element))
        bare = quoted("meta").isNull() if "meta" in df.columns and "meta" not in element.names else F.lit(True)
        records = F.coalesce(records, F.when(bare, single))
    kept = [quoted(CORRUPT)] if CORRUPT in df.columns else []
    return df.select(F.explode(records).alias("record"), *kept).select("record.*", *kept)


def write_raw(
    records: DataFrame, root: str, resource: str, ds: str | dt.date, source: str, fetched_at: dt.datetime | None = None
) -> int:
    """Land records as compressed JSON lines under their day, and one meta row (source, fetched_at, count) beside them.

    The count is observed in the writing job itself, so the records are computed once.
    """
    spark = records.sparkSession
    seen = Observation("records")
    counted = records.observe(seen, F.count(F.lit(1)).alias("count"))
    writer = counted.write.mode("overwrite").options(compression=TEXT_CODEC, maxRecordsPerFile=FILE_RECORDS)
    writer.json(day_path(root, "raw", resource, ds))
    count = seen.get["count"]
    stamp = (fetched_at or dt.datetime.now(dt.timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    meta = spark.createDataFrame([(source, stamp, count)], META_SCHEMA)
    meta.coalesce(1).write.mode("overwrite").json(day_path(root, "raw_meta", resource, ds))
    return count


def read_raw(
    spark: SparkSession, root: str, resource: str, ds: str | dt.date, schema: T.StructType, lenient: bool = False
) -> DataFrame:
    return read_json(spark, day_path(root, "raw", resource, ds), schema, lenient=lenient)


def read_meta(spark: SparkSession, root: str, resource: str, ds: str | dt.date) -> DataFrame:
    return spark.read.schema(META_SCHEMA).json(day_path(root, "raw_meta", resource, ds))


def write_staging(df: DataFrame, root: str, resource: str) -> None:
    """Staging Parquet by day. Only the days in ``df`` are replaced; the write needs no shuffle."""
    (
        df.write.mode("overwrite")
        .options(partitionOverwriteMode="dynamic", compression=TABLE_CODEC)
        .partitionBy("ds")
        .parquet(f"{root}/staging/{resource}")
    )


def write_staging_day(df: DataFrame, root: str, resource: str, ds: str | dt.date) -> None:
    """Staging Parquet of one day, replaced as a whole, so a day landed again without records is empty afterwards."""
    df.drop("ds").write.mode("overwrite").option("compression", TABLE_CODEC).parquet(day_path(root, "staging", resource, ds))


def read_staging(
    spark: SparkSession, root: str, resource: str, ds: str | dt.date, schema: T.StructType | None = None
) -> DataFrame:
    """One day of staging, opened by its folder, so no other day is listed.

    A day that was never written has no rows if the ``schema`` is given, else the read fails.
    """
    reader = spark.read.option("basePath", f"{root}/staging/{resource}").option("ignoreMissingFiles", True)
    if schema is not None:
        reader = reader.schema(schema)
    frame = reader.parquet(day_path(root, "staging", resource, ds))
    return frame.withColumn("ds", quoted("ds").cast("date"))
