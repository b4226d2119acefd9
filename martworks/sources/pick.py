"""Pick one landed object out of several candidate folders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.functions.scalars import parse_ds


def candidate_prefixes(root: str, layer: str, resource: str, ds: str | dt.date, feed: str) -> list[str]:
    """Folders to try, in order: the dated layer folder, then the feed's ``ds=`` folder."""
    day = parse_ds(ds)
    return [f"{root}/{layer}/{resource}/{day:%Y/%m/%d}", f"{root}/{feed}/{resource}/ds={day}"]


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def list_objects(spark: SparkSession, prefix: str, suffix: str) -> DataFrame | None:
    """Paths below a folder that end in ``suffix``; ``None`` when there is no such folder. No content is read."""
    if not folder_exists(spark, prefix):
        return None
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .load(prefix)
        .select("path")
    )


def pick_source(spark: SparkSession, prefixes: Sequence[str], suffix: str, ds: str | dt.date) -> str | None:
    """First folder with a match wins; in it, names holding ``_<ds>`` come first, then path order."""
    token = f"_{parse_ds(ds)}"
    for prefix in prefixes:
        found = list_objects(spark, prefix, suffix)
        if found is None:
            continue
        name = F.substring_index("path", prefix.split(":")[-1], -1)
        best = found.orderBy(~F.contains(name, F.lit(token)), "path").first()
        if best is not None:
            return best["path"]
    return None
