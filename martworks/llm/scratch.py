"""Intermediate tables in the folder that the cluster shares.

A step that several later steps read is written once as Parquet and reread, so that a lost executor costs its own tasks
only and no step is computed twice. Tables that nothing reads any more are emptied by ``drop``, or all tables of a part of
the work together by ``clear``; those that a returned frame still reads stay until the folder is cleared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martworks.session import scratch_dir, tune

# Rows and bytes that a Python task gets at once, so that long texts do not fill its memory.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def tuned(spark: SparkSession) -> SparkSession:
    """The runtime settings that the operators of this package rely on."""
    tune(spark)
    for key, value in BATCHES.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


class Scratch:
    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = tuned(spark)
        self.base = scratch_dir(spark, purpose)
        self.frames: dict[str, DataFrame] = {}

    def within(self, name: str) -> Scratch:
        """A folder below this one, for tables that are cleared together."""
        part = Scratch.__new__(Scratch)
        part.spark, part.base, part.frames = self.spark, f"{self.base}/{name}", {}
        return part

    def clear(self) -> None:
        self.spark.range(0).write.mode("overwrite").parquet(self.base)
        self.frames = {}

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.mode("overwrite").parquet(path)
        self.frames[path] = self.spark.read.schema(df.schema).parquet(path)
        return self.frames[path]

    def drop(self, *frames: DataFrame) -> None:
        for path, df in list(self.frames.items()):
            if any(df is f for f in frames):
                self.spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)
                del self.frames[path]


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the operator's own names: ``only(df, doc_id="id", text="body")``."""
    return df.select(*(df[source].alias(name) for name, source in columns.items()))
