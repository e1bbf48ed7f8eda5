"""Incremental ingestion (an extension): a stream of sittings folded into stored tables, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import fold
from ..operators.sinks import remove


def fold_stream(source: DataFrame, table: str, order: list[str], read: Callable[[], DataFrame | None], swap: Callable[[DataFrame, str], None], checkpoint: str) -> StreamingQuery:
    """Each micro-batch: read the stored table, fold the batch in, hand the result and the batch's name to swap, which
    publishes it atomically and ignores a name it has seen (so a retried batch is folded once). A name holds the
    stream's id from its checkpoint folder: another folder is another stream, whose batches count."""

    def one(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.read.schema("id string").json(f"{checkpoint}/metadata").first().id
        swap(fold.upsert(read(), batch, table, order), f"{stream}-{number}")

    return source.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class VersionedTable:
    """A Parquet table as numbered folders (number, then the batch's name); the highest complete one is the table. The one
    before stays for its readers, older ones are removed. Works on any store Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[tuple[int, str]]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not self.fs.exists(p):
            return []
        names = [s.getPath().getName().partition("-") for s in self.fs.listStatus(p)]
        return sorted((int(n), batch) for n, _, batch in names if n.isdigit() and self.fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}-{batch}/_SUCCESS")))

    def read(self) -> DataFrame | None:
        v = self.versions()
        return self.spark.read.parquet(f"{self.path}/{v[-1][0]}-{v[-1][1]}") if v else None

    def swap(self, df: DataFrame, batch: str) -> None:
        there = self.versions()
        if batch in [name for _, name in there]:
            return
        df.write.mode("overwrite").parquet(f"{self.path}/{there[-1][0] + 1 if there else 0}-{batch}")
        for n, name in there[:-1]:
            remove(self.spark, f"{self.path}/{n}-{name}")
