"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these six ASCII white-space characters.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
#: Rows in an Arrow batch: whole texts travel, so batches stay small however long the texts are.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: spark.checkpoint.dir. Where it is unset a local master gets a folder of its own
    (tests); a cluster gets an error. Sessions that keep Spark's Arrow batch size get a smaller one."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="plenaria-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Materialises df in the shared folder and cuts its lineage, so that lost executors cost no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Narrow rows (pairs, ids) that are read by one task.
GATHERED_ROWS = 20_000


def gathered(df: DataFrame, rows: int = GATHERED_ROWS) -> DataFrame:
    """cut, for narrow rows: read in as few partitions as `rows` rows each need, so that a few rows do not cost a task and
    three files for each shuffle partition whenever they are used."""
    told = Observation()
    out = cut(df.observe(told, F.count(F.lit(1)).alias("n")))
    return out.coalesce(max(1, -(-told.get.get("n", 0) // rows)))


def stored(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: like cut, for rows with texts (compressed, read by column)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/stored-{spark.sparkContext.applicationId}-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that we wrote."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def fresh(columns: list[str], name: str) -> str:
    """name, with underscores before it until it clashes with none of columns (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Rows of two 64-bit numbers that may be broadcast: 32 MB.
BROADCAST_ROWS = 2_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df (materialised, narrow) marked for broadcast if it has at most `rows` rows; else left to a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def words(text: Column) -> Column:
    """All words of a text (null: none), in order."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), rf"[{SPACE}]+"), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body names it (also inside lambdas)."""
    return F.transform(F.array(value), body)[0]


def pieces(batches: Iterator, limit: int = 8 << 20) -> Iterator:
    """Slices of Arrow batches whose texts (a column named text) hold about limit bytes, or one row."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if batch.num_rows > start:
            yield batch.slice(start)


def encoded(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column; null: empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def pick(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, renamed: other columns, whatever their names, cannot clash."""
    return docs.select(*[docs[f"`{c}`"].alias(name) for name, c in columns.items()])
