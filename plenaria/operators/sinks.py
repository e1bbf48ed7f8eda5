"""Sinks: JSON, CSV (nested columns as JSON text) and Parquet; and metrics."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections import defaultdict
from contextlib import closing
from typing import Protocol

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import ArrayType, StringType, StructField, StructType, VariantType

from . import fold

def scratch(spark: SparkSession) -> str:
    """A new folder in the one that driver and executors share; on a local master without one, a folder of our own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="plenaria-")
    return f"{root.rstrip('/')}/store-{spark.sparkContext.applicationId}-{uuid.uuid4()}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that we wrote."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Store:
    """The stored tables as Parquet folders of the declared schemas, partitioned by a hash of the key. An upsert reads and
    rewrites only the partitions that its keys fall in, by dynamic partition overwrite: what it reads stays until the write
    commits, so a failed one changes nothing. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, parts: int = 16):
        """parts: of every table, fixed with the first migrate()."""
        self.spark, self.path, self.parts = spark, path.rstrip("/"), parts

    def _there(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def migrate(self) -> None:
        """Empty tables of the declared schemas, where there are none; the number of partitions is the store's, once it has one."""
        about = f"{self.path}/_about"
        if not self._there(f"{about}/_SUCCESS"):
            self.spark.createDataFrame([(self.parts,)], "parts int").coalesce(1).write.mode("overwrite").json(about)
        self.parts = self.spark.read.schema("parts int").json(about).first().parts
        for name, schema in fold.SCHEMAS.items():
            if not self._there(f"{self.path}/{name}"):
                empty = self.spark.createDataFrame([], f"{schema}, _part int")
                empty.write.partitionBy("_part").parquet(f"{self.path}/{name}")

    def _part(self, name: str) -> Column:
        return F.pmod(F.xxhash64(*fold.TABLES[name][0]), F.lit(self.parts)).cast("int")

    def _all(self, name: str) -> DataFrame:
        return self.spark.read.schema(f"{fold.SCHEMAS[name]}, _part int").parquet(f"{self.path}/{name}")

    def read(self, name: str) -> DataFrame:
        return self._all(name).drop("_part")

    def write(self, name: str, df: DataFrame) -> None:
        """df in place of the partitions that it has rows for."""
        rows = df.select(*fold.complete(df, name)).withColumn("_part", self._part(name))
        rows.repartition("_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(f"{self.path}/{name}")

    def upsert(self, name: str, incoming: DataFrame, order: list[str], without: DataFrame | None = None) -> list[int]:
        """Folds incoming in; returns the partitions that it touched. without (sitting_url): stored rows of these sittings are
        left out, as what a broken run has left of them."""
        touched = [r[0] for r in incoming.select(self._part(name)).distinct().collect()]  # at most self.parts
        if touched:
            stored = self._all(name).filter(F.col("_part").isin(touched)).drop("_part")
            stored = stored if without is None else stored.join(without, "sitting_url", "left_anti")
            self.write(name, fold.upsert(stored, incoming, name, order))
        return sorted(touched)

    def update(self, name: str, change) -> None:
        """The table with change(table) in its place, row by row of the same keys: links, summaries, embeddings."""
        self.write(name, change(self.read(name)))


class JdbcStore:
    """The stored tables in a database: a batch goes to a staging table, by Spark's writer and over all tasks, and from there
    into the table by one MERGE on its key, with the policies of the folds. The batch's name is written in the same
    transaction, so a batch that comes again, or whose job died after the merge, changes nothing. Nested columns are JSON."""

    #: What a matched row's column becomes; t: stored, s: staged.
    MERGED = {"new": "{s}", "coalesce": "coalesce({s}, {t})", "add": "{t} + {s}", "stay": "coalesce({t}, {s})"}

    def __init__(self, spark: SparkSession, url: str, key_type: str = "VARCHAR(1000)", **options: str):
        """key_type: the database's type of text keys; options: of Spark's JDBC source."""
        self.spark, self.url, self.key_type, self.options = spark, url, key_type, options

    def _run(self, *statements: str) -> int:
        """The statements as one transaction; returns the rows that the last one changed."""
        c = self.spark._jvm.java.sql.DriverManager.getConnection(self.url)
        try:
            c.setAutoCommit(False)
            changed = 0
            for sql in statements:
                with closing(c.createStatement()) as statement:
                    changed = statement.executeUpdate(sql)
            c.commit()
            return changed
        except Exception:
            c.rollback()
            raise
        finally:
            c.close()

    def _about(self, what):
        """what(metadata) of the database."""
        c = self.spark._jvm.java.sql.DriverManager.getConnection(self.url)
        try:
            return what(c.getMetaData())
        finally:
            c.close()

    def _exists(self, table: str) -> bool:
        return self._about(lambda m: any(m.getTables(None, None, name, None).next() for name in (table, table.upper(), table.lower())))

    def _save(self, rows: DataFrame, table: str, mode: str, types: str = "") -> None:
        more = {"createTableColumnTypes": types} if types else {}
        rows.write.format("jdbc").options(url=self.url, dbtable=table, **more, **self.options).mode(mode).save()

    def _text_keys(self, name: str) -> list[str]:
        return [f.name for f in StructType.fromDDL(fold.SCHEMAS[name]) if f.name in fold.TABLES[name][0] and f.dataType == StringType()]

    def _flat(self, name: str, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "struct", "map") else F.col(f.name) for f in StructType.fromDDL(fold.SCHEMAS[name])])

    def migrate(self, *names: str) -> None:
        """Empty tables, where there are none."""
        for name in names or fold.SCHEMAS:
            if not self._exists(name):
                types = ", ".join(f"{k} {self.key_type}" for k in self._text_keys(name))
                self._save(self._flat(name, self.spark.createDataFrame([], fold.SCHEMAS[name])), name, "append", types)
        if not self._exists("batches"):
            self._run(f"CREATE TABLE batches (name {self.key_type} NOT NULL PRIMARY KEY)")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(url=self.url, dbtable=name, **self.options).load()

    def upsert(self, name: str, incoming: DataFrame, order: list[str], batch: str) -> bool:
        """Folds incoming in, unless the batch has been; returns whether it did."""
        keys, policies = fold.TABLES[name]
        mark = f"{name}/{batch}".replace("'", "''")
        if not self.read("batches").filter(F.col("name") == f"{name}/{batch}").isEmpty():
            return False
        self._save(self._flat(name, fold.upsert(None, incoming, name, order)), f"staged_{name}", "overwrite")
        # staged texts have the type that Spark gives them, which need not be comparable
        text, mark_ = self._text_keys(name), self._about(lambda m: m.getIdentifierQuoteString().strip())
        at = lambda side, c: f"{side}.{mark_}{c}{mark_}"
        staged = lambda c: f"CAST({at('s', c)} AS {self.key_type})" if c in text else at("s", c)
        on = " AND ".join(f"({at('t', k)} = {staged(k)} OR {at('t', k)} IS NULL AND {at('s', k)} IS NULL)" for k in keys)
        sets = ", ".join(f"{mark_}{c}{mark_} = {self.MERGED[p].format(s=at('s', c), t=at('t', c))}" for c, p in policies.items() if p in self.MERGED)
        columns = [*keys, *policies]
        matched = f" WHEN MATCHED THEN UPDATE SET {sets}" if sets else ""
        merge = f"MERGE INTO {name} AS t USING staged_{name} AS s ON {on}{matched} WHEN NOT MATCHED THEN INSERT ({', '.join(f'{mark_}{c}{mark_}' for c in columns)}) VALUES ({', '.join(map(staged, columns))})"
        self._run(f"INSERT INTO batches VALUES ('{mark}')", merge)
        return True


def frame(rows: DataFrame, json_col: str, schema: str | None = None, told: Observation | None = None) -> DataFrame:
    """The records of a JSON column, one object or a list of them a row, as columns of a schema (None: the one that all
    records show). Records that are no object, or have a value of another type, are dropped; told: counts them (rejected)
    and the others (decoded)."""
    kind = StructType.fromDDL(schema) if schema else inferred(rows, json_col)
    bad = "_corrupt_record"
    full = StructType([*kind.fields, StructField(bad, StringType())])
    each = F.when(F.col(json_col).rlike(r"^\s*\["), F.from_json(json_col, ArrayType(VariantType()))).otherwise(F.array(F.try_parse_json(json_col)))
    records = rows.select(F.explode(F.coalesce(each, F.array(F.lit(None).cast("variant")))).alias("v"))
    one = F.from_json(F.to_json("v"), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    out = records.select(F.when(F.schema_of_variant("v").startswith("OBJECT"), one).alias("r"))
    fits = F.col("r").isNotNull() & F.col(f"r.{bad}").isNull()
    if told:
        out = out.observe(told, F.count_if(~fits).alias("rejected"), F.count_if(fits).alias("decoded"))
    return out.filter(fits).select(*[F.col("r")[f.name].alias(f.name) for f in kind.fields])


def inferred(rows: DataFrame, json_col: str) -> StructType:
    """The schema of all records of a JSON column, by an aggregate over all rows."""
    many = F.col(json_col).rlike(r"^\s*\[")
    v = rows.select(F.when(many, F.from_json(json_col, ArrayType(VariantType()))).otherwise(F.array(F.try_parse_json(json_col))).alias("v")).select(F.explode("v").alias("v"))
    said = v.filter(F.schema_of_variant("v").startswith("OBJECT")).agg(F.schema_of_variant_agg("v")).first()[0]
    return StructType.fromDDL(re.sub(r"^OBJECT<(.*)>$", r"\1", said, flags=re.S).replace("OBJECT<", "STRUCT<")) if said and said != "OBJECT<>" else StructType([])


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path, ignoreNullFields=False)


def write_csv(df: DataFrame, path: str) -> None:
    flat = [F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "struct", "map") else F.col(f.name) for f in df.schema]
    df.select(*flat).write.csv(path, header=True, escape='"')


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    (df.write.partitionBy(*by) if by else df.write).parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


class Metrics(Protocol):
    def counter(self, name: str, value: float, **labels: str) -> None: ...
    def gauge(self, name: str, value: float, **labels: str) -> None: ...
    def flush(self) -> None: ...


class NoMetrics:
    def counter(self, name, value, **labels):
        pass

    gauge = counter

    def flush(self):
        pass


class TextMetrics:
    """Counters add, gauges keep the last value; flush hands the text exposition to push, whose failure only warns."""

    def __init__(self, push):
        self.push, self.counters, self.gauges = push, defaultdict(float), {}

    def counter(self, name, value, **labels):
        self.counters[name, tuple(sorted(labels.items()))] += value

    def gauge(self, name, value, **labels):
        self.gauges[name, tuple(sorted(labels.items()))] = value

    def text(self) -> str:
        show = lambda k, v: f"{k[0]}{{{','.join(f'{a}="{b}"' for a, b in k[1])}}} {v:g}" if k[1] else f"{k[0]} {v:g}"
        out, typed = [], set()
        for kind, values in (("counter", self.counters), ("gauge", self.gauges)):
            for k, v in sorted(values.items()):
                if k[0] not in typed:
                    out.append(f"# TYPE {k[0]} {kind}")
                    typed.add(k[0])
                out.append(show(k, v))
        return "\n".join(out) + "\n"

    def flush(self):
        import warnings

        try:
            self.push(self.text())
        except Exception as e:  # noqa: BLE001
            warnings.warn(f"metrics were not pushed: {e}", stacklevel=2)


def rollup(samples: DataFrame) -> DataFrame:
    """name, labels: counter (sum) and gauge (last by ts) of samples (name, labels, kind, value, ts)."""
    return samples.groupBy("name", "labels").agg(F.sum(F.when(F.col("kind") == "counter", F.col("value"))).alias("counter"), F.max_by("value", F.when(F.col("kind") == "gauge", F.col("ts"))).alias("gauge"))


def counted(told: Observation) -> dict[str, int]:
    """What an observation of a finished job counted; empty if its rows were optimised away, as there were none."""
    try:
        return {k: v or 0 for k, v in told.get.items()}
    except Py4JJavaError:
        return {}


def report(told: Observation, metrics: Metrics, prefix: str, **labels: str) -> None:
    """Hands what an observation counted in the tasks of a finished job to metrics, as counters."""
    for name, value in counted(told).items():
        metrics.counter(f"{prefix}_{name}", value, **labels)


class StreamMetrics(StreamingQueryListener):
    """Reports each micro-batch: rows read, its duration, and the observed metrics of its plan."""

    def __init__(self, metrics: Metrics, prefix: str = "stream"):
        self.metrics, self.prefix = metrics, prefix

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.metrics.counter(f"{self.prefix}_rows", p.numInputRows, query=p.name or str(p.id))
        self.metrics.gauge(f"{self.prefix}_batch_seconds", p.batchDuration / 1000, query=p.name or str(p.id))
        for values in p.observedMetrics.values():
            for name, value in values.asDict().items():
                self.metrics.counter(f"{self.prefix}_{name}", value or 0, query=p.name or str(p.id))
        self.metrics.flush()

    def onQueryTerminated(self, event):
        pass
