"""Publication: new paths only, a manifest last, accepted and rejected rows apart."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file that wasn't there, as a whole: written aside, then renamed, which fails where the name is taken.
    False if it was. The file system must rename without overwriting, as HDFS does."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    where, fs = _path(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(where), gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        raise
    return True


class CommitLog:
    """A table that grows by whole commits. Each writer has a folder of its own below `data`; a commit is one small file
    below `log`, which names that folder and is there as a whole or not at all. Readers read the folders that the log
    names: what a writer that died left behind is never seen, and of two writers of one commit the first is.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> dict[str, dict]:
        """What the log says, by the names of its commits."""
        where, fs = _path(self.spark, f"{self.path}/log")
        if not fs.exists(where):
            return {}
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        out = {}
        for name in sorted(n for n in names if n.endswith(".json")):
            read = fs.open(_path(self.spark, f"{self.path}/log/{name}")[0])
            try:
                out[name.removesuffix(".json")] = json.loads(bytes(read.readAllBytes()))
            finally:
                read.close()
        return out

    def has(self, name: str) -> bool:
        where, fs = _path(self.spark, f"{self.path}/log/{name}.json")
        return fs.exists(where)

    def append(self, df: DataFrame, name: str, report: dict | None = None) -> bool:
        """Commit the rows of df as `name`; False, and nothing changes, if that commit is there already."""
        if self.has(name):
            return False
        folder = f"data/{name}-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").option("compression", "zstd").parquet(f"{self.path}/{folder}")
        text = json.dumps({"folder": folder, "report": report or {}}, sort_keys=True, separators=(",", ":"), allow_nan=False)
        if _put_new(self.spark, f"{self.path}/log/{name}.json", text):
            return True
        where, fs = _path(self.spark, f"{self.path}/{folder}")
        fs.delete(where, True)
        return False

    def read(self, schema: T.StructType | str) -> DataFrame:
        """The rows of all commits; an empty table if there are none."""
        folders = [f"{self.path}/{e['folder']}" for e in self.entries().values()]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def orphans(self) -> list[str]:
        """Folders that no commit names: of writers that died, or are still at work."""
        where, fs = _path(self.spark, f"{self.path}/data")
        known = {e["folder"] for e in self.entries().values()}
        return sorted(x for s in (fs.listStatus(where) if fs.exists(where) else []) if (x := f"data/{s.getPath().getName()}") not in known)


def publish(tables: dict[str, DataFrame], path: str, report: dict) -> None:
    """Write tables below path, which must not exist, and the report last: a folder without report.json is not complete.
    The first writer to put its claim there publishes; a rival stops before it has written anything."""
    spark = next(iter(tables.values())).sparkSession
    where, fs = _path(spark, path)
    if fs.exists(where) or not _put_new(spark, f"{path}/claim.json", json.dumps({"writer": uuid.uuid4().hex})):
        raise FileExistsError(path)
    for name, df in tables.items():
        df.write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/{name}")
    text = json.dumps(report, sort_keys=True, separators=(",", ":"), allow_nan=False)
    out = fs.create(_path(spark, f"{path}/report.json")[0], False)
    out.write(bytearray(text.encode()))
    out.close()


def is_complete(spark: SparkSession, path: str) -> bool:
    where, fs = _path(spark, f"{path}/report.json")
    return fs.exists(where)


def partitioned_by_verdict(df: DataFrame, path: str, accepted: Column) -> None:
    """Accepted and rejected rows in one pass, each in its own partition; an unknown verdict is a rejection."""
    df.withColumn("accepted", F.coalesce(accepted, F.lit(False))).write.partitionBy("accepted").mode("errorifexists").option("compression", "zstd").parquet(path)


def json_lines(df: DataFrame, path: str) -> None:
    """Rows as JSON below a new path; a number of a column that isn't finite stops the write."""
    for f in df.schema:
        if isinstance(f.dataType, T.FractionalType) and not isinstance(f.dataType, T.DecimalType):
            c = F.col(f"`{f.name}`")
            bad = F.isnan(c) | (F.abs(c) == float("inf"))
            df = df.withColumn(f.name, F.when(bad, F.raise_error(F.lit(f"{f.name} is not finite"))).otherwise(c))
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def identified(df: DataFrame, identity: dict[str, str]) -> DataFrame:
    """df with the identity in the metadata of each column, which Parquet keeps in every file's footer."""
    return df.select(*(F.col(f"`{c}`").alias(c, metadata=identity) for c in df.columns))


def tensor_batches(df: DataFrame, columns: list[str], size: int, order: str) -> DataFrame:
    """batch, and the columns' values as arrays, of each `size` rows in order within the partitions of a range sort."""
    from pyspark.sql import Window

    at = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    rows = df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()).withColumn("_batch", F.floor(at / size))
    return rows.groupBy("_part", "_batch").agg(F.array_sort(F.collect_list(F.struct(order, *columns))).alias("rows")).select(F.struct("_part", "_batch").alias("batch"), *(F.col(f"rows.{c}").alias(c) for c in columns))
