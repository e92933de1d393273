"""A partitioned table that is refreshed partition by partition, with every refresh a version of its own.

A refresh writes the partitions it touches, whole, under its own number and then an index that says
for every partition which number holds it. Nothing that an earlier version reads is overwritten, so a
refresh that fails half way, or is repeated, leaves the version before it as it was. The cost of a
refresh follows the partitions it touches; no refresh lists or reads the others.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder Spark files a null under


class Generations:
    """`schema`: all columns, `keys`: the partition columns among them (strings).

    A null or empty key is filed under null.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        inner = [f for f in schema.fields if f.name not in self.keys]
        self.columns = schema.names
        self.schema = T.StructType([*inner, *[T.StructField(k, T.StringType()) for k in self.keys]])
        self.index_schema = T.StructType([*[T.StructField(k, T.StringType()) for k in self.keys], T.StructField("gen", T.LongType())])

    def index(self, version: int) -> DataFrame:
        """Every partition of a version and the refresh that wrote it; version -1 has none."""
        if version < 0:
            return self.spark.createDataFrame([], self.index_schema)
        return self.spark.read.schema(self.index_schema).parquet(f"{self.path}/index/version={version}")

    def _folder(self, row: Row) -> str:
        parts = [f"{k}={NULL_FOLDER if row[k] in (None, '') else quote(row[k], safe=' ')}" for k in self.keys]
        return "/".join([self.path, "data", f"gen={row['gen']}", *parts])

    def _rows(self, held: list[Row]) -> DataFrame:
        if not held:
            return self.spark.createDataFrame([], self.schema).select(*self.columns)
        reader = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*map(self._folder, held)).select(*self.columns)

    def read(self, version: int) -> DataFrame:
        return self._rows(self.index(version).collect())

    def read_touched(self, version: int, touched: DataFrame) -> DataFrame:
        """The partitions of a version that `touched` (the key columns) names; one listed path for each."""
        index = self.index(version)
        on = [index[k].eqNullSafe(F.nullif(touched[k], F.lit(""))) for k in self.keys]
        return self._rows(index.join(touched, on, "left_semi").collect())

    def commit(self, version: int, rows: DataFrame) -> None:
        """Version `version`: the partitions of `rows` replaced, all others as in the version before."""
        target = f"{self.path}/data/gen={version}"
        # rows of one partition meet in few files, and a large partition is split over tasks
        rows.hint("rebalance", *self.keys).write.mode("overwrite").partitionBy(*self.keys).parquet(target)
        new = self.spark.read.schema(self.schema).parquet(target).select(*self.keys).distinct().withColumn("gen", F.lit(version))
        before = self.index(version - 1)
        kept = before.join(new, [before[k].eqNullSafe(new[k]) for k in self.keys], "left_anti")
        kept.union(new.select(kept.columns)).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/index/version={version}")

    def latest(self) -> int:
        """The newest version whose index is complete; -1 if there is none."""
        found = [int(p.getPath().getName().partition("=")[2]) for p in self._list("index")
                 if self._fs().exists(self._hadoop(f"{p.getPath()}/_SUCCESS"))]
        return max(found, default=-1)

    def vacuum(self, version: int) -> int:
        """Remove what version `version` and later ones no longer read; how many folders went.

        Only for a time when nobody reads an earlier version.
        """
        used = {r.gen for r in self.index(version).select("gen").distinct().collect()}
        gone = 0
        for what, old in (("data", lambda n: n not in used), ("index", lambda n: True)):
            for p in self._list(what):
                n = int(p.getPath().getName().partition("=")[2])
                if n < version and old(n):
                    self._fs().delete(p.getPath(), True)
                    gone += 1
        return gone

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._hadoop(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _list(self, what: str) -> list:
        folder = self._hadoop(f"{self.path}/{what}")
        return [p for p in self._fs().listStatus(folder) if "=" in p.getPath().getName()] if self._fs().exists(folder) else []
