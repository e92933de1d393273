"""Type-2 history kept as a store that new observations are merged into, in any order of arrival.

Observations lie in chunks of their clock (months). For every (key, chunk) the store also holds what a
reader of the history needs of it: the observations that differ from the one before them inside the
chunk, the first one always, and the signature the chunk ends with. A merge reads and rewrites the
chunks that new observations fall into and no others; versions are then stitched from these summaries,
a first observation counting only if it differs from the end of its key's chunk before. The result
equals `version_starts` over all observations, however they were split and in whatever order they came.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from playmart.operators.ordered import split_scan
from playmart.sources.generations import Generations

CHUNK = "chunk"


@dataclass(frozen=True)
class VersionStore:
    """`schema` of the observations; (key, order) names one, and `order[0]`, a timestamp, is its clock."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    order: Sequence[str]
    signature: str

    def _observations(self) -> Generations:
        chunked = T.StructType([*self.schema.fields, T.StructField(CHUNK, T.StringType())])
        return Generations(self.spark, f"{self.path}/observations", chunked, [CHUNK])

    def _starts(self) -> Generations:
        kind = self.schema[self.signature].dataType
        fields = [*self.schema.fields, T.StructField("is_first", T.BooleanType()), T.StructField("chunk_end", kind),
                  T.StructField(CHUNK, T.StringType())]
        return Generations(self.spark, f"{self.path}/starts", T.StructType(fields), [CHUNK])

    def merge(self, observations: DataFrame, version: int) -> None:
        """Make version `version` from the one before; an observation that is known already changes nothing."""
        held, starts = self._observations(), self._starts()
        new = observations.withColumn(CHUNK, F.date_format(self.order[0], "yyyy-MM")).select(*held.columns)
        touched = new.select(CHUNK).distinct()
        rows = held.read_touched(version - 1, touched).union(new).dropDuplicates([self.key, *self.order])
        held.commit(version, rows)
        whole = held.read_touched(version, touched)
        within = Window.partitionBy(CHUNK, self.key).orderBy(*self.order)
        last = within.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        before, now = F.col("__before"), F.col(self.signature)
        summary = (
            whole.withColumns({
                "__before": F.lag(self.signature).over(within), "is_first": F.row_number().over(within) == 1,
                "chunk_end": F.last(self.signature).over(last)})
            .filter(F.col("is_first") | before.isNull() | (before != now)).drop("__before")
        )
        starts.commit(version, summary.select(*starts.columns))

    def versions(self, version: int, keys: DataFrame | None = None) -> DataFrame:
        """The observations that open a version, as `version_starts` numbers and spans them; of some keys if asked."""
        starts = self._starts().read(version)
        if keys is not None:
            starts = starts.join(keys.select(self.key), self.key, "left_semi")
        by_chunk = Window.partitionBy(self.key).orderBy(CHUNK)  # one row a chunk
        firsts = starts.filter("is_first").withColumn("__before", F.lag("chunk_end").over(by_chunk))
        opened = firsts.filter(F.col("__before").isNull() | (F.col("__before") != F.col(self.signature))).drop("__before")
        rows = opened.union(starts.filter("not is_first")).drop("is_first", "chunk_end")
        spans = split_scan(rows, [self.key], list(self.order), F.col(CHUNK), lead={"valid_to": self.order[0]}, row_number="version_number")
        return spans.withColumn("valid_from", F.col(self.order[0])).drop(CHUNK)

    def refreshed(self, table: DataFrame, touched: DataFrame, version: int) -> DataFrame:
        """The version table after a merge: rows of keys it touched made anew, all others as they are."""
        new = self.versions(version, touched)
        return table.join(touched.select(self.key), self.key, "left_anti").unionByName(new)
