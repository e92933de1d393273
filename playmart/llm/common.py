"""Helpers the operators share: Arrow passes that carry whole rows, tables in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.session import shared_dir

# A side is broadcast only when counted and found to have no more rows than this (8-40 bytes each).
BROADCAST_ROWS = 200_000


def annotate(docs: DataFrame, inputs: list[Column], make: Callable, outputs: str, carry: list[str] | None = None,
             part: int | None = None) -> DataFrame:
    """One pass of Python over Arrow batches that keeps every row whole.

    Returns the columns `row` (a struct of all of `docs`' columns, or of those in `carry`, passed
    through untouched, so that no output can clash with them) and `outputs`. `make()` is called once per task and gives a
    function from the inputs' Arrow arrays to one list or array per output. With `part` it is given that many rows
    at most at once, so that no more outputs are held.
    """
    src = docs.select(F.struct(*(carry or ["*"])).alias("row"), *[c.alias(f"_{i}") for i, c in enumerate(inputs)])
    out = T.StructType.fromDDL(outputs)
    schema = T.StructType([src.schema["row"], *out.fields])
    names = ["row", *out.names]
    kinds = [_arrow(f.dataType) for f in out.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for whole in batches:
            work = work or make()
            for at in range(0, max(1, len(whole)), part or max(1, len(whole))):
                batch = whole.slice(at, part)
                made = work(*[batch.column(i) for i in range(1, batch.num_columns)])
                cols = [pa.array(m, type=k) for m, k in zip(made, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=names)

    return src.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


class Stored(NamedTuple):
    """Rows written to the shared folder, and where they lie."""

    rows: DataFrame
    path: str

    def drop(self) -> None:
        """Remove the files; only for tables whose readers have all ended."""
        spark = self.rows.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_scratch: dict[str, list[Stored]] = {}


def stored(df: DataFrame, name: str, compression: str = "snappy") -> Stored:
    """Write `df` as Parquet under the cluster's checkpoint folder and read it back.

    This cuts the lineage: a lost executor re-reads the files, which every node can reach.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    made = Stored(spark.read.schema(df.schema).parquet(path), path)
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(made)
    return made


def clear_scratch(spark: SparkSession) -> None:
    """Remove every table this session stored; call it once the results have been written."""
    for made in _scratch.pop(spark.sparkContext.applicationId, []):
        made.drop()


def join_counted(df: DataFrame, side: DataFrame, on: str | list[str], how: str, rows: int) -> DataFrame:
    """Join a side whose rows have been counted: broadcast up to BROADCAST_ROWS, shuffled beyond."""
    return df.join(F.broadcast(side) if rows <= BROADCAST_ROWS else side, on, how)
