"""Small helpers shared by the corpus operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldpulse.session import checkpoint_dir, ship_package


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps scan the files instead of
    running the plan again, and a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(col: str | Column) -> Column:
    """Text as UTF-8 bytes; null is empty."""
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("binary"), F.lit(b""))


def byte_size(col: str) -> Column:
    return F.coalesce(F.octet_length(F.col(col)), F.lit(0)).cast("long")


def quoted(name: str) -> str:
    """A column name as a reference that dots don't take apart."""
    return "`" + name.replace("`", "``") + "`"


def row_of(columns: list[str]) -> Column:
    """The columns as one struct, so that their names can't clash with an operator's own."""
    return F.struct(*[F.col(quoted(c)).alias(c) for c in columns])


def row_columns(columns: list[str], row: str = "row") -> list[Column]:
    """The columns of such a struct again."""
    return [F.col(row).getField(c).alias(c) for c in columns]


def with_fields(df: DataFrame, fields: str, row: str = "row") -> StructType:
    """The schema of a column of ``df`` followed by further fields (DDL)."""
    return StructType([df.schema[row], *StructType.fromDDL(fields).fields])


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with the package shipped to the Python workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive items whose sizes add up to at most ``most`` (one item at
    least), so that working arrays stay bounded whatever the Arrow batch holds."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
