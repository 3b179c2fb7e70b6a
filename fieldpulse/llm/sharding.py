"""Two-pass external shuffle into shards.

Pass 1 scatters records into buckets by a seeded hash of the whole record and of how many equal records
its task has had before, so that a record repeated a million times doesn't fill one bucket. There are as
many buckets as make one fit into a task's memory (``bucket_bytes``). Pass 2 brings one bucket at a time into
memory, puts it into the order of its hashes (so the result does not depend on the order of arrival),
shuffles it by Fisher-Yates with a generator seeded by the bucket and writes it. The buckets one after
the other are a uniform order of all records; a record's rank in it deals it to shard ``rank mod n``
and slot ``rank div n``, so shards differ by one record at most (law ``rows``).

Only one number a bucket reaches the driver (its row count, for the ranks).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm._common import map_batches, quoted, row_of, scratch_path, with_fields

N_SHARDS = 8
BUCKET_BYTES = 64 << 20
SEED = 8
#: Equal records of one task that share a bucket.
TOGETHER = 8


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniform order of ``n`` records (numpy's permutation is the Fisher-Yates shuffle)."""
    return np.random.Generator(np.random.PCG64([seed, bucket])).permutation(n)


def _shuffle_batches(offsets, n_shards: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = offsets.value
        held: list[pa.RecordBatch] = []

        def emit():
            bucket = held[0].column("bucket")[0].as_py()
            table = pa.Table.from_batches(held)
            table = table.take(pa.array(fisher_yates(table.num_rows, seed, bucket)))
            rank = first[bucket] + np.arange(table.num_rows, dtype=np.int64)
            out = pa.table([table.column("row"), pa.array((rank % n_shards).astype(np.int32)), pa.array(rank // n_shards)],
                           names=["row", "shard", "slot"])
            yield from out.to_batches(max_chunksize=4096)

        for batch in batches:
            ids = batch.column("bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b == a:
                    continue
                if held and held[-1].column("bucket")[0].as_py() != ids[a]:
                    yield from emit()
                    held.clear()
                held.append(batch.slice(a, b - a))
        if held:
            yield from emit()
    return run


def _row_bytes(docs: DataFrame) -> Column:
    """About the bytes of a record: texts and binaries as they are, nested columns as JSON, others 16."""
    out = F.lit(64)
    for f in docs.schema.fields:
        c, kind = F.col(quoted(f.name)), f.dataType.typeName()
        if kind in ("string", "binary", "varchar", "char"):
            out = out + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind in ("struct", "array", "map"):
            out = out + F.coalesce(F.octet_length(F.to_json(F.struct(c.alias("c")))), F.lit(0))
        else:
            out = out + 16
    return out.cast("long")


def _number_batches(seed: int):
    """Adds the bucket hash: of the record alone for the first few that a task meets, then of the record, the task
    and how many equal records it has met. Equal records are interchangeable, so a task run again in another
    order of rows scatters the same."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, int] = {}
        for b in batches:
            hashes, task = b.column("_h").to_pylist(), b.column("task")[0].as_py() if b.num_rows else 0
            at = np.array(hashes, np.int64)
            for i, h in enumerate(hashes):
                n = met[h] = met.get(h, -1) + 1
                if n >= TOGETHER:
                    at[i] = xxhash.xxh3_64_intdigest(f"{seed}:{h}:{task}:{n // TOGETHER}".encode()) - (1 << 63)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("_h"), pa.array(at)], names=["row", "_h", "at"])
    return run


def scatter(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> tuple[DataFrame, int]:
    """Rows as ``row`` with their hash ``_h`` and ``bucket``, and the number of buckets."""
    total = docs.agg(F.sum(_row_bytes(docs))).first()[0] or 0
    n = max(1, -(-int(total) // bucket_bytes))
    rows = docs.select(row_of(docs.columns).alias("row"), F.xxhash64(F.lit(seed), *[F.col(quoted(c)) for c in docs.columns]).alias("_h"), F.spark_partition_id().alias("task"))
    rows = map_batches(rows, _number_batches(seed), with_fields(rows, "_h long, at long"))
    return rows.withColumn("bucket", F.pmod("at", F.lit(n)).cast("int")).drop("at"), n


def shuffle_to_shards(docs: DataFrame, path: str, n_shards: int = N_SHARDS, bucket_bytes: int = BUCKET_BYTES,
                      seed: int = SEED) -> DataFrame:
    """Write ``docs`` to ``path`` as ``shard=k`` folders of ``(row struct, slot)`` and read them back.

    Every row is written once, whole, with all its columns (in ``row``, so names can't clash with
    ``shard`` and ``slot``). Equal rows are separate records. Null or empty texts count no bytes. An
    empty table makes no shard. The order depends on the rows, the seed and the bucket size alone, but for
    records that a task has many of: those also on the tasks.
    """
    spark = docs.sparkSession
    rows, n = scatter(docs, bucket_bytes, seed)
    counts = {r["bucket"]: r["count"] for r in rows.groupBy("bucket").count().collect()}
    sizes = np.array([counts.get(k, 0) for k in range(n)], np.int64)
    offsets = spark.sparkContext.broadcast(np.concatenate(([0], np.cumsum(sizes)[:-1])))
    dealt = rows.repartitionById(n, "bucket").sortWithinPartitions("bucket", "_h").select("row", "bucket")
    out = map_batches(dealt, _shuffle_batches(offsets, n_shards, seed), with_fields(rows, "shard int, slot long"))
    out.write.partitionBy("shard").parquet(path)
    return spark.read.schema(with_fields(rows, "slot long, shard int")).parquet(path)


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = shuffle_to_shards(docs, scratch_path(spark, "shards"))
    text = F.coalesce(F.col("row.text").cast("binary"), F.lit(b""))
    return got.select("row.doc_id", (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                      F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
