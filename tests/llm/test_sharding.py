import numpy as np
import pytest

from fieldpulse.llm import sharding as S
from fieldpulse.llm._common import scratch_path

SCHEMA = "doc_id long, text string, shard string, slot int"


def make(spark, n=500):
    rows = [(i if i % 50 else None, None if i % 41 == 0 else "t" * (i % 97), "clash", i) for i in range(n)]
    return spark.createDataFrame(rows + rows[:20], SCHEMA)


@pytest.mark.parametrize("bucket_bytes", [1 << 20, 2_000])
def test_every_row_once_and_counts_even(spark, bucket_bytes):
    docs = make(spark)
    got = S.shuffle_to_shards(docs, scratch_path(spark, "t"), 8, bucket_bytes).collect()
    assert sorted((str(tuple(r["row"])) for r in got)) == sorted(str(tuple(r)) for r in docs.collect())
    sizes = [sum(r["shard"] == k for r in got) for k in range(8)]
    assert max(sizes) - min(sizes) <= 1
    for k in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sizes[k]))


def test_same_rows_same_order_whatever_the_partitions(spark):
    docs = make(spark)
    order = lambda df: [tuple(r["row"]) for r in sorted(S.shuffle_to_shards(df, scratch_path(spark, "t"), 8, 3_000).collect(), key=lambda r: (r["slot"], r["shard"]))]
    a, b = order(docs), order(docs.repartition(7))
    assert a == b and a != [tuple(r) for r in docs.collect()]


def test_order_is_uniform(spark):
    """Rank and input order are uncorrelated."""
    docs = spark.createDataFrame([(i, "x") for i in range(2000)], "doc_id long, text string")
    got = S.shuffle_to_shards(docs, scratch_path(spark, "t"), 1, 5_000).collect()
    r = np.corrcoef([x["row"]["doc_id"] for x in got], [x["slot"] for x in got])[0, 1]
    assert abs(r) < 0.08


def test_empty_table(spark):
    assert S.shuffle_to_shards(make(spark).limit(0), scratch_path(spark, "t")).collect() == []


def test_fisher_yates_is_a_seeded_order():
    assert sorted(S.fisher_yates(50, 1, 2)) == list(range(50))
    assert (S.fisher_yates(50, 1, 2) == S.fisher_yates(50, 1, 2)).all()
    assert (S.fisher_yates(50, 1, 2) != S.fisher_yates(50, 1, 3)).any()


def test_equal_rows_are_spread(spark):
    rows = [(1, "the same text", "s", 0)] * 500 + [(i, f"text {i}", "s", i) for i in range(2, 501)]
    docs = spark.createDataFrame(rows, SCHEMA)
    scattered, n = S.scatter(docs, 3_000)
    sizes = [r["count"] for r in scattered.groupBy("bucket").count().collect()]
    assert n > 20 and max(sizes) < 4 * S.TOGETHER + 2 * len(rows) / n
    got = S.shuffle_to_shards(docs, scratch_path(spark, "t"), 8, 3_000).collect()
    assert sorted(str(tuple(r["row"])) for r in got) == sorted(str(r) for r in rows)


def test_wide_columns_count_for_buckets(spark):
    docs = spark.createDataFrame([(i, "x", "w" * 1000, [1, 2], {"k": "v" * 500}) for i in range(50)],
                                 "doc_id long, text string, `wide.column` string, a array<int>, s struct<k:string>")
    scattered, n = S.scatter(docs, 10_000)
    assert n >= 7
    got = S.shuffle_to_shards(docs, scratch_path(spark, "t"), 4, 10_000)
    assert got.select("row.*").columns == docs.columns and got.count() == 50


def test_against_a_plain_scatter_and_shuffle(spark):
    """Buckets by the same hashes, shuffled one by one in plain Python."""
    docs = make(spark, 120)
    scattered, n = S.scatter(docs, 2_000)
    buckets = {}
    for r in scattered.collect():
        buckets.setdefault(r["bucket"], []).append((r["_h"], tuple(r["row"])))
    order = []
    for b in sorted(buckets):
        rows = sorted(buckets[b], key=lambda r: r[0])
        swapped = [rows[i] for i in np.random.Generator(np.random.PCG64([S.SEED, b])).permutation(len(rows))]
        order += [r for _, r in swapped]
    got = S.shuffle_to_shards(docs, scratch_path(spark, "t"), 8, 2_000).collect()
    assert [tuple(r["row"]) for r in sorted(got, key=lambda r: (r["slot"], r["shard"]))] == order
