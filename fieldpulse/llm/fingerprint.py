"""Document fingerprints by locally consistent parsing.

A text's bytes are parsed into phrases, the phrases' names into longer phrases, and so on. Where a
phrase begins is decided by deterministic coin tossing: each symbol gets a short label from the lowest
bit in which it differs from its left neighbour, a few rounds of which leave six labels, and phrases
begin at the labels' local maxima. A cut depends on a handful of neighbours only, so equal
substrings are cut alike and share the names of their interior phrases at every level, wherever they
stand. Runs of one symbol are named as a whole first, since coin tossing needs unlike neighbours.

The fingerprint is a one-permutation sketch of the phrase names from ``FIRST_LEVEL`` up: ``BINS`` bins,
in each the least name that falls into it (16 bits of it). Likeness is the share of equal bins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm._common import byte_size, map_batches, slices

BINS, FIRST_LEVEL = 64, 2
CHUNK_BYTES = 1 << 20
PART_BYTES, MAX_PARTS = 32 << 20, 10_000

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _toss_table() -> np.ndarray:
    """Label of a byte by its left neighbour: twice the place of the lowest bit in which they differ,
    plus the byte's own bit there."""
    y, left = np.arange(256, dtype=np.uint8)[:, None], np.arange(256, dtype=np.uint8)[None, :]
    d = y ^ left
    low = np.minimum(np.bitwise_count((d & (~d + np.uint8(1))) - np.uint8(1)), 7).astype(np.uint8)
    return (2 * low + ((y >> low) & 1)).astype(np.uint8).reshape(-1)


_TOSS = _toss_table()
_EIGHT = np.uint16(8)


def _left(y: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Left neighbours; a text's first symbol gets one that differs in its lowest bit."""
    out = np.empty_like(y)
    out[1:] = y[:-1]
    out[first] = y[first] ^ y.dtype.type(1)
    return out


def _labels(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 0 to 5, unlike between neighbours. ``first``: where texts begin."""
    if x.dtype == np.uint8:
        y, rounds = x, 3  # 256 symbols -> 16 -> 8 -> 6 labels
    else:
        d = x ^ _left(x, first)
        low = np.minimum(np.bitwise_count((d & (~d + _U(1))) - _U(1)), 63)
        y, rounds = (2 * low + ((x >> low.astype(_U)) & _U(1)).astype(np.uint8)).astype(np.uint8), 3  # 128 -> 14 -> 8 -> 6
    for _ in range(rounds):
        y = _TOSS[(y.astype(np.uint16) << _EIGHT) | _left(y, first)]
    return y


def next_level(x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of each text and where texts begin among them. ``x``: bytes or names."""
    begin = np.empty(len(x), bool)
    begin[0] = True
    np.not_equal(x[1:], x[:-1], out=begin[1:])
    begin[first] = True
    runs = None
    if not begin.all():  # a run of one symbol becomes one symbol
        at = np.flatnonzero(begin)
        runs = np.diff(at, append=len(x))
        x, first = x[at], np.searchsorted(at, first)
    y = _labels(x, first)
    cut = np.zeros(len(x), bool)
    if len(x) > 2:
        np.greater(y[1:-1], y[:-2], out=cut[1:-1])
        cut[1:-1] &= y[1:-1] > y[2:]
    cut[np.append(first[1:], len(x)) - 1] = False  # neighbours beyond a text's ends don't count
    cut[first] = True
    names = x.astype(_U) + _U(1) if x.dtype == np.uint8 else x
    if runs is not None:
        long = np.flatnonzero(runs > 1)
        names = names.copy()
        names[long] = _mix(names[long] + runs[long].astype(_U) * _ODD)
    at = np.flatnonzero(cut)
    n = np.diff(at, append=len(x))
    total, k, which = n.astype(_U) * _ODD, 0, None
    while True:  # a phrase has a dozen symbols at most
        if which is None:
            total = (total ^ names[at]) * _ODD
        else:
            part = total[which]
            total[which] = ((part ^ (part >> _U(29))) ^ names[at[which] + k]) * _ODD
        k += 1
        which = np.flatnonzero(n > k)
        if not len(which):
            return _mix(total), np.searchsorted(at, first)


def sketches(texts: list[bytes], bins: int = BINS, first_level: int = FIRST_LEVEL) -> np.ndarray:
    """A row of ``bins`` numbers a text: 0 for a bin without names. An empty text has none at all."""
    out = np.zeros((len(texts), bins), np.uint16)
    full = [i for i, t in enumerate(texts) if t]
    if not full:
        return out
    sizes = np.array([len(texts[i]) for i in full])
    x = np.frombuffer(b"".join(texts[i] for i in full), np.uint8)
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    doc = np.arange(len(full))
    width = int(bins).bit_length() - 1
    seen, level = [], 0
    while len(first):
        x, first = next_level(x, first)
        level += 1
        n = np.diff(np.concatenate((first, [len(x)])))
        over = n == 1
        owner = np.repeat(doc, n)
        used = np.ones(len(x), bool) if level >= first_level else np.repeat(over, n)
        h = _mix(x[used] + _U(level * int(_ODD) % (1 << 64)))
        seen.append((owner[used].astype(_U) << _U(width) | (h & _U(bins - 1))) << _U(44) | (h >> _U(20)))
        if over.any():  # texts that have come down to one phrase are done
            keep = np.repeat(~over, n)
            x, doc, n = x[keep], doc[~over], n[~over]
            first = np.concatenate(([0], np.cumsum(n)[:-1])).astype(np.int64) if len(n) else n
    names = np.sort(np.concatenate(seen))
    slot = (names >> _U(44)).astype(np.int64)
    least = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
    value = (_mix(names[least] & _U((1 << 44) - 1)) % _U(65535)).astype(np.uint16) + np.uint16(1)
    rows = np.zeros((len(full), bins), np.uint16)
    rows.reshape(-1)[slot[least]] = value
    out[full] = rows
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bins among those that either has; 1 for two texts without names."""
    some = ((a > 0) | (b > 0)).sum(axis=-1)
    same = ((a == b) & (a > 0)).sum(axis=-1)
    return np.where(some > 0, same / np.maximum(some, 1), 1.0)


def as_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u2").tobytes().hex()


def all_sketches(texts: list[bytes]) -> np.ndarray:
    """Sketches in chunks of bounded size (the owner's number has 14 bits, so 16,000 texts at most)."""
    parts = [sketches(texts[a:b]) for a, b in slices([max(len(t), CHUNK_BYTES // 8192) for t in texts], CHUNK_BYTES)]
    return np.concatenate(parts) if parts else np.zeros((0, BINS), np.uint16)


# ---- Spark ---------------------------------------------------------------------------------------

def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` for every row, in one pass without a shuffle. Null text is empty; an
    empty text's fingerprint is all zeros; equal texts have equal fingerprints."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = all_sketches([(t or "").encode() for t in b.column("_text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(map(as_text, s), pa.string())], names=["doc_id", "fingerprint"])
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("_text")), run,
                       "doc_id long, fingerprint string")


def with_next(docs: DataFrame, part_bytes: int = PART_BYTES) -> tuple[DataFrame, int]:
    """Rows dealt to ranges of doc_id, descending, so that the next document of a row is the next row
    of its range. Each range also gets the first row of the range after it (``tail``; the last range
    that of the first), so no range waits for another and texts move once.

    A null doc_id comes after all others; rows with one doc_id follow by the hash of their text.
    The driver gets one doc_id a range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("_text"))
    total = rows.agg(F.sum(byte_size("_text") + 64)).first()[0] or 0
    parts = int(min(max(1, -(-int(total) // part_bytes)), MAX_PARTS))
    cuts = sorted({int(q) for q in rows.filter("doc_id is not null").approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.1 / parts)},
                  reverse=True) if parts > 1 else []
    part = F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(
        F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<bigint>"), lambda c: F.col("doc_id") < c))) if cuts else F.lit(0)
    rows = rows.withColumn("part", part.cast("int"))
    firsts = sorted((r["part"], r["first"]) for r in rows.groupBy("part").agg(F.max("doc_id").alias("first")).collect())
    table = spark.createDataFrame([(p, f, firsts[k - 1][0]) for k, (p, f) in enumerate(firsts)], "part int, first long, to int")
    rows = rows.join(F.broadcast(table), "part")  # at most MAX_PARTS rows
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("tail"))
    extra = F.struct(F.col("to").alias("part"), F.lit(1).alias("tail"))
    at = F.when(F.col("doc_id").eqNullSafe(F.col("first")), F.array(own, extra)).otherwise(F.array(own))
    return rows.select("doc_id", "_text", F.xxhash64("_text").alias("_h"), F.explode(at).alias("at")).select(
        "doc_id", "_text", "_h", "at.part", "at.tail"), len(cuts) + 1


def _edit(text: str, following: str) -> str:
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def _compare(rows: list[tuple], following: str) -> pa.RecordBatch:
    texts = [t for _, t in rows] + [following]
    edited = [_edit(t, f).encode() for t, f in zip(texts[:-1], texts[1:])]
    s, e = all_sketches([t.encode() for t in texts]), all_sketches(edited)
    own = s[:-1]
    return pa.RecordBatch.from_arrays(
        [pa.array([d for d, _ in rows], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
         pa.array([hashlib.sha256(x).hexdigest() for x in edited], pa.string()), pa.array(map(as_text, own), pa.string()),
         pa.array(map(as_text, e), pa.string()), pa.array(likeness(own, e)), pa.array(likeness(own, s[1:]))],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _next_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size, part = 0, None
    for b in batches:
        for doc_id, text, p, tail in zip(*(b.column(c).to_pylist() for c in ("doc_id", "_text", "part", "tail"))):
            text = text or ""
            if tail:
                if held:
                    yield _compare(held, text)
                    held, size = [], 0
                continue
            if held and size > CHUNK_BYTES:
                yield _compare(held, text)
                held, size = [], 0
            held.append((doc_id, text))
            size += len(text)
    if held:
        raise RuntimeError("a range ended without the row that follows it")


def edited_fingerprints(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """For every row: fingerprints of its text and of its text with the last third replaced by the
    start of the next document (descending doc_id; after the last, the first), and the likeness of the
    first to the second and to the next document's. Null text is empty. One row is its own next."""
    rows, n = with_next(docs, part_bytes)
    rows = rows.repartitionById(n, "part").sortWithinPartitions("part", "tail", F.col("doc_id").desc_nulls_last(), "_h")
    return map_batches(rows, _next_batches, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                       "edited_fingerprint string, near_edited double, near_next double")


def op9_fingerprint(spark, sf_dir: str) -> DataFrame:
    return edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
