"""Benchmark decontamination as a prefix-filtered set join.

A benchmark window is ``window`` consecutive words of an item (a shorter item is one window). As a
set, it consists of its ``SHINGLE``-word shingles. Shingles are ordered by rarity, counted over the
whole corpus. A text can only contain a window if it contains every shingle of it, so the necessary
prefix of a window at containment 1 is a single shingle: its rarest. The join goes over these prefix
shingles alone. For each match, the place of the shingle in the window fixes where the window must
start in the text (positional bound) and the text must have room for it (length bound); what remains
is verified word by word over a stretch of the window's own size.

Words never meet as strings in the join: the benchmark's words get numbers, and a text is turned into
those numbers (unknown words: none), so a shingle is a single integer.

The windows are a stated query set: they go to all rows in blocks. A block is cut by the driver so
that it holds at most ``block_words`` benchmark words, which bounds what is collected and broadcast;
a benchmark of any size makes more blocks, each with its own pass, whose hits are merged per row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm._common import map_batches, row_columns, row_of, staged, utf8, with_fields

WINDOW, SHINGLE = 13, 3
BLOCK_WORDS = 1_000_000
NUM, DEN = 1, 20  # contaminated: hit words are at least this share of all

#: A-Z to a-z; ASCII other than letters and digits to space; other bytes belong to words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class Windows:
    """A block of distinct benchmark windows."""

    vocab: dict  # word -> number, from 0
    words: np.ndarray  # (windows, window) word numbers, -1 beyond a short window's end
    size: np.ndarray  # words in each
    items: list  # of each window: the items it occurs in
    shingles: np.ndarray  # sorted distinct shingle codes of all windows
    prefix: np.ndarray | None = None  # sorted prefix codes, one a window
    prefix_window: np.ndarray | None = None
    prefix_at: np.ndarray | None = None


def shingle_codes(ids: np.ndarray, base: int) -> np.ndarray:
    """Codes of the shingles at every position; -1 where a word is unknown. Texts shorter than a
    shingle have none: their windows are looked up by the single words."""
    n = len(ids) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    a, b, c = ids[:n], ids[1:n + 1], ids[2:n + 2]
    return np.where((a < 0) | (b < 0) | (c < 0), -1, ((a + 1) * base + b + 1) * base + c + 1)


def _base(w: Windows) -> int:
    return len(w.vocab) + 1


def _codes_of_window(w: Windows, k: int) -> np.ndarray:
    """A window's elements: its shingles, or its words if it has too few for one."""
    ids = w.words[k, :w.size[k]]
    return shingle_codes(ids, _base(w)) if len(ids) >= SHINGLE else ids + 1


def make_windows(items: list[tuple], window: int = WINDOW) -> Windows:
    vocab: dict = {}
    found: dict = {}
    for item, text in items:
        ids = [vocab.setdefault(x, len(vocab)) for x in words_of(text)]
        for s in range(max(1, len(ids) - window + 1) if ids else 0):
            found.setdefault(tuple(ids[s:s + window]), set()).add(item)
    words = np.full((len(found), window), -1, np.int64)
    size = np.zeros(len(found), np.int64)
    for k, key in enumerate(found):
        size[k] = len(key)
        words[k, :len(key)] = key
    w = Windows(vocab, words, size, [sorted(x, key=str) for x in found.values()], np.zeros(0, np.int64))
    codes = [_codes_of_window(w, k) for k in range(len(found))]
    w.shingles = np.unique(np.concatenate(codes)) if codes else np.zeros(0, np.int64)
    return w


def choose_prefixes(w: Windows, counts: dict) -> Windows:
    """The rarest element of each window by corpus count (ties: the smaller code, the first place)."""
    best, at = np.zeros(len(w.size), np.int64), np.zeros(len(w.size), np.int64)
    for k in range(len(w.size)):
        codes = _codes_of_window(w, k).tolist()
        at[k] = min(range(len(codes)), key=lambda i: (counts.get(codes[i], 0), codes[i], i))
        best[k] = codes[at[k]]
    order = np.argsort(best, kind="stable")
    w.prefix, w.prefix_window, w.prefix_at = best[order], order, at[order]
    return w


def _ids(w: Windows, text: bytes) -> np.ndarray:
    words = words_of(text)
    get = w.vocab.get
    return np.fromiter((get(x, -1) for x in words), np.int64, len(words))


def _elements(w: Windows, ids: np.ndarray) -> list[np.ndarray]:
    """Codes at every position: shingles, and words where the block has windows that short."""
    short = bool(len(w.size) and w.size.min() < SHINGLE)
    return [shingle_codes(ids, _base(w))] + ([np.where(ids < 0, -1, ids + 1)] if short else [])


def window_hits(w: Windows, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and numbers of the windows that occur in a text of word numbers ``ids``."""
    starts, wins = [], []
    for codes in _elements(w, ids):
        known = np.flatnonzero(codes > 0)
        lo = np.searchsorted(w.prefix, codes[known])
        hi = np.searchsorted(w.prefix, codes[known], side="right")
        some = hi > lo
        known, lo, n = known[some], lo[some], (hi - lo)[some]
        if not len(known):
            continue
        entry = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        start, win = np.repeat(known, n) - w.prefix_at[entry], w.prefix_window[entry]
        ok = (start >= 0) & (start + w.size[win] <= len(ids))
        start, win = start[ok], win[ok]
        for j in range(w.words.shape[1]):
            inside = j < w.size[win]
            same = ~inside | (ids[np.minimum(start + j, len(ids) - 1)] == w.words[win, j])
            start, win = start[same], win[same]
        starts.append(start)
        wins.append(win)
    empty = np.zeros(0, np.int64)
    return np.concatenate(starts or [empty]), np.concatenate(wins or [empty])


def hit_spans(w: Windows, start: np.ndarray, win: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of hit words, as (first, end)."""
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    s, e = start[order], (start + w.size[win])[order]
    top = np.maximum.accumulate(e)
    first = np.concatenate(([True], s[1:] > top[:-1]))
    return list(zip(s[first].tolist(), np.maximum.reduceat(e, np.flatnonzero(first)).tolist()))


# ---- Spark ---------------------------------------------------------------------------------------

def _count_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        total = np.zeros(len(w.shingles), np.int64)
        for b in batches:
            for text in b.column("_text").to_pylist():
                ids = _ids(w, text)
                for codes in _elements(w, ids):
                    codes = codes[codes > 0]
                    if len(codes):
                        at = np.minimum(np.searchsorted(w.shingles, codes), len(w.shingles) - 1)
                        np.add.at(total, at[w.shingles[at] == codes], 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(w.shingles[some]), pa.array(total[some])], names=["code", "n"])
    return run


def _hit_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches:
            n_words, spans, items = [], [], []
            for text in b.column("_text").to_pylist():
                ids = _ids(w, text)
                start, win = window_hits(w, ids)
                n_words.append(len(ids))
                spans.append([{"s": s, "e": e} for s, e in hit_spans(w, start, win)])
                items.append(sorted({x for k in np.unique(win).tolist() for x in w.items[k] if x is not None}))
            rest = [c for c in b.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in rest), pa.array(n_words, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                 pa.array(items, pa.list_(pa.string()))], names=[*rest, "n_words", "spans", "items"])
    return run


_OUT = "n_words long, spans array<struct<s:long,e:long>>, items array<string>"


def _union_length(spans):
    """Words covered by spans that may overlap (those of several blocks)."""
    ordered = F.array_sort(spans)
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(ordered, zero, lambda acc, x: F.struct(
        (acc["n"] + F.greatest(x["e"] - F.greatest(x["s"], acc["end"]), F.lit(0))).alias("n"),
        F.greatest(acc["end"], x["e"]).alias("end")))["n"]


def benchmark_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS, window: int = WINDOW) -> Iterator[Windows]:
    """The benchmark's windows, a block at a time. Items are cut into blocks by a running sum of
    their bytes (an item has fewer words than bytes), so each collect is bounded."""
    items = staged(benchmark.select(F.col("item_id").cast("string").alias("item"), utf8("text").alias("t"))
                   .filter(F.length("t") > 0), "benchmark")
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-int(total) // (4 * block_words)))
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item", "t"), F.lit(n)) == k)
        w = make_windows([(r["item"], bytes(r["t"])) for r in part.toLocalIterator()], window)
        if len(w.size):
            yield w


def corpus_counts(src: DataFrame, shared) -> dict:
    """Occurrences over the whole corpus of the block's shingles (bounded by the block)."""
    return {r["code"]: r["n"] for r in map_batches(src, _count_batches(shared), "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n")).collect()}


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, window: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """The ``keep`` columns (default: ``doc_id``) of every row as a struct ``row``, with ``n_words``,
    ``spans`` (maximal runs of hit words), ``items`` (ids as sorted strings), ``n_hit`` and
    ``contaminated`` (hit words are at least one in twenty).

    Null or empty texts have no words and no hits. A null item_id makes its windows count but isn't
    listed. Repeated items and rows change nothing for others. An empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    keep = keep or ["doc_id"]
    src = docs.select(row_of(keep).alias("row"), utf8("text").alias("_text"))
    blocks = list(_prepared(src, benchmark, window, block_words, spark))
    if len(blocks) == 1:
        out = map_batches(src, _hit_batches(blocks[0]), with_fields(src, _OUT))
        out = out.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"]))
    else:
        numbered = staged(src.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        parts = None
        for shared in blocks:
            part = map_batches(numbered.select("_row", "_text"), _hit_batches(shared), f"_row long, {_OUT}").filter(F.size("spans") > 0)
            parts = part if parts is None else parts.unionByName(part)
        merged = parts.groupBy("_row").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                           F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        count = map_batches(numbered.select("row", "_row", "_text"), _hit_batches(spark.sparkContext.broadcast(choose_prefixes(make_windows([]), {}))),
                            with_fields(src, f"_row long, {_OUT}")).drop("spans", "items")
        out = count.join(merged, "_row", "left").drop("_row")
        out = (out.withColumn("spans", F.coalesce("spans", F.expr("cast(array() as array<struct<s:long,e:long>>)")))
               .withColumn("items", F.coalesce("items", F.expr("cast(array() as array<string>)")))
               .withColumn("n_hit", _union_length(F.col("spans"))))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * DEN >= F.col("n_words") * NUM))


def _prepared(src: DataFrame, benchmark: DataFrame, window: int, block_words: int, spark):
    some = False
    for w in benchmark_blocks(benchmark, block_words, window):
        shared = spark.sparkContext.broadcast(w)
        counts = corpus_counts(src, shared)
        shared.unpersist()
        some = True
        yield spark.sparkContext.broadcast(choose_prefixes(w, counts))
    if not some:
        yield spark.sparkContext.broadcast(choose_prefixes(make_windows([]), {}))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """``docs`` without contaminated rows, all columns as they were."""
    return contamination(docs, benchmark, keep=docs.columns, **kw).filter(~F.col("contaminated")).select(*row_columns(docs.columns))



def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT id, least(len(w), 13) AS n, array_to_string(w[i : i + 12], ' ') AS s
        FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) t(i) WHERE len(w) > 0),
dw AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
       FROM d, (SELECT DISTINCT n FROM win) l, unnest(range(1, len(w) - n + 2)) t(i)),
hit AS (SELECT doc_id, i, n, id FROM dw JOIN win USING (n, s)),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, unnest(range(0, n)) u(k) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT id) AS n_items, string_agg(DISTINCT id, ',' ORDER BY id) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)
"""
