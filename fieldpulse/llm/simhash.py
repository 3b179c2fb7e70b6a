"""SimHash near-duplicates by pivot distance tables.

1. Every text gets a 64-bit SimHash of its word shingles (one pass, no shuffle).
2. Rows collapse to distinct fingerprints before anything is shuffled by content.
3. Distinct fingerprints are dealt to buckets: 64 bits are cut into six blocks and a bucket fixes
   two of them. Two fingerprints that differ in four bits or fewer agree in two blocks at least, so
   they meet in a bucket. A bucket above ``bucket_limit`` is dealt to cells by the distances to three
   pivots, in steps of five: coordinates of a link differ by four at most, so a member goes to its own
   cell and the next one by each pivot, and every link meets in a cell. Nothing is capped, and the plan
   does not depend on the data.
4. In a bucket, a pivot table holds each fingerprint's Hamming distances to ``PIVOTS``. By the
   triangle inequality a pair whose coordinates differ by more than the limit at any pivot cannot
   be a link, so the pair is discarded by its largest coordinate difference; survivors are verified
   on the fingerprints themselves.
   A bucket too large for one sweep cuts the bits that differ in it into five parts, of which a link
   agrees in one; parts whose members are already in one component are passed over.
5. A bucket emits a spanning forest of its links (at most one edge a member, never all pairs), and
   connected components join the forests.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm._common import map_batches, row_columns, row_of, staged, utf8
from fieldpulse.llm._graph import connected_components

SHINGLE, MAX_BITS = 4, 4
BLOCKS = 6
#: Reference fingerprints: balanced Walsh patterns (mutually 32 bits apart), so that the coordinates
#: at different pivots carry independent information.
N_PIVOTS = 16
BUCKET_LIMIT, CELL_PIVOTS = 20_000, 3
SMALL, SWEEP = 64, 4096


def walsh_pivots(n: int) -> np.ndarray:
    """Pattern k has bit i set where the bits common to i and the pivot's number are odd in count."""
    i, k = np.arange(64, dtype=np.uint64), (np.arange(n, dtype=np.uint64) * np.uint64(37) + np.uint64(11)) % np.uint64(64)
    odd = np.bitwise_count(i[None, :] & k[:, None]).astype(np.uint64) & np.uint64(1)
    return (odd << i[None, :]).sum(axis=1, dtype=np.uint64)


PIVOTS = walsh_pivots(N_PIVOTS)


def simhash64(text: bytes, shingle: int = SHINGLE, step: int = 1 << 16) -> int:
    words = text.lower().split()  # bytes: lowers A-Z and splits on space and \x09-\x0D only
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
        ends = (ends[shingle - 1:] - 1).tolist()
        h = xxhash.xxh64_intdigest
        hashes = [h(joined[a:b], 42) for a, b in zip(starts, ends)]
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), step):
        part = np.array(hashes[k:k + step], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(hashes)).tolist())


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = np.fromiter((simhash64(t) for t in b.column("_text").to_pylist()), np.uint64, b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64)), b.column("_copy")],
                                         names=["doc_id", "fp", "copy_key"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp long, copy_key long)`` for every row; ``copy_key`` is a hash of the text."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("_text"),
                      F.xxhash64("text").alias("_copy"))
    return map_batches(src, _fingerprint_batches, "doc_id long, fp long, copy_key long")


# ---- buckets -----------------------------------------------------------------------------------

def _cut(bits: list[int], parts: int) -> list[list[int]]:
    return [list(map(int, p)) for p in np.array_split(np.array(bits), parts) if len(p)]


def _mask(bits: list[int]) -> int:
    return signed(sum(1 << b for b in bits))


def first_masks(max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> list[int]:
    cut = _cut(list(range(64)), blocks)
    return [_mask(sum(c, [])) for c in combinations(cut, blocks - max_bits)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def cells(max_bits: int) -> Column:
    """The cells of the fingerprint ``fp`` by its distances to the first pivots: its own and the next of each."""
    width = max_bits + 1
    own = [F.floor(F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed(int(p))))) / F.lit(width)) for p in PIVOTS[:CELL_PIVOTS]]
    return F.array(*[sum(((o + F.lit(k >> i & 1)) * F.lit(100 ** i) for i, o in enumerate(own)), F.lit(0)).cast("int") for k in range(1 << CELL_PIVOTS)])


def bucket_rows(distinct_fps: DataFrame, max_bits: int, blocks: int, bucket_limit: int) -> DataFrame:
    """``(fp, mask, key, cell)``: each fingerprint in every bucket, and in every cell of a large bucket, where it
    may meet a partner."""
    rows = distinct_fps.select("fp", F.explode(F.array(*map(F.lit, first_masks(max_bits, blocks)))).alias("mask"))
    rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    hot = staged(rows.groupBy("mask", "key").count().filter(F.col("count") > bucket_limit).select("mask", "key", F.lit(True).alias("hot")), "hot-buckets")
    marked = rows.join(hot, ["mask", "key"], "left")
    return marked.select("fp", "mask", "key", F.explode(F.when(F.col("hot"), cells(max_bits)).otherwise(F.array(F.lit(-1)))).alias("cell"))


# ---- links inside buckets ------------------------------------------------------------------------

def pivot_table(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def _close(fps: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs are links: largest coordinate difference first, then the fingerprints."""
    keep = np.arange(len(i))
    for p in range(0, table.shape[1], 4):
        far = np.abs(table[i[keep], p:p + 4] - table[j[keep], p:p + 4]).max(axis=1) if len(keep) else keep
        keep = keep[far <= max_bits]
    return keep[np.bitwise_count(fps[i[keep]] ^ fps[j[keep]]) <= max_bits]


def _forest(n: int, i: np.ndarray, j: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """The least index reachable from each of ``n`` members over the links (and what ``root`` has joined)."""
    root = np.arange(n) if root is None else root.copy()
    while len(i):
        a, b = root[i], root[j]
        if (a == b).all():
            break
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    return root


def _sweep(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Roots in one large bucket: members leave the open list as a component reaches them, so a
    tight cluster costs a few passes. The open list is kept in order of the first pivot, and a
    member is compared only with the stretch within ``max_bits`` of its own coordinate."""
    n = len(fps)
    root, table = np.arange(n), pivot_table(fps)
    order = np.argsort(table[:, 0], kind="stable")
    open_, first = order, table[order, 0]
    while len(open_):
        seed = int(open_[0])
        front, open_, first = [seed], open_[1:], first[1:]
        while front:
            x = front.pop()
            lo = np.searchsorted(first, table[x, 0] - max_bits)
            hi = np.searchsorted(first, table[x, 0] + max_bits, side="right")
            part = open_[lo:hi]
            hit = _close(fps, table, np.full(len(part), x), part, max_bits)
            if len(hit):
                got = part[hit]
                root[got] = seed
                front += got.tolist()
                left = np.ones(len(open_), bool)
                left[lo + hit] = False
                open_, first = open_[left], first[left]
    return root


def _near_pairs(group: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups of ``SMALL`` rows at most (rows sorted by group): every distance apart at once."""
    table = pivot_table(fps)
    ii, jj = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for d in range(1, SMALL):
        i = np.flatnonzero(group[d:] == group[:-d])
        if not len(i):
            break
        hit = i[_close(fps, table, i, i + d, max_bits)]
        ii.append(hit)
        jj.append(hit + d)
    return np.concatenate(ii), np.concatenate(jj)


def _large(fps: np.ndarray, root: np.ndarray, max_bits: int) -> np.ndarray:
    """Roots in a bucket of any size. ``root`` is what is known of its components (least members).

    The bits that differ are cut into ``max_bits + 1`` parts; a link agrees in one of them, so its ends have equal
    bits there. Groups of equal bits are solved one by one; a group in one component has nothing to add, one with
    few members outside its largest component compares those with all."""
    n = len(fps)
    names, number, size = np.unique(root, return_inverse=True, return_counts=True)
    if len(names) == 1:
        return root
    few = np.flatnonzero(number != size.argmax())
    if n <= SWEEP or len(few) <= SMALL:
        if n <= SWEEP and len(few) > SMALL:
            found = _sweep(fps, max_bits)
            return _forest(n, np.arange(n), found, root)
        table, every = pivot_table(fps), np.arange(n)
        for x in few.tolist():
            hit = _close(fps, table, np.full(n, x), every, max_bits)
            root = _forest(n, np.full(len(hit), x), hit, root)
        return root
    differ = int(np.bitwise_or.reduce(fps ^ fps[0]))
    for part in _cut([b for b in range(64) if differ >> b & 1], max_bits + 1):
        key = fps & np.uint64(sum(1 << b for b in part))
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1])))
        sizes = np.diff(starts, append=n)
        small = order[np.repeat((sizes > 1) & (sizes <= SMALL), sizes)]
        if len(small):
            i, j = _near_pairs(key[small], fps[small], max_bits)
            root = _forest(n, small[i], small[j], root)
        for s, m in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
            members = np.sort(order[s:s + m])
            known = root[members]
            first = np.unique(known, return_index=True, return_inverse=True)
            found = _large(fps[members], first[1][first[2]], max_bits)
            root = _forest(n, members, members[found], root)
        if (root == root[0]).all():
            break
    return root


def bucket_links(group: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of rows sorted by bucket number ``group``: pairs (member, root)."""
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, int)
    sizes = np.diff(np.concatenate((starts, [len(group)])))
    out_a, out_b = [], []
    for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        part = fps[s:s + n]
        root = _sweep(part, max_bits) if n <= SWEEP else _large(part, np.arange(n), max_bits)
        moved = root != np.arange(n)
        out_a.append(part[moved])
        out_b.append(part[root[moved]])
    small = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
    g, f = group[small], fps[small]
    if len(f):
        root = _forest(len(f), *_near_pairs(g, f, max_bits))
        moved = root != np.arange(len(f))
        out_a.append(f[moved])
        out_b.append(f[root[moved]])
    empty = np.zeros(0, np.uint64)
    return np.concatenate(out_a or [empty]), np.concatenate(out_b or [empty])


def _link_batches(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def emit(rows: np.ndarray):
            change = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
            group = np.concatenate(([0], np.cumsum(change)))
            a, b = bucket_links(group, rows[:, 3].copy().view(np.uint64), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "key", "cell", "fp")], axis=1)
            last = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0  # the batch's last bucket may go on
            if cut:
                yield emit(np.concatenate(held + [rows[:cut]]))
                held = []
            elif held and (held[-1][-1, :3] != rows[0, :3]).any():
                yield emit(np.concatenate(held))
                held = []
            held.append(rows[cut:])
        if held:
            yield emit(np.concatenate(held))
    return run


def fingerprint_links(distinct_fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS,
                      bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints that span every component."""
    rows = bucket_rows(distinct_fps, max_bits, blocks, bucket_limit)
    rows = rows.repartition("mask", "key", "cell").sortWithinPartitions("mask", "key", "cell", "fp")
    return map_batches(rows, _link_batches(max_bits), "a long, b long")


def near_duplicate_classes(docs: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS,
                           bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row a document row: ``doc_id, fp long, copy_key long, root long, component_id, rep_copy``.

    ``root`` names the component (its least fingerprint), ``component_id`` is the smallest doc_id in
    it and ``rep_copy`` the copy key of the row that stands for it. Null and empty texts have no
    words: fingerprint zero, linked like any other. A null doc_id keeps its row and is never the
    smallest (a component without any doc_id has a null id). Repeated rows give repeated rows. An
    empty table gives no rows. Only ``doc_id`` and ``text`` are read; other columns don't matter.
    """
    prints = staged(fingerprints(docs), "simhash")
    classes = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "copy_key")).alias("least"))
    classes = staged(classes, "simhash-classes")
    roots = connected_components(fingerprint_links(classes.select("fp"), max_bits, blocks, bucket_limit))
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = named.groupBy("root").agg(F.min("least").alias("best"))
    lookup = named.select("fp", "root").join(best, "root").select(
        "fp", "root", F.col("best.doc_id").alias("component_id"), F.col("best.copy_key").alias("rep_copy"))
    return prints.join(lookup, "fp")


def keep_one_per_group(docs: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that stand for their near-duplicate group: one of each, all columns as
    they were. The one with the smallest doc_id stays (of rows that share it, the one with the least
    text hash; of rows equal in both, one)."""
    found = near_duplicate_classes(docs, **kw)
    # settled on ids; the texts move once, by the key that copies are told apart by
    reps = found.select(F.struct(F.col("component_id").alias("d"), F.col("rep_copy").alias("c")).alias("who")).distinct()
    rows = docs.select(row_of(docs.columns).alias("row"), F.struct(F.col("doc_id").cast("long").alias("d"), F.xxhash64("text").alias("c")).alias("who"))
    return rows.join(reps, "who", "left_semi").dropDuplicates(["who"]).select(*row_columns(docs.columns))


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicate_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
