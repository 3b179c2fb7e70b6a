"""Exact substring dedup by suffix arrays.

Every byte covered by a ``LENGTH``-byte string that starts at least twice in the corpus is marked. A
window is a stretch of ``LENGTH`` bytes; equal windows must be found wherever they stand.

1. *Anchors.* Each window chooses its least ``GRAM``-byte hash (the first of equals) as its anchor.
   Equal windows choose equal anchors at the same place, so windows can only be equal within one
   anchor's group. Windows in a row that share an anchor make a segment: one row ``(anchor, segment
   hash, text, start)``, narrow, aggregated before it is shuffled.
2. *Shards.* Anchors of a segment that stands once are dropped, unless the segment may repeat itself. Of the rest, each distinct segment's bytes go to the
   shard of its anchor. A group above ``shard_bytes`` is dealt over several shards.
3. *Suffix arrays.* A shard sorts the suffixes of its segments by Larsson-Sadakane refinement: ranks
   by the first 8 bytes, then pairs of ranks double the sorted length, each time only inside the
   groups that are still tied, until ``LENGTH`` bytes are sorted; what reaches over a segment's end is
   left as it is. Kasai's scan, run on all segments of the shard side by side and eight bytes at a time,
   gives the common prefixes of neighbouring windows. A run of neighbours with ``LENGTH`` bytes in common
   that starts twice (a segment counts as often as it stands in the corpus) is repeated.
4. *Merging.* Groups spread over shards are merged: every shard lists its distinct windows of those
   groups as a sorted run of 128-bit keys, runs are cut by key range, and in each range every run is
   looked up in the union of the others by binary search; a key that two runs hold is repeated in both.
5. *Removal.* Repeated windows go back to all places of their segments, are joined into spans per
   distinct text, and copies of a text share its result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm._common import map_batches, staged, utf8

LENGTH, GRAM = 400, 64
PIECE = 1 << 22  # window starts handled at once; longer texts go piece by piece
SEGMENT = 4096  # windows of a segment at most
SHARD_BYTES = 4 << 20
_U = np.uint64
_PLACE = _U((1 << 24) - 1)


# ---- anchors -----------------------------------------------------------------------------------

def gram_hashes(x: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes at every place (``gram`` a power of two)."""
    h = (x.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15)
    h ^= h >> _U(29)
    m = 1
    while m < gram:
        h = h[:-m] * _U(0xD6E8FEB86659FD93 + 2 * m) + h[m:]
        m *= 2
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(29))


def sliding_least(key: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours: block-wise running minima from both sides."""
    n = len(key) - width + 1
    pad = -len(key) % width
    rows = np.concatenate((key, np.full(pad, np.iinfo(np.uint64).max, _U))).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, int, int, bool]]:
    """(anchor hash, segment hash, start, bytes, whether its windows have several anchors, so that some may be
    equal) of each segment of a text."""
    for base in range(0, max(0, len(text) - length + 1), PIECE):
        x = np.frombuffer(text, np.uint8)[base:base + PIECE + length - 1]
        h = gram_hashes(x, gram)
        key = (h & ~_PLACE) | np.arange(len(h), dtype=_U)
        at = (sliding_least(key, length - gram + 1) & _PLACE).astype(np.int64)
        of = h[at]
        first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        runs = np.diff(first, append=len(of))
        if runs.max() > SEGMENT:  # long runs are cut from their starts
            n = -(-runs // SEGMENT)
            first = np.repeat(first, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * SEGMENT
        last = np.append(first[1:], len(of)) - 1
        for a, s, e, more in zip(of[first].view(np.int64).tolist(), (first + base).tolist(), (last + length + base).tolist(), (at[first] != at[last]).tolist()):
            yield a, xxhash.xxh3_64_intdigest(text[s:e]) - (1 << 63), s, e - s, more


# ---- suffix arrays ---------------------------------------------------------------------------------

def words8(x: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on (zeros beyond the end), the first byte on top."""
    wide = np.concatenate((x, np.zeros(8, np.uint8)))
    out = np.zeros(len(x), _U)
    for j in range(8):
        out |= wide[j:j + len(x)].astype(_U) << _U(56 - 8 * j)
    return out


def suffix_array(x: np.ndarray, room: np.ndarray, most: int) -> np.ndarray:
    """Places of ``x`` in the order of their suffixes' first ``most`` bytes (Larsson-Sadakane: ranks by the
    first 8 bytes, then by pairs of ranks, sorting only the groups still tied). ``room`` is how many bytes a
    place has to its segment's end; a place with less than what is compared stays in front of its equals so
    far, and nothing asks for its order."""
    n = len(x)
    key = words8(x)
    sa = np.argsort(key, kind="stable")  # equals in the order of their places, which the scan for prefixes relies on
    key = key[sa]
    head = np.concatenate(([True], key[1:] != key[:-1]))
    start = np.flatnonzero(head)
    rank = np.empty(n, np.int64)
    rank[sa] = np.repeat(start, np.diff(start, append=n))
    tied = np.flatnonzero(~(head & np.append(head[1:], True)))  # places in the array whose group has others
    done = min(8, most)
    while len(tied) and done < most:
        step = min(done, most - done)
        at = sa[tied]
        # two stretches of ``done`` bytes, the second from ``step`` on (the last pair overlaps)
        fits = room[at] >= done + step
        second = np.where(fits, rank[np.minimum(at + step, n - 1)] + 1, 0)
        key = (rank[at].astype(_U) << _U(32)) | second.astype(_U)
        order = np.argsort(key, kind="stable")
        at, key, fits = at[order], key[order], fits[order]
        sa[tied] = at
        head = np.concatenate(([True], key[1:] != key[:-1]))
        start = np.flatnonzero(head)
        rank[at] = np.repeat(tied[start], np.diff(start, append=len(tied)))
        tied = tied[~(head & np.append(head[1:], True)) & fits]
        done += step
    return sa


def common_prefixes(x: np.ndarray, windows: np.ndarray, starts: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """Kasai's scan: for every place of ``windows`` (sorted by their first ``most`` bytes), the bytes (``most`` at
    most) it has in common with the one before it. Going one place on loses one byte at most where both go on to
    places in the same order, so a scan carries its count along; all segments (``counts`` windows from each of
    ``starts``) scan side by side, eight bytes a step."""
    n = len(x)
    before, rank = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
    before[windows[1:]] = windows[:-1]
    rank[windows] = np.arange(len(windows))
    eight = np.append(words8(x), np.zeros(1, _U))
    common = np.zeros(n, np.int32)
    order = np.argsort(-counts, kind="stable")
    starts, counts = starts[order], counts[order]
    have, last = np.zeros(len(starts), np.int64), np.full(len(starts), -1, np.int64)
    for t in range(int(counts.max(initial=0))):
        live = int(np.searchsorted(-counts, -t, side="left"))  # segments with more than t windows
        i = starts[:live] + t
        j = before[i]
        along = last[:live] + 1
        carried = (last[:live] >= 0) & (rank[along] >= 0) & (rank[along] < rank[i])
        h = np.where(carried, np.maximum(have[:live] - 1, 0), 0)
        open_ = np.flatnonzero((j >= 0) & (h < most))
        while len(open_):
            a, b = i[open_] + h[open_], j[open_] + h[open_]
            differ = eight[np.minimum(a, n)] ^ eight[np.minimum(b, n)]
            same = differ == 0
            h[open_[same]] += 8
            rest = differ[~same]
            h[open_[~same]] += np.add.reduce([rest < _U(1 << k) for k in range(8, 64, 8)], axis=0) if len(rest) else 0
            open_ = open_[same]
            open_ = open_[h[open_] < most]
        h = np.minimum(h, most)
        h[j < 0] = 0
        common[i] = h
        have[:live], last[:live] = h, j
    return common


def repeated_windows(segments: list[bytes], times: list[int], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """For the windows of a shard: places in the joined segments, the segment of each, whether the
    window is repeated in the shard, and whether it is the first of its kind."""
    sizes = np.array([len(s) for s in segments], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    x = np.frombuffer(b"".join(segments), np.uint8)
    room = np.repeat(starts + sizes, sizes) - np.arange(len(x))
    sa = suffix_array(x, room, length)
    window = sa[room[sa] >= length]  # windows in the array's order
    if not len(window):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(bool), none.astype(bool), starts
    lcp = common_prefixes(x, window, starts, np.maximum(sizes - length + 1, 0), length)
    owner = np.repeat(np.arange(len(segments)), sizes)[window]
    head = lcp[window] < length
    head[0] = True
    number = np.cumsum(head) - 1
    weight = np.bincount(number, np.array(times, float)[owner])
    return window, owner, weight[number] >= 2, head, starts


def spans_of(at: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Sorted window places as maximal covered runs (first, end)."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > length)
    return list(zip(at[np.concatenate(([0], cut + 1))].tolist(), (at[np.append(cut, len(at) - 1)] + length).tolist()))


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, e in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([a, e])
    return [(a, e) for a, e in out]


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, last = [], 0
    for a, e in spans:
        parts.append(text[last:a])
        last = e
    return b"".join([*parts, text[last:]])


# ---- Spark -----------------------------------------------------------------------------------------

_SPANS = "array<struct<a:long,e:long>>"
_PA_SPANS = pa.list_(pa.struct([("a", pa.int64()), ("e", pa.int64())]))


def _spans_array(rows: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"a": a, "e": e} for a, e in r] for r in rows], _PA_SPANS)


def _anchor_batches(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows, tids):
            *cols, more = zip(*rows) if rows else [()] * 5
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), pa.array(more, pa.bool_()), pa.array(tids, pa.binary())],
                                              names=["h", "s", "start", "size", "more", "tid"])
        for b in batches:
            rows, tids = [], []
            for text, tid in zip(b.column("_text").to_pylist(), b.column("tid").to_pylist()):
                for segment in anchors(text, length, gram):
                    rows.append(segment)
                    tids.append(tid)
                    if len(rows) >= 50_000:
                        yield out(rows, tids)
                        rows, tids = [], []
            yield out(rows, tids)
    return run


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for text, need in zip(b.column("_text").to_pylist(), b.column("need").to_pylist()):
            yield pa.RecordBatch.from_arrays(
                [pa.array([n["shard"] for n in need], pa.int64()), pa.array([n["hot"] for n in need], pa.bool_()), pa.array([n["h"] for n in need], pa.int64()),
                 pa.array([n["s"] for n in need], pa.int64()), pa.array([n["times"] for n in need], pa.int64()),
                 pa.array([text[n["start"]:n["start"] + n["size"]] for n in need], pa.binary())], names=["shard", "hot", "h", "s", "times", "bytes"])


_SHARD_OUT = f"h long, s long, spans {_SPANS}, run long, part int, keys binary, owners binary, places binary"


def _shard_batches(length: int, ranges: int):
    """Sorted by shard: one suffix array a shard. Rows with ``spans`` say what is repeated inside the
    shard; rows with ``keys`` are pieces of a hot shard's run, for merging."""
    names = ["h", "s", "spans", "run", "part", "keys", "owners", "places"]
    types = [pa.int64(), pa.int64(), _PA_SPANS, pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def solve(shard, rows):
        window, owner, again, head, starts = repeated_windows([r[3] for r in rows], [r[2] for r in rows], length)
        at = window - starts[owner]
        order = np.lexsort((at[again], owner[again]))
        own, place = owner[again][order], at[again][order]
        cuts = [*np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))).tolist(), len(own)] if len(own) else []
        found = [(rows[own[a]][0], rows[own[a]][1], spans_of(place[a:b], length)) for a, b in zip(cuts[:-1], cuts[1:])]
        n = len(found)
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                                          _spans_array([f[2] for f in found]), *(pa.nulls(n, t) for t in types[3:])], names=names)
        if rows[0][4]:
            first = np.flatnonzero(head)
            w, o = at[first], owner[first]
            digest = xxhash.xxh3_128_digest
            keys = np.array([digest(rows[i][3][p:p + length]) for i, p in zip(o.tolist(), w.tolist())], dtype="S16") if len(first) else np.zeros(0, "S16")
            single = ~again[first]
            seg = np.where(single, np.array([r[1] for r in rows], np.int64)[o], 0)
            place = np.where(single, w, -1)
            sort = np.argsort(keys, kind="stable")
            keys, seg, place = keys[sort], seg[sort], place[sort]
            lines = np.array([int(k * 2 ** 64 // ranges).to_bytes(8, "big") for k in range(1, ranges)], dtype="S16") if ranges > 1 else np.zeros(0, "S16")
            cut = [0, *np.searchsorted(keys, lines).tolist(), len(keys)]
            for k, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
                if b > a:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([rows[0][0]], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, _PA_SPANS), pa.array([shard], pa.int64()), pa.array([k], pa.int32()),
                         pa.array([keys[a:b].tobytes()], pa.binary()), pa.array([seg[a:b].tobytes()], pa.binary()), pa.array([place[a:b].tobytes()], pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("shard", "h", "s", "times", "bytes", "hot"))):
                if held and row[0] != shard:
                    yield from solve(shard, held)
                    held = []
                shard = row[0]
                held.append(row[1:])
        if held:
            yield from solve(shard, held)
    return run


def _merge_batches(length: int):
    """Sorted by (group, key range): keys that stand in two runs are repeated where they stand alone."""
    def merge(h, runs):
        keys = [np.frombuffer(r[0], "S16") for r in runs]
        union = np.sort(np.concatenate(keys))
        rows = []
        for k, r in zip(keys, runs):
            n = np.searchsorted(union, k, side="right") - np.searchsorted(union, k)
            seg, place = np.frombuffer(r[1], np.int64), np.frombuffer(r[2], np.int64)
            hit = (n > 1) & (place >= 0)
            rows += [(s, [(p, p + length)]) for s, p in zip(seg[hit].tolist(), place[hit].tolist())]
        return pa.RecordBatch.from_arrays([pa.array([h] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int64()), _spans_array([r[1] for r in rows])],
                                          names=["h", "s", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for h, part, *rest in zip(*(b.column(c).to_pylist() for c in ("h", "part", "keys", "owners", "places"))):
                if held and (h, part) != now:
                    yield merge(now[0], held)
                    held = []
                now = (h, part)
                held.append(rest)
        if held:
            yield merge(now[0], held)
    return run


def _remove_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        spans = [joined_spans([(s["a"], s["e"]) for s in row]) for row in b.column("spans").to_pylist()]
        kept = [without(t, s) for t, s in zip(b.column("_text").to_pylist(), spans)]
        yield pa.RecordBatch.from_arrays([b.column("tid"), _spans_array(spans), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                                         names=["tid", "spans", "kept_sha256"])


def repeated_segments(texts: DataFrame, copies: DataFrame, length: int = LENGTH, gram: int = GRAM,
                      shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``tid, a, e``-spans of repeated windows of texts that stand once in the corpus, not yet joined."""
    each = map_batches(texts.select("_text", "tid"), _anchor_batches(length, gram), "h long, s long, start long, size long, more boolean, tid binary")
    # copies of a text make one row a place: n is how often the text stands in the corpus
    places = staged(each.groupBy("h", "s", "tid", "start", "size", "more").agg(F.count("*").alias("n")), "places")
    segments = staged(places.groupBy("h", "s").agg(F.sum("n").alias("times"), F.min(F.struct("tid", "start")).alias("at"), F.first("size").alias("size"), F.max("more").alias("more")), "segments")
    groups = (segments.groupBy("h").agg(F.sum("times").alias("n"), F.count("*").alias("kinds"), F.sum("size").alias("bytes"), F.max("more").alias("own"))
              .filter("n > 1 or own").drop("own"))
    met = staged(segments.join(groups, "h"), "met")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("size").alias("e")))
    alone = met.filter("kinds = 1 and n > 1").select("h", "s", whole.alias("spans"))  # equal segments have met already

    many = met.filter("kinds > 1 or n = 1")
    total = int(many.agg(F.sum("size")).first()[0] or 0)
    shards = max(1, -(-2 * total // shard_bytes))
    hot = F.col("bytes") > shard_bytes
    parts = F.ceil(F.col("bytes") / F.lit(shard_bytes))
    shard = F.when(hot, -1 - F.pmod(F.xxhash64("h", F.pmod(F.col("s"), parts)), F.lit(1 << 62))).otherwise(F.pmod(F.xxhash64("h"), F.lit(shards)))
    need = many.select(F.col("at.tid").alias("tid"), F.struct(shard.cast("long").alias("shard"), hot.alias("hot"), "h", "s", "times",
                                                              F.col("at.start").alias("start"), "size").alias("n"))
    # one of a text's copies delivers its segments; copies are told apart in the key, so they don't meet
    need = need.groupBy("tid").agg(F.collect_list("n").alias("need")).join(copies, "tid").select(F.struct("tid", F.col("least").alias("doc_id")).alias("who"), "need")
    held = texts.select(F.struct("tid", "doc_id").alias("who"), "_text")
    cut = map_batches(held.join(need, "who").select("_text", "need"), _cut_batches, "shard long, hot boolean, h long, s long, times long, bytes binary")
    # rows equal in doc_id and text may each deliver a segment; one is enough
    cut = cut.repartition("shard").sortWithinPartitions("shard", "h", "s")
    ranges = max(1, min(1 << 12, -(-total // shard_bytes)))
    solved = staged(map_batches(cut, _unique_then(_shard_batches(length, ranges)), _SHARD_OUT), "solved")
    inside = solved.filter("spans is not null").select("h", "s", "spans")
    runs = solved.filter("keys is not null").repartition("h", "part").sortWithinPartitions("h", "part").select("h", "part", "keys", "owners", "places")
    across = map_batches(runs, _merge_batches(length), f"h long, s long, spans {_SPANS}")
    found = alone.unionByName(inside).unionByName(across)
    once = places.filter("n = 1").select("h", "s", "tid", "start")
    return once.join(found, ["h", "s"]).select(
        "tid", F.transform("spans", lambda x: F.struct((x["a"] + F.col("start")).alias("a"), (x["e"] + F.col("start")).alias("e"))).alias("spans"))


def _unique_then(fn):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def unique():
            last = None
            for b in batches:
                keys = list(zip(*(b.column(c).to_pylist() for c in ("shard", "h", "s"))))
                keep = []
                for k in keys:
                    keep.append(k != last)
                    last = k
                yield b if all(keep) else b.filter(pa.array(keep))
        yield from fn(unique())
    return run


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row a document row: ``doc_id, n_bytes, spans`` (removed runs, sorted and apart),
    ``kept_sha256`` (of the bytes that stay).

    Null text is empty; texts under ``length`` bytes lose nothing. A text that stands more than once
    (and is long enough) is removed whole from every copy. Only ``doc_id`` and ``text`` are read; a null
    or repeated doc_id is a row like any other.
    """
    # a text's name is half of its SHA-256
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("_text"))
    texts = texts.withColumn("sha", F.sha2("_text", 256)).withColumn("tid", F.unhex(F.substring("sha", 1, 32)))
    rows = staged(texts.select("doc_id", "tid", F.length("_text").cast("long").alias("n_bytes"), "sha"), "texts")
    copies = staged(rows.groupBy("tid").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least")), "copies")
    long = texts.filter(F.length("_text") >= length)
    per_text = repeated_segments(long, copies, length, gram, shard_bytes).groupBy("tid").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    done = map_batches(long.join(per_text, "tid").select("tid", "_text", "spans"), _remove_batches, f"tid binary, spans {_SPANS}, kept_sha256 string")
    out = rows.join(copies.select("tid", "copies"), "tid").join(staged(done, "removed"), "tid", "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("n_bytes").alias("e")))
    return out.select("doc_id", "n_bytes", F.when(whole, all_of_it).otherwise(F.coalesce("spans", F.expr(f"cast(array() as {_SPANS})"))).alias("spans"),
                      F.when(whole, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["a"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
