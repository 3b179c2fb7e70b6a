"""Language-model scoring by context-tree weighting over bytes.

A text is its bytes, then an end. A symbol is nine binary decisions: whether the text ends here, then the
byte's bits, most significant first. The decision at a node of the symbol (the decisions before it) is
predicted in a context: the last 0, 1, ... ``DEPTH`` bytes. Every node of that tree has a
Krichevsky-Trofimov estimate from its counts over the whole training part of the corpus, and weighting mixes
the estimates of all depths: a node's weighted probability is one half its own estimate and one half the
product of its children's. After training, the share of its own estimate in a node's weighted probability
says how far to trust it against the deeper contexts, so the probability of a decision is mixed along the
path from the deepest context that training has seen up. The sum over a text's decisions is its log
probability, so the probabilities of all texts sum to one; over its bytes, its code length.

Counts are (context, symbol) grams: all nodes follow from them. Nothing is sampled, and no table that
grows with the corpus is broadcast or collected:

* texts are cut into blocks by bytes; each block lists its distinct grams and words with training counts;
* a gram's or word's counts are added up over the blocks by a plain aggregate;
* grams are dealt by the last three context bytes, sorted, and weighted there from depth ``DEPTH`` up to
  three, a few contexts at a time; a context of three bytes has 2^25 grams at most, whatever the corpus;
* depth two is finished from sums by a task a share, depths one and zero on the driver; what the tasks get of
  the three is bounded by the contexts there can be (2^25 nodes; some 10^5 in texts);
* probabilities of grams and counts of words are joined with the blocks' lists, and each block is scored from
  its own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm._common import map_batches, slices, staged, utf8

DEPTH = 5
CHUNK_BYTES = 1 << 20
#: Texts of a block (one text at least), and grams weighted at once (one context of three bytes at least).
BLOCK_BYTES, GRAMS_AT_ONCE = 32 << 20, 1 << 20
#: Decisions of a symbol, and the symbol that ends a text.
BITS, END = 9, 1 << 8
NODES = 1 << BITS
_U = np.uint64
_HALF = np.log(0.5)


# ---- the tree --------------------------------------------------------------------------------------

def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x of 0.5 and more: six steps up, then Stirling's series."""
    shift = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
    y = x + 6
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - np.log(shift)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log probability that the estimator gives to n0 zeros and n1 ones."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - 2 * 0.5723649429247001 - log_gamma(n0 + n1 + 1.0)


def _weigh(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log weighted probability, and the share in it of the node's own estimate."""
    total = np.logaddexp(_HALF + own, _HALF + below)
    return total, np.exp(_HALF + own - total)


def _runs(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))


class Layer:
    """Nodes of one depth at one decision: sorted keys (context << bit | decisions before), stop shares,
    estimates of a one (none where training has not been), and log weighted probabilities."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, bit: int, child: Layer | None):
        key = codes >> _U(BITS - bit)
        at = _runs(key)
        self.bit, self.key = bit, key[at]
        ones = counts * ((codes >> _U(BITS - 1 - bit)) & _U(1)).astype(np.int64)
        n, n1 = np.add.reduceat(counts, at).astype(float), np.add.reduceat(ones, at).astype(float)
        self.n0, self.n1 = n - n1, n1
        self.one = _estimate(self.n0, n1)
        self.weighted, self.stop = log_kt(self.n0, n1), np.ones(len(at))
        if child is not None:
            b = _U(bit)
            up = ((child.key >> b) >> _U(8)) << b | child.key & ((_U(1) << b) - _U(1))
            self.weighted, self.stop = _weigh(self.weighted, np.bincount(np.searchsorted(self.key, up), child.weighted, len(at)))


def _estimate(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.where(n0 + n1 > 0, (n1 + 0.5) / (n0 + n1 + 1), np.nan)


def _mix(p: np.ndarray, stop: np.ndarray, one: np.ndarray) -> np.ndarray:
    """The probability of a one at a context, from that at the next deeper one (none: not seen)."""
    return np.where(np.isnan(one), p, np.where(np.isnan(p), one, stop * one + (1 - stop) * p))


def _context(codes: np.ndarray, depth: int, d: int) -> np.ndarray:
    """The last ``d`` bytes of grams of ``depth``."""
    return codes >> _U(8 * (depth - d) + BITS)


def _going_on(codes: np.ndarray) -> np.ndarray:
    return (codes & _U(END)) == 0


def layers(codes: np.ndarray, counts: np.ndarray, depth: int, top: int = 3) -> list[list[Layer]]:
    """Layers by depth (from ``depth`` down to ``top``) and decision. ``codes``: sorted distinct grams,
    the context's latest byte first, then the symbol. An end has no decisions but the first."""
    out: list[list[Layer]] = []
    for d in range(depth, top - 1, -1):
        at_d = _context(codes, depth, d) << _U(BITS) | codes & _U(NODES - 1)
        order = np.argsort(at_d, kind="stable")
        own, n = at_d[order], counts[order]
        first = _runs(own)
        own, n = own[first], np.add.reduceat(n, first)
        on = _going_on(own)
        rest, m = own[on], n[on]
        out.append([Layer(own if b == 0 else rest, n if b == 0 else m, b, out[-1][b] if out else None) for b in range(BITS if len(rest) else 1)])
    return out


def upper_sums(tree: list[list[Layer]]) -> tuple[np.ndarray, ...]:
    """What the depth above needs of the uppermost layers: (its context << 9 | node, n0, n1, log weighted); a
    node's number is 1 followed by the decisions before it."""
    parts = []
    for layer in tree[-1]:
        b = _U(layer.bit)
        node = (_U(1) << b) | layer.key & ((_U(1) << b) - _U(1))
        parts.append((((layer.key >> b >> _U(8)) << _U(BITS) | node).astype(np.int64), layer.n0, layer.n1, layer.weighted))
    key, n0, n1, w = (np.concatenate([p[k] for p in parts]) for k in range(4))
    seen, inv = np.unique(key, return_inverse=True)
    return seen, *(np.bincount(inv, v, len(seen)) for v in (n0, n1, w))


def finished(n0: np.ndarray, n1: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log weighted probability, stop share and estimate of nodes from their sums."""
    weighted, stop = _weigh(log_kt(n0, n1), below)
    return weighted, stop, _estimate(n0, n1)


class Top:
    """Depth two by key (context << 9 | node), depths one and zero dense."""

    def __init__(self, two: tuple[np.ndarray, np.ndarray, np.ndarray], one: tuple[np.ndarray, ...]):
        order = np.argsort(two[0])
        self.key2, self.stop2, self.one2 = (x[order] for x in two)
        a0, a1, lower = np.zeros((256, NODES)), np.zeros((256, NODES)), np.zeros((256, NODES))
        key, n0, n1, below = one
        c, node = key >> BITS, key & (NODES - 1)
        a0[c, node], a1[c, node], lower[c, node] = n0, n1, below
        weighted, self.stop1, self.one1 = finished(a0, a1, lower)
        _, self.stop0, self.one0 = finished(a0.sum(axis=0), a1.sum(axis=0), weighted.sum(axis=0))


def top_of(sums: tuple[np.ndarray, ...]) -> Top:
    """From all sums of depth two at once (the Spark job does the same share by share)."""
    key, n0, n1, below = sums
    weighted, stop, one = finished(n0, n1, below)
    up = (key >> (BITS + 8)) << BITS | key & (NODES - 1)
    seen, inv = np.unique(up, return_inverse=True)
    return Top((key, stop, one), (seen, *(np.bincount(inv, v, len(seen)) for v in (n0, n1, weighted))))


def log10_probabilities(codes: np.ndarray, tree: list[list[Layer]], top: Top, depth: int) -> np.ndarray:
    """Of each gram's symbol in its context."""
    total = np.zeros(len(codes))
    for b in range(BITS):
        live = np.flatnonzero(_going_on(codes)) if b else np.arange(len(codes))
        if not len(live):
            break
        c = codes[live]
        bit = ((c >> _U(BITS - 1 - b)) & _U(1)).astype(bool)
        p = np.full(len(c), np.nan)
        before = (c & _U(NODES - 1)) >> _U(BITS - b)
        for k, row in enumerate(tree):
            layer = row[b]
            i = np.searchsorted(layer.key, _context(c, depth, depth - k) << _U(b) | before)
            p = _mix(p, layer.stop[i], layer.one[i])
        node = ((_U(1) << _U(b)) | before).astype(np.int64)
        i = np.searchsorted(top.key2, _context(c, depth, 2).astype(np.int64) << BITS | node)
        p = _mix(p, top.stop2[i], top.one2[i])
        last = _context(c, depth, 1).astype(np.int64)
        p = _mix(p, top.stop1[last, node], top.one1[last, node])
        p = _mix(p, top.stop0[node], top.one0[node])
        p = np.where(np.isnan(p), 0.5, p)  # no training at all
        total[live] += np.log10(np.where(bit, p, 1 - p))
    return total


def grams(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """The gram at every symbol of the texts, text after text, and how many each has (its bytes and the end).
    Contexts beyond a text's start are zero bytes."""
    pad = b"\0" * depth
    x = np.frombuffer(pad + pad.join(texts) + pad, np.uint8).astype(_U)
    n = len(x) - depth
    codes = x[depth:].copy()
    for j in range(1, depth + 1):  # the latest byte on top
        codes |= x[depth - j:depth - j + n] << _U(8 * (depth - j) + BITS)
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes + depth - 1) - depth
    codes[ends] |= _U(END)
    keep = np.ones(n, bool)
    for j in range(1, depth):
        keep[ends + j] = False
    return codes[keep], sizes


# ---- Spark -----------------------------------------------------------------------------------------

def _add_up(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    c, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(c, kind="stable")
    c, n = c[order], n[order]
    at = _runs(c)
    return c[at], np.add.reduceat(n, at)


def _distinct(sorted_codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = _runs(sorted_codes) if len(sorted_codes) else np.zeros(0, np.int64)
    return sorted_codes[at], np.diff(at, append=len(sorted_codes))


class Table:
    """Values by gram for a known set of grams: open addressing, so a look-up costs a few reads
    instead of a search."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        self.codes, self.values = codes, values
        bits = max(4, int(2 * len(codes)).bit_length())
        self.shift, self.last = _U(64 - bits), (1 << bits) - 1
        self.place = np.full(1 << bits, -1, np.int32)
        slot, open_ = self._slot(codes), np.arange(len(codes), dtype=np.int32)
        while len(open_):
            s = slot[open_]
            free = self.place[s] < 0
            self.place[s[free]] = open_[free]
            open_ = open_[self.place[s] != open_]
            slot[open_] = (slot[open_] + 1) & self.last

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * _U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __getitem__(self, codes: np.ndarray) -> np.ndarray:
        slot = self._slot(codes)
        at = self.place[slot]
        wrong = np.flatnonzero(self.codes[at] != codes)
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & self.last
            if (self.place[slot[wrong]] < 0).any():
                raise KeyError("a gram that the block's list lacks")
            at[wrong] = self.place[slot[wrong]]
            wrong = wrong[self.codes[at[wrong]] != codes[wrong]]
        return self.values[at]


def word_code(word: bytes) -> int:
    """A word's 64-bit hash with the sign bit set, so that it can't be a gram."""
    return (xxhash.xxh3_64_intdigest(word) & ((1 << 63) - 1)) - (1 << 63)


def _cut_batches(block_bytes: int):
    """Rows with the number of their block: consecutive rows of a task, cut by bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, 0
        for b in batches:
            sizes = pc.binary_length(b.column("_text")).to_numpy()
            blocks = np.empty(len(sizes), np.int64)
            for i, (n, task) in enumerate(zip(sizes.tolist(), b.column("task").to_pylist())):
                if block is None:
                    block = task << 32
                elif held and held + n > block_bytes:
                    block, held = block + 1, 0
                held += n
                blocks[i] = block
            yield pa.RecordBatch.from_arrays([pa.array(blocks), *(b.column(c) for c in ("doc_id", "held_out", "_text"))], names=["block", "doc_id", "held_out", "_text"])
    return run


def _list_batches(depth: int):
    """(block, code, n): the distinct grams and words of a block's rows with their training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, codes, counts = None, [], []

        def emit():
            if codes:
                c, n = _add_up(codes, counts)
                for k in range(0, len(c), 1 << 16):
                    m = len(c[k:k + (1 << 16)])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(m, block, np.int64)), pa.array(c[k:k + m]), pa.array(n[k:k + m])], names=["block", "code", "n"])

        for b in batches:
            ids = b.column("block").to_numpy()
            for lo, hi in zip(_runs(ids).tolist(), [*_runs(ids)[1:].tolist(), len(ids)]) if len(ids) else ():
                if ids[lo] != block:
                    yield from emit()
                    block, codes, counts = int(ids[lo]), [], []
                sizes = pc.binary_length(b.column("_text").slice(lo, hi - lo)).to_pylist()
                for i, j in slices(sizes, CHUNK_BYTES):
                    texts = [t.lower() for t in b.column("_text").slice(lo + i, j - i).to_pylist()]
                    held = b.column("held_out").slice(lo + i, j - i).to_pylist()
                    for out in (True, False):
                        mine = [t for t, h in zip(texts, held) if h == out]
                        if not mine:
                            continue
                        c, n = _distinct(np.sort(grams(mine, depth)[0]))
                        words = Counter(w for t in mine for w in t.split())
                        codes += [c.view(np.int64), np.fromiter(map(word_code, words), np.int64, len(words))]
                        counts += [n * (not out), np.fromiter(words.values(), np.int64, len(words)) * (not out)]
                    if sum(map(len, codes)) > 2 * CHUNK_BYTES and len(codes) > 4:
                        c, n = _add_up(codes, counts)
                        codes, counts = [c], [n]
        yield from emit()
    return run


def _whole_contexts(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted (code, n) rows in stretches that hold contexts of three bytes whole."""
    codes, counts, size, enough = [], [], 0, GRAMS_AT_ONCE
    for b in batches:
        if not b.num_rows:
            continue
        codes.append(b.column("code").to_numpy().view(_U))
        counts.append(b.column("n").to_numpy())
        size += b.num_rows
        if size >= enough:
            c, n = np.concatenate(codes), np.concatenate(counts)
            context = _context(c, depth, 3)
            cut = int(np.searchsorted(context, context[-1]))
            if cut:
                yield c[:cut], n[:cut]
            codes, counts, size = [c[cut:]], [n[cut:]], len(c) - cut
            enough = max(GRAMS_AT_ONCE, 2 * size)
    if size:
        yield np.concatenate(codes), np.concatenate(counts)


def _sum_batches(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, counts in _whole_contexts(batches, depth):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in upper_sums(layers(codes, counts, depth))], names=["key", "n0", "n1", "w"])
    return run


def _finish_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Depth two: each node's sums with its share, estimate and log weighted probability."""
    for b in batches:
        weighted, stop, one = finished(*(b.column(c).to_numpy() for c in ("n0", "n1", "w")))
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("n0"), b.column("n1"), pa.array(weighted), pa.array(stop), pa.array(one)], names=["key", "n0", "n1", "w", "stop", "one"])


def _probability_batches(depth: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, counts in _whole_contexts(batches, depth):
            p = log10_probabilities(codes, layers(codes, counts, depth), shared.value, depth).astype(np.float32).astype(float)
            for k in range(0, len(codes), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(codes[k:k + (1 << 16)].view(np.int64)), pa.array(p[k:k + (1 << 16)])], names=["code", "v"])
    return run


def _by_place(x: np.ndarray) -> bytes:
    """An array's first bytes, then all second bytes, and so on: sorted numbers then compress well."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _from_places(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def _packed(block: np.ndarray, code: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    """Rows (block, code, value) as one row a block: far fewer bytes for the shuffle to the blocks."""
    order = np.argsort(block, kind="stable")
    block, code, value = block[order], code[order], value[order]
    at = [*_runs(block).tolist(), len(block)] if len(block) else [0]
    spans = list(zip(at[:-1], at[1:]))
    return pa.RecordBatch.from_arrays([pa.array([int(block[i]) for i, _ in spans], pa.int64()), pa.array([_by_place(code[i:j]) for i, j in spans], pa.binary()),
                                       pa.array([_by_place(value[i:j]) for i, j in spans], pa.binary())], names=["block", "a", "b"])


def _pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for b in batches:
        held.append([b.column(c).to_numpy() for c in ("block", "code", "v")])
        size += b.num_rows
        if size > 1 << 20:
            yield _packed(*map(np.concatenate, zip(*held)))
            held, size = [], 0
    if size:
        yield _packed(*map(np.concatenate, zip(*held)))


_SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long"


def _score_batches(depth: int, n_all: int, n_words: int, n_ends: int):
    """Rows of a block in order: packed values of grams and words (kind 0), then texts (1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.log10(n_all + n_words + 1)
        end = np.log10(n_ends + 1) - whole
        block, parts, p_of, n_of = None, [], None, None
        for b in batches:
            kinds, ids, docs = b.column("kind").to_pylist(), b.column("block").to_pylist(), []

            def flush():
                texts = [b.column("a")[i].as_py().lower() for i in docs]
                scores = []
                for i, j in slices([len(t) for t in texts], CHUNK_BYTES):
                    c, sizes = grams(texts[i:j], depth)
                    scores.append(np.add.reduceat(p_of[c], np.cumsum(sizes) - sizes))
                rows = [n_of[np.fromiter(map(word_code, t.split()), np.int64).view(_U)] for t in texts]
                base = [float(np.log10(r + 1.0).sum() - len(r) * whole + end) for r in rows]
                return pa.RecordBatch.from_arrays(
                    [pa.array([b.column("doc_id")[i].as_py() for i in docs], pa.int64()), pa.array([b.column("held_out")[i].as_py() for i in docs], pa.bool_()),
                     pa.array([len(r) + 1 for r in rows], pa.int64()), pa.array([int((r > 0).sum()) + (n_ends > 0) for r in rows], pa.int64()),
                     pa.array(base, pa.float64()), pa.array(np.concatenate(scores)), pa.array([len(t) for t in texts], pa.int64())],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "n_bytes"])

            for i, (kind, at) in enumerate(zip(kinds, ids)):
                if at != block:
                    if docs:
                        yield flush()
                        docs = []
                    block, parts, p_of, n_of = at, [], None, None
                if kind == 0:
                    parts.append((_from_places(b.column("a")[i].as_py(), _U), _from_places(b.column("b")[i].as_py(), np.float64)))
                    continue
                if p_of is None:
                    code, value = map(np.concatenate, zip(*parts))
                    parts, word = [], code >= _U(1 << 63)
                    p_of, n_of = Table(code[~word], value[~word]), Table(code[word], value[word])
                docs.append(i)
            if docs:
                yield flush()
    return run


def score_corpus(docs: DataFrame, depth: int = DEPTH, block_bytes: int | None = None) -> tuple[DataFrame, int]:
    """Scores of every row (columns of ``_SCORE``) and the number of training tokens.

    Training rows are those whose crc32 of the doc_id as text is not 2 modulo 7 (null doc_id: training).
    Null text is empty: one token and one symbol (the end). Repeated rows count and are scored as often as they
    stand. Without training rows every decision is even. ``depth`` is 3 to 6. Only ``doc_id`` and ``text`` are
    read.
    """
    if not 3 <= depth <= 6:
        raise ValueError("depth: 3 to 6 bytes")
    spark = docs.sparkSession
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc % 7 == 2).alias("held_out"), utf8("text").alias("_text"), F.spark_partition_id().alias("task"))
    src = staged(map_batches(src, _cut_batches(block_bytes or BLOCK_BYTES), "block long, doc_id long, held_out boolean, _text binary"), "lm-texts", "zstd")

    # every gram and word of a block, then their training counts in the corpus
    listed = staged(map_batches(src.select("block", "held_out", "_text"), _list_batches(depth), "block long, code long, n long"), "lm-listed", "zstd")
    corpus = staged(listed.groupBy("code").agg(F.sum("n").alias("n")), "lm-corpus", "zstd")
    words, all_grams = corpus.filter("code < 0"), corpus.filter("code >= 0")
    n_words_all, n_distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    n_ends = src.filter("not held_out").count()
    n_all, n_distinct = int(n_words_all) + n_ends, n_distinct + (1 if n_ends else 0)

    context = F.shiftrightunsigned(F.col("code"), 8 * (depth - 3) + BITS)
    dealt = all_grams.repartition(context).sortWithinPartitions("code")
    sums = map_batches(dealt, _sum_batches(depth), "key long, n0 double, n1 double, w double").groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "w")])
    two = staged(map_batches(sums, _finish_batches, "key long, n0 double, n1 double, w double, stop double, one double"), "lm-depth-two")
    up = F.expr(f"(key >> {BITS + 8} << {BITS}) | (key & {NODES - 1})")
    one = two.groupBy(up.alias("key")).agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "w")]).toArrow()  # 256 contexts of 384 nodes at most
    known = two.select("key", "stop", "one").toArrow()  # contexts of two bytes
    top = Top(tuple(known.column(c).to_numpy() for c in ("key", "stop", "one")), tuple(one.column(c).to_numpy() for c in ("key", "n0", "n1", "w")))
    values = map_batches(dealt, _probability_batches(depth, spark.sparkContext.broadcast(top)), "code long, v double").unionByName(
        words.select("code", F.col("n").cast("double").alias("v")))
    packed = map_batches(listed.select("block", "code").join(values, "code").select("block", "code", "v"), _pack_batches, "block long, a binary, b binary")

    rows = packed.select("block", F.lit(0).alias("kind"), "a", "b", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("boolean").alias("held_out")).unionByName(
        src.select("block", F.lit(1).alias("kind"), F.col("_text").alias("a"), F.lit(None).cast("binary").alias("b"), "doc_id", "held_out"))
    rows = rows.repartition("block").sortWithinPartitions("block", "kind")
    return map_batches(rows, _score_batches(depth, n_all, n_distinct, n_ends), _SCORE), n_all


def op5_ctw(spark, sf_dir: str) -> DataFrame:
    scored, n_all = score_corpus(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score",
                         (-F.col("score") / F.lit(float(np.log10(2))) / F.nullif(F.col("n_bytes"), F.lit(0))).alias("bits_per_byte"))
