"""Context-tree weighting against a direct recursion, scores against plain sums."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np

from fieldpulse.llm import ctw as C

SCHEMA = "doc_id long, text string, score double"


def log_kt(a, b):
    lg = math.lgamma
    return lg(a + .5) + lg(b + .5) - 2 * lg(.5) - lg(a + b + 1)


def decisions(symbol):
    """(decision, what was decided before) of a symbol; None is the end."""
    if symbol is None:
        return [(1, ())]
    bits = [0] + [symbol >> (7 - b) & 1 for b in range(8)]
    return [(bit, tuple(bits[:b])) for b, bit in enumerate(bits)]


class PlainTree:
    """Nodes by (context bytes latest first, decisions before); straight from the definition."""

    def __init__(self, texts, depth):
        self.depth, self.n = depth, defaultdict(lambda: [0, 0])
        self.kids = defaultdict(set)
        for t in texts:
            for symbol, past in self.steps(t):
                for bit, before in decisions(symbol):
                    for d in range(depth + 1):
                        self.n[(past[:d], before)][bit] += 1
                        if d:
                            self.kids[(past[:d - 1], before)].add(past[:d])
        self.memo = {}

    def steps(self, t):
        t = b"\0" * self.depth + t
        return [(t[i] if i < len(t) else None, t[i - self.depth:i][::-1]) for i in range(self.depth, len(t) + 1)]

    def weighted(self, ctx, before):
        key = (ctx, before)
        if key not in self.memo:
            own = log_kt(*self.n[key])
            below = sum(self.weighted(c, before) for c in self.kids.get(key, ()))
            self.memo[key] = own if len(ctx) == self.depth else np.logaddexp(math.log(.5) + own, math.log(.5) + below)
        return self.memo[key]

    def score(self, t):
        total = 0.0
        for symbol, past in self.steps(t):
            for bit, before in decisions(symbol):
                p = None
                for d in range(self.depth, -1, -1):
                    if (past[:d], before) not in self.n:
                        continue
                    n0, n1 = self.n[(past[:d], before)]
                    kt = ((n1 if bit else n0) + .5) / (n0 + n1 + 1)
                    stop = 1.0 if d == self.depth else math.exp(math.log(.5) + log_kt(n0, n1) - self.weighted(past[:d], before))
                    p = kt if p is None else stop * kt + (1 - stop) * p
                total += math.log10(.5 if p is None else p)
        return total


def corpus():
    base = ["the cat sat on the mat", "The dog sat.", "a mat, a cat\tand a dog", "é à ü the", "x", "", None, "the the the the", "zzz unseen words here"]
    return [(i, base[i % len(base)] if i < 20 else f"{base[i % 5]} {i}") for i in range(30)] + [(None, "no number"), (3, "a mat"), (3, "a mat")]


def held(d):
    return zlib.crc32(str(d).encode() if d is not None else b"") % 7 == 2


def test_scores(spark):
    docs = corpus()
    scored, n_all = C.score_corpus(spark.createDataFrame([(*d, 1.0) for d in docs], SCHEMA), depth=3)
    low = lambda t: (t or "").encode().lower()
    train = [low(t) for d, t in docs if not held(d)]
    tree = PlainTree(train, 3)
    words = Counter(w for t in train for w in t.split())
    words[None] = len(train)
    n = sum(words.values())
    assert n_all == n
    want = sorted((d is None, d or 0, held(d), len(low(t).split()) + 1, sum(words[w] > 0 for w in low(t).split()) + 1,
                   round(sum(math.log10((words[w] + 1) / (n + len([1 for c in words.values() if c]) + 1)) for w in [*low(t).split(), None]), 6),
                   round(tree.score(low(t)), 6)) for d, t in docs)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6))
                 for r in scored.collect())
    assert [r[:5] for r in got] == [r[:5] for r in want] and any(r[2] for r in want)
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], atol=1e-5)


def test_symbols_of_a_context_sum_to_one():
    for ctx in (b"abr", b"bra", b"zab"):  # seen, seen, and seen in part
        codes, n = C._distinct(np.sort(C.grams([b"abracadabra", b"banana"], 3)[0]))
        at = int.from_bytes(ctx, "little") << C.BITS
        every = np.unique(np.concatenate([codes, at + np.arange(257, dtype=np.uint64)]))
        count = np.zeros(len(every), np.int64)
        count[np.searchsorted(every, codes)] = n
        tree = C.layers(every, count, 3)
        p = C.log10_probabilities(every, tree, C.top_of(C.upper_sums(tree)), 3)
        mine = (every >> np.uint64(C.BITS)) == np.uint64(at >> C.BITS)
        assert mine.sum() == 257 and abs((10 ** p[mine]).sum() - 1) < 1e-9


def test_small_stretches_and_blocks_give_the_same_scores(spark, monkeypatch):
    df = spark.createDataFrame([(*d, 1.0) for d in corpus()], SCHEMA)
    want = sorted(map(str, C.score_corpus(df, depth=4)[0].collect()))
    monkeypatch.setattr(C, "GRAMS_AT_ONCE", 7)
    got = sorted(map(str, C.score_corpus(df, depth=4, block_bytes=30)[0].collect()))
    assert [r.split("score=")[0] for r in got] == [r.split("score=")[0] for r in want]
    numbers = lambda rows: [float(x.split("=")[1].split(",")[0].rstrip(")")) for r in rows for x in r.split(", ") if "score=" in x]
    assert np.allclose(numbers(got), numbers(want), atol=1e-5)


def test_blocks_are_cut_by_bytes():
    import pyarrow as pa

    texts = [b"x" * n for n in (10, 10, 10, 50, 1, 1, 1, 0, 30, 30)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([False] * len(texts)), pa.array(texts), pa.array([3] * len(texts), pa.int32())],
                                       names=["doc_id", "held_out", "_text", "task"])
    (out,) = C._cut_batches(25)(iter([batch]))
    blocks = out.column("block").to_numpy() - (3 << 32)
    assert blocks.tolist() == sorted(blocks.tolist())
    for b in set(blocks.tolist()):
        held = [len(t) for t, k in zip(texts, blocks) if k == b]
        assert sum(held) <= 25 or len([n for n in held if n]) == 1


def test_held_out_texts_score_better_than_words_that_are_spelled():
    """Add-one word counts give every unknown word the same price, however long; with unknown words spelled at
    the model's own price a byte, the model is better. Deeper contexts are better than shallow ones."""
    import pyarrow.parquet as pq

    rows = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    train = [(r["text"] or "").encode().lower() for r in rows if not held(r["doc_id"])]
    test = [(r["text"] or "").encode().lower() for r in rows if held(r["doc_id"])]
    words = Counter(w for t in train for w in t.split())
    words[None] = len(train)
    n, v = sum(words.values()), len(words)
    base = sum(math.log10((words.get(w, 0) + 1) / (n + v + 1)) for t in test for w in [*t.split(), None])

    def score(depth):
        seen, new = (C._distinct(np.sort(C.grams(ts, depth)[0])) for ts in (train, test))
        code, count = C._add_up([seen[0], new[0]], [seen[1], new[1] * 0])
        tree = C.layers(code, count, depth)
        return C.Table(code, C.log10_probabilities(code, tree, C.top_of(C.upper_sums(tree)), depth))[C.grams(test, depth)[0]].sum()

    scores = [score(d) for d in (3, 4, 5)]
    assert scores == sorted(scores)
    unknown = sum(len(w) for t in test for w in t.split() if w not in words)
    assert scores[-1] > base + unknown * scores[-1] / sum(map(len, test))


def test_table_and_gamma():
    rng = np.random.default_rng(0)
    codes = np.unique(rng.integers(0, 1 << 48, 5000, dtype=np.uint64))
    t = C.Table(codes, np.arange(len(codes), dtype=float))
    pick = rng.integers(0, len(codes), 9000)
    assert (t[codes[pick]] == pick).all()
    x = np.array([.5, 1, 1.5, 7.25, 1000.5])
    assert np.allclose(C.log_gamma(x), [math.lgamma(v) for v in x], atol=1e-9)


def test_empty_and_untrained(spark):
    scored, n = C.score_corpus(spark.createDataFrame([], SCHEMA), depth=3)
    assert scored.collect() == [] and n == 0
    only = next(d for d in range(100) if held(d))
    scored, n = C.score_corpus(spark.createDataFrame([(only, "ab", 0.0)], SCHEMA), depth=3)
    r = scored.collect()[0]
    assert n == 0 and r["held_out"] and r["n_known"] == 0 and abs(r["score"] + 19 * math.log10(2)) < 1e-5 and r["base_score"] == 0.0
