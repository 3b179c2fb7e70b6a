"""Suffix-array dedup against a brute-force count of every window."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from fieldpulse.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string"


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        hit = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                hit[i:i + length] = True
        runs = int(hit[:1].sum() + (hit[1:] & ~hit[:-1]).sum()) if len(d) else 0
        out.append((len(d), int(hit.sum()), runs, hashlib.sha256(bytes(b for b, h in zip(d, hit) if not h)).hexdigest()))
    return out


def got(spark, rows, **kw):
    df = S.dedup(spark.createDataFrame(rows, SCHEMA), **kw)
    return sorted((r["doc_id"], (r["n_bytes"], sum(s["e"] - s["a"] for s in r["spans"]), len(r["spans"]), r["kept_sha256"]))
                  for r in df.collect())


def corpus(seed=3, n=40):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdé"), rng.integers(1, 4)))
    shared = [" ".join(word() for _ in range(40)) for _ in range(4)]
    texts = []
    for _ in range(n):
        parts = [" ".join(word() for _ in range(rng.integers(0, 60)))]
        for _ in range(rng.integers(0, 3)):
            parts += [shared[rng.integers(4)][rng.integers(0, 9):], word()]
        texts.append(" ".join(parts))
    return texts + [texts[3], texts[3], "a" * 300, "ab" * 200, "", None, "short"]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 300])
def test_against_brute_force(spark, shard_bytes):
    """With tiny shards, groups are dealt over shards and merged by binary search."""
    texts = corpus()
    want = brute(texts, 32)
    rows = got(spark, list(enumerate(texts)), length=32, gram=8, shard_bytes=shard_bytes)
    assert [r[1] for r in rows] == want
    assert sum(w[1] for w in want) > 0 and any(0 < w[1] < w[0] for w in want)


@pytest.mark.parametrize("most", [8, 13, 16, 50, 100])
@pytest.mark.parametrize("x", [np.random.default_rng(1).integers(0, 3, 500), np.zeros(300), np.tile([1, 2, 1], 80), np.arange(200) % 7])
def test_suffix_array(x, most):
    x = x.astype(np.uint8)
    data, room = x.tobytes(), np.arange(len(x), 0, -1)
    sa = S.suffix_array(x, room, most)
    assert sorted(sa.tolist()) == list(range(len(data)))
    windows = [data[i:i + most] for i in sa if room[i] >= most]
    assert windows == sorted(windows)


def test_common_prefixes():
    rng = np.random.default_rng(7)
    for most in (9, 16, 21):
        block = bytes(rng.integers(97, 99, 40).astype(np.uint8))
        segs = [b"abcabcabc" * 9, b"abcabd" * 9, b"z" * 70, block + block[::-1], b"cab" * 11, block * 2, b"abcabcabc" * 9, b"x" * most]
        x = np.frombuffer(b"".join(segs), np.uint8)
        sizes = np.array([len(s) for s in segs])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        room = np.repeat(starts + sizes, sizes) - np.arange(len(x))
        sa = S.suffix_array(x, room, most)
        windows = sa[room[sa] >= most]
        lcp = S.common_prefixes(x, windows, starts, np.maximum(sizes - most + 1, 0), most)
        data = x.tobytes()
        for a, b in zip(windows[:-1].tolist(), windows[1:].tolist()):
            n = 0
            while n < most and data[a + n] == data[b + n]:
                n += 1
            assert lcp[b] == n


def test_long_run_of_one_letter():
    """Five million bytes of one letter are a few hundred times the same segment."""
    rows = list(S.anchors(b"e" * 5_000_000))
    assert len(rows) < 2000 and len({r[1] for r in rows}) <= 4
    places = np.zeros(5_000_000 - S.LENGTH + 1, np.int64)
    for _, _, start, size, _ in rows:
        places[start:start + size - S.LENGTH + 1] += 1
    assert (places == 1).all()


def test_long_texts(spark):
    rng = np.random.default_rng(11)
    long = "e" * 1_500_000
    mixed = "".join(rng.choice(list("abcdef "), 300_000).tolist())
    texts = [long, "e" * 401, mixed, "q" + mixed[1000:1900] + "z", "e" * 399, mixed[:500] + "e" * 500, mixed[299_000:] + mixed[:700]]
    assert [r[1] for r in got(spark, list(enumerate(texts)))] == brute(texts, S.LENGTH)


def test_null_ids_deliver_segments(spark):
    shared = "".join(np.random.default_rng(2).choice(list("abcdefgh"), 200).tolist())
    rows = [(None, "x1 " + shared + " y1"), (None, "x1 " + shared + " y1"), (5, "other " + shared), (None, "more " + shared[20:])]
    texts = [t for _, t in rows]
    df = S.dedup(spark.createDataFrame(rows, SCHEMA), length=32, gram=8)
    have = sorted((r["n_bytes"], sum(s["e"] - s["a"] for s in r["spans"]), len(r["spans"]), r["kept_sha256"]) for r in df.collect())
    assert have == sorted(brute(texts, 32))


def test_long_text_in_pieces(monkeypatch):
    rng = np.random.default_rng(5)
    t = bytes(rng.integers(97, 101, 3000).astype(np.uint8))
    whole = list(S.anchors(t, 64, 8))
    monkeypatch.setattr(S, "PIECE", 500)
    parts = list(S.anchors(t, 64, 8))
    cover = lambda rows: sorted(w for _, _, s, n, _ in rows for w in range(s, s + n - 63))
    assert cover(whole) == cover(parts) == list(range(3000 - 63))
    anchor = lambda rows: {w: a for a, _, s, n, _ in rows for w in range(s, s + n - 63)}
    assert anchor(whole) == anchor(parts)


def test_empty_table_nulls_and_extra_columns(spark):
    assert S.dedup(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, None, 1), (1, "x" * 50, 2), (1, "x" * 50, 2), (2, "", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    out = sorted((r["n_bytes"], len(r["spans"])) for r in S.dedup(df, length=32, gram=8).collect())
    assert out == [(0, 0), (0, 0), (50, 1), (50, 1)]
