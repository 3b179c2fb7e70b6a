"""SimHash classes against brute force over all pairs."""

import numpy as np
import pytest
import xxhash

from fieldpulse.llm import simhash as S

SCHEMA = "doc_id long, text string"


def plain_simhash(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_classes(fps, bits=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def texts(seed=0, n=60):
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(300)] + ["É", "ß", "Ñandú"]
    out = []
    for _ in range(n):
        t = list(rng.choice(vocab, rng.integers(1, 200)))
        out.append(" ".join(t))
        if rng.random() < 0.5:
            t[rng.integers(len(t))] = "changed"
            out.append("  ".join(t).upper())
    return out + ["", None, " \n\t ", "one", "one two three", "one  two\tthree"]


def test_fingerprints_and_classes(spark):
    docs = list(enumerate(texts()))
    fps = [plain_simhash(t) for _, t in docs]
    want = {d: (f, c) for (d, _), f, c in zip(docs, fps, plain_classes(fps))}
    got = {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in S.near_duplicate_classes(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(docs)


@pytest.mark.parametrize("limit", [3, 20_000])
def test_links_keep_every_component(spark, limit):
    """Clustered fingerprints: a tight cluster, chains and noise, with and without finer buckets."""
    rng = np.random.default_rng(2)
    fps = set(int(x) for x in rng.integers(0, 1 << 63, 80, dtype=np.uint64))
    for base in list(fps)[:6]:
        cur = base
        for _ in range(40):
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                cur ^= 1 << int(b)
            fps.add(cur)
            fps.add(base ^ (1 << int(rng.integers(64))))
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in S.fingerprint_links(df, bucket_limit=limit).collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in links)
    place = {f: i for i, f in enumerate(fps)}
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in links:
        x, y = find(place[a]), find(place[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(fps))] == plain_classes(fps)


def test_sweep_equals_pairs():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 10, dtype=np.uint64)
    fps = np.unique(np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64)) for b in base]))
    a, b = S.bucket_links(np.zeros(len(fps), int), fps, 4)
    place = {int(f): i for i, f in enumerate(fps)}
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for x, y in zip(a.tolist(), b.tolist()):
        i, j = find(place[x]), find(place[y])
        root[max(i, j)] = min(i, j)
    assert [find(i) for i in range(len(fps))] == plain_classes([int(f) for f in fps])


def components(fps, links):
    place = {int(f): i for i, f in enumerate(fps)}
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for x, y in links:
        i, j = find(place[int(x)]), find(place[int(y)])
        root[max(i, j)] = min(i, j)
    return [find(i) for i in range(len(fps))]


def test_large_bucket_equals_pairs(monkeypatch):
    """Buckets over the sweep's size: tight clusters, chains and noise."""
    monkeypatch.setattr(S, "SWEEP", 70)
    rng = np.random.default_rng(9)
    for noise in (50, 900):
        fps = [rng.integers(0, 1 << 63, noise, dtype=np.uint64)]
        for base in fps[0][:8]:
            flips = rng.integers(0, 64, (60, 4)).astype(np.uint64)
            fps.append(base ^ (np.uint64(1) << flips).sum(axis=1, dtype=np.uint64))
        fps = np.unique(np.concatenate(fps))
        a, b = S.bucket_links(np.zeros(len(fps), int), fps, 4)
        assert components(fps, zip(a, b)) == plain_classes([int(f) for f in fps])


def test_tight_cluster_of_fifty_thousand():
    import time

    rng = np.random.default_rng(1)
    base = np.uint64(0x123456789ABCDEF0)
    flips = rng.integers(0, 64, (60_000, 6)).astype(np.uint64)
    fps = base
    for k in range(6):
        fps = fps ^ (np.uint64(1) << flips[:, k])
    fps = np.unique(fps)
    assert len(fps) > 50_000
    start = time.time()
    a, b = S.bucket_links(np.zeros(len(fps), int), fps, 4)
    assert time.time() - start < 60
    assert len(a) < len(fps)
    got = components(fps, zip(a, b))
    for i in rng.integers(0, len(fps), 40).tolist():  # each one's links, against all
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4)
        assert {got[j] for j in near.tolist()} == {got[i]}


def test_plan_does_not_depend_on_the_data(spark):
    near = [(i,) for i in range(300)]  # low bits only: one hot bucket after the other
    far = [(int(x),) for x in np.random.default_rng(0).integers(0, 1 << 62, 300)]
    sizes = []
    for data in (near, far):
        plan = S.fingerprint_links(spark.createDataFrame(data, "fp long"), bucket_limit=3)._jdf.queryExecution().analyzed().treeString()
        sizes.append(len(plan.split("\n")))
    assert sizes[0] == sizes[1]


def test_pivots_never_discard_a_link():
    rng = np.random.default_rng(5)
    f = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    g = f.copy()
    for _ in range(4):
        g ^= np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)
    both = np.concatenate([f, g])
    kept = S._close(both, S.pivot_table(both), np.arange(500), np.arange(500) + 500, 4)
    assert len(kept) == 500


def test_keep_one_nulls_ties_and_extra_columns(spark):
    rows = [(5, "a b c d e f", "x"), (3, "a b c d e f", "y"), (3, "a b c d e f", "y"), (None, "a b c d e f", None), (None, "lonely words stand here now", "z"),
            (9, None, "n"), (8, "", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string").selectExpr("*", "1 as _c", "2 as _d", "3 as `a.b`", "4 as who")
    kept = sorted(((r["doc_id"] is None, r["doc_id"], r["text"]) for r in S.keep_one_per_group(df).collect()), key=str)
    assert kept == sorted([(False, 3, "a b c d e f"), (True, None, "lonely words stand here now"), (False, 8, "")], key=str)
    assert S.keep_one_per_group(df).columns == df.columns
    assert {tuple(r)[3:] for r in S.keep_one_per_group(df).collect()} == {(1, 2, 3, 4)}
    assert S.near_duplicate_classes(df.limit(0)).collect() == []
