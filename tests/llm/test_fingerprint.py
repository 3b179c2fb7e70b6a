import hashlib

import numpy as np
import pytest

from fieldpulse.llm import fingerprint as P

SCHEMA = "doc_id long, text string, fingerprint string"


def text(n, seed):
    rng = np.random.default_rng(seed)
    return "".join(rng.choice(list("abcdefgh é\n"), n))


def names_by_level(data, levels=3):
    """Phrase spans (first byte, end) and names at each level."""
    x, first = np.frombuffer(data, np.uint8), np.array([0])
    spans = [(i, i + 1) for i in range(len(data))]
    out = []
    for _ in range(levels):
        n0 = len(x)
        y, _ = P.next_level(x, first)
        out.append(y)
        x = y
        assert len(x) <= n0
    return out


def test_equal_substrings_share_interior_names():
    core = text(4000, 1)
    a, b = (text(37, 2) + core).encode(), (text(501, 3) + core + text(90, 4)).encode()
    own = names_by_level(core.encode())
    for level, (p, q, r) in enumerate(zip(own, names_by_level(a), names_by_level(b))):
        # all but a few phrases at the ends recur, wherever the text stands
        edge = 8
        assert set(p[edge:-edge].tolist()) <= set(q.tolist()), level
        assert set(p[edge:-edge].tolist()) <= set(r.tolist()), level


def test_sketches_do_not_depend_on_company():
    texts = [text(n, n).encode() for n in (0, 1, 2, 3, 10, 500, 3000)] + [b"a" * 1000, b"ab" * 500, "é".encode(), b"\x00\x00"]
    alone = np.concatenate([P.sketches([t]) for t in texts])
    assert (P.sketches(texts) == alone).all()
    assert (P.sketches(texts[::-1]) == alone[::-1]).all()
    assert (alone[0] == 0).all() and all((s > 0).any() for s in alone[1:])


def test_labels_are_unlike_and_few():
    rng = np.random.default_rng(0)
    for x in (rng.integers(0, 256, 5000).astype(np.uint8), rng.integers(0, 1 << 63, 5000, dtype=np.uint64)):
        x = x[np.concatenate(([True], x[1:] != x[:-1]))]
        y = P._labels(x, np.array([0]))
        assert y.max() <= 5 and (y[1:] != y[:-1]).all()


def test_likeness_tells_shared_text():
    a, b = text(3000, 1), text(3000, 2)
    s = P.sketches([a.encode(), (a[:2000] + b[:1000]).encode(), b.encode(), b"", b""])
    assert 0.3 < P.likeness(s[0], s[1]) < 0.7 and P.likeness(s[0], s[2]) < 0.1
    assert P.likeness(s[0], s[0]) == 1 and P.likeness(s[3], s[4]) == 1 and P.likeness(s[0], s[3]) == 0


@pytest.mark.parametrize("part_bytes", [1 << 20, 2_000])
def test_edits_and_order(spark, part_bytes):
    docs = [(int(d), text(int(d) * 7 % 300, int(d))) for d in np.random.default_rng(0).permutation(80)] + [(200, None), (201, ""), (202, "ééé🙂a")]
    got = {r["doc_id"]: r for r in P.edited_fingerprints(spark.createDataFrame([(*d, "") for d in docs], SCHEMA), part_bytes).collect()}
    assert len(got) == len(docs)
    order = sorted(((d, t or "") for d, t in docs), reverse=True)
    for (d, t), (_, f) in zip(order, order[1:] + order[:1]):
        k = len(t) // 3
        e = (t[:len(t) - k] + f[:k]).encode()
        r = got[d]
        s = P.sketches([t.encode(), e, f.encode()])
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(e).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (P.as_text(s[0]), P.as_text(s[1]))
        assert r["near_edited"] == P.likeness(s[0], s[1]) and r["near_next"] == P.likeness(s[0], s[2])


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "null id", ""), (1, "same", ""), (1, "same", ""), (2, "two", "")], SCHEMA)
    got = P.edited_fingerprints(df).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "1", "2", "None"]
    assert P.edited_fingerprints(df.limit(0)).collect() == []
    one = P.edited_fingerprints(df.filter("doc_id = 2")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert P.fingerprints(df).count() == 4
