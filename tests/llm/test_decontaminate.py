"""Decontamination against a plain scan for every window."""

import re

import numpy as np
import pytest

from fieldpulse.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def plain(docs, items, window=13):
    wins = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[s:s + window]), set()).add(i)
    out = {}
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for win, ids in wins.items():
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s:s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    found |= {str(i) for i in ids if i is not None}
        out[d] = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
    return out


def fixture(seed=1):
    rng = np.random.default_rng(seed)
    vocab = ["a", "b", "é", "The", "x9", "ß", "q"]
    text = lambda n: " ".join(rng.choice(vocab, n))
    items = [(i, text(int(n))) for i, n in enumerate([20, 13, 14, 5, 2, 1, 0, 30])] + [(7, "Zoo zoo"), (None, "unnamed item has words"), (10, None)]
    docs = []
    for d in range(60):
        body = text(int(rng.integers(0, 200)))
        if d % 3 == 0:
            body += ", " + items[d % 8][1].upper() + " - " + text(3)
        docs.append((d, body))
    return docs + [(100, None), (101, ""), (102, "zoo; ZOO zoo"), (103, "unnamed ITEM has words"), (104, "!!")], items


@pytest.mark.parametrize("block_words", [1_000_000, 20])
def test_against_plain_scan(spark, block_words):
    docs, items = fixture()
    got = D.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_words=block_words)
    rows = {r["row"]["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"]), r["contaminated"]) for r in got.collect()}
    assert rows == plain(docs, items)
    assert any(0 < v[1] < v[0] for v in rows.values())


def test_empty_tables_and_columns(spark):
    docs = spark.createDataFrame([(1, "some words", 3), (1, "some words", 3)], "doc_id long, text string, spans int")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.drop_contaminated(docs, none).collect() == docs.collect()
    assert D.drop_contaminated(docs.limit(0), none).collect() == []
    items = spark.createDataFrame([(1, "SOME words")], "item_id long, text string")
    out = D.drop_contaminated(docs, items)
    assert out.collect() == [] and out.columns == docs.columns


def test_prefix_is_the_rarest_shingle():
    w = D.make_windows([(1, "a b c d e")])
    codes = D._codes_of_window(w, 0).tolist()
    w = D.choose_prefixes(w, {codes[0]: 9, codes[1]: 2, codes[2]: 5})
    assert w.prefix.tolist() == [codes[1]] and w.prefix_at.tolist() == [1]
