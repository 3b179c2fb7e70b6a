"""The stages on a small corpus, each against a plain version of its rule."""

import numpy as np
import pytest

import corpus_pipeline as P
from fieldpulse.llm import mixing, toxicity

from test_decontaminate import plain as plain_hits
from test_simhash import plain_classes, plain_simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    rng = np.random.default_rng(3)
    vocab = [f"{a}{b}" for a in "bcdfgklm" for b in ("ana", "ore", "ist", "umo", "eli")]
    docs, labels = [], []
    items = [(i, " ".join(rng.choice(vocab, 20))) for i in range(5)]
    for d in range(240):
        t = list(rng.choice(vocab, rng.integers(20, 120)))
        toxic = d % 6 == 0
        for w in ("idiot", "scum", "moron", "loser") * 2 if toxic else ():
            t[rng.integers(len(t))] = w
        if d % 10 == 1:
            t = list(docs[-1][1].split())  # a copy
        if d % 11 == 3:
            t += items[d % 5][1].split()
        docs.append((d, " ".join(t), "en" if d % 3 else "de", "big" if d % 2 else f"s{d % 5}", None))
        if d % 2 == 0 or toxic:
            labels.append((d, 1, int(toxic)))
    docs += [(900, None, None, None, None), (901, "", "en", "big", 0)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(docs, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), docs, labels, items


def test_stages_in_turn(spark, sf):
    path, docs, labels, items = sf
    texts = {d[0]: d[1] for d in docs}
    seen = {}
    df = spark.read.parquet(f"{path}/documents.parquet")
    columns = df.columns
    for k, (name, stage) in enumerate(P.STAGES):
        df = P.staged(stage(spark, df, path), "test")
        assert df.columns[:len(columns)] == columns and (k == 4 or df.columns == columns)
        seen[name] = sorted(r["doc_id"] for r in df.collect())
        assert len(set(seen[name])) == len(seen[name])
    tox, near, clean, mixed, sharded = (seen[n] for n, _ in P.STAGES)
    # toxic rows go, labelled clean ones and empty texts stay
    toxic = {d for d, _, t in labels if t}
    assert len(toxic & set(tox)) <= 0.05 * len(toxic) and {d for d, _, t in labels if not t and d % 10 != 1} <= set(tox) and {900, 901} <= set(tox)
    # one of each fingerprint group
    fps = [plain_simhash(texts[d]) for d in tox]
    assert near == sorted({tox[c] for c in plain_classes(fps)})
    # no contaminated row is left, no other is gone
    hits = plain_hits([(d, texts[d]) for d in near], items)
    assert clean == [d for d in near if not hits[d][3]] and len(clean) < len(near)
    assert set(mixed) <= set(clean) and mixed and sharded == mixed
    rows = df.collect()
    sizes = [sum(r["shard"] == s for r in rows) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1


def test_run(spark, sf):
    out = P.run(spark, sf[0])
    assert set(out.columns) == {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"} and out.count() > 0


def test_stages_on_empty_tables_and_odd_columns(spark, sf, tmp_path):
    for n in ("labels", "benchmark"):
        spark.read.parquet(f"{sf[0]}/{n}.parquet").limit(0).write.parquet(f"{tmp_path}/{n}.parquet")
    docs = spark.createDataFrame([(1, "some words in here", "en", "a", 1, "x", 5), (1, "some words in here", "en", "a", 1, "x", 5), (None, None, None, None, None, None, None)],
                                 DOCS + ", row string, shard int")
    for name, stage in P.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == [], name
        out = stage(spark, docs, str(tmp_path)).collect()
        assert 0 < len(out) <= 3 or name == "mixing", name


def test_names_with_dots_and_operators_own_names(spark, sf, tmp_path):
    """Every stage keeps columns whose names have dots or clash with an operator's own."""
    path = sf[0]
    df = spark.read.parquet(f"{path}/documents.parquet").limit(40).selectExpr(
        "*", "1 as `a.b`", "2 as _c", "3 as _d", "4 as row", "5 as _text", "6 as who", "7 as n_words", "8 as p0", "9 as bucket", "10 as `x.y.z`")
    for k, (name, stage) in enumerate(P.STAGES):
        out = P.staged(stage(spark, df, path), "test")
        assert out.columns[:len(df.columns)] == df.columns, name
        assert {tuple(r)[6:15] for r in out.collect()} <= {(2, 3, 4, 5, 6, 7, 8, 9, 10)}, name
