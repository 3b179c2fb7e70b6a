import numpy as np

from fieldpulse.llm import mixing as M

SCHEMA = "doc_id long, text string, lang string, source string, weight int"


def make(spark, n=3000):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        s = "big" if rng.random() < 0.6 else f"s{rng.integers(4)}"
        rows.append((i, " ".join(f"word{rng.integers(30)}" for _ in range(rng.integers(1, 20))), rng.choice(["en", "de", None]), s, i))
    return spark.createDataFrame(rows + [(-1, None, None, None, 0), (-2, "", "en", "big", 0)], SCHEMA)


def test_rake_local_meets_all_marginals():
    rng = np.random.default_rng(1)
    keys = [rng.integers(0, k, 200) for k in (5, 3, 4)]
    tokens = rng.integers(1, 1000, 200).astype(float)
    goals = [np.array([.1, .2, .3, .2, .2]), np.array([.5, .3, .2]), np.array([.25] * 4)]
    w = M.rake_local(keys, tokens, goals)
    for k, g in zip(keys, goals):
        assert np.allclose(np.bincount(k, w * tokens) / (w * tokens).sum(), g, atol=1e-6)


def test_spread_equals_local(spark):
    rows = M.described(make(spark), ["doc_id", "source", "lang"])
    cells = M.cells_of(rows)
    key = lambda df: sorted((r["source"], r["lang"], r["topic"], round(r["probability"], 5)) for r in df.collect())
    # relative weights are what counts: both scale to the greatest
    assert key(M.calibrated_cells(cells)) == key(M.calibrated_cells(cells, max_local_cells=0, rounds=12, tolerance=1e-7))


def test_expected_tokens_follow_the_targets(spark):
    goal = {"lang": {"en": 0.6, "de": 0.2, M.NONE: 0.2}}
    got = M.mix(make(spark), targets=goal).toPandas()
    got["tokens"] = got.n_tokens * got.probability
    share = got.groupby("lang").tokens.sum() / got.tokens.sum()
    assert abs(share["en"] - 0.6) < 1e-6 and abs(share[M.NONE] - 0.2) < 1e-6
    drawn = got[got.sampled]
    assert abs(drawn[drawn.lang == "en"].n_tokens.sum() / drawn.n_tokens.sum() - 0.6) < 0.05
    assert len(got) == 3002


def test_sample_keeps_rows_and_columns(spark):
    docs = make(spark)
    a, b = M.sample_to_targets(docs), M.sample_to_targets(docs.repartition(5))
    assert a.columns == docs.columns
    rows = set(map(str, a.collect()))
    assert rows == set(map(str, b.collect())) and rows <= set(map(str, docs.collect())) and 0 < len(rows) < docs.count()
    assert M.sample_to_targets(docs.limit(0)).collect() == []


def test_topic():
    assert M.topic_of(b"") == 0 == M.topic_of(b"a bb ccc")
    assert M.topic_of(b"word word other") == M.topic_of(b"WORD other word")


def test_one_rare_cell_does_not_scale_the_corpus(spark):
    docs = make(spark)
    rare = spark.createDataFrame([(-3, "seldom " * 20, "xx", "lone", 0)], SCHEMA)
    for kw in ({}, {"max_local_cells": 0, "rounds": 12, "tolerance": 1e-7}):
        cells = M.calibrated_cells(M.cells_of(M.described(docs.unionByName(rare), ["doc_id", "source", "lang"])), **kw)
        got = cells.toPandas()
        kept = (got.tokens * got.probability).sum() / got.tokens.sum()
        assert abs(kept - M.KEPT) < 1e-4 and got.probability.between(0, 1).all()
        assert got[got.source == "lone"].probability.tolist() == [1.0] and got[got.tokens > 0].probability.min() > 0.05
        # the rare values fall short and are named, the others follow their targets
        short = M.shortfalls(cells).toPandas()
        assert set(zip(short.dimension, short.value)) >= {("source", "lone"), ("lang", "xx")}
        own, drawn = got.groupby("source").tokens.sum(), (got.tokens * got.probability).groupby(got.source).sum()
        for v in ("s0", "s1"):
            assert abs(drawn[v] / drawn["big"] / (own[v] / own["big"]) ** 0.7 - 1) < 1e-3
    got = M.mix(docs.unionByName(rare)).toPandas()
    assert abs(got[got.sampled].n_tokens.sum() / got.n_tokens.sum() - M.KEPT) < 0.05


def test_contradicting_targets_lose_no_cell(spark):
    # each source has a language of its own, and the two targets differ
    rows = [(i, "alpha beta gamma delta", "en" if i % 4 else "de", "big" if i % 4 else "small", 0) for i in range(400)]
    cells = M.cells_of(M.described(spark.createDataFrame(rows, SCHEMA), ["doc_id", "source", "lang"]))
    got = M.calibrated_cells(cells, targets={"source": {"big": 0.9, "small": 0.1}, "lang": {"en": 0.5, "de": 0.5}}).toPandas()
    assert got.probability.between(0.01, 1).all()
    none = M.calibrated_cells(cells, targets={"lang": {"en": 1.0}}).toPandas()
    assert none[none.lang == "de"].probability.tolist() == [0.0] and none[none.lang == "en"].probability.iloc[0] > 0.6


def test_kept_share_is_stated(spark):
    cells = M.cells_of(M.described(make(spark), ["doc_id", "source", "lang"]))
    for kept in (0.1, 0.8, 1.0):
        got = M.calibrated_cells(cells, kept=kept).toPandas()
        assert abs((got.tokens * got.probability).sum() / got.tokens.sum() - kept) < 1e-3


def test_topic_column_of_the_caller(spark):
    docs = make(spark, 600).selectExpr("*", "CASE WHEN doc_id % 5 = 0 THEN 'law' WHEN doc_id % 5 < 4 THEN 'art' END AS subject")
    got = M.mix(docs, topic="subject", targets={"topic": {"law": 0.4, "art": 0.4, M.NONE: 0.2}}, kept=0.3).toPandas()
    assert set(got.topic) == {"law", "art", M.NONE} and len(got) == 602
    drawn = (got.n_tokens * got.probability).groupby(got.topic).sum()
    assert abs(drawn["law"] / drawn.sum() - 0.4) < 1e-6 and abs(drawn[M.NONE] / drawn.sum() - 0.2) < 1e-6
    kept = M.sample_to_targets(docs, topic="subject")
    assert kept.columns == docs.columns and 0 < kept.count() < 602
