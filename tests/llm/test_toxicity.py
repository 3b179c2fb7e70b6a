import numpy as np

from fieldpulse.llm import toxicity as T

DOCS, LABELS = "doc_id long, text string, p1 double", "doc_id long, quality int, toxic int"


def corpus(n=600, seed=0):
    rng = np.random.default_rng(seed)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{rng.integers(2000)}" for _ in range(rng.integers(20, 200))]
        toxic, low = rng.random() < 0.15, rng.random() < 0.15
        for word, on in (("idiot", toxic), ("moron", toxic), ("scum", toxic), ("buy", low), ("cheap", low)):
            if on:
                words[rng.integers(len(words))] = word
        letters = {str(k): chr(97 + k) for k in range(10)}
        docs.append((i, " ".join("".join(letters.get(c, c) for c in w) for w in words), 0.5))
        labels.append((i, 0 if low else 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    train = labels[:400]
    d = spark.createDataFrame(docs, DOCS)
    chain = T.train(d, spark.createDataFrame(train, LABELS))
    rows = {r["doc_id"]: r["bad"] for r in T.score(d, chain).withColumn("bad", T.is_rejected(chain)).collect()}
    hits = [rows[i] == bool(t) for i, _, t in labels[400:]]
    assert np.mean(hits) > 0.97
    assert len(rows) == len(docs)


def test_later_models_see_earlier_probabilities():
    """The second label equals the first, which the features of the second model's rows only hint at."""
    rng = np.random.default_rng(1)
    y = (rng.random(300) < 0.5).astype(int)
    rows = [(np.array([5, 9]) if v else np.array([7, 9]), np.array([1.0, 1.0])) for v in y]
    models, held = T.fit_chain(T.Sparse(rows), np.column_stack([y, y]), np.arange(300) % 3)
    assert models[0].chain.shape == (0,) and models[1].chain.shape == (1,) and models[1].chain[0] > 0
    assert ((held[:, 0] > 0.5) == (y > 0)).all() and ((held[:, 1] > 0.5) == (y > 0)).all()


def test_out_of_fold_rows_are_not_fitted():
    """Labels that no feature tells: out-of-fold probabilities are no better than chance."""
    rng = np.random.default_rng(2)
    y = (rng.random(400) < 0.5).astype(int)
    rows = [(np.array(sorted({int(rng.integers(1000)), 2000 + i})), np.ones(2)[:len({0, 1})]) for i in range(400)]
    _, held = T.fit_chain(T.Sparse(rows), y[:, None], np.arange(400) % 3)
    assert abs(((held[:, 0] > 0.5) == (y > 0)).mean() - 0.5) < 0.1


def test_drop_toxic_keeps_columns_and_empty_texts(spark):
    docs, labels = corpus(300)
    docs += [(1000, None, 0.1), (1001, "", 0.2), (None, "wa wb", 0.3), (0, docs[0][1], 0.5)]
    labels += [(None, 1, 1), (2000, None, 1), (3, 0, None)]
    d = spark.createDataFrame(docs, DOCS)
    out = T.drop_toxic(d, spark.createDataFrame(labels, LABELS))
    kept = out.collect()
    assert out.columns == d.columns
    ids = [r["doc_id"] for r in kept]
    assert 1000 in ids and 1001 in ids and len(kept) < len(docs)
    assert {str(r) for r in kept} <= {str(r) for r in d.collect()}


def test_no_labels_reject_nothing(spark):
    d = spark.createDataFrame(corpus(20)[0], DOCS)
    assert T.drop_toxic(d, spark.createDataFrame([], LABELS)).count() == 20
    assert T.drop_toxic(d.limit(0), spark.createDataFrame([], LABELS)).collect() == []


def test_threshold():
    assert abs(T.best_threshold(np.array([.9, .8, .5, .3, .1]), np.array([1, 1, 1, 0, 0])) - 0.4) < 1e-9  # half way to .3
    assert T.best_threshold(np.array([.9]), np.array([0])) > 1
