"""Toxicity by classifier chains over hashed word features.

Categories are predicted one after the other. The model of a category sees the text's features and
the probabilities of all categories before it. In training those earlier probabilities are
out-of-fold predictions, so a later model learns from probabilities as uncertain as the ones it
meets when it scores.

Training uses a bounded sample of labelled rows (``sample_rows``, by hash of the doc_id, so it does
not depend on order or partitioning), because a linear model stops gaining long before that. Only
the sample's feature lists reach the driver. Scoring runs over every row and every whole text, in
one pass without a shuffle; the model that is broadcast has a fixed size (``2**HASH_BITS`` weights a
category).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm._common import map_batches, row_columns, row_of, utf8, with_fields

HASH_BITS = 18
PREFIX_BYTES = 4
SAMPLE_ROWS = 6_000
FOLDS = 3
STEPS = 100
L2 = 1e-5
MIN_ROWS = 3
#: Categories in chain order: name and the condition on a row of ``labels``.
CATEGORIES = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"))

#: A-Z to a-z, other ASCII that is no letter to space; bytes of other scripts stay as they are.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def text_features(text: bytes, memo: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and word beginnings of a whole text with values log(1 + count), scaled to
    length 1. Texts without letters have none."""
    memo = {} if memo is None else memo
    mask = (1 << HASH_BITS) - 1
    ids: list[int] = []
    counts: list[int] = []
    for word, n in Counter(text.translate(_FOLD).split()).items():
        pair = memo.get(word)
        if pair is None:
            pair = (zlib.crc32(word) & mask, zlib.crc32(b"^" + word[:PREFIX_BYTES]) & mask)
            if len(memo) < 300_000:
                memo[word] = pair
        ids += pair
        counts += (n, n)
    if not ids:
        return np.zeros(0, np.int64), np.zeros(0)
    arr = np.array(ids)
    order = np.argsort(arr, kind="stable")
    arr = arr[order]
    first = np.flatnonzero(np.concatenate(([True], arr[1:] != arr[:-1])))
    val = np.log1p(np.add.reduceat(np.array(counts, float)[order], first))
    return arr[first], val / np.sqrt((val * val).sum())


@dataclass
class Linear:
    """Logistic model: hashed weights, weights of earlier categories' log-odds, intercept."""

    w: np.ndarray
    chain: np.ndarray
    b: float


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p)) / 4


class Sparse:
    """Rows of (feature, value) lists, flattened."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], width: int = 1 << HASH_BITS):
        self.n, self.width = len(rows), width
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), [len(r[0]) for r in rows])
        self.col = np.concatenate([r[0] for r in rows]).astype(np.int32) if rows else np.zeros(0, np.int32)
        self.val = np.concatenate([r[1] for r in rows]).astype(np.float32) if rows else np.zeros(0, np.float32)

    def take(self, pick: np.ndarray) -> Sparse:
        out = Sparse([])
        new = np.full(self.n, -1, np.int32)
        new[pick] = np.arange(len(pick))
        keep = new[self.row] >= 0
        out.n, out.row, out.col, out.val = len(pick), new[self.row[keep]], self.col[keep], self.val[keep]
        return out

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * w[self.col], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.val * g[self.row], self.width)


def fit_linear(x: Sparse, prior: np.ndarray, y: np.ndarray, steps: int = STEPS) -> Linear:
    """Logistic regression with classes weighted alike, by accelerated gradient steps. A feature is
    scaled by the log-ratio of its document frequencies in the two classes and left out below
    ``MIN_ROWS`` rows, so that words seen once don't let the model learn rows by heart."""
    pos = max(y.sum(), 1.0)
    neg = max(len(y) - y.sum(), 1.0)
    weight = np.where(y > 0, 0.5 / pos, 0.5 / neg)
    size = 1 << HASH_BITS
    with_pos = np.bincount(x.col, y[x.row], size)
    seen = np.bincount(x.col, minlength=size)
    ratio = np.log((with_pos + 1) / (pos + 2)) - np.log((seen - with_pos + 1) / (neg + 2))
    ratio[seen < MIN_ROWS] = 0
    cols = np.flatnonzero(ratio)  # only these are fitted
    place = np.zeros(size, np.int32)
    place[cols] = np.arange(len(cols))
    used, on = Sparse([], len(cols)), ratio[x.col] != 0
    used.n, used.row, used.col, used.val = x.n, x.row[on], place[x.col[on]], (x.val[on] * ratio[x.col[on]]).astype(np.float32)
    odds = _log_odds(prior) if prior.size else prior
    theta = np.zeros(len(cols) + prior.shape[1] + 1)
    ahead, rate = theta.copy(), 2.0 / (1 + np.bincount(used.row, used.val ** 2, x.n).max(initial=0))
    for k in range(1, steps + 1):
        err = (_sigmoid(used.dot(ahead) + odds @ ahead[len(cols):-1] + ahead[-1]) - y) * weight
        grad = np.concatenate([used.back(err), odds.T @ err, [err.sum()]]) + L2 * ahead
        step = ahead - 4 * rate * grad
        ahead = step + (k - 1) / (k + 2) * (step - theta)
        theta = step
    w = np.zeros(size)
    w[cols] = theta[:len(cols)] * ratio[cols]
    return Linear(w, theta[len(cols):-1], float(theta[-1]))


def predict(model: Linear, x: Sparse, prior: np.ndarray) -> np.ndarray:
    return _sigmoid(x.dot(model.w) + (_log_odds(prior) @ model.chain if prior.size else 0.0) + model.b)


def fit_chain(x: Sparse, labels: np.ndarray, fold: np.ndarray, folds: int = FOLDS) -> tuple[list[Linear], np.ndarray]:
    """One model a category and the out-of-fold probabilities, in chain order."""
    prior = np.zeros((x.n, 0))
    models = []
    for c in range(labels.shape[1]):
        y = labels[:, c].astype(float)
        models.append(fit_linear(x, prior, y))
        held = np.full(x.n, y.mean() if x.n else 0.0)
        for k in range(folds):
            out, rest = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
            if len(out) and len(rest):
                held[out] = predict(fit_linear(x.take(rest), prior[rest], y[rest]), x.take(out), prior[out])
        prior = np.column_stack([prior, held])
    return models, prior


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut with the best F1 on out-of-fold probabilities, half way to the next lower one. Without
    positive rows nothing is rejected."""
    if not y.sum():
        return 2.0
    order = np.argsort(-p, kind="stable")
    p, hits = p[order], np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    f1[:-1][p[:-1] == p[1:]] = -1  # a cut can't part equal probabilities
    k = int(np.argmax(f1))
    return float((p[k] + p[k + 1]) / 2) if k + 1 < len(p) else float(p[k])


# ---- Spark ---------------------------------------------------------------------------------------

def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo: dict = {}
    keep = ("_order", "_fold", "_labels")
    for b in batches:
        rows = [text_features(t, memo) for t in b.column("_text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in keep), pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())),
             pa.array([r[1].astype(np.float32) for r in rows], pa.list_(pa.float32()))], names=[*keep, "ids", "vals"])


def training_sample(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, sample_rows: int = SAMPLE_ROWS,
                    folds: int = FOLDS) -> DataFrame:
    """At most about ``sample_rows`` labelled rows with features. A doc_id is in the sample or not by
    its hash; rows with a null doc_id, label or text take no part; a doc_id that is labelled or
    present more than once counts once (its greatest label, its least text)."""
    conds = [F.coalesce(F.expr(c), F.lit(False)).cast("int") for _, c in categories]
    known = F.expr(" and ".join(f"({c}) is not null" for _, c in categories))
    lab = (labels.filter(known & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("_id"), F.array(*conds).alias("_labels"))
           .groupBy("_id").agg(F.max("_labels").alias("_labels")))
    total = lab.count()
    share = min(1.0, sample_rows / max(total, 1))
    h = F.pmod(F.xxhash64("_id", F.lit(4)), F.lit(1_000_003))
    lab = lab.withColumn("_order", h).filter(h < F.lit(int(share * 1_000_003) + 1))
    texts = docs.filter(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("_id"), utf8("text").alias("_text"))
    # the sample has about ``sample_rows`` rows whatever the corpus, so the texts need no shuffle
    met = texts.join(F.broadcast(lab), "_id").groupBy("_id").agg(F.min("_text").alias("_text"), F.first("_order").alias("_order"),
                                                    F.first("_labels").alias("_labels"))
    fold = F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(folds)).cast("int")
    return map_batches(met.select("_text", "_order", fold.alias("_fold"), "_labels"), _feature_batches,
                       "_order long, _fold int, _labels array<int>, ids array<int>, vals array<float>")


@dataclass
class Chain:
    names: tuple[str, ...]
    models: list[Linear]
    thresholds: list[float]
    out_of_fold: np.ndarray  # of the sample, in its order
    labels: np.ndarray


def train(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, sample_rows: int = SAMPLE_ROWS,
          folds: int = FOLDS) -> Chain:
    """The sample (bounded by ``sample_rows``) is fitted on the driver. No labelled row: models that
    say the same for every text and thresholds that reject nothing."""
    t = training_sample(docs, labels, categories, sample_rows, folds).toArrow().sort_by([("_order", "ascending"), ("_fold", "ascending")])
    rows = [(i.values.to_numpy(zero_copy_only=False), v.values.to_numpy(zero_copy_only=False))
            for i, v in zip(t.column("ids"), t.column("vals"))]
    y = np.array(t.column("_labels").to_pylist(), np.int64).reshape(len(rows), len(categories))
    names = tuple(n for n, _ in categories)
    if not rows:
        flat = [Linear(np.zeros(1 << HASH_BITS), np.zeros(k), -1.0) for k in range(len(names))]
        return Chain(names, flat, [2.0] * len(names), np.zeros((0, len(names))), y)
    x, fold = Sparse(rows), np.array(t.column("_fold").to_pylist())
    del rows, t
    models, held = fit_chain(x, y, fold, folds)
    return Chain(names, models, [best_threshold(held[:, k], y[:, k]) for k in range(len(names))], held, y)


def _score_batches(chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = chain.value
        ws = np.stack([m.w for m in model.models])
        memo: dict = {}
        for b in batches:
            z = np.zeros((len(ws), b.num_rows))
            for i, t in enumerate(b.column("_text").to_pylist()):
                ids, vals = text_features(t, memo)
                z[:, i] = ws[:, ids] @ vals
            prior = np.zeros((b.num_rows, 0))
            for m, score in zip(model.models, z):
                p = _sigmoid(score + (_log_odds(prior) @ m.chain if prior.size else 0.0) + m.b)
                prior = np.column_stack([prior, p])
            rest = [b.column(c) for c in b.schema.names if c != "_text"]
            names = [c for c in b.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays(rest + [pa.array(prior[:, k]) for k in range(len(ws))],
                                             names=names + [f"p{k}" for k in range(len(ws))])
    return run


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """``doc_id``, a probability a category (``p0``, ``p1``, ... in chain order) and the text itself,
    for every row. A null or empty text has no features: its probabilities are the intercepts'."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("_text"))
    cols = ", ".join(f"p{k} double" for k in range(len(chain.names)))
    return map_batches(src, _score_batches(shared), f"doc_id long, {cols}")


def is_rejected(chain: Chain, category: str = "toxic"):
    k = chain.names.index(category)
    return F.col(f"p{k}") >= chain.thresholds[k]


def drop_toxic(docs: DataFrame, labels: DataFrame, category: str = "toxic", **kw) -> DataFrame:
    """``docs`` without the rows whose toxicity probability reaches the threshold, all columns and
    whole texts as they were. Rows with a null or empty text stay."""
    chain = train(docs, labels, **kw)
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    cols = ", ".join(f"p{k} double" for k in range(len(chain.names)))
    inner = docs.select(row_of(docs.columns).alias("row"), utf8("text").alias("_text"))
    scored = map_batches(inner, _score_batches(shared), with_fields(inner, cols))
    return scored.filter(~is_rejected(chain, category) | (F.trim(F.coalesce("row.text", F.lit(""))) == "")).select(*row_columns(docs.columns))


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    chain = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score(docs, chain)
    return out.select("doc_id", *[F.col(f"p{k}").alias(f"p_{n}") for k, n in enumerate(chain.names)],
                      is_rejected(chain).alias("toxic"))
