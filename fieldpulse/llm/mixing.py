"""Mixing to target weights by iterative proportional fitting.

Rows fall into cells of (source, language, topic). Fitting scales the cells' token weights to the
target share of each source, each language and each topic in turn until all three marginals hold.
A row is then kept with the calibrated probability of its cell, so that the expected tokens kept
follow the targets in every dimension at once.

The scale is a stated share of the tokens (``KEPT``), not the rarest cell: a cell is drawn with
probability 1 at most and the other cells are fitted to what remains. A value that holds less than its
target is kept whole and the others share the rest in the ratio of their targets; :func:`shortfalls`
lists such values.

One pass reads the texts (tokens and topic, no shuffle of text), one aggregate makes the cells. Cells
are few next to rows; up to ``MAX_LOCAL_CELLS`` of them are raked in numpy on the driver, beyond that
the same steps run as aggregates and joins.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm._common import map_batches, quoted, row_columns, row_of, staged, utf8, with_fields

DIMS = ("source", "lang", "topic")
#: Default targets: a value's share is its token share to this power (1 keeps the mix, 0 levels it).
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 0.5}
TOPICS = 8
MAX_LOCAL_CELLS = 200_000
ROUNDS, TOLERANCE = 200, 1e-9
#: Share of the tokens to keep.
KEPT = 0.5
#: No cell falls below this part of what its three values' targets alone would give it, also where the
#: targets contradict each other and fitting would take a cell to nothing.
FLOOR = 0.1
MAX_STEP, MAX_WEIGHT = 4.0, 1e9  # of a fitting step and of a weight
SEED = 20
NONE = "\x00"  # stands for a null source, language or topic, which is a value of its own


def topic_of(text: bytes, topics: int = TOPICS) -> int:
    """A text's topic: the hash class of its most frequent word of four bytes or more (ties: the
    least word); 0 if it has none."""
    counts = Counter(w for w in text.lower().split() if len(w) > 3)
    if not counts:
        return 0
    most = max(counts.values())
    return zlib.crc32(min(w for w, n in counts.items() if n == most)) % topics


def _token_batches(topics: int, given: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("_text").to_pylist()
            topic = b.column("_topic") if given else pa.array([str(topic_of(t, topics)) for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array([len(t.split()) for t in texts], pa.int64()), topic],
                                             names=["row", "n_tokens", "topic"])
    return run


def described(docs: DataFrame, keep: list[str], topics: int = TOPICS, topic: str | None = None) -> DataFrame:
    """``row`` (struct of the ``keep`` columns), ``n_tokens``, ``source``, ``lang``, ``topic`` (of the
    column that ``topic`` names, else :func:`topic_of` the text)."""
    src = docs.select(row_of(keep).alias("row"), utf8("text").alias("_text"),
                      *([F.coalesce(F.col(quoted(topic)).cast("string"), F.lit(NONE)).alias("_topic")] if topic else []))
    out = map_batches(src, _token_batches(topics, topic is not None), with_fields(src, "n_tokens long, topic string"))
    return out.withColumn("source", F.coalesce(F.col("row.source").cast("string"), F.lit(NONE))).withColumn(
        "lang", F.coalesce(F.col("row.lang").cast("string"), F.lit(NONE)))


def cells_of(described_rows: DataFrame) -> DataFrame:
    return described_rows.groupBy(*DIMS).agg(F.sum("n_tokens").cast("double").alias("tokens"))


def water_level(sums, budget: float) -> float:
    """The level at which ``min(tokens, level * share)`` adds up to ``budget`` over the values.
    ``sums(level)``: tokens of the values below it and shares of the others."""
    level = 0.0
    while True:
        whole, rest = sums(level)
        higher = (budget - whole) / rest if rest > 0 else 0.0
        if higher <= level * (1 + 1e-12):
            return level
        level = higher


def rake_local(keys: list[np.ndarray], tokens: np.ndarray, targets: list[np.ndarray], rounds: int = ROUNDS,
               tolerance: float = TOLERANCE, total: float | None = None, start: np.ndarray | None = None,
               low: np.ndarray | float = 0.0, most: float = np.inf) -> np.ndarray:
    """Weights of the cells. ``keys[d]`` numbers the cells' values in dimension d, ``targets[d]`` has
    the shares of those values in ``total``, which ``clip(weight, low, most) * tokens`` then follows. A
    value without tokens keeps its weight. Each step is a Newton step on the clipped sum; without
    bounds that is goal / sum."""
    weight, total = np.ones(len(tokens)) if start is None else start, tokens.sum() if total is None else total
    for _ in range(rounds):
        worst = 0.0
        for k, t in zip(keys, targets):
            n, goal = len(t), t * total
            free = (weight > low) & (weight < most)
            now = np.bincount(k, np.clip(weight, low, most) * tokens, n)
            loose = np.bincount(k, weight * tokens * free, n)
            held = now - loose
            newton = (loose > 0) & (goal > held)
            factor = np.divide(np.where(newton, goal - held, goal), np.where(newton, loose, now), out=np.ones(n), where=now > 0)
            if most < np.inf:
                some, least = (tokens > 0) & (weight > 0), np.full(n, np.inf)
                np.minimum.at(least, k[some], weight[some])
                whole = goal >= np.bincount(k, tokens * some, n) * most * (1 - 1e-9)
                factor = np.where(whole, np.maximum(1.0, most / least), np.clip(factor, 1 / MAX_STEP, MAX_STEP))
            factor = np.where((now > 0) & ((goal > 0) | (most == np.inf)), factor, 1.0)
            worst = max(worst, np.abs(np.divide(goal, now, out=np.ones(n), where=now > 0) - 1).max(initial=0.0))
            weight = np.minimum(weight * factor[k], MAX_WEIGHT)
        if worst < tolerance:
            break
    return weight


def _shares(values: list, tokens: np.ndarray, power: float, given: dict | None) -> np.ndarray:
    """Target shares of the values that have tokens: the given ones (missing: none) or tempered."""
    raw = np.array([float(given.get(v, 0.0)) for v in values]) if given is not None else np.where(tokens > 0, tokens, 0) ** power * (tokens > 0)
    raw = np.where(tokens > 0, raw, 0)
    return raw / raw.sum() if raw.sum() > 0 else raw


def _share_tables(cells: DataFrame, targets: dict | None, temper: dict) -> dict[str, DataFrame]:
    """``_shares`` as a table a dimension: value, ``share`` (values with tokens only)."""
    out = {}
    for d in DIMS:
        own = cells.groupBy(d).agg(F.sum("tokens").alias("t")).filter("t > 0")
        if targets and targets.get(d) is not None:
            given = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in targets[d].items()], "value string, raw double")
            own = own.join(given, own[d] == given["value"], "left").select(d, F.coalesce("raw", F.lit(0.0)).alias("raw"))
        else:
            own = own.select(d, F.pow("t", F.lit(temper[d])).alias("raw"))
        sum_raw = own.agg(F.sum("raw")).first()[0] or 1.0
        out[d] = staged(own.select(d, (F.col("raw") / F.lit(sum_raw)).alias("share")), "shares")
    return out


def rake_spread(cells: DataFrame, targets: dict | None, temper: dict, rounds: int, tolerance: float, kept: float = KEPT) -> DataFrame:
    """The same fitting as aggregates and joins, for any number of cells; each round is written to
    the shared folder."""
    cur = cells
    for d, shares in _share_tables(cells, targets, temper).items():
        # a value without tokens has no share and takes none away
        cur = cur.join(shares.withColumnRenamed("share", f"_{d}"), d, "left")
    wanted = F.lit(True)
    for d in DIMS:
        wanted = wanted & (F.coalesce(F.col(f"_{d}"), F.lit(1.0)) > 0)
    cur = staged(cur.withColumn("live", wanted), "cells")
    live = F.when(F.col("live"), F.col("tokens")).otherwise(0.0)
    everything, holds = (x or 0.0 for x in cur.agg(F.sum("tokens"), F.sum(live)).first())
    budget = min(kept * everything, holds)
    start = budget / holds if holds else 1.0
    goals, low = {}, F.lit(FLOOR * start)
    for d in DIMS:
        own = staged(cur.groupBy(d).agg(F.sum(live).alias("holds"), F.max(f"_{d}").alias("share")).filter("share > 0 AND holds > 0"), "goals")

        def sums(level):
            below = F.col("share") * F.lit(level) >= F.col("holds")
            return tuple(x or 0.0 for x in own.agg(F.sum(F.when(below, F.col("holds"))), F.sum(F.when(~below, F.col("share")))).first())

        goals[d] = own.select(d, "holds", F.least("holds", F.col("share") * F.lit(water_level(sums, budget))).alias("goal"))
        cur = cur.join(goals[d].select(d, F.least(F.lit(1.0), F.col("goal") / F.col("holds") / F.lit(start)).alias(f"r_{d}")), d, "left")
        low = low * F.coalesce(F.col(f"r_{d}"), F.lit(1.0))
    cur = staged(cur.select(*DIMS, "tokens", F.when(F.col("live"), F.lit(start)).otherwise(0.0).alias("weight"),
                            F.when(F.col("live"), low).otherwise(0.0).alias("low")), "cells")
    w, one = F.col("weight"), F.lit(1.0)
    drawn, free = F.least(one, F.greatest("low", w)), (w > F.col("low")) & (w < 1)
    for _ in range(rounds):
        worst = 0.0
        for d in DIMS:
            now = cur.groupBy(d).agg(F.sum(drawn * F.col("tokens")).alias("now"), F.sum(F.when(free, w * F.col("tokens")).otherwise(0.0)).alias("loose"),
                                     F.min(F.when((F.col("tokens") > 0) & (w > 0), w)).alias("least"))
            held = F.col("now") - F.col("loose")
            newton = (F.col("loose") > 0) & (F.col("goal") > held)
            step = F.when(newton, (F.col("goal") - held) / F.col("loose")).otherwise(F.col("goal") / F.col("now"))
            factor = F.when(F.col("goal") >= F.col("holds") * (1 - 1e-9), F.greatest(one, one / F.col("least"))).otherwise(
                F.least(F.lit(MAX_STEP), F.greatest(F.lit(1 / MAX_STEP), step)))
            changes = (F.col("now") > 0) & (F.col("goal") > 0)
            factors = staged(now.join(goals[d], d, "left").select(d, F.when(changes, factor).otherwise(1.0).alias("factor"),
                                                                  F.when(changes, F.abs(F.col("goal") / F.col("now") - 1)).alias("off")), "factors")
            worst = max(worst, factors.agg(F.max("off")).first()[0] or 0.0)
            cur = cur.join(factors.select(d, "factor"), d).withColumn("weight", F.least(F.lit(MAX_WEIGHT), w * F.col("factor"))).drop("factor")
        cur = staged(cur, "cells")
        if worst < tolerance:
            break
    return cur.withColumn("probability", drawn).drop("low")


def calibrated_cells(cells: DataFrame, targets: dict | None = None, temper: dict | None = None, rounds: int = ROUNDS,
                     tolerance: float = TOLERANCE, max_local_cells: int = MAX_LOCAL_CELLS, kept: float = KEPT) -> DataFrame:
    """Cells with ``weight`` and ``probability``, the weight within its bounds: ``kept`` of all tokens
    are expected to be drawn, and no cell is drawn more than it holds (a weight above 1 says that it
    would have been)."""
    if not 0 < kept <= 1:
        raise ValueError(f"kept is a share above 0 up to 1, not {kept}")
    temper = {**TEMPER, **(temper or {})}
    cells = staged(cells, "cells")
    n = cells.count()
    if n > max_local_cells:
        return rake_spread(cells, targets, temper, rounds, tolerance, kept).select(*DIMS, "tokens", "weight", "probability")
    rows = sorted(tuple(r) for r in cells.select(*DIMS, "tokens").collect())
    tokens = np.array([r[3] for r in rows], float)
    keys, shares, live = [], [], np.ones(len(rows), bool)
    for d, name in enumerate(DIMS):
        values = sorted({r[d] for r in rows})
        place = {v: i for i, v in enumerate(values)}
        keys.append(np.array([place[r[d]] for r in rows], np.int64))
        own = np.bincount(keys[-1], tokens, len(values)) if len(rows) else tokens
        shares.append(_shares(values, own, temper[name], (targets or {}).get(name)))
        live &= ((shares[-1] > 0) | (own <= 0))[keys[-1]]
    holds = float(tokens[live].sum())
    budget = min(kept * tokens.sum(), holds)
    start = budget / holds if holds else 1.0
    goals, low = [], np.where(live, FLOOR * start, 0.0)
    for k, share in zip(keys, shares):
        own = np.bincount(k, tokens * live, len(share)) if len(rows) else tokens

        def sums(level):
            below = share * level >= own
            return own[below & (share > 0)].sum(), share[~below].sum()

        goal = np.minimum(own, share * water_level(sums, budget))
        low = low * np.minimum(1.0, np.divide(goal, own * start, out=np.ones(len(goal)), where=own > 0))[k]
        goals.append(goal / (budget or 1.0))
    weight = rake_local(keys, tokens, goals, rounds, tolerance, budget, np.where(live, start, 0.0), low, 1.0)
    data = [(*r, float(w), float(p)) for r, w, p in zip(rows, weight, np.clip(weight, low, 1.0))]
    return cells.sparkSession.createDataFrame(data, "source string, lang string, topic string, tokens double, weight double, probability double")


def shortfalls(calibrated: DataFrame, targets: dict | None = None, temper: dict | None = None, kept: float = KEPT,
               tolerance: float = 1e-3) -> DataFrame:
    """``dimension``, ``value``, ``tokens``, ``wanted``, ``expected``: the values of which fewer tokens
    are expected than their target's share of what is to be kept."""
    budget = kept * (calibrated.agg(F.sum("tokens")).first()[0] or 0.0)
    out = None
    for d, shares in _share_tables(calibrated, targets, {**TEMPER, **(temper or {})}).items():
        own = calibrated.groupBy(d).agg(F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * F.col("probability")).alias("expected"))
        part = own.join(shares, d).select(F.lit(d).alias("dimension"), F.col(d).alias("value"), "tokens",
                                          (F.col("share") * F.lit(budget)).alias("wanted"), "expected")
        out = part if out is None else out.unionByName(part)
    return out.filter(F.col("expected") < F.col("wanted") * (1 - tolerance))


def uniform(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the values alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))


def mix(docs: DataFrame, keep: list[str] | None = None, targets: dict | None = None, temper: dict | None = None,
        topics: int = TOPICS, seed: int = SEED, topic: str | None = None, **kw) -> DataFrame:
    """Every row as ``row`` with source, lang, topic, n_tokens, weight, probability and ``sampled``.

    ``targets``: {dimension: {value: share}}; dimensions left out are tempered. ``kept``: the share of
    all tokens to keep; a value that holds less than its target is kept whole. ``topic``: the column of
    ``docs`` that holds the topics, if they are known. A null source, language or topic given is a value
    of its own. A null or empty text has no tokens and topic 0, and gets the
    weight of its cell. The draw depends on doc_id and text, so rows equal in both are drawn alike.
    """
    keep = keep or ["doc_id", "source", "lang", "text"]
    rows = described(docs, sorted({*keep, "doc_id", "source", "lang", "text"}, key=[*keep, "doc_id", "source", "lang", "text"].index), topics, topic)
    narrow = staged(rows.select("source", "lang", "topic", "n_tokens"), "tokens")
    cells = calibrated_cells(cells_of(narrow), targets, temper, **kw)
    drawn = uniform(seed, F.col("row.doc_id"), F.xxhash64("row.text")) < F.col("probability")
    return rows.join(cells.drop("tokens"), list(DIMS)).withColumn("sampled", drawn)


def sample_to_targets(docs: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that are drawn, all columns as they were."""
    out = mix(docs, keep=list(docs.columns), **kw).filter("sampled")
    return out.select(*row_columns(docs.columns))


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = staged(described(docs.withColumn("text_key", F.xxhash64("text")), ["doc_id", "source", "lang", "text_key"]), "described")
    cells = calibrated_cells(cells_of(rows)).drop("tokens")
    drawn = uniform(SEED, F.col("row.doc_id"), F.col("row.text_key")) < F.col("probability")
    none = lambda c: F.when(F.col(c) != NONE, F.col(c)).alias(c)
    return rows.join(cells, list(DIMS)).select("row.doc_id", none("source"), none("lang"), "topic", "n_tokens", "weight",
                                               "probability", drawn.alias("sampled"))
