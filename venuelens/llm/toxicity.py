"""Toxicity by a factorization machine over hashed terms.

A text is the set of its hashed terms: words and word beginnings. The score is the logistic
of a bias, a weight per term, and a product of two factor vectors per pair of terms, which
learns pairs (an insult with a group mentioned) that weights alone cannot. Only terms whose
counts in the two classes differ beyond chance, alone or together with another term, are learned,
and sparse penalties take weights that do not help to zero, so the length of a text does not move
its score.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelens.llm.tables import shared, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = re.compile(r"[^\W_]+")
BEGINNING = 4
HASH_BITS = 22


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled rows learned from. A term is learned if its log-likelihood
    ratio between the classes is at least ``evidence``, and of these the ``terms`` with most; or
    if with another term it has ``pair_evidence`` more than either alone, which chance hardly gives
    to one of many million pairs. Of terms frequent enough for that the ``paired`` most frequent are tried."""

    sample: int = 10_000
    evidence: float = 12.0
    terms: int = 20_000
    pair_evidence: float = 40.0
    paired: int = 8_000
    factors: int = 4
    epochs: int = 30
    batch: int = 128
    rate: float = 0.1
    sparse: float = 1e-4
    sparse_factors: float = 1e-4
    seed: int = 7


@dataclass(frozen=True)
class Model:
    bias: float
    terms: np.ndarray  # hashed terms with any weight, sorted
    weights: np.ndarray
    factors: np.ndarray


def terms(text: str | None) -> set[int]:
    """Hashed words and beginnings of longer words; null gives none."""
    words = set(WORD.findall((text or "").lower()))
    words |= {"^" + w[:BEGINNING] for w in words if len(w) > BEGINNING}
    mask = (1 << HASH_BITS) - 1
    return {zlib.crc32(w.encode("utf-8", "replace")) & mask for w in words}


def _logistic(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _margins(bias, weights, factors, columns, starts):
    """Score before the logistic, and the factor sums, of rows given as runs of ``columns``."""
    if not len(columns):
        return np.full(len(starts) - 1, bias), np.zeros((len(starts) - 1, factors.shape[1]))
    lengths = np.diff(starts)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    linear = np.bincount(rows, weights[columns], len(lengths))
    v = factors[columns]
    sums = np.stack([np.bincount(rows, v[:, f], len(lengths)) for f in range(v.shape[1])], axis=1)
    squares = np.bincount(rows, (v * v).sum(axis=1), len(lengths))
    return bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums


def fit(rows: list[np.ndarray], labels: np.ndarray, settings: Settings = Settings()) -> Model:
    """Learn from hashed term sets and 0/1 labels by adaptive stochastic gradient steps.

    Without rows the score of every text is 0.5; with one class only, near that class.
    """
    empty = np.zeros(0, np.int64), np.zeros(0), np.zeros((0, settings.factors))
    n = len(rows)
    share = (float(labels.sum()) + 0.5) / (n + 1.0)
    prior = float(np.log(share / (1 - share)))
    if n == 0 or labels.min() == labels.max():
        return Model(prior, *empty)
    lengths = np.array([len(r) for r in rows])
    starts = np.concatenate([[0], np.cumsum(lengths)])
    known, columns = np.unique(np.concatenate(rows), return_inverse=True)
    if not len(known):
        return Model(prior, *empty)

    random = np.random.default_rng(settings.seed)
    bias, bias_sum = prior, 1e-8
    w, w_sum = np.zeros(len(known)), np.full(len(known), 1e-8)
    v = random.normal(0, 0.05, (len(known), settings.factors))
    v_sum = np.full(len(known), 1e-8)
    for _ in range(settings.epochs):
        order = random.permutation(n)
        for low in range(0, n, settings.batch):
            batch = order[low : low + settings.batch]
            sizes = starts[batch + 1] - starts[batch]
            cut = np.concatenate([[0], np.cumsum(sizes)])
            picked = np.repeat(starts[batch] - cut[:-1], sizes) + np.arange(cut[-1])
            active, local = np.unique(columns[picked], return_inverse=True)
            z, sums = _margins(bias, w[active], v[active], local, cut)
            error = (_logistic(z) - labels[batch]) / len(batch)
            bias_sum += error.sum() ** 2
            bias -= settings.rate * error.sum() / np.sqrt(bias_sum)
            row = np.repeat(np.arange(len(batch)), sizes)
            g = np.bincount(local, error[row], len(active))
            gv = np.stack(
                [np.bincount(local, (error[:, None] * sums)[row, f], len(active)) for f in range(v.shape[1])], axis=1
            ) - g[:, None] * v[active]
            w_sum[active] += g * g
            step = settings.rate / np.sqrt(w_sum[active])
            moved = w[active] - step * g
            w[active] = np.sign(moved) * np.maximum(np.abs(moved) - step * settings.sparse, 0)
            v_sum[active] += (gv * gv).mean(axis=1)
            step = settings.rate / np.sqrt(v_sum[active])
            moved = v[active] - step[:, None] * gv
            norm = np.sqrt((moved * moved).sum(axis=1)) + 1e-12
            v[active] = moved * np.maximum(1 - step * settings.sparse_factors / norm, 0)[:, None]
    used = (w != 0) | (v != 0).any(axis=1)
    z, _ = _margins(bias, w, v, columns, starts)
    return Model(float(bias - _cut(z, labels)), known[used], w[used], v[used])


def _cut(margins: np.ndarray, labels: np.ndarray) -> float:
    """The margin that parts the classes with fewest errors, in the middle of its widest gap."""
    order = np.argsort(margins, kind="stable")
    z, y = margins[order], labels[order]
    wrong = np.cumsum(y)[:-1] + (1 - y)[::-1].cumsum()[::-1][1:]
    gap = np.diff(z)
    wrong = np.where(gap > 0, wrong, np.inf)
    if not np.isfinite(wrong).any():
        return 0.0
    best = np.flatnonzero(wrong == wrong.min())
    low = best[np.argmax(gap[best])]
    return float((z[low] + z[low + 1]) / 2)


def predict(model: Model, rows: Iterable[set[int]]) -> np.ndarray:
    """Scores of term sets, from 0 to 1; the sets are taken one at a time."""
    place = {t: i for i, t in enumerate(model.terms.tolist())}
    found = [[place[t] for t in sorted(r) if t in place] for r in rows]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)])
    columns = np.array([i for x in found for i in x], np.int64)
    return _logistic(_margins(model.bias, model.weights, model.factors, columns, starts)[0])


def train(
    docs: DataFrame, labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    settings: Settings = Settings(),
) -> Model:
    """Learn from at most ``settings.sample`` labelled rows, chosen by a hash of their id.

    ``labelled`` has (doc_id, label); an id labelled more than once counts as toxic if any
    row says so, and null labels or ids are left out. Terms are counted by class on Spark, and
    only those that tell the classes apart, or are in rows enough for a telling pair, reach the driver.
    """
    chosen = (
        labelled.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("id"))
        .agg(F.max(F.col(label).cast("int")).alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(settings.sample)
    )

    @F.pandas_udf("array<int>")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([np.fromiter(terms(x), np.int32) for x in texts], dtype=object)

    # ``chosen`` has at most ``sample`` short rows.
    seen = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    # A text that is repeated with its id is learned from once.
    seen = seen.select("id", "y", F.array_sort(hashed("text")).alias("terms")).distinct()
    seen = written(seen.withColumn("row", F.struct("id", F.xxhash64("terms"))), "labelled")
    n, positive = seen.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    each = seen.select("row", "y", F.explode("terms").alias("term"))
    counts = each.groupBy("term").agg(F.sum("y").cast("double").alias("toxic"), F.count("*").cast("double").alias("all"))
    told = (
        counts.withColumn("ratio", _ratio(F.col("toxic"), F.col("all"), float(positive), float(n)))
        .where(F.col("ratio") >= settings.evidence)
        .orderBy(F.desc("ratio"), "term")
        .limit(settings.terms)
    )
    # A pair tells most if all rows of its rarer term in one class have it and none of the other class.
    pure = [(F.col("toxic"), F.col("toxic")), (F.lit(0.0), F.col("all") - F.col("toxic"))]
    most = F.greatest(*[_ratio(a, b, float(positive), float(n)) for a, b in pure])
    pairable = counts.where(most >= settings.pair_evidence).orderBy(F.desc("all"), "term").limit(settings.paired)
    marked = told.select("term", F.lit(True).alias("alone"), F.lit(False).alias("paired")).unionByName(
        pairable.select("term", F.lit(False).alias("alone"), F.lit(True).alias("paired"))
    )
    marked = marked.groupBy("term").agg(F.max("alone").alias("alone"), F.max("paired").alias("paired")).collect()
    if not marked:
        marked = [(-1, True, True)]
    # ``marked`` has at most ``terms`` and ``paired`` numbers.
    wanted = docs.sparkSession.createDataFrame([(t,) for t, *_ in marked], "term int")
    of_row = each.join(F.broadcast(wanted), "term").groupBy("row").agg(F.collect_list("term").alias("found"))
    rows = seen.select("row", "y").join(of_row, "row", "left").orderBy("row").limit(settings.sample).collect()
    found = [np.sort(np.asarray(r.found or [], np.int64)) for r in rows]
    labels = np.array([r.y for r in rows], float)
    together = in_telling_pairs(found, labels, np.array(sorted(t for t, _, p in marked if p), np.int64), settings)
    learned = np.union1d(np.array([t for t, a, _ in marked if a], np.int64), together)
    return fit([r[np.isin(r, learned)] for r in found], labels, settings)


def in_telling_pairs(
    rows: list[np.ndarray], labels: np.ndarray, tried: np.ndarray, settings: Settings = Settings()
) -> np.ndarray:
    """Terms of ``tried`` (sorted) that tell the classes apart together with another, beyond either alone."""
    if not len(tried) or not len(rows):
        return np.zeros(0, np.int64)
    has = np.zeros((len(rows), len(tried)), np.uint8)
    for i, row in enumerate(rows):
        has[i, np.searchsorted(tried, row[np.isin(row, tried)])] = 1
    toxic, n = labels == 1, float(len(rows))
    positive = float(toxic.sum())
    alone = _ratios(has[toxic].sum(axis=0, dtype=float), has.sum(axis=0, dtype=float), positive, n)
    ends, block = np.zeros(len(tried), bool), 512
    for low in range(0, len(tried), block):
        left = has[:, low : low + block].astype(np.float32)
        for at in range(low, len(tried), block):
            right = has[:, at : at + block].astype(np.float32)
            of_toxic = (left[toxic].T @ right[toxic]).astype(float)
            ratio = _ratios(of_toxic, of_toxic + left[~toxic].T @ right[~toxic], positive, n)
            more = ratio - np.maximum(alone[low : low + block, None], alone[None, at : at + block])
            a, b = np.nonzero(more >= settings.pair_evidence)
            ends[low + a] = ends[at + b] = True
    return tried[ends]


def _ratios(toxic: np.ndarray, all_: np.ndarray, positive: float, n: float) -> np.ndarray:
    """``_ratio`` of arrays of counts."""
    total = np.zeros(np.shape(all_))
    for count, rows, columns in (
        (toxic, positive, all_),
        (all_ - toxic, n - positive, all_),
        (positive - toxic, positive, n - all_),
        (n - positive - all_ + toxic, n - positive, n - all_),
    ):
        expected = rows * columns / n
        some = count > 0
        total += np.where(some, 2 * count * np.log(np.where(some, count, 1) / np.where(some, expected, 1)), 0.0)
    return total


def _ratio(toxic: Column, all_: Column, positive: float, n: float) -> Column:
    """Log-likelihood ratio of a term's counts in the two classes, if they did not differ."""
    total = F.lit(0.0)
    for count, rows, columns in (
        (toxic, positive, all_),
        (all_ - toxic, n - positive, all_),
        (F.lit(positive) - toxic, positive, n - all_),
        (F.lit(n - positive) - all_ + toxic, n - positive, n - all_),
    ):
        expected = F.lit(rows) * columns / F.lit(max(n, 1.0))
        total = total + F.when(count > 0, 2 * count * F.ln(count / expected)).otherwise(0.0)
    return total


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A column expression for the scores of a text column of ``docs``; null scores as empty."""
    sent = shared(docs.sparkSession, model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = cloudpickle.loads(sent.value)
        for texts in batches:
            yield pd.Series(predict(model, map(terms, texts)), dtype="float64")

    return scored(F.col(text))


def keep_clean(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score under the threshold, all columns as they are."""
    return docs.where(score(docs, model, text) < threshold)
