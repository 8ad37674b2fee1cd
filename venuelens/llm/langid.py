"""Language by averaged embeddings of hashed subwords and a linear softmax, learned in numpy.

A text is lower-cased, everything but letters and numerals becomes one blank, and every run
of one to three characters, blanks included, is hashed to a bucket. The mean of the buckets'
embeddings goes through a linear softmax. After training, embeddings and weights multiply to
one table of class scores per bucket. A temperature, fitted on rows not trained on,
calibrates the probabilities, and a floor found there rejects doubtful predictions.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelens.llm.tables import shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNKNOWN = "und"
OTHER = re.compile(r"[\W\d_]+")
BITS = 15
LONGEST = 3
# Characters hashed at a time, so that a very long text needs no more memory.
PIECE = 1 << 20
RESULT = "lang_pred string, score double, accepted boolean"


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled rows learned from; one in five of them calibrates."""

    sample: int = 4_000
    width: int = 16
    epochs: int = 8
    batch: int = 64
    rate: float = 0.2
    precision: float = 0.99
    seed: int = 11


@dataclass(frozen=True)
class Model:
    languages: list[str]
    table: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float
    floor: float


def letters(text: str | None) -> str | None:
    """The text as it is hashed; None if it has no letter."""
    plain = f" {OTHER.sub(' ', (text or '').lower()).strip()} "
    return plain if any(map(str.isalpha, plain)) else None


def buckets(plain: str) -> Iterator[np.ndarray]:
    """Buckets of all runs of one to ``LONGEST`` characters, in pieces."""
    points = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), "<u4")
    for low in range(0, len(points), PIECE):
        piece = points[low : low + PIECE + LONGEST - 1]
        own = min(PIECE, len(points) - low)
        hashed = np.zeros(len(piece), np.uint32)
        for n in range(1, LONGEST + 1):
            if len(piece) < n:
                break
            hashed = (hashed[: len(piece) - n + 1] ^ piece[n - 1 :]) * np.uint32(0x9E3779B1)
            mixed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            yield (mixed[:own] >> np.uint32(32 - BITS)).astype(np.int64)


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and the share of its runs in each."""
    plain = letters(text)
    if plain is None:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    total = np.zeros(1 << BITS, np.int64)
    for found in buckets(plain):
        total += np.bincount(found, minlength=1 << BITS)
    used = np.flatnonzero(total)
    return used.astype(np.int32), (total[used] / total.sum()).astype(np.float32)


def _softmax(z):
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], names: list[str], settings: Settings = Settings()) -> Model:
    """Learn from bucket shares and language names. Without rows, nothing is ever predicted."""
    languages = sorted(set(names))
    if not languages:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0), 1.0, 1.0)
    y = np.searchsorted(languages, names)
    random = np.random.default_rng(settings.seed)
    order = random.permutation(len(rows))
    held = order[: len(rows) // 5]
    learned = order[len(held) :]
    k = len(languages)
    embedding = random.normal(0, 0.1, (1 << BITS, settings.width)).astype(np.float32)
    weights, bias = np.zeros((settings.width, k), np.float32), np.zeros(k, np.float32)
    total = max(1, settings.epochs * (-(-len(learned) // settings.batch)))
    step = 0
    for _ in range(settings.epochs):
        shuffled = random.permutation(learned)
        for low in range(0, len(shuffled), settings.batch):
            rate = settings.rate * (1 - step / total) * 10
            step += 1
            batch = shuffled[low : low + settings.batch]
            ids = np.concatenate([rows[i][0] for i in batch])
            share = np.concatenate([rows[i][1] for i in batch])
            row = np.repeat(np.arange(len(batch)), [len(rows[i][0]) for i in batch])
            active, local = np.unique(ids, return_inverse=True)
            dense = np.zeros((len(batch), len(active)), np.float32)
            dense[row, local] = share
            hidden = dense @ embedding[active]
            error = _softmax(hidden @ weights + bias)
            error[np.arange(len(batch)), y[batch]] -= 1
            error /= len(batch)
            back = error @ weights.T
            weights -= rate * hidden.T @ error
            bias -= settings.rate * error.sum(axis=0)
            # A bucket has a small share of a text: its step is scaled up to match.
            embedding[active] -= 50 * rate * (dense.T @ back)
    table = (embedding @ weights).astype(np.float64)
    model = Model(languages, table, bias, 1.0, 0.0)
    if len(held) == 0:
        return model
    z = np.stack([rows[i][1] @ table[rows[i][0]] for i in held]) + bias
    scales = np.geomspace(0.05, 20, 60)
    truth = y[held]
    loss = [-np.log(_softmax(z / t)[np.arange(len(held)), truth] + 1e-12).mean() for t in scales]
    temperature = float(scales[int(np.argmin(loss))])
    p = _softmax(z / temperature)
    return Model(languages, table, bias, temperature, _floor(p.max(axis=1), p.argmax(axis=1) == truth, settings.precision))


def _floor(confidence: np.ndarray, right: np.ndarray, precision: float) -> float:
    """The lowest confidence from which on predictions reach the precision."""
    order = np.argsort(-confidence)
    reached = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= precision
    return float(confidence[order][np.flatnonzero(reached)[-1]]) if reached.any() else 1.0


def predict(model: Model, text: str | None) -> tuple[str, float, bool]:
    """(language, calibrated probability, accepted); ('und', 0, False) without a letter."""
    plain = letters(text)
    if plain is None or not model.languages:
        return UNKNOWN, 0.0, False
    total = np.zeros(1 << BITS, np.int64)
    for found in buckets(plain):
        total += np.bincount(found, minlength=1 << BITS)
    p = _softmax(((total @ model.table / total.sum() + model.bias) / model.temperature)[None, :])[0]
    best = int(p.argmax())
    return model.languages[best], float(p[best]), bool(p[best] >= model.floor)


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", order_by: str = "doc_id", settings: Settings = Settings()
) -> Model:
    """Learn from at most ``settings.sample`` rows with a language, chosen by a hash of their id."""

    @F.pandas_udf("struct<ids:array<int>,shares:array<float>>")
    def shares(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [counted(x) for x in texts]
            yield pd.DataFrame({"ids": [a for a, _ in found], "shares": [b for _, b in found]})

    given = docs.where(F.col(lang).isNotNull() & F.col(order_by).isNotNull())
    ids = given.select(F.col(order_by).alias("id")).distinct()
    chosen = ids.orderBy(F.xxhash64("id"), "id").limit(settings.sample)
    rows = (
        given.select(F.col(order_by).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
        .join(F.broadcast(chosen), "id")
        .select("id", "lang", shares("text").alias("x"))
        .select("id", "lang", "x.ids", "x.shares")
        .orderBy("id", "lang", F.hash("ids"))
        .limit(settings.sample)
        .toPandas()
    )
    rows = rows[rows["ids"].map(len) > 0]
    found = [
        (np.asarray(a, np.int64), np.asarray(b, np.float32)) for a, b in zip(rows["ids"], rows["shares"], strict=True)
    ]
    return fit(found, rows["lang"].tolist(), settings)


def predicted(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct column (lang_pred, score, accepted) for a text column of ``docs``."""
    sent = shared(docs.sparkSession, model)

    @F.pandas_udf(RESULT)
    def computed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = cloudpickle.loads(sent.value)
        for texts in batches:
            yield pd.DataFrame([predict(model, x) for x in texts], columns=["lang_pred", "score", "accepted"])

    return computed(F.col(text))
