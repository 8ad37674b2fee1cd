"""Embedding whitening from a bit-sliced scatter matrix.

Vectors become integers. In each block of distinct vectors, every dimension is shifted by its least
value and its bits are packed across the rows, one word for 64 rows of a bit. The cross-product of two
dimensions is then the sum of AND-popcounts over their planes, weighted with powers of two: exact, and
added up over blocks as integers. They are centred as integers too, and only then divided for the
eigenvectors, so that a mean far from zero costs no precision.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelens.llm.tables import commonest_length, finite, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows that are packed at a time.
BLOCK = 8192


@dataclass(frozen=True)
class Settings:
    scale: int = 64
    offset: int = 1_000_000
    components: int = 16


@dataclass(frozen=True)
class Fit:
    """Exact moments of the fit list, and the components found from them."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # a column for each
    trace: float
    rank: int  # eigenvalues that are not zero but for rounding


def planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, dimension, bit) of the bit planes of unsigned rows, ordered by dimension."""
    widths = [int(m).bit_length() for m in y.max(axis=0)]
    rows = -(-len(y) // 64) * 64
    padded = np.zeros((y.shape[1], rows), np.uint64)
    padded[:, : len(y)] = y.T
    words, of, bits = [], [], []
    for bit in range(max(widths, default=0)):
        some = np.flatnonzero(np.array(widths) > bit)
        ones = ((padded[some] >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        words.append(np.packbits(ones, axis=1).view(np.uint64))
        of.append(some)
        bits.append(np.full(len(some), bit))
    if not words:
        return np.zeros((0, rows // 64), np.uint64), np.zeros(0, int), np.zeros(0, int)
    of, bits = np.concatenate(of), np.concatenate(bits)
    order = np.lexsort((bits, of))
    return np.concatenate(words)[order], of[order], bits[order]


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, cross-products) of integer rows, as exact Python integers."""
    n, d = x.shape
    low = x.min(axis=0)
    y = x.astype(np.uint64) - low.astype(np.uint64)  # modulo 2 ** 64, which holds every difference
    words, of, bits = planes(y)
    sums, cross = np.zeros(d, object), np.zeros((d, d), object)
    if len(of):
        counts = np.zeros((len(of), len(of)), np.int64)
        for k in range(len(of)):
            counts[k, k:] = np.bitwise_count(words[k:] & words[k]).sum(axis=1, dtype=np.int64)
        counts = np.triu(counts) + np.triu(counts, 1).T
        fits = 2 * int(bits.max()) + 2 + int(n).bit_length() < 63
        weight = np.array([1 << b for b in bits.tolist()], np.int64 if fits else object)
        held, starts = np.unique(of, return_index=True)
        weighted = counts * weight[:, None] * weight[None, :]
        cross[np.ix_(held, held)] = np.add.reduceat(np.add.reduceat(weighted, starts, axis=0), starts, axis=1).astype(object)
        sums[held] = np.add.reduceat(np.diag(counts) * weight, starts).astype(object)
    # Back from the block's own shift.
    low = low.astype(object)
    cross = cross + np.outer(low, sums) + np.outer(sums, low) + n * np.outer(low, low)
    return sums + n * low, cross


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64).reshape(len(column), width)


def moments(distinct: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, cross-products) of the vectors ``x`` of a table.

    Every task sends one row for each pair of dimensions, added up on Spark: what the driver gets depends on the
    dimension only.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, np.zeros(width, object), np.zeros((width, width), object)
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            for at in range(0, len(x), BLOCK):
                block = x[at : at + BLOCK]
                s, c = scatter(block)
                n, sums, cross = n + len(block), sums + s, cross + c
        rows = [(-1, -1, n)] if n else []
        rows += [(i, -1, sums[i]) for i in range(width) if n]
        rows += [(i, j, cross[i, j]) for i in range(width) for j in range(i, width) if n]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        i, j, total = (list(c) for c in columns)
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()),
             "total": pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))}
        )

    found = distinct.select("x").mapInArrow(partial, "i int, j int, total decimal(38,0)")
    n, sums, cross = 0, [0] * width, [[0] * width for _ in range(width)]
    for r in found.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        if r.i < 0:
            n = int(r.total)
        elif r.j < 0:
            sums[r.i] = int(r.total)
        else:
            cross[r.i][r.j] = cross[r.j][r.i] = int(r.total)
    return n, sums, cross


def fit(distinct: DataFrame, width: int) -> Fit:
    """Components of the distinct vectors ``x``, of ``width`` entries each."""
    n, sums, cross = moments(distinct, width)
    if not n or not width:
        return Fit(n, sums, np.zeros(0), np.zeros((width, 0)), 0.0, 0)
    # n * n times the covariance, exact.
    centred = [[n * cross[i][j] - sums[i] * sums[j] for j in range(width)] for i in range(width)]
    covariance = np.array([[c / (n * n) for c in row] for row in centred])
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = int((values > values[0] * width * np.finfo(float).eps).sum()) if values[0] > 0 else 0
    return Fit(n, sums, values, vectors, sum(centred[i][i] for i in range(width)) / (n * n), rank)


def projected(docs: DataFrame, found: Fit, x: Column, components: int) -> Column:
    """A struct (deviation, whitened) for each vector ``x``, by the first ``components``.

    Components without variance are null.
    """
    used = min(components, found.rank)
    shown = min(components, len(found.values))
    scaled = found.vectors[:, :used] / np.sqrt(found.values[:used])
    shared = docs.sparkSession.sparkContext.broadcast((found.n, found.sums, scaled))
    width = len(found.sums)
    kind = pa.struct([("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])

    @F.arrow_udf("deviation long, whitened array<double>")
    def computed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        n, sums, scaled = shared.value
        for lists in batches:
            x = _matrix(lists, width)
            most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
            exact = np.int64 if most * most * max(width, 1) < 1 << 62 else object
            centred = x.astype(exact) * n - np.array(sums, exact)
            deviation = (centred * centred).sum(axis=1)
            white = (centred / n).astype(np.float64) @ scaled
            rows = [[*w, *[None] * (shown - used)] for w in white.tolist()]
            yield pa.StructArray.from_arrays(
                [pa.array(deviation.tolist(), pa.int64()), pa.array(rows, pa.list_(pa.float64()))], fields=list(kind)
            )

    return computed(x)


def identity_error(distinct: DataFrame, found: Fit, components: int) -> float | None:
    """The largest entry of the covariance of the whitened fit list less the identity; null without variance."""
    used = min(components, found.rank)
    if not used:
        return None
    white = distinct.select(projected(distinct, found, F.col("x"), components)["whitened"].alias("w"))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, cross = np.zeros(used), np.zeros((used, used))
        for batch in batches:
            w = np.array([row[:used] for row in batch.column("w").to_pylist()], float).reshape(-1, used)
            sums, cross = sums + w.sum(axis=0), cross + w.T @ w
        i, j = np.indices((used, used))
        yield pa.RecordBatch.from_pydict(
            {"i": np.concatenate([i.ravel(), np.arange(used)]).astype(np.int32),
             "j": np.concatenate([j.ravel(), np.full(used, -1)]).astype(np.int32),
             "total": np.concatenate([cross.ravel(), sums])}
        )

    mean, second = np.zeros(used), np.zeros((used, used))
    for r in white.mapInArrow(partial, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        if r.j < 0:
            mean[r.i] = r.total / found.n
        else:
            second[r.i, r.j] = r.total / found.n
    # The projections are centred already; what rounding left of their mean is taken out.
    return float(np.abs(second - np.outer(mean, mean) - np.eye(used)).max())


def whitened(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for each vector and component.

    Rows are left out whose vector is null or holds a null, NaN or infinite entry, or is not of the
    table's commonest length (the longer on a tie). Vectors that are equal as integers count once for
    the fit, however many rows have them; every row is returned, repeated rows and rows without an id
    too. A component without variance (fewer distinct vectors than dimensions) is null, and without any
    variance so are explained and identity_error. Other columns are not carried; an empty table gives no rows.
    Integers that do not fit a long are an error.
    """
    x = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * settings.scale) + settings.offset)
    given = rows.where(finite(F.col(vector))).select(F.col(vec_id).alias("vec_id"), x.alias("x"))
    distinct = written(given.select("x").distinct(), "distinct")
    length = commonest_length(given, "x")
    given, distinct = given.where(F.size("x") == length), distinct.where(F.size("x") == length)
    found = fit(distinct, length)
    error = identity_error(distinct, found, settings.components)
    white = given.select("vec_id", projected(given, found, F.col("x"), settings.components).alias("p"))
    shares = [float(v) / found.trace if found.trace else None for v in found.values[: settings.components]]
    explained = F.array(*[F.lit(s).cast("double") for s in shares]) if shares else F.array().cast("array<double>")
    each = white.select("vec_id", "p.deviation", F.posexplode("p.whitened").alias("place", "whitened"))
    return each.select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(found.n).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("place")].alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
