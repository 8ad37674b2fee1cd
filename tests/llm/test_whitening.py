"""Whitening against exact integer and numpy computations."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from venuelens.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def integers(vector):
    return tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector)


def check(rows, got, components=16):
    """All columns of the result, from distinct integer vectors with plain arithmetic."""
    kept = [(i, integers(v)) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in kept})
    n, d = len(fit), len(kept[0][1])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    centred = np.array([[n * x[j] - sums[j] for j in range(d)] for x in fit], float) / n
    v = centred.T @ centred / n
    shown = min(components, d)
    assert len(got) == len(kept) * shown
    values = np.linalg.eigvalsh(v)[::-1]
    of = {}
    for r in got:
        of.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
        assert r.n == n and abs(r.explained - values[r.component - 1] / np.trace(v)) < 1e-9 and r.identity_error < 1e-6
    white = {}
    for i, x in kept:
        parts = of[i, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))]
        assert sorted(parts) == list(range(1, shown + 1))
        if len(set(parts[1])) == 1:  # else another row's deviation is the same
            white[x] = [parts[c][0].whitened for c in sorted(parts)]
    w = np.array([white[x] for x in fit])
    assert np.abs(w.T @ w / n - np.eye(shown)).max() < 1e-6 and np.abs(w.mean(axis=0)).max() < 1e-9
    # The projections are on eigenvectors: rows differ as the eigenvectors say, up to the sign of a component.
    axes = np.linalg.lstsq(centred, w * np.sqrt(values[:shown]), rcond=None)[0]
    assert np.abs(v @ axes - axes * values[:shown]).max() < 1e-6 * values[0]


def test_scatter_is_exact():
    random_ = np.random.default_rng(1)
    for n, d, most in ((1, 3, 5), (64, 4, 2), (65, 5, 1000), (300, 3, 1 << 40), (7, 2, 1 << 62)):
        x = random_.integers(-most, most, (n, d)) + 1_000_000
        x[:, 0] = 7  # no variance
        sums, cross = whitening.scatter(x)
        big = x.astype(object)
        assert sums.tolist() == big.sum(axis=0).tolist() and cross.tolist() == (big.T @ big).tolist()


def test_planes_hold_every_bit():
    y = np.array([[0, 5], [1, 2], [0, 7]], np.uint64)
    words, of, bits = whitening.planes(y)
    assert of.tolist() == [0, 1, 1, 1] and bits.tolist() == [0, 0, 1, 2]
    assert [int(np.bitwise_count(w).sum()) for w in words] == [1, 2, 2, 2]


def test_copies_count_once_and_rows_stay(spark):
    pick = random.Random(9)
    base = [[pick.gauss(0, 1 + j / 3) for j in range(20)] for _ in range(120)]
    rows = [(i, v, 1) for i, v in enumerate(base)] + [(1000 + i, base[3], 2) for i in range(200)]
    rows += [(5, base[5], None), (None, [0.5] * 20, 1), (-1, None, 1), (-2, [None] * 20, 1), (-3, [float("nan")] * 20, 1), (-4, [float("-inf")] * 20, 1)]
    check(rows, whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect())


def test_mean_far_from_zero_costs_nothing(spark):
    pick = random.Random(2)
    rows = [(i, [30_000.0 + pick.random(), -9_000.0 + 40 * pick.random(), pick.random()], 1) for i in range(400)]
    check(rows, whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect())


def test_no_variance_no_rows_and_clashing_names(spark):
    rows = spark.createDataFrame([(1, [0.5, 0.25], 1), (2, [0.5, 0.25], 1), (3, [1.0], 1)], SCHEMA)
    rows = rows.withColumns({n: F.lit("own") for n in ("x", "n", "component", "whitened", "p", "place")})
    got = whitening.whitened(rows).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in got] == [(1, 1, 1, 0), (1, 2, 1, 0), (2, 1, 1, 0), (2, 2, 1, 0)]
    assert {(r.whitened, r.explained, r.identity_error) for r in got} == {(None, None, None)}
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0], 1) for i in range(9)], SCHEMA)
    got = whitening.whitened(line).collect()
    assert {r.component for r in got if r.whitened is None} == {2, 3} and max(r.explained for r in got) > 0.999
    assert whitening.whitened(rows.limit(0)).count() == 0


def test_query_whitens_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(rows, queries.op13_whitening(spark, sf_dir).collect())
