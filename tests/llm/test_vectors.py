"""Vector near-duplicates against all pairs."""

import dataclasses
import math

import numpy as np
from frames import values
from test_simhash import plain_components

from venuelens.llm import queries, vectors

SF_DIR = "/root/testdata/sf0.01"
NAMES = ("vec_id", "n_links", "component_id", "kept")


def expected(rows):
    """All pairs of sound vectors of one length, in double precision."""
    sound = {}
    for i, (vec_id, v) in enumerate(rows):
        if vec_id is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            u = np.array(v, float) / np.abs(v).max()
            sound[i] = u / np.linalg.norm(u)
    linked = lambda a, b: len(sound[a]) == len(sound[b]) and sound[a] @ sound[b] >= 0.95
    root = plain_components(sound, linked)
    least = {}
    for i, r in root.items():
        least[r] = min(rows[i][0], least.get(r, rows[i][0]))
    out = []
    for i, (vec_id, _) in enumerate(rows):
        n = sum(linked(i, j) for j in sound if j != i) if i in sound else 0
        component = least[root[i]] if i in sound else vec_id
        out.append((vec_id, n, component, vec_id is not None and vec_id == component))
    return sorted(out, key=repr)


def test_query_equals_all_pairs(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got = values(queries.op5_vectors(spark, SF_DIR), *NAMES)
    assert got == expected(rows)


def made(seed, n=400, width=8):
    """Clusters with vectors near the limit of linking, copies and scaled copies."""
    random = np.random.default_rng(seed)
    centres = random.normal(size=(6, width))
    x = centres[random.integers(0, 6, n)] + random.normal(0, 0.35, (n, width))
    x[50:60] = x[40:50]
    x[60:70] = x[40:50] * 7.5
    return [(int(i), [float(a) for a in v]) for i, v in zip(random.permutation(n), x, strict=True)]


def test_cells_and_blocks_lose_nothing(spark):
    rows = made(1)
    small = dataclasses.replace(vectors.Settings(), cell=20, members=13, queries=17, slice=5, sample=128)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert values(vectors.near_duplicates(table, settings=small), *NAMES) == expected(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.01]), (2, [1.0, 0.01]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [1e300, 1e300]),
        (11, [1e-300, 1e-300]), (12, [-1.0, -0.0]), (13, [-1.0, 0.0]), (14, [5.0, 0.0]),
    ]
    table = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, n_links int")
    got = vectors.near_duplicates(table)
    assert values(got, *NAMES) == expected(rows)


def test_empty_table(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_every_near_cell_is_visited():
    random = np.random.default_rng(4)
    x = vectors.unit(random.normal(size=(3000, 6)))
    centroids = vectors.spherical_kmeans(x, 40, 5, 1)
    home, visits = vectors.visited(x, centroids, 0.95)
    a, b = np.nonzero(x @ x.T >= 0.95)
    assert visits[a, home[b]].all() and visits.mean() < 0.7
