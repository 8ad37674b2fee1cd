"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one kept per group.

Vectors are assigned to the nearest of a set of unit centroids. A vector is compared with the
members of its own cell and of every cell that can hold a vector within the angle: a member
of another cell lies beyond the plane between the two centroids, so only cells whose plane
is within the angle matter. No link is lost by the cells.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelens.llm.components import components
from venuelens.llm.tables import hashed_sample, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the vectors the centroids are fitted on. A cell holds about ``cell``
    vectors as long as ``most_cells`` allows; a product compares ``queries`` with ``members``.
    ``reach`` scales how far beyond a plane is looked: 1 loses nothing."""

    cosine: float = 0.95
    sample: int = 8_192
    cell: int = 4_096
    most_cells: int = 512
    rounds: int = 8
    members: int = 4_096
    queries: int = 8_192
    slice: int = 512
    reach: float = 1.0
    seed: int = 3


def comparable(vector: Column) -> Column:
    """False for null and zero vectors and those with null or non-finite components."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, by their largest component first."""
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Unit centroids of unit rows; a cell that empties keeps its centroid."""
    random = np.random.default_rng(seed)
    centroids = x[random.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(rounds):
        cell = (x @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, cell, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centroids)
    return centroids


def visited(x: np.ndarray, centroids: np.ndarray, cosine: float, reach: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """(home cell, rows x cells: may the cell hold a vector within the angle) of unit rows."""
    near = x @ centroids.T
    home = near.argmax(axis=1)
    between = np.sqrt(np.maximum(2 - 2 * centroids @ centroids.T, 0))
    beyond = near[np.arange(len(x)), home][:, None] - near
    sine = math.sqrt(max(0.0, 1 - cosine * cosine)) if cosine > 0 else 1.0
    return home, beyond <= reach * sine * between[home] + 1e-9


class Forest:
    """Groups of numbered nodes under links that come in batches."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def _find(self, nodes: np.ndarray) -> np.ndarray:
        while True:
            up = self.root[self.root]
            if (up == self.root).all():
                return self.root[nodes]
            self.root = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self._find(a), self._find(b)
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))


def compared(block: pd.DataFrame, cosine: float, piece: int) -> pd.DataFrame:
    """(rep, links, root) of one block: rows of other ids linked to each query, and a node of its group."""
    members = block[~block["asks"]]
    asking = block[block["asks"]]
    if members.empty or asking.empty:
        return pd.DataFrame({"rep": [], "links": [], "root": []}, dtype="int64")
    h = unit(np.stack(members["v"].to_numpy()).astype(np.float64))
    q = unit(np.stack(asking["v"].to_numpy()).astype(np.float64))
    copies = members["n"].to_numpy(np.float64)
    named, asked = members["rep"].to_numpy(), asking["rep"].to_numpy()
    forest, links = Forest(len(q) + len(h)), np.zeros(len(q), np.int64)
    for low in range(0, len(q), piece):
        near = q[low : low + piece] @ h.T >= cosine
        a, b = np.nonzero(near)
        near &= asked[low : low + piece, None] != named[None, :]
        links[low : low + piece] = np.rint(near @ copies)
        forest.link(a + low, b + len(q))
    reps = np.concatenate([asked, named])
    root = forest._find(np.arange(len(reps)))
    out = pd.DataFrame(
        {"rep": reps, "links": np.concatenate([links, np.zeros(len(h), np.int64)]), "root": reps[root]}
    )
    return out[(out["links"] > 0) | (out["rep"] != out["root"])]


def _blocks(total: Column, most: int) -> Column:
    return F.greatest(F.ceil(total / most), F.lit(1))


def near_duplicates(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``rows``.

    Equal vectors are compared once, with their number of copies; n_links counts the other
    rows linked directly. Vectors that cannot be compared link with nothing, and vectors of
    different lengths do not link. A row without an id does not take part: it has no
    links, a null component and is not kept. Rows repeated with an id stay repeated; an id
    that is the smallest of several vectors has the links of all of them.
    """
    spark = rows.sparkSession
    given = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    fit_for = comparable(F.col("v")) & F.col("vec_id").isNotNull()
    given = given.withColumn("v", F.when(fit_for, F.col("v")))
    classes = given.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    classes = written(classes.withColumn("size", F.size("v")), "vectors")

    sizes = {r["size"]: r["count"] for r in classes.groupBy("size").count().orderBy(F.desc("count")).limit(64).collect()}
    cells = {}
    for size, count in sizes.items():
        sample = hashed_sample(classes.where(F.col("size") == size), "rep", settings.sample, count)
        x = unit(np.stack([np.asarray(r.v) for r in sample.select("v").collect()]))
        k = max(1, min(settings.most_cells, -(-count // settings.cell), len(x)))
        cells[size] = spherical_kmeans(x, k, settings.rounds, settings.seed)
    shared = spark.sparkContext.broadcast(cells)

    @F.pandas_udf("struct<home:int,visits:array<int>>")
    def assigned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for vectors in batches:
            home, visits = np.zeros(len(vectors), np.int32), [[0]] * len(vectors)
            lengths = vectors.map(len).to_numpy()
            for size in np.unique(lengths):
                centroids = shared.value.get(int(size))
                if centroids is None:
                    continue  # rare lengths have one cell
                at = np.flatnonzero(lengths == size)
                own, seen = visited(
                    unit(np.stack(vectors.iloc[at].to_numpy())), centroids, settings.cosine, settings.reach
                )
                home[at] = own
                for i, row in zip(at, seen, strict=True):
                    visits[i] = np.flatnonzero(row).astype(np.int32)
            yield pd.DataFrame({"home": home, "visits": visits})

    placed = written(classes.withColumn("cell", assigned("v")).select("*", "cell.home", "cell.visits").drop("cell"), "cells")
    asking = placed.select("rep", "n", "v", "size", F.explode("visits").alias("cell"), F.lit(True).alias("asks"))
    members = placed.select("rep", "n", "v", "size", F.col("home").alias("cell"), F.lit(False).alias("asks"))
    count = F.count(F.lit(1))
    totals = (
        members.groupBy("size", "cell").agg(count.alias("m"))
        .join(asking.groupBy("size", "cell").agg(count.alias("q")), ["size", "cell"])
        .select("size", "cell", _blocks(F.col("m"), settings.members).alias("m"), _blocks(F.col("q"), settings.queries).alias("q"))
    )
    totals = written(totals, "blocks")

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        mixed = F.pmod(F.xxhash64("rep", F.lit(17)), F.col(own)).alias(f"{own}_block")
        return side.join(totals, ["size", "cell"]).select(
            "rep", "n", "v", "asks", "size", "cell", mixed,
            F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(f"{other}_block"),
        )

    blocks = dealt(members, "m", "q").unionByName(dealt(asking, "q", "m"))
    cosine, piece = settings.cosine, settings.slice

    def products(block: pd.DataFrame) -> pd.DataFrame:
        return compared(block, cosine, piece)

    found = blocks.groupBy("size", "cell", "m_block", "q_block").applyInPandas(products, "rep long, links long, root long")
    found = written(found, "links")
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    of_class = classes.join(linked, "rep", "left").join(joined, F.col("rep") == F.col("node"), "left")
    links = F.coalesce("links", F.lit(0)) + F.col("n") - 1
    of_class = of_class.select("v", links.alias("links"), F.coalesce("root", "rep").alias("component_id"))
    result = given.join(written(of_class, "classes"), "v", "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
