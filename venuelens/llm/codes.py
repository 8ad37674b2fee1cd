"""Vector code compression: integer product quantization by active-entry Lloyd rounds.

Vectors become integers and are cut into consecutive parts, each with a codebook of its own. A
part keeps the exact distance to its assigned entry. In the next round, a part whose entry did not
move compares only the entries that moved with that distance, since all others are as far as
before; a part whose entry moved is compared with all. Both take the lower index on a tie.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelens.llm.tables import commonest_length, finite, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Vectors compared with a codebook at a time.
SLICE = 4096


@dataclass(frozen=True)
class Settings:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024


def squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to the entries of a codebook."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    bound = 4 * most * most * max(1, x.shape[1])
    if bound >= 1 << 62:
        raise OverflowError("squared distances of these vectors do not fit a long")
    kind = np.float64 if bound < 1 << 53 else np.int64  # either holds every term exactly
    x, book = x.astype(kind), book.astype(kind)
    found = (x * x).sum(axis=1)[:, None] - 2 * (x @ book.T) + (book * book).sum(axis=1)
    return found.astype(np.int64)


def scanned(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of each row over the whole codebook."""
    near, far = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for at in range(0, len(x), SLICE):
        found = squares(x[at : at + SLICE], book)
        best = found.argmin(axis=1)
        near[at : at + SLICE], far[at : at + SLICE] = best, found[np.arange(len(best)), best]
    return near, far


def reassigned(
    x: np.ndarray, book: np.ndarray, moved: np.ndarray, near: np.ndarray, far: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """What ``scanned`` gives, from the assignment before the entries ``moved`` changed."""
    near, far = near.copy(), far.copy()
    lost = moved[near]
    near[lost], far[lost] = scanned(x[lost], book)
    active, fixed = np.flatnonzero(moved), np.flatnonzero(~lost)
    if len(active) and len(fixed):
        at, distance = scanned(x[fixed], book[active])
        entry = active[at]
        closer = (distance < far[fixed]) | ((distance == far[fixed]) & (entry < near[fixed]))
        near[fixed[closer]], far[fixed[closer]] = entry[closer], distance[closer]
    return near, far


def cuts(length: int, parts: int) -> list[slice]:
    """Consecutive parts, equal where the length allows."""
    ends = [length * p // parts for p in range(parts + 1)]
    return [slice(a, b) for a, b in zip(ends, ends[1:], strict=False)]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64).reshape(len(column), width)


def _lists(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel(), pa.int64()))


def assigned(state: DataFrame, books: list[np.ndarray], moved: list[np.ndarray] | None, length: int) -> DataFrame:
    """``state`` (x, near, far, ...) with every part assigned anew; without ``moved`` by a whole scan."""
    spans, width = cuts(length, len(books)), len(books)
    shared = state.sparkSession.sparkContext.broadcast((books, moved))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, moved = shared.value
        for batch in batches:
            x = _matrix(batch.column("x"), length)
            if moved is None:
                found = [scanned(x[:, s], book) for s, book in zip(spans, books, strict=True)]
            else:
                near, far = _matrix(batch.column("near"), width), _matrix(batch.column("far"), width)
                found = [
                    reassigned(x[:, s], book, of, near[:, p], far[:, p])
                    for p, (s, book, of) in enumerate(zip(spans, books, moved, strict=True))
                ]
            for name, i in (("near", 0), ("far", 1)):
                place = batch.schema.get_field_index(name)
                batch = batch.set_column(place, pa.field(name, pa.list_(pa.int64())), _lists(np.stack([f[i] for f in found], 1)))
            yield batch

    return state.mapInArrow(step, state.schema)


def moments(state: DataFrame, length: int, parts: int) -> DataFrame:
    """(part, entry, at, n, total): parts counted and their components summed by assigned entry.

    Every task sends one row an entry at most, which are added up on Spark.
    """
    spans = cuts(length, parts)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list] = {}
        for batch in batches:
            x, near = _matrix(batch.column("x"), length), _matrix(batch.column("near"), parts)
            for p, span in enumerate(spans):
                order = np.argsort(near[:, p], kind="stable")
                entries, starts, counts = np.unique(near[order, p], return_index=True, return_counts=True)
                if not len(entries):
                    continue
                totals = np.add.reduceat(x[order][:, span], starts, axis=0) if span.stop > span.start else np.zeros((len(entries), 0), np.int64)
                for entry, n, total in zip(entries.tolist(), counts.tolist(), totals, strict=True):
                    held = sums.setdefault((p, entry), [0, np.zeros(span.stop - span.start, np.int64)])
                    held[0] += n
                    held[1] += total
        keys = sorted(sums)
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([p for p, _ in keys], pa.int32()), "entry": pa.array([e for _, e in keys], pa.int32()),
                "n": pa.array([sums[k][0] for k in keys], pa.int64()),
                "totals": pa.array([sums[k][1].tolist() for k in keys], pa.list_(pa.int64())),
            }
        )

    each = state.select("x", "near").mapInArrow(partial, "part int, entry int, n long, totals array<long>")
    each = each.select("part", "entry", "n", F.posexplode("totals").alias("at", "total"))
    return each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def compressed(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", settings: Settings = Settings()
) -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, near, far), codebooks): codes and exact squared errors by part.

    Rows are left out whose vector is null or holds a null, NaN or infinite component, or is not of
    the table's commonest length (the longer on a tie). Codebooks begin as the parts of the
    rows with the smallest ids (null ids last, then by vector); fewer rows make fewer entries. Repeated
    rows count as often as they occur. Other columns are not carried. An empty table has empty codebooks.
    Raises OverflowError where squared distances would not fit a long.

    Codebooks hold ``entries`` x dimension numbers, whatever the number of vectors: they and the sums
    for them go through the driver.
    """
    x = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * settings.scale))
    kept = rows.where(finite(F.col(vector))).select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), x.alias("x"))
    none = F.array().cast("array<bigint>")
    kept = written(kept.select("*", none.alias("near"), none.alias("far")), "integers")
    length = commonest_length(kept, "x")
    kept = kept.where(F.size("x") == length)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(settings.entries).select("x").collect()
    started = np.array([r.x for r in first], np.int64).reshape(len(first), length)
    books = [started[:, s] for s in cuts(length, settings.parts)]
    state = written(assigned(kept, books, None, length), "assigned")
    for _ in range(settings.rounds if first else 0):
        moved = [np.zeros(len(first), bool) for _ in books]
        fresh = [book.copy() for book in books]
        for r in moments(state, length, settings.parts).collect():
            fresh[r.part][r.entry, r.at] = r.total // r.n
        for p, book in enumerate(books):
            moved[p] = (fresh[p] != book).any(axis=1)
        books = fresh
        if not any(of.any() for of in moved):
            break  # further rounds change nothing
        state = written(assigned(state, books, moved, length), "assigned")
    return state.select("vec_id", "label", "near", "far"), books


def fingerprint(books: list[np.ndarray]) -> str:
    """SHA-256 of all components as decimals with commas, by part, entry and place."""
    return hashlib.sha256(",".join(str(c) for book in books for c in book.ravel().tolist()).encode()).hexdigest()


def hex_code(near: Column) -> Column:
    """Two lowercase hexadecimal digits for each index."""
    return F.array_join(F.transform(near, lambda i: F.lpad(F.lower(F.hex(i)), 2, "0")), "")


def digest(found: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): errors summed over parts and over equal labels."""
    error = F.aggregate("far", F.lit(0).cast("long"), lambda a, b: a + b)
    each = found.select("vec_id", "label", hex_code(F.col("near")).alias("code"), error.alias("error"))
    of_label = each.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = each.join(of_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))


def oracle(settings: Settings = Settings()) -> str:
    """The digest over ``embeddings`` as SQL, for vectors of one length."""
    p, k = settings.parts, settings.entries
    steps = [
        f"""whole AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS num, vec_id, label,
         list_transform(embedding, lambda c: floor({settings.scale} * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
)""",
        f"""parts AS MATERIALIZED (
  SELECT num, part, list_slice(x, len(x) * part // {p} + 1, len(x) * (part + 1) // {p}) AS v
  FROM whole, (SELECT unnest(range({p})) AS part)
)""",
        f"book0 AS MATERIALIZED (SELECT part, num AS entry, v AS c FROM parts WHERE num < {k})",
    ]
    for turn in range(settings.rounds + 1):
        steps.append(f"""near{turn} AS MATERIALIZED (
  SELECT num, part, v, min({{'d': list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c),
                           'e': entry}}) AS best
  FROM parts JOIN book{turn} USING (part) GROUP BY num, part, v
)""")
        if turn < settings.rounds:
            steps.append(f"""book{turn + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m, c) AS c FROM book{turn} LEFT JOIN (
    SELECT part, e AS entry, list(m ORDER BY place) AS m FROM (
      SELECT part, best.e AS e, place, floor(sum(v[place]) / count(*)) AS m
      FROM near{turn}, (SELECT unnest(range(1, (SELECT max(len(v)) FROM parts) + 1)) AS place)
      WHERE place <= len(v) GROUP BY part, best.e, place
    ) GROUP BY part, e
  ) USING (part, entry)
)""")
    last = settings.rounds
    return f"""WITH {", ".join(steps)}, coded AS (
  SELECT num, string_agg(format('{{:02x}}', CAST(best.e AS BIGINT)), '' ORDER BY part) AS code,
         CAST(sum(best.d) AS BIGINT) AS error
  FROM near{last} GROUP BY num
), shown AS (
  SELECT sha256(string_agg(text, ',' ORDER BY part, entry)) AS codebooks_sha256 FROM (
    SELECT part, entry, array_to_string(list_transform(c, lambda n: CAST(CAST(n AS BIGINT) AS VARCHAR)), ',') AS text FROM book{last}
  )
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN whole USING (num), shown
"""
