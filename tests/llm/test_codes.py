"""Vector codes against whole rescans in plain Python, and against SQL."""

import hashlib
import math
import random

import numpy as np
from harness import connect, difference, oracle_result, spark_result
from pyspark.sql import functions as F

from venuelens.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, entries, rounds=4, parts=4, scale=1024):
    """{(row number): (code, error)} and the codebooks, every part compared with every entry each round."""
    kept = sorted(
        [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])],
        key=lambda r: (r[0] is None, r[0] or 0, r[1]),
    )
    x = [[math.floor(scale * float(np.float32(c))) for c in r[1]] for r in kept]
    width = len(x[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for v in x] for p in range(parts)]
    books = [[list(v) for v in cut[p][:entries]] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            found = [nearest(v, books[p])[1] for v in cut[p]]
            for e in range(len(books[p])):
                own = [v for v, i in zip(cut[p], found, strict=True) if i == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out = []
    for at, r in enumerate(kept):
        best = [nearest(cut[p][at], books[p]) for p in range(parts)]
        out.append((r[0], "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best), r[2]))
    flat = ",".join(str(c) for book in books for entry in book for c in entry)
    return out, hashlib.sha256(flat.encode()).hexdigest()


def with_label_errors(found, sha):
    totals = {}
    for _, _, error, label in found:
        totals[label] = totals.get(label, 0) + error
    return sorted(((i, code, error, totals[label], sha) for i, code, error, label in found), key=repr)


def got(spark, rows, entries):
    out = codes.digest(*codes.compressed(spark.createDataFrame(rows, SCHEMA), settings=codes.Settings(entries=entries)))
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_equals_whole_rescans(spark):
    pick = random.Random(4)
    rows = [(i, [pick.choice([-0.01, 0.0, 0.002, 0.5, -0.7]) + pick.random() / 50 for _ in range(8)], pick.choice([None, 1, 2])) for i in range(150)]
    rows += [(200 + i, rows[0][1], 1) for i in range(60)] + [(i, rows[i][1], None) for i in range(5)]  # copies, repeated ids
    rows += [(None, [0.25] * 8, 3), (-4, [0.1, None] * 4, 1), (-5, [float("nan")] * 8, 1), (-6, [float("inf")] * 8, 1), (-7, None, 1), (-8, [0.1] * 4, 1)]
    for entries in (1, 7, 256):
        assert got(spark, rows, entries) == with_label_errors(*plain([r for r in rows if r[0] != -8], entries))


def test_active_entries_give_what_a_scan_gives():
    random_ = np.random.default_rng(2)
    for _ in range(60):
        x = random_.integers(-6, 6, (80, 3))
        before = random_.integers(-6, 6, (9, 3))
        near, far = codes.scanned(x, before)
        after, moved = before.copy(), random_.random(9) < random_.choice([0.0, 0.2, 0.6, 1.0])
        after[moved] = random_.integers(-6, 6, (int(moved.sum()), 3))
        assert all(np.array_equal(a, b) for a, b in zip(codes.reassigned(x, after, moved, near, far), codes.scanned(x, after), strict=True))


def test_large_components_are_exact_or_refused():
    x = np.array([[1 << 28, 3], [-(1 << 28), 5]])
    assert codes.scanned(x, np.array([[(1 << 28) - 1, 0]]))[1].tolist() == [10, (2 ** 29 - 1) ** 2 + 25]
    try:
        codes.scanned(np.array([[1 << 40]]), np.array([[0]]))
    except OverflowError:
        return
    raise AssertionError


def test_no_rows_and_clashing_names(spark):
    rows = spark.createDataFrame([(1, [0.5] * 4, 1), (2, [0.25] * 4, None)], SCHEMA)
    rows = rows.withColumns({n: F.lit("own") for n in ("x", "near", "far", "error", "code", "of")})
    found, books = codes.compressed(rows)
    assert [r.code for r in codes.digest(found, books).orderBy("vec_id").collect()] == ["00" * 4, "01" * 4]
    assert codes.digest(*codes.compressed(rows.limit(0))).count() == 0


def test_sql_equals_whole_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    out = codes.digest(*codes.compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
    assert difference(spark_result(out), oracle_result(connect(sf_dir), codes.oracle())) is None
