"""SimHash against a plain computation and all pairs."""

import random
import re

import xxhash
from frames import awkward, clashing, values

from venuelens.llm import queries, simhash
from venuelens.llm.components import components

SF_DIR = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    """{node: smallest node reachable} by trying all pairs."""
    nodes = sorted(nodes)
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def near(a, b):
    return ((a ^ b) & (1 << 64) - 1).bit_count() <= 2


def expected(rows):
    prints = [(doc_id, plain_fingerprint(text)) for doc_id, text in rows]
    root = plain_components({fp for _, fp in prints}, near)
    least = {}
    for doc_id, fp in prints:
        if doc_id is not None:
            least[root[fp]] = min(doc_id, least.get(root[fp], doc_id))
    return sorted(((d, f"{fp:016x}", least.get(root[fp])) for d, fp in prints), key=repr)


def test_query_equals_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = values(queries.op4_simhash(spark, SF_DIR), "doc_id", "fingerprint", "component_id")
    assert got == expected(rows)
    assert any(d != c for d, _, c in got)


def test_links_of_few_and_many_near_fingerprints(spark):
    pick = random.Random(5)
    fps = {pick.getrandbits(64) for _ in range(150)}
    for _ in range(120):  # pairs and chains
        fps.add(pick.choice(sorted(fps)) ^ (1 << pick.randrange(64)) ^ (1 << pick.randrange(64)))
    centre = pick.getrandbits(64)
    crowd = {centre}
    while len(crowd) < 300:  # more in a variant than are joined by pairs
        crowd.add(centre ^ (1 << pick.randrange(32)) ^ (1 << pick.randrange(32)) ^ (1 << pick.randrange(32)))
    fps = sorted((f - (1 << 64) if f >> 63 else f) for f in fps | crowd)
    table = spark.createDataFrame([(f,) for f in fps], "fp long")
    linked = simhash.links(table)
    assert all(near(r.a, r.b) for r in linked.collect())
    assert simhash.variants(table).groupBy("key").count().where(f"count > {simhash.PAIRED}").count() > 0
    got = {r.node: r.root for r in components(linked).collect()}
    assert {f: got.get(f, f) for f in fps} == plain_components(fps, near)


def test_long_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(300)]
    hub = [(1000, 1000 + i) for i in range(1, 2000)]
    edges = spark.createDataFrame([*path, *hub, *hub, (5, 5), (None, 7)], "a long, b long")
    got = dict(values(components(edges), "node", "root"))
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(2000)}}


def test_awkward_rows(spark):
    docs = clashing(awkward(spark))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = simhash.near_duplicates(docs)
    assert values(got.select("doc_id", simhash.hex16(got.fp).alias("f"), "component_id"), "doc_id", "f", "component_id") == expected(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # 2 copies 1; 4, 5 and a row without an id are blank like 3; the other row without one has a text of its own.
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 3, 6, 7, 8, 9, None], key=repr)


def test_empty_table(spark):
    docs = awkward(spark).limit(0)
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs).columns == docs.columns


def test_long_text_equals_plain():
    text = " ".join(f"w{i % 977}x{i}" for i in range(70_000))
    assert simhash.fingerprint(text.encode()) & ((1 << 64) - 1) == plain_fingerprint(text)


def test_one_row_of_a_group_stays_whatever_its_ids(spark):
    text = "one two three four five six"
    rows = [(1, text), (1, text.upper()), (1, text), (None, text), (None, "other words stand here alone"), (None, "other words stand here alone"), (2, text)]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 2 and sorted([r.doc_id for r in got], key=repr) == [1, None]
