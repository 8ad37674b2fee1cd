"""Language, token counts and decontamination against plain computations."""

import random
import zlib

import public_tokenizers
import pytest
from frames import LONG, awkward, clashing, values
from tokenizers import Tokenizer

from venuelens.llm import decontaminate, langid, queries, tokens

SF_DIR = "/root/testdata/sf0.01"


def documents(spark, sf_dir=SF_DIR):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


# -- language ---------------------------------------------------------------
def test_language_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op3_language(spark, SF_DIR).collect()}
    rows = documents(spark)
    assert len(got) == len(rows)
    held = [r for r in rows if got[r.doc_id].held_out and r.lang is not None and any(map(str.isalpha, r.text or ""))]
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_awkward_rows(spark):
    docs = clashing(awkward(spark))
    model = langid.train(docs)
    got = docs.select("doc_id", langid.predicted(docs, model).alias("p")).select("doc_id", "p.*")
    found = {r.doc_id: r for r in got.where("doc_id is not null").collect()}
    assert {i: found[i].lang_pred for i in (3, 4, 5, 8)} == dict.fromkeys((3, 4, 5, 8), "und")
    assert found[1].lang_pred in model.languages and found[3].score == 0
    nothing = langid.train(docs.limit(0))
    assert langid.predict(nothing, "text") == ("und", 0.0, False)


def test_language_pieces_equal_whole(monkeypatch):
    text = langid.letters(LONG[:5000] + " çà et là")
    whole = sum(len(b) for b in langid.buckets(text)), sum(int(b.sum()) for b in langid.buckets(text))
    monkeypatch.setattr(langid, "PIECE", 97)
    assert whole == (sum(len(b) for b in langid.buckets(text)), sum(int(b.sum()) for b in langid.buckets(text)))


def test_rejection_floor_reaches_precision():
    import numpy as np

    confidence = np.array([0.9, 0.8, 0.7, 0.6, 0.5])
    assert langid._floor(confidence, np.array([1, 1, 0, 1, 0], bool), 0.75) == 0.6
    assert langid._floor(confidence, np.zeros(5, bool), 0.75) == 1.0


# -- token counts -----------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))


def test_counts_equal_library(spark, library):
    got = {r.doc_id: r for r in queries.op7_tokens(spark, SF_DIR).collect()}
    for r in documents(spark):
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert (got[r.doc_id].n_tokens, got[r.doc_id].over_limit) == (n, n > 2048)
        assert got[r.doc_id].n_bytes == len((r.text or "").encode())


def test_counts_of_odd_texts(library):
    counter = tokens.Counter(tokens.prove(public_tokenizers.path(queries.TOKENIZER)))
    pick = random.Random(3)
    signs = [chr(c) for c in (*range(9, 592), 0x3A3, 0x3C3, 0x130, 0x1E9E, 0x2028, 0x301, 0x4E00, 0x1F600, 0x660)]
    signs += ["<|endoftext|>", "<|startoftext|>", "'LL", "'s", "  "]
    texts = ["".join(pick.choice(signs) for _ in range(pick.randrange(40))) for _ in range(1500)]
    texts += ["", "a\x1cb", "ΟΔΟΣ ΟΔΟΣ.", "<|endoftext|", "ﬁ ſ K", "नमस्ते 東京"]
    for text in texts:
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)
    assert counter.count(None) == 0


def test_counts_of_awkward_rows(spark, library):
    docs = clashing(awkward(spark))
    counted = docs.withColumn("got", tokens.counted(docs, tokens.prove(public_tokenizers.path(queries.TOKENIZER))))
    for r in counted.collect():
        assert r.got == len(library.encode(r.text or "", add_special_tokens=False).ids)
    assert counted.limit(0).count() == 0


# -- decontamination --------------------------------------------------------
def plain_distance(pattern, text):
    """Least edit distance of the pattern to a part of the text, by the table."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        before, row[0] = row[0], 0
        for i, p in enumerate(pattern, 1):
            before, row[i] = row[i], min(before + (p != c), row[i] + 1, row[i - 1] + 1)
        best = min(best, row[-1])
    return best


def test_myers_equals_table():
    pick = random.Random(9)
    for _ in range(300):
        pattern = "".join(pick.choice("abc ") for _ in range(pick.randrange(1, 90)))
        text = "".join(pick.choice("abc ") for _ in range(pick.randrange(0, 120)))
        distance, stop = decontaminate.myers(pattern, text)
        assert distance == plain_distance(pattern, text)
        assert plain_distance(pattern, text[:stop]) == distance


def edited(pick, text, edits):
    for _ in range(edits):
        at = pick.randrange(len(text))
        text = pick.choice([text[:at] + text[at + 1 :], text[:at] + "q" + text[at:], text[:at] + "z" + text[at + 1 :]])
    return text


def test_matches_equal_brute_force(spark):
    pick = random.Random(4)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(pick.randrange(2, 7)))
    phrase = lambda n: " ".join(word() for _ in range(n))
    given = [(i, phrase(pick.randrange(4, 40))) for i in range(12)] + [(90, "it"), (91, ""), (92, None), (None, phrase(9))]
    texts = []
    for i in range(60):
        item = given[pick.randrange(12)][1]
        middle = edited(pick, item, pick.randrange(0, max(2, len(item) // 8)))
        texts.append((i, f"{phrase(20)} {middle.title()}, {phrase(20)}"))
    texts += [(70, None), (71, ""), (None, given[0][1]), (72, "bit it it"), (72, "bit it it")]
    docs = clashing(spark.createDataFrame(texts, "doc_id long, text string"))
    bench = spark.createDataFrame([*given, given[0]], "item_id long, text string")
    want = sorted(
        (
            (d, item.item_id, distance)
            for d, text in texts
            for item in decontaminate.items(given)
            if (distance := plain_distance(item.text, decontaminate.normal(text))) <= item.budget
        ),
        key=repr,
    )
    found = decontaminate.contaminated(docs, bench)
    assert values(found, "doc_id", "item_id", "distance") == want
    assert 30 < len(want) < len(texts) * 2
    for r in found.collect():
        if r.doc_id is not None and r.item_id is not None:
            part = decontaminate.normal(dict(texts)[r.doc_id])[r.start : r.stop]
            assert plain_distance(decontaminate.normal(dict(given)[r.item_id]), part) == r.distance
    in_blocks = [decontaminate.blocks(bench, size=n) for n in (100, 10_000)]
    assert len(in_blocks[0]) > 1 == len(in_blocks[1])
    assert sorted(map(repr, sum(in_blocks[0], []))) == sorted(map(repr, in_blocks[1][0]))
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    assert values(kept, "doc_id") == sorted(((d,) for d, t in texts if not any(w[0] == d for w in want)), key=repr)


def test_query_finds_the_planted_items(spark):
    got = {(r.doc_id, r.item_id) for r in queries.op9_decontaminate(spark, SF_DIR).collect()}
    bench = [(r.item_id, decontaminate.normal(r.text)) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    planted = {(d.doc_id, i) for d in documents(spark) for i, t in bench if t in decontaminate.normal(d.text)}
    assert planted and planted <= got


def test_empty_tables(spark):
    docs = awkward(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs, none).count() == 0
    assert decontaminate.keep_clean(docs, none).count() == docs.count()
    assert decontaminate.contaminated(docs.limit(0), none).count() == 0
