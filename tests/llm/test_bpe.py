"""Byte-pair encoding against the library and against merging by repeated search."""

import hashlib
import random

import numpy as np
import pytest
from frames import awkward, clashing
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from venuelens.llm import bpe, queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def source():
    return bpe.load(queries.tokenizer_path(queries.BYTE_TOKENIZER))


@pytest.fixture(scope="module")
def coder(source):
    return bpe.Coder(source)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.tokenizer_path(queries.BYTE_TOKENIZER))


def searched(symbols, ranks, made):
    """Merge the leftmost pair of the lowest rank until none is left, searching all pairs each time."""
    ids = list(symbols)
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in ranks]
        if not found:
            return ids
        rank, i = min(found)
        ids[i : i + 2] = [made[rank]]


def test_tree_merges_as_repeated_search():
    pick = random.Random(3)
    for _ in range(400):
        letters = pick.randint(1, 4)
        pairs = [(a, b) for a in range(12) for b in range(12)]
        pick.shuffle(pairs)
        pairs = pairs[: pick.randint(0, 60)]
        ranks = {p: i for i, p in enumerate(pairs)}
        made = [pick.randint(letters, 11) for _ in pairs]
        symbols = [pick.randrange(letters) for _ in range(pick.choice([0, 1, 2, 3, 5, 8, 9, 30]))]
        assert bpe.merged(symbols, ranks, made) == searched(symbols, ranks, made)


def ids_of(coder, text):
    return np.frombuffer(coder.encode(text), np.int32).tolist()


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(text=st.text(max_size=60))
def test_any_text_equals_the_library(coder, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert ids_of(coder, text) == ids
    assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_odd_texts_equal_the_library(coder, library):
    odd = [
        "", " ", "  \n\t x  y z ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endof<|endoftext|>text|>", "it's we'll I'D",
        "\x00\x1c\x85﻿", "naïve ŤÝ ɏ", "東京 😀 ‍ 𝒳", "x" * 5000, "ab" * 4000 + " " * 3000, "ÿ" * 999, "1234567890" * 300,
        "the " * 5000, "\n" * 2000 + "end",
    ]
    for text in odd:
        ids = library.encode(text, add_special_tokens=False).ids
        assert ids_of(coder, text) == ids
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False) == text
    pick = random.Random(5)
    for _ in range(200):  # also bytes that are no UTF-8
        ids = [pick.randrange(50257) for _ in range(pick.randint(0, 20))]
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_one_long_word_is_no_square_work(coder, library):
    pick = random.Random(1)
    text = "".join(pick.choice("etaoinshr") for _ in range(200_000))
    assert ids_of(coder, text) == library.encode(text, add_special_tokens=False).ids


def test_memory_is_given_back(source, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 2000)
    small = bpe.Coder(source)
    text = " ".join(f"word{i} größe{i}" for i in range(300))
    for _ in range(2):
        assert ids_of(small, text) == library.encode(text, add_special_tokens=False).ids
        assert sum(200 + 4 * len(w) + len(b) for w, b in small.known.items()) <= 2000


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.load(queries.tokenizer_path(queries.TOKENIZER))


def test_query_equals_the_library(spark, library):
    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = queries.op11_bpe(spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_awkward_rows(spark, source, library):
    docs = clashing(awkward(spark)).withColumn("ids", F.lit("own"))
    rows = docs.select("doc_id", "text", bpe.encoded(docs, source).alias("i"))
    rows = rows.select("*", bpe.decoded(docs, source, F.col("i")).alias("d"))
    got = rows.collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.i == library.encode(r.text or "", add_special_tokens=False).ids and r.d == (r.text or "")
    nothing = docs.limit(0)
    assert nothing.select(bpe.encoded(nothing, source)).count() == 0
    missing = spark.createDataFrame([(None,), ([15496, -1, 99999],)], "i array<int>")
    assert [r[0] for r in missing.select(bpe.decoded(missing, source, F.col("i"))).collect()] == [None, "Hello"]


def test_texts_are_encoded_once(spark):
    plan = queries.op11_bpe(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2 and plan.count("ids(text") == 1
