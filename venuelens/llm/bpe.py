"""Byte-level BPE: encoding by a segment tree over the ranks of adjacent pairs, and decoding.

Each leaf of the tree holds the rank and place of one adjacent pair, so that the root is the
leftmost pair of the lowest rank. A merge changes at most three leaves, and each climbs to the root:
a run of n bytes costs n log n, however long it is. Ids and texts equal those of the ``tokenizers`` library.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelens.llm.tokens import LATIN, _byte_letters, _spelled_out

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: the pattern of the byte-level pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}]+| ?[\p{N}]+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# No mergeable pair.
NONE = 1 << 62
# Bytes of pre-tokens and their ids that a task keeps.
MEMORY = 64 << 20


def merged(symbols: Sequence[int], ranks: dict[tuple[int, int], int], made: Sequence[int]) -> list[int]:
    """The ids left of ``symbols`` when no adjacent pair has a rank any more.

    ``ranks`` gives a pair's rank, ``made`` the id that the merge of that rank makes. Of equal ranks
    the leftmost pair is merged first.
    """
    ids, n = list(symbols), len(symbols)
    if n < 2:
        return ids
    width = 1 << (n - 2).bit_length()
    tree = [NONE] * (2 * width)
    for i in range(n - 1):
        rank = ranks.get((ids[i], ids[i + 1]))
        if rank is not None:
            tree[width + i] = rank * n + i
    for at in range(width - 1, 0, -1):
        tree[at] = min(tree[2 * at], tree[2 * at + 1])

    def put(i: int, value: int) -> None:
        at = width + i
        tree[at] = value
        while at > 1:
            at >>= 1
            least = min(tree[2 * at], tree[2 * at + 1])
            if tree[at] == least:
                break
            tree[at] = least

    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while tree[1] < NONE:
        rank, i = divmod(tree[1], n)
        gone = after[i]
        ids[i] = made[rank]
        after[i] = right = after[gone]
        if gone < n - 1:
            put(gone, NONE)
        if right < n:
            before[right] = i
            rank = ranks.get((ids[i], ids[right]))
            put(i, NONE if rank is None else rank * n + i)
        else:
            put(i, NONE)
        left = before[i]
        if left >= 0:
            rank = ranks.get((ids[left], ids[i]))
            put(left, NONE if rank is None else rank * n + left)
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return out


def load(path: str) -> str:
    """The text of a tokenizer file, if it is plain byte-level BPE.

    It is sent to every executor, so the file must have its size bounded.
    """
    with open(path, encoding="utf-8") as file:
        source = file.read()
    told = json.loads(source)
    model, split = told["model"], told["pre_tokenizer"]
    plain = model["type"] == "BPE" and split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
    plain = plain and told["normalizer"] is None and told["decoder"]["type"] == "ByteLevel"
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")
    if not plain or any(model.get(k) for k in odd) or any(c not in model["vocab"] for c in _byte_letters()):
        raise ValueError("not plain byte-level BPE")
    if any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in told["added_tokens"]):
        raise ValueError("special strings must be taken as they are")
    return source


class Coder:
    """Encodes and decodes; one is made for each task."""

    def __init__(self, source: str):
        told = json.loads(source)
        vocab = told["model"]["vocab"]
        self.source, self.tokenizer = source, None
        letters = _byte_letters()
        self.byte = [vocab[c] for c in letters]
        self.letter = {c: vocab[c] for c in letters}
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(told["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[left], vocab[right]] = rank
            self.made.append(vocab[left + right])
        to_byte = {c: b for b, c in enumerate(letters)}
        self.pieces = {}
        special = {x["content"]: x["id"] for x in told["added_tokens"]}
        for token, i in [*vocab.items(), *special.items()]:
            known = all(c in to_byte for c in token)
            self.pieces[i] = bytes(to_byte[c] for c in token) if known else token.encode("utf-8")
        self.special = {x: array("i", [i]).tobytes() for x, i in special.items()}
        self.specials = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or "(?!)")
        self.split = re.compile(_spelled_out(PATTERN))
        self.known: dict[str, bytes] = {}
        self.spelled: dict[str, bytes] = {}
        self.held = 0

    def kept(self, words: dict[str, bytes], word: str, symbols: list[int]) -> bytes:
        """The ids of a pre-token, which are kept while the memory lasts."""
        found = array("i", merged(symbols, self.ranks, self.made)).tobytes()
        self.held += 200 + 4 * len(word) + len(found)
        if self.held > MEMORY:
            self.known.clear()
            self.spelled.clear()
            self.held = 200 + 4 * len(word) + len(found)
        if self.held <= MEMORY:
            words[word] = found
        return found

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as 32-bit integers; null gives none."""
        if not text:
            return b""
        out, at = [], 0
        for mark in self.specials.finditer(text):
            out += self.part(text[at : mark.start()])
            out.append(self.special[mark.group()])
            at = mark.end()
        out += self.part(text[at:] if at else text)
        return b"".join(out)

    def part(self, text: str) -> list[bytes]:
        """The ids of each pre-token of a text without special strings."""
        if LATIN.fullmatch(text):
            words = self.split.findall(text)
            got = list(map(self.known.get, words))
            if None in got:
                for i, found in enumerate(got):
                    if found is None:
                        word = words[i]
                        got[i] = self.known.get(word) or self.kept(
                            self.known, word, [self.byte[b] for b in word.encode("utf-8")]
                        )
            return got
        # The library's Unicode tables part other scripts; its pre-tokens are spelled in letters for bytes.
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_str(self.source)
        words = [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return [self.spelled.get(w) or self.kept(self.spelled, w, [self.letter[c] for c in w]) for w in words]

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids; unknown ids are left out, and bytes that are no UTF-8 replaced."""
        piece = self.pieces.get
        return b"".join([piece(i, b"") for i in ids]).decode("utf-8", "replace")


def encoded(docs: DataFrame, source: str, text: str = "text") -> Column:
    """A column expression with the ids of each whole text of ``docs`` as array<int>; null has none.

    Very long texts, also of one word, are encoded whole; repeated rows are encoded like any other.
    """
    shared = docs.sparkSession.sparkContext.broadcast(source)

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = Coder(shared.value)
        for texts in batches:
            found = [coder.encode(x) for x in texts.to_pylist()]
            ends = np.cumsum([0, *map(len, found)]) // 4
            values = np.frombuffer(b"".join(found), np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))

    return ids(F.col(text).cast("string"))


def decoded(docs: DataFrame, source: str, ids: Column) -> Column:
    """A column expression with the text of each array of ids; null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(source)

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = Coder(shared.value)
        for lists in batches:
            values, ends = np.asarray(lists.values), np.asarray(lists.offsets).tolist()
            spans = zip(ends, ends[1:], lists.is_valid().to_pylist(), strict=False)
            yield pa.array([coder.decode(values[a:b].tolist()) if some else None for a, b, some in spans], pa.string())

    return texts(ids.cast("array<int>"))
