"""Benchmark decontamination by pigeonhole edit matching.

A test item may occur in a text with up to a budget of edits, a share of its length. Cut into
budget-plus-one pieces, at least one piece then occurs unchanged. All pieces of a block of
items are found in one pass over a text, and around each hit Myers' bit-parallel algorithm
computes the edit distance of the whole item to the best place there.
"""

from __future__ import annotations

import re
import sys
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelens.llm.tables import shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = re.compile(r"[^\W_]+")
# Edits allowed for each character of an item.
SHARE = 0.07
# Characters of items that are searched for at a time.
BLOCK = 1_000_000
MATCHES = "array<struct<item_id:bigint,distance:int,start:bigint,stop:bigint>>"


def normal(text: str | None) -> str:
    """Lower-cased words with one blank between; punctuation is not compared."""
    return " ".join(WORD.findall((text or "").lower()))


@dataclass(frozen=True)
class Item:
    item_id: int | None
    text: str
    budget: int


def items(rows: list[tuple[int | None, str | None]], share: float = SHARE) -> list[Item]:
    """Items with a word in them. A short item has a budget of zero and matches exactly only."""
    made = []
    for item_id, text in rows:
        plain = normal(text)
        if plain:
            made.append(Item(item_id, plain, int(share * len(plain))))
    return made


def pieces(item: Item) -> list[tuple[int, str]]:
    """(offset, piece): the budget-plus-one pieces of an item, none of them empty."""
    n, parts = len(item.text), item.budget + 1
    edges = [n * i // parts for i in range(parts + 1)]
    return [(a, item.text[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def myers(pattern: str, text: str, places: dict[str, int] | None = None) -> tuple[int, int]:
    """(distance, stop): the least edit distance of the pattern to a part of the text, and where
    the first such part stops."""
    m = len(pattern)
    places = places if places is not None else bit_places(pattern)
    every, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score = every, 0, m
    best, stop = m, 0
    for at, c in enumerate(text):
        eq = places.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | (every & ~(xh | up))
        mh = up & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
        ph = (ph << 1) & every
        mh = (mh << 1) & every
        up = mh | (every & ~(xv | ph))
        down = ph & xv
        if score < best:
            best, stop = score, at + 1
    return best, stop


def bit_places(pattern: str) -> dict[str, int]:
    found: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        found[c] |= 1 << i
    return dict(found)


class Finder:
    """Finds a block of items in texts; one is made for each task."""

    def __init__(self, block: list[Item]):
        import ahocorasick

        self.block = block
        self.places = [bit_places(item.text) for item in block]
        of: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, item in enumerate(block):
            for offset, piece in pieces(item):
                of[piece].append((i, offset))
        self.search = ahocorasick.Automaton()
        for piece, wanted in of.items():
            self.search.add_word(piece, (len(piece), wanted))
        if of:
            self.search.make_automaton()
        self.empty = not of

    def find(self, text: str | None) -> list[dict]:
        """For each item that occurs within its budget, its best place in the normalised text."""
        plain = normal(text)
        if self.empty or not plain:
            return []
        starts: dict[int, list[int]] = defaultdict(list)
        for end, (length, wanted) in self.search.iter(plain):
            for i, offset in wanted:
                starts[i].append(end + 1 - length - offset)
        found = []
        for i, hits in starts.items():
            item = self.block[i]
            best = None
            for low, high in self._windows(sorted(set(hits)), item, len(plain)):
                distance, stop = self._nearest(i, plain[low:high])
                if distance <= item.budget and (best is None or distance < best[0]):
                    best = (distance, low, low + stop)
            if best is not None:
                distance, low, stop = best
                back = plain[max(low, stop - len(item.text) - distance) : stop][::-1]
                length = myers(item.text[::-1], back)[1]
                found.append({"item_id": item.item_id, "distance": distance, "start": stop - length, "stop": stop})
        return found

    def _nearest(self, i: int, window: str) -> tuple[int, int]:
        at = window.find(self.block[i].text)
        if at >= 0:
            return 0, at + len(self.block[i].text)
        return myers(self.block[i].text, window, self.places[i])

    @staticmethod
    def _windows(starts: list[int], item: Item, size: int) -> Iterator[tuple[int, int]]:
        """Stretches that hold every place an item with these hits can take, joined where they overlap."""
        low = high = None
        for start in starts:
            a = max(0, start - item.budget)
            b = min(size, start + len(item.text) + item.budget)
            if high is not None and a <= high:
                high = max(high, b)
                continue
            if high is not None:
                yield low, high
            low, high = a, b
        if high is not None:
            yield low, high


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", size: int = BLOCK) -> list[list[tuple]]:
    """The items in blocks of about ``size`` characters, each a bounded list for one pass."""
    kept = benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where(F.col("t").isNotNull()).distinct()
    total = kept.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    n = max(1, -(-total // size))
    number = F.pmod(F.xxhash64("i", "t"), F.lit(n))
    return [[(r.i, r.t) for r in kept.where(number == b).orderBy("i", "t").collect()] for b in range(n)]


def matches(docs: DataFrame, block: list[tuple], text: str = "text", share: float = SHARE) -> Column:
    """An array column with the items of a block that occur in each text; null texts have none."""
    sent = shared(docs.sparkSession, items(block, share))

    @F.pandas_udf(MATCHES)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(cloudpickle.loads(sent.value))
        for texts in batches:
            yield pd.Series([finder.find(x) for x in texts], dtype=object)

    return found(F.col(text))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = SHARE
) -> DataFrame:
    """(doc_id, item_id, distance, start, stop): the items in each text, at their best place.

    start and stop are characters of the normalised text. Items of equal id and text count
    once; items without a word, and null items, match nothing. A row of ``docs`` that is
    repeated is reported as often; rows without an id are reported with a null id. The
    benchmark is searched for in blocks, one pass over ``docs`` each.
    """
    passes = [
        docs.select(F.col(doc_id).alias("doc_id"), F.explode(matches(docs, block, text, share)).alias("m"))
        for block in blocks(benchmark)
    ]
    every = passes[0]
    for further in passes[1:]:
        every = every.unionByName(further)
    return every.select("doc_id", "m.*")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` in which no item occurs, all columns as they are."""
    for block in blocks(benchmark):
        docs = docs.where(F.size(matches(docs, block, text, share)) == 0)
    return docs
