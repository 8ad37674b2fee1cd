"""Token counts with a whole-token shortcut, equal to those of the ``tokenizers`` library.

Which strings of the vocabulary encode alone as one token is proved once, on the driver, by
encoding each of them. In the texts such pre-tokens count one without any merging; the
merges run for the other pre-tokens only. Special strings inside a text count one token each,
as the library takes them by default.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelens.llm.tables import shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Texts of these characters only are split here; others by the library's own splitter, whose
# Unicode tables may be of another version.
LAST_LATIN = 0x24F
LATIN = re.compile(r"[\t-\r -~\u00a0-\u024f]*")
# Bytes of pre-tokens that need merges, with their counts, that a task keeps.
MEMORY = 32 << 20


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file and what was proved of it."""

    source: str
    pattern: str
    whole: frozenset[str]
    special: tuple[str, ...]


def prove(path: str) -> Vocabulary:
    """Read a tokenizer file whose pre-tokens are the matches of one pattern, byte by byte.

    A string of the vocabulary is whole if the library leaves it as it is, takes it as one
    pre-token and encodes it alone as one token. The file must have its size bounded: it is
    sent to every executor.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        source = file.read()
    told = json.loads(source)
    split = told["pre_tokenizer"]["pretokenizers"][0]
    if split["type"] != "Split" or not split["invert"] or split["behavior"] != "Removed":
        raise ValueError("pre-tokens must be the matches of a pattern")
    tokenizer = Tokenizer.from_str(source)
    to_byte = {c: b for b, c in enumerate(_byte_letters())}
    suffix = told["model"]["end_of_word_suffix"] or ""
    texts = []
    for token in told["model"]["vocab"]:
        plain = token.removesuffix(suffix)
        if token.endswith(suffix) and plain and all(c in to_byte for c in plain):
            try:
                texts.append(bytes(to_byte[c] for c in plain).decode("utf-8"))
            except UnicodeDecodeError:
                continue
    whole = []
    for text, found in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        if len(found.ids) == 1 and tokenizer.normalizer.normalize_str(text) == text:
            pieces = tokenizer.pre_tokenizer.pre_tokenize_str(text)
            if len(pieces) == 1 and pieces[0][1] == (0, len(text)):
                whole.append(text)
    special = tuple(x["content"] for x in told["added_tokens"])
    if any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in told["added_tokens"]):
        raise ValueError("special strings must be taken as they are")
    return Vocabulary(source, split["pattern"]["Regex"], frozenset(whole), special)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else the next free one from 256."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(free)) for b in range(256)]


def _spelled_out(pattern: str) -> str:
    """The pattern with its classes of letters and numbers listed, as far as ``LAST_LATIN``."""
    for name in (r"\p{L}", r"\p{N}"):
        members = regex.findall(name, "".join(map(chr, range(LAST_LATIN + 1))))
        pattern = pattern.replace(name, "".join(members))
    return pattern


class Counter:
    """Counts tokens of texts; one is made for each task."""

    def __init__(self, vocabulary: Vocabulary):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary.source)
        self.split = re.compile(_spelled_out(vocabulary.pattern))
        self.special = re.compile("|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True))) or "(?!)")
        self.letters = _byte_letters()
        self.whole = dict.fromkeys(vocabulary.whole, 1)
        self.counts = dict(self.whole)
        self.held = 0

    def kept(self, word: str) -> int:
        """Tokens of a pre-token that is not whole, kept while the memory lasts."""
        size, n = 150 + 4 * len(word), self.merged(word)
        if self.held + size > MEMORY:
            self.counts, self.held = dict(self.whole), 0
        if size <= MEMORY:
            self.counts[word] = n
            self.held += size
        return n

    def merged(self, word: str) -> int:
        """Tokens of a pre-token that is not whole."""
        spelled = "".join([self.letters[b] for b in word.encode("utf-8")])
        return len(self.tokenizer.model.tokenize(spelled))

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings, after normalisation."""
        normal = text.lower() if text.isascii() else self.tokenizer.normalizer.normalize_str(text)
        if LATIN.fullmatch(normal):
            return self.split.findall(normal)
        return [normal[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        total, at = 0, 0
        parts = [text]
        if self.special.search(text):
            parts = self.special.split(text)
            total += len(parts) - 1
        for part in parts:
            words = self.words(part)
            got = list(map(self.counts.get, words))
            if None in got:
                for at, n in enumerate(got):
                    if n is None:
                        word = words[at]
                        n = self.counts.get(word)
                        if n is None:
                            n = self.kept(word)
                        got[at] = n
            total += sum(got)
        return total


def counted(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> Column:
    """A column expression with the tokens of each text of ``docs``; null has none."""
    sent = shared(docs.sparkSession, vocabulary)

    @F.pandas_udf("long")
    def computed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(cloudpickle.loads(sent.value))
        for texts in batches:
            yield pd.Series([counter.count(x) for x in texts], dtype="int64")

    return computed(F.col(text))
