"""Token ids of texts by a public tokenizer, through a bounded cache of words.

A space between two characters that are no white space starts a token in the
byte-level vocabulary, so a text whose spaces all stand like that is encoded
word by word. The different words of a batch are found by Arrow, looked up in a
cache that lives as long as the Python worker, and their ids are dealt back to
all places by numpy. Words the cache does not have are encoded side by side: a
token that begins with a space begins a word there. Words of letters, with or
without punctuation at their end, go to the merges at once, if no token of the
vocabulary crosses from one of them to the next or from a letter to punctuation.
Any other text is encoded as a whole.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Iterator
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "byte_bpe_50k.json"
CACHE_ENTRIES = 1_000_000
LONG_WORD = 64
MERGE_AT_ONCE = 32  # words that go to the merges side by side
LEARN_AT_ONCE = 1 << 14  # and to the whole tokenizer
_POINTS = ".,;:!?"


def worker_encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """The encoder of this Python worker, kept from task to task."""
    home = sys.modules.setdefault("_posloom_worker", types.ModuleType("_posloom_worker"))
    kept = home.__dict__.setdefault("encoders", {})
    if vocabulary not in kept:
        kept[vocabulary] = Encoder(vocabulary)
    return kept[vocabulary]


class Alphabet(dict):
    """A character, by its number, as the vocabulary's letters for its bytes; asked for once each."""

    def __init__(self):
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.letters = ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, number: int) -> str:
        self[number] = self.letters.pre_tokenize_str(chr(number))[0][0]
        return self[number]


def crosses(token: str) -> bool:
    """Is part of a letter, or a letter, before punctuation in this token, or one of them before a space?"""
    from tokenizers.decoders import ByteLevel

    text = ByteLevel().decode([token])
    return any(
        (a.isalpha() or a == "\ufffd" or a in _POINTS and b == " ") and b in _POINTS + " " for a, b in pairwise(text)
    )


class Encoder:
    """The ids of all words in the cache lie side by side in ``ids``; the cache has a word's number."""

    def __init__(self, vocabulary: str = VOCABULARY, entries: int = CACHE_ENTRIES):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.alphabet = Alphabet()
        space = " ".translate(self.alphabet)
        known = self.model.get_vocab(with_added_tokens=False)
        self.begins = np.zeros(self.model.get_vocab_size() + 1, bool)
        self.begins[[i for token, i in known.items() if token.startswith(space)]] = True
        may_cross = re.compile(rf"[^{space}]{space}|[^!-/:-@\[-`{{-~{space}][{_POINTS}]").search
        self.apart = not any(map(crosses, filter(may_cross, known)))
        self.entries = entries
        self.clear()

    def clear(self) -> None:
        self.cache: dict[str, int] = {}
        self.ids = np.zeros(0, "<u4")
        self.sizes = np.zeros(0, np.int64)

    def plain(self, text: str) -> np.ndarray:
        return np.asarray(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _merged(self, words: list[str]) -> np.ndarray:
        merges, alphabet = self.model.model.tokenize, self.alphabet
        return np.fromiter((t.id for t in merges((" " + " ".join(words)).translate(alphabet))), "<u4")

    def _learn(self, words: list[str]) -> None:
        """Put words into the cache, with the ids they have after a space."""
        lettered, others = [], words
        if self.apart:
            lettered, others = [], []
            for word in words:
                (lettered if len(word) <= LONG_WORD and word.rstrip(_POINTS).isalpha() else others).append(word)
        ids, sizes = [self.ids], [self.sizes]
        for some, at_once, encoded in ((lettered, MERGE_AT_ONCE, self._merged), (others, LEARN_AT_ONCE, lambda w: self.plain(" " + " ".join(w)))):
            for at in range(0, len(some), at_once):
                part = some[at : at + at_once]
                found = encoded(part)
                starts = np.flatnonzero(self.begins[found])
                if len(starts) == len(part) and starts[0] == 0:
                    ids.append(found)
                    sizes.append(np.diff(starts, append=len(found)))
                else:
                    each = [self.plain(" " + word) for word in part]
                    ids += each
                    sizes.append(np.fromiter(map(len, each), np.int64, len(each)))
        self.cache.update(zip([*lettered, *others], range(len(self.sizes), len(self.sizes) + len(words))))
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts side by side, and how many each has."""
        if not texts:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        starts = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        units = coded.indices.to_numpy().astype(np.int64)
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        size = len(words)
        # A word with white space at an end, or none at all, makes its text crowded.
        bare = pc.binary_length(coded.dictionary).to_numpy()
        end_space = pc.binary_length(pc.utf8_rtrim_whitespace(coded.dictionary)).to_numpy() < bare
        odd = end_space | (pc.binary_length(pc.utf8_ltrim_whitespace(coded.dictionary)).to_numpy() < bare) | (bare == 0)
        firsts = units[starts[:-1]]
        crowded = (end_space | (bare == 0))[firsts]
        inner = odd[units]
        inner[starts[:-1]] = False
        crowded |= np.add.reduceat(inner, starts[:-1], dtype=np.int64) > 0
        if len(self.cache) > self.entries:
            self.clear()
        number = np.fromiter(map(self.cache.get, words, repeat(-1)), np.int64, size)
        new = np.flatnonzero((number < 0) & ~odd)
        learned = [words[k] for k in new.tolist()]
        self._learn(learned)
        number[new] = np.fromiter(map(self.cache.get, learned), np.int64, len(learned))
        heads = [self.plain(t if c else words[k]) for t, k, c in zip(texts, firsts.tolist(), crowded.tolist())]
        # The first place of a text stands for its first word, or for all of a crowded text.
        number = np.concatenate([number, len(self.sizes) + np.arange(len(texts))])
        units[starts[:-1]] = size + np.arange(len(texts))
        stay = ~np.repeat(crowded, np.diff(starts))
        stay[starts[:-1]] = True
        owner = np.repeat(np.arange(len(texts)), np.diff(starts))[stay]
        units = number[units[stay]]
        sizes = np.concatenate([self.sizes, np.fromiter(map(len, heads), np.int64, len(heads))])
        flat = np.concatenate([self.ids, *heads])
        counts = sizes[units]
        begin = (np.cumsum(sizes) - sizes)[units] - (np.cumsum(counts) - counts)
        ids = flat[np.repeat(begin, counts) + np.arange(int(counts.sum()))]
        return ids, np.bincount(owner, counts, len(texts)).astype(np.int64)


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with an end id after each text."""
    out = np.full(len(ids) + len(counts), end, "<u4")
    out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
    return out, counts + 1


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch with about ``size`` characters of text each, and their texts; null is empty."""
    at, total, texts = 0, 0, []
    for text in batch.column(batch.schema.get_field_index(column)):
        texts.append(text.as_py() or "")
        total += len(texts[-1])
        if total >= size:
            yield batch.slice(at, len(texts)), texts
            at, total, texts = at + len(texts), 0, []
    if texts:
        yield batch.slice(at, len(texts)), texts
