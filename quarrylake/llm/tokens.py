"""Token ids of whole texts through the tokenizers library.

White space never reaches the tokenizers used here (their pre-tokenizers drop it), so a text's
ids are its words' ids in order.  Each worker keeps the ids of words it has seen in a bounded
cache and hands only new words to the library.  As in the library's own ``encode``, the string of
an added token (``<|endoftext|>``) in a text gives that token's id.  ``whole=True`` encodes text by
text instead, for tokenizers to which white space matters.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import ragged, words

#: Distinct words that a worker remembers before it starts afresh.
CACHE_WORDS = 250_000


#: A word of letters of one code point each in either case, then punctuation: two pre-tokens whose
#: ids the model gives directly.  Other words pass through the tokenizer's own normaliser and splitter.
PLAIN = r"^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<rest>[!-&(-/:-@\[-`{-~]*)$"
#: Words on which the short way must agree with the tokenizer before it is taken.
PROBES = ("word", "Word,", "ÉTÉ!!", "größer|", "ñ.", "a***", "###b", "it's", "x", "Être$$$", "A.B", "ÿ-_-")


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Pieces:
    """Ids of strings, by string; piece 0 is empty."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.ids = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.starts, self.counts = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def add(self, new: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        first = len(self.known)
        self.known.update(zip(new, range(first, first + len(new))))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while len(self.known) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.empty_like(self.starts)])
            self.counts = np.concatenate([self.counts, np.empty_like(self.counts)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[first : first + len(new)] = self.used + np.cumsum(counts) - counts
        self.counts[first : first + len(new)] = counts
        self.used += len(ids)


class WordIds:
    def __init__(self, path: str, whole: bool = False, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.whole, self.limit, self.letters = whole, limit, _byte_letters()
        self.model = self.tokenizer.model
        self.short, self.long = _Pieces(), _Pieces()
        self.direct = True
        plain, _ = self.encode(pa.array(PROBES), None)
        self.direct = plain.tolist() == [i for w in PROBES for i in self._own(w)]
        self.short, self.long = _Pieces(), _Pieces()

    def _own(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _places(self, strings: pa.Array, direct: bool) -> np.ndarray:
        """Each string's place in its pieces; new ones are learnt."""
        coded = strings.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        pieces = self.short if direct else self.long
        new = [w for w in distinct if w not in pieces.known]
        for a in range(0, len(new), 20_000):
            part = new[a : a + 20_000]
            if direct:
                tokenize, letters = self.model.tokenize, self.letters
                each = [[t.id for t in tokenize(w.encode().decode("latin-1").translate(letters))] for w in part]
                counts = np.array([len(x) for x in each], np.int64)
                ids = np.array([i for x in each for i in x], np.uint32)
            else:
                got = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
                ids = np.array(got.ids, np.uint32)
                counts = np.bincount(np.array(got.word_ids, np.int64), minlength=len(part))
            pieces.add(part, ids, counts)
        place = np.fromiter(map(pieces.known.__getitem__, distinct), np.int64, len(distinct))
        return place[coded.indices.to_numpy()] if len(coded) else place[:0]

    def _table(self, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words one after another, and each word's start and count."""
        if len(self.short.known) + len(self.long.known) > self.limit:
            self.short, self.long = _Pieces(), _Pieces()
        cut = pc.extract_regex(vocabulary, PLAIN) if self.direct else None
        plain = cut.is_valid().to_numpy(zero_copy_only=False) if self.direct else np.zeros(len(vocabulary), bool)
        counts = np.zeros((len(vocabulary), 2), np.int64)
        if plain.any():
            two = cut.filter(pa.array(plain))
            core = self._places(pc.utf8_lower(two.field("core")), True)
            rest = self._places(two.field("rest"), True)
            both = np.stack([core, rest], axis=1)
            counts[plain] = self.short.counts[both]
        if not plain.all():
            other = self._places(vocabulary.filter(pa.array(~plain)), False)
            counts[~plain, 0] = self.long.counts[other]
        total = counts.sum(axis=1)
        starts = np.cumsum(total) - total
        ids = np.empty(int(total.sum()), np.uint32)
        if plain.any():
            ids[ragged(starts[plain], total[plain])] = self.short.ids[ragged(self.short.starts[both].ravel(), counts[plain].ravel())]
        if not plain.all():
            ids[ragged(starts[~plain], total[~plain])] = self.long.ids[ragged(self.long.starts[other], total[~plain])]
        return ids, starts, total

    def encode(self, texts: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text's followed by ``end``, and the texts' offsets."""
        if self.whole:
            each = [e.ids for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            sizes = np.array([len(x) for x in each], np.int64)
            flat = np.fromiter((i for x in each for i in x), np.uint32, int(sizes.sum()))
        else:
            found, offsets = words(texts)
            coded = found.dictionary_encode()
            table, starts, counts = self._table(coded.dictionary)
            word = coded.indices.to_numpy()
            if len(word):
                starts, counts = starts[word], counts[word]
            flat = table[ragged(starts, counts)]
            sizes = np.diff(np.r_[0, np.cumsum(counts)][offsets])
        if end is None:
            return flat, np.r_[0, np.cumsum(sizes)]
        offsets = np.r_[0, np.cumsum(sizes + 1)]
        out = np.empty(offsets[-1], np.uint32)
        inner = np.ones(len(out), bool)
        inner[offsets[1:] - 1] = False
        out[inner] = flat
        out[~inner] = end
        return out, offsets


@functools.cache
def word_ids(path: str, whole: bool = False) -> WordIds:
    """One encoder for each worker process."""
    return WordIds(path, whole)
