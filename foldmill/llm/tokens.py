"""Token ids of whole texts by the ``tokenizers`` library, each distinct word encoded once per worker."""

from __future__ import annotations

import functools
import gc
import itertools
import re

import numpy as np

#: Distinct words a worker remembers before it starts anew; bounds memory, has no effect on ids.
REMEMBERED = 750_000
#: Punctuation that becomes a word of its own where it follows a Latin letter or a digit and ends a word: it is a token run of its own there.
#: Not after U+0130, whose lower case ends in a mark that would join the run.
TAIL = ".,!?;:*#$%&|)("
TAILS = re.compile(rf"[{TAIL}](?<=[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f][{TAIL}])[{TAIL}]*(?=[ \n]|\Z)")
#: In a text without these characters, composing changes nothing and lower case is a map of single letters.
OTHER = re.compile("[^\x00-\u024f]")

class _Numbered(dict):
    """Numbers words as they are first asked for, and notes the new ones."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class _Pool:
    """Runs of ids in one growing array."""

    def __init__(self):
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.n = self.used = 0

    def add(self, lengths: np.ndarray, flat: np.ndarray, order: np.ndarray) -> None:
        """As many runs more as there are lengths; run i of these gets the number ``order[i]`` among them."""
        while len(self.start) < self.n + len(lengths):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        while len(self.flat) < self.used + len(flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.length[self.n + order] = lengths
        self.start[self.n + order] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used : self.used + len(flat)] = flat
        self.n += len(lengths)
        self.used += len(flat)

    def get(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these runs in a row, and where each run ends."""
        lengths = self.length[index]
        ends = np.cumsum(lengths)
        at = np.repeat(self.start[index] - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.flat[at], ends


class WordEncoder:
    """Encodes texts word by word.

    A word-level vocabulary drops white space and never joins characters across it, so the ids of a text
    are those of its blank-separated words in a row; ``tests/llm/test_tokens.py`` compares them with the
    library's ids of whole texts. Punctuation at the end of a word is split off first (``TAILS``), so that a word is learned once whatever
    stands behind it. Words of Latin letters only (below U+0250, where composing changes nothing and lower case is a map of single letters)
    skip the library's normaliser and splitter and go to the same BPE model directly; all else goes through the whole library.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit

        self.whole = Tokenizer.from_file(path)
        self.model = Tokenizer(self.whole.model)
        self.model.pre_tokenizer = CharDelimiterSplit(" ")
        suffix = self.whole.model.end_of_word_suffix
        #: Whether an id ends a word, where the vocabulary tells.
        self.ends = np.zeros(self.vocabulary, bool)
        if suffix:
            self.ends[[i for token, i in self.whole.get_vocab(with_added_tokens=False).items() if token.endswith(suffix)]] = True
        self.remembered = remembered
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        shown = {low: level.pre_tokenize_str(chr(low)) for low in range(0x250)}
        self.as_bytes = {low: x[0][0] if x else "" for low, x in shown.items()}
        self._forget()

    @property
    def vocabulary(self) -> int:
        return self.whole.get_vocab_size()

    def _forget(self) -> None:
        self.words, self.pool = _Numbered(), _Pool()

    @staticmethod
    def _each(words: list[str], encoder) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids in a row."""
        ids = [x.ids for x in encoder.encode_batch_fast(words, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return lengths, np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(lengths.sum()))

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`_each` by the model, in one text: an answer of the library for each word would cost more than its ids.

        A word has one id that ends a word at most, its last; as many of them as words show where each ends.
        """
        ids = np.array(self.model.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(words) or last[-1] != len(ids) - 1:
            return self._each(words, self.model)
        return np.diff(last, prepend=-1), ids

    def _learn(self) -> None:
        """Encode the words that were new."""
        new = self.words.new
        latin, others, shown = [], [], []
        for i, word in enumerate(new):
            if word.isalpha():
                if word.isascii():
                    latin.append(i)
                    shown.append(word.lower())
                    continue
                low = word.lower()
                if max(word) < "\u0250" and max(low) < "\u0250":
                    latin.append(i)
                    shown.append(low.translate(self.as_bytes))
                    continue
            others.append(i)
        runs = [self._together(shown[i : i + 5000]) for i in range(0, len(shown), 5000)]
        runs += [self._each([new[k] for k in others[i : i + 5000]], self.whole) for i in range(0, len(others), 5000)]
        lengths, flat = (np.concatenate(x) for x in zip(*runs))
        self.pool.add(lengths, flat, np.array(latin + others))
        self.words.new = []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text."""
        collects = gc.isenabled()
        gc.disable()  # nothing here makes cycles, and each collection would walk the remembered words
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.words) > self.remembered:
            self._forget()
        words = []
        per_text = np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            if "<|" not in text and not OTHER.search(text):  # no marker of the tokenizer can come or go with the case
                text = text.lower()
            found = TAILS.sub(r" \g<0>", text).replace("\n", " ").split(" ")
            per_text[i] = len(found)
            words += found
        index = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        if self.words.new:
            self._learn()
        ids, ends = self.pool.get(index)
        bounds = np.concatenate([[0], ends])[np.cumsum(per_text)]
        return ids, np.diff(bounds, prepend=0)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The worker's encoder; it stays from task to task while the worker lives."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordEncoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
