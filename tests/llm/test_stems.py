"""Stems are encoded together and get the library's ids."""

from __future__ import annotations

import itertools

import numpy as np

from foldmill.llm import tokens


class Counted:
    def __init__(self, model):
        self.model, self.texts = model, 0

    def encode_batch_fast(self, texts, **more):
        self.texts += len(texts)
        return self.model.encode_batch_fast(texts, **more)


def test_many_stems_are_one_text():
    encoder = tokens.WordEncoder(tokens.default_path())
    encoder.model = Counted(encoder.model)
    words = ["".join(w) for w in itertools.product("aeiouxyzßé", repeat=4)][:7000]
    texts = [" ".join(words), "", ". a.b .c. Zoë, naïve...", " ".join(reversed(words))]
    ids, n = encoder.encode(texts)
    assert encoder.model.texts <= 4
    expected = [encoder.whole.encode(text, add_special_tokens=False).ids for text in texts]
    assert n.tolist() == [len(x) for x in expected]
    assert ids.tolist() == list(itertools.chain.from_iterable(expected)) and ids.dtype == np.uint32


def test_a_word_is_learned_once_whatever_follows_it():
    encoder = tokens.WordEncoder(tokens.default_path())
    stems = ["".join(w) for w in itertools.product("aeioußé", repeat=3)]
    texts = [" ".join(stem + tail for stem in stems) for tail in ("", ".", ",", "!?", "...")] + ["İ. 漢 x1. İ, é́. a.b. it's!", "É. ɐ"]
    ids, n = encoder.encode(texts)
    expected = [encoder.whole.encode(text, add_special_tokens=False).ids for text in texts]
    assert n.tolist() == [len(x) for x in expected] and ids.tolist() == list(itertools.chain.from_iterable(expected))
    assert len(encoder.words) < len(stems) + 20
