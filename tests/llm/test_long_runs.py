"""Runs of text too long to be kept by the encoder of token files."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers

from lodeworks.llm.token_files import LONGEST, Encoder


def test_long_words_with_and_without_a_stop():
    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=70)) for _ in range(40)]
    texts = [f"a {w} b {w}. c {w}," for w in words]
    encoder = Encoder(path)
    got = encoder.encode(texts)
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == encoder._tokenizer.encode(text, add_special_tokens=False).ids
    assert all(len(run) <= LONGEST for run in encoder._kept)
    assert encoder.encode(texts) == got
