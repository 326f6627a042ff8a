"""The encoder of token files against the library, text by text."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers

from lodeworks.llm import token_files
from lodeworks.llm.token_files import Encoder

PARTS = ["a", "bc", ".", ",", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0", "　", "\x01", "\x00", "é", "—", "1", "23", "'s",
         "<|endoftext|>", "word", "Word.", " the", " the,", "x" * 70, "\x1c", "\x85"]


def test_any_blanks_and_marks():
    rng, encoder = random.Random(1), Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["", " ", "\n", *("".join(rng.choices(PARTS, k=rng.randint(0, 12))) for _ in range(3_000))]
    expected = [e.ids for e in encoder._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    for _ in range(2):  # new runs, then kept ones
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == expected


def test_runs_are_looked_up_once_a_block():
    """A text's runs are told apart by Arrow; Python sees the different ones only."""

    class Counting(dict):
        asked = 0

        def get(self, *key):
            Counting.asked += 1
            return super().get(*key)

    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    encoder._kept = Counting()
    encoder.encode(["one two three " * 1_000 + "end"] * 10)
    assert Counting.asked < 100


def test_words_and_marks_are_kept_apart():
    """A word before a mark is the word itself, so the library sees it once."""
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    encoder.encode(["a vord vord, vord. vord!! vord$$$ vord; (vord) vördé vörd"])
    assert sum(run.startswith(b" vord") for run in encoder._kept) == 1
    assert {b"!!", b"$$$", b",", " vörd".encode()} <= set(encoder._kept)


def test_any_letters_and_marks(monkeypatch):
    rng, path = random.Random(2), public_tokenizers.path("byte_bpe_50k.json")
    letters = [*"aZqsé\xd7\xf7ßÿ\xaa\xb5ªþ́Āжあ中😀 09", " ", "'", "'s", "'ll", "-", ".", "$$", "_", "~", "\x7f", "\x00", "\x01", "\xad"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(4_000)]
    encoder = Encoder(path)
    expected = [e.ids for e in encoder._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    for kept, ids in ((10**6, 10**6), (50, 10**6), (10**6, 200)):
        monkeypatch.setattr(token_files, "KEPT", kept)
        monkeypatch.setattr(token_files, "IDS", ids)
        got = [x for at in range(0, len(texts), 100) for x in encoder.encode(texts[at : at + 100])]
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == expected
    assert encoder.encode([]) == [] and encoder.encode(["", ""]) == [b"", b""]


def test_other_tokenizers_encode_whole_texts(tmp_path):
    """Bounds and spelling of words hold for the usual byte-level steps only."""
    from tokenizers import AddedToken, Tokenizer, normalizers

    for change in ("added", "lower"):
        tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        if change == "added":
            tokenizer.add_tokens([AddedToken("vor", normalized=False), AddedToken("d, x", normalized=False)])
        else:
            tokenizer.normalizer = normalizers.Lowercase()
        tokenizer.save(str(tmp_path / "other.json"))
        texts = ["vord, xvor", "Vord vOR. d, x", ""]
        got = Encoder(str(tmp_path / "other.json")).encode(texts)
        expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == expected
