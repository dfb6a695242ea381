"""Ids of the word tokenizer's kept words against the library: every low code point, and random texts."""

import random

import numpy as np
import pytest

from martwise.llm.queries import word_model
from martwise.llm.token_records import WordTokenizer


@pytest.fixture(scope="module")
def tok():
    return WordTokenizer(word_model())


def same(tok, texts):
    got = tok.encode(texts)
    for text, ids in zip(texts, got):
        want = tok.whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, tok.dtype).tolist() == want, repr(text)


def test_every_code_point_below_u0250(tok):
    for c in map(chr, range(0x250)):
        same(tok, [c, f"ab{c}cd", f"ab {c} cd", f"{c}LI", f"Ab{c}", f"9{c}9", f"'{c}s it's{c}", c * 3])


def test_characters_beyond(tok):
    same(tok, ["ƏLI", "K", "Å", "é", "İK", "ſ", "ẞ", "漢字 ab", "naïve​x", "<|endoftext|>", "a<|b", "퟿", "😀 ok", "ǅ ǆ", "", " "])


def test_random_texts(tok):
    rng = random.Random(20)
    low = [chr(k) for k in range(0x250)]
    usual = list("abcdefgh  THE'.,-9é") + ["ß", "Ɓ", "\n", "'s", "'re", "<", "|"]
    for n in range(400):
        chars = low if n % 2 else usual
        same(tok, ["".join(rng.choice(chars) for _ in range(rng.randrange(40))) for _ in range(20)])


def test_a_full_table_starts_over(tok, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(WordTokenizer, "LIMIT", 50)
    same(tok, [" ".join("".join(rng.choice("abc,.") for _ in range(4)) for _ in range(30)) for _ in range(300)])
