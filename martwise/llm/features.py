"""Hashed n-gram features of texts, shared by the two text models."""

from __future__ import annotations

import re

import numpy as np
import xxhash

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1+")
_MUL = np.uint64(0x9E3779B97F4A7C15)
_HIGH, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)
_SAME = np.uint64(0x5EED)


def shape(token: str) -> str:
    """The pattern of a token: letters as X or x, digits as 9, runs as one."""
    if token.isalpha():  # the usual cases first
        if token.islower():
            return "x"
        if token.isupper():
            return "X"
        if token[0].isupper() and token[1:].islower():
            return "Xx"
    marks = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in token)
    return _RUN.sub(r"\1", marks)


class _Codes(dict):
    """Token to 64 bits: the hash of the lower-cased token, then that of its shape."""

    def __missing__(self, token: str) -> int:
        if len(self) > 150_000:
            self.clear()
        code = (xxhash.xxh32_intdigest(token.lower()) << 32) | xxhash.xxh32_intdigest(shape(token))
        self[token] = code
        return code


class _Words(dict):
    """Word to the ids of the word and of its first 4 and 5 letters."""

    def __missing__(self, word: str) -> tuple[int, int, int]:
        if len(self) > 100_000:
            self.clear()
        ids = self[word] = tuple(xxhash.xxh3_64_intdigest(x) >> 1 for x in (word, "^4" + word[:4], "^5" + word[:5]))
        return ids


_CODES, _WORDS = _Codes(), _Words()


def _mix(*parts: np.ndarray) -> np.ndarray:
    out = parts[0] * _MUL
    for p in parts[1:]:
        out ^= out >> np.uint64(29)
        out = (out ^ p) * _MUL
    return out ^ (out >> _HIGH)


def ngram_features(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted feature numbers and values of unit length.

    Features are word 1- and 2-grams and 1- to 3-grams of word shapes, where
    a word equal to the one before it has a shape of its own; each is hashed
    to ``bits`` bits.  A value is the square root of the count, normalised.
    """
    tokens = _TOKEN.findall(text) if text else []
    if not tokens:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    codes = np.fromiter(map(_CODES.__getitem__, tokens), np.uint64, len(tokens))
    word, form = codes >> _HIGH, codes & _LOW
    form[1:][codes[1:] == codes[:-1]] = _SAME
    tag = [np.full(len(word), k, np.uint64) for k in range(1, 6)]
    grams = [_mix(word, tag[0]), _mix(word[:-1], word[1:], tag[1][1:]), _mix(form, tag[2]),
             _mix(form[:-1], form[1:], tag[3][1:])]
    if len(form) > 2:
        grams.append(_mix(form[:-2], form[1:-1], form[2:], tag[4][2:]))
    ids, counts = np.unique((np.concatenate(grams) >> np.uint64(64 - bits - 8)) & np.uint64((1 << bits) - 1),
                            return_counts=True)
    values = np.sqrt(counts)
    return ids.astype(np.int32), (values / np.sqrt(counts.sum())).astype(np.float32)


def word_features(text: str | None) -> set[int]:
    """63-bit ids of the distinct words (letter runs, lower-cased) and of their beginnings."""
    words = set(_LETTERS.findall(text.lower())) if text else ()
    return set().union(*map(_WORDS.__getitem__, words)) if words else set()


class Ftrl:
    """Follow-the-regularised-leader weights, one learning rate per feature."""

    def __init__(self, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, z: np.ndarray, n: np.ndarray, at: np.ndarray, w: np.ndarray, g: np.ndarray) -> None:
        """Take in gradients ``g`` at features ``at``, whose weights were ``w``."""
        g2 = g * g
        z[at] += g - (np.sqrt(n[at] + g2) - np.sqrt(n[at])) / self.alpha * w
        n[at] += g2
