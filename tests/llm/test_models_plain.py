"""The text models' features and fits against plain versions; spans of pieces against the library."""

import math
import random
import re

import numpy as np
import pytest
import xxhash

from martwise.llm import features, piece_encoding, quality_classifier, toxicity
from martwise.llm.common import ship
from martwise.llm.queries import QUERIES, piece_model
from tests.conftest import SF001

MASK = (1 << 64) - 1


def mix(*parts):
    out = parts[0] * 0x9E3779B97F4A7C15 & MASK
    for p in parts[1:]:
        out ^= out >> 29
        out = (out ^ p) * 0x9E3779B97F4A7C15 & MASK
    return out ^ (out >> 32)


def plain_ngrams(text, bits):
    tokens = re.findall(r"\w+|[^\w\s]+", text)
    word = [xxhash.xxh32_intdigest(t.lower()) for t in tokens]
    form = []
    for k, t in enumerate(tokens):
        marks = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in t)
        whole = (word[k], xxhash.xxh32_intdigest(re.sub(r"(.)\1+", r"\1", marks)))
        form.append(whole)
    shape = [0x5EED if k and form[k] == form[k - 1] else form[k][1] for k in range(len(form))]
    counts = {}

    def add(*parts):
        k = mix(*parts) >> (64 - bits - 8) & ((1 << bits) - 1)
        counts[k] = counts.get(k, 0) + 1
    for k in range(len(tokens)):
        add(word[k], 1)
        add(shape[k], 3)
        if k:
            add(word[k - 1], word[k], 2)
            add(shape[k - 1], shape[k], 4)
        if k > 1:
            add(shape[k - 2], shape[k - 1], shape[k], 5)
    size = math.sqrt(sum(counts.values()))
    return {k: math.sqrt(c) / size for k, c in counts.items()}


def random_text(rng):
    words = ["the", "The", "THE", "cat", "cats", "x9", "42", "Éa", "a1b", "!!", "don't", "iPhone", "ﬁ", "日本"]
    return " ".join(rng.choice(words) + rng.choice(["", ",", ".", "?!"]) for _ in range(rng.randrange(1, 40)))


def test_ngram_features_equal_plain_ones():
    rng = random.Random(6)
    for _ in range(150):
        text = random_text(rng)
        ids, values = features.ngram_features(text, 20)
        want = plain_ngrams(text, 20)
        assert ids.tolist() == sorted(want)
        assert np.allclose(values, [want[k] for k in sorted(want)], atol=1e-6)


def test_word_features_equal_plain_ones():
    rng = random.Random(7)
    for _ in range(100):
        text = random_text(rng)
        words = set(re.findall(r"[^\W\d_]+", text.lower()))
        want = {xxhash.xxh3_64_intdigest(x) >> 1 for w in words for x in (w, "^4" + w[:4], "^5" + w[:5])}
        assert features.word_features(text) == want


def test_follow_the_leader_equals_a_plain_loop():
    rng = np.random.default_rng(2)
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 0.5
    rule, size = features.Ftrl(alpha, beta, l1, l2), 12
    z, n = np.zeros(size), np.zeros(size)
    pz, pn = [0.0] * size, [0.0] * size

    def weight(i):
        if abs(pz[i]) <= l1:
            return 0.0
        return (math.copysign(l1, pz[i]) - pz[i]) / ((beta + math.sqrt(pn[i])) / alpha + l2)
    for _ in range(300):
        at = rng.choice(size, 4, replace=False)
        x = rng.uniform(-1, 1, 4)
        w = rule.weights(z[at], n[at])
        assert np.allclose(w, [weight(i) for i in at])
        g = (1 / (1 + math.exp(-float(w @ x))) - rng.integers(2)) * x
        rule.update(z, n, at, w, g)
        for i, gi, wi in zip(at, g, w):
            sigma = (math.sqrt(pn[i] + gi * gi) - math.sqrt(pn[i])) / alpha
            pz[i] += gi - sigma * wi
            pn[i] += gi * gi
    assert np.allclose(z, pz) and np.allclose(n, pn)


def test_classifier_scores_are_sparse_dot_products(spark):
    ship(spark)
    rng = random.Random(1)
    rows = [(k, random_text(rng) + (" good words" if k % 2 else " bad words")) for k in range(300)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality_classifier.train(docs, spark.createDataFrame([(k, k % 2) for k in range(300)], "doc_id long, quality int"))
    bias, at, w = model
    weight = dict(zip(at.tolist(), w.tolist()))
    for r in quality_classifier.score(docs, model).collect():
        total = bias + sum(weight.get(k, 0.0) * v for k, v in plain_ngrams(r["text"] or "", 20).items())
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-4)


def ordinal_data(seed=3, n=1500, vocab=30):
    """Grades drawn from a known proportional-odds model over words."""
    rng = np.random.default_rng(seed)
    true_w = np.where(np.arange(vocab) < 10, rng.uniform(1.0, 2.5, vocab), 0.0)
    theta = np.array([1.0, 3.0, 5.0])
    words = [np.sort(rng.choice(vocab, rng.integers(2, 9), replace=False)).astype(np.int64) for _ in range(n)]
    score = np.array([true_w[x].sum() for x in words])
    cdf = 1 / (1 + np.exp(-(theta[None, :] - score[:, None])))
    grade = (rng.uniform(size=n)[:, None] > cdf).sum(axis=1)
    return words, grade, score


def log_likelihood(theta, weights, words, grade):
    score = np.array([weights[x].sum() for x in words])
    cdf = np.hstack([1 / (1 + np.exp(-(theta[None, :] - score[:, None]))), np.ones((len(words), 1))])
    cdf = np.hstack([np.zeros((len(words), 1)), cdf])
    p = cdf[np.arange(len(words)), grade + 1] - cdf[np.arange(len(words)), grade]
    return np.log(np.maximum(p, 1e-12)).mean(), (1 - cdf[:, 1:4]).sum(axis=1)


def test_ordinal_fit_comes_near_the_plain_likelihood_fit():
    words, grade, score = ordinal_data()
    vocab = np.arange(30, dtype=np.int64)
    theta, ids, w, _ = toxicity.fit(grade, words, vocab)
    own = np.zeros(30)
    own[ids] = w
    assert (np.diff(theta) > 0).all() and (own >= 0).all()
    # plain: gradient ascent on the whole likelihood, thresholds as sums of positive steps
    x = np.zeros((len(words), 30))
    for k, v in enumerate(words):
        x[k, v] = 1
    pw, first, steps = np.zeros(30), 0.0, np.zeros(2)
    for _ in range(3000):
        t = np.cumsum([first, *np.exp(steps)])
        cdf = np.hstack([np.zeros((len(x), 1)), 1 / (1 + np.exp(-(t[None, :] - (x @ pw)[:, None]))), np.ones((len(x), 1))])
        dens = cdf * (1 - cdf)
        i = np.arange(len(x))
        p = np.maximum(cdf[i, grade + 1] - cdf[i, grade], 1e-9)
        pw = np.maximum(pw - 1.0 * (x.T @ ((dens[i, grade + 1] - dens[i, grade]) / p)) / len(x), 0)
        dt = np.array([np.where(grade == j, dens[:, j + 1] / p, 0).sum() - np.where(grade == j + 1, dens[:, j + 1] / p, 0).sum()
                       for j in range(3)]) / len(x)
        first += 1.0 * dt.sum()
        steps += 1.0 * np.array([dt[1:].sum(), dt[2]]) * np.exp(steps)
    best, severity = log_likelihood(np.cumsum([first, *np.exp(steps)]), pw, words, grade)
    got, own_severity = log_likelihood(theta, own, words, grade)
    flat = log_likelihood(np.log(np.cumsum(np.bincount(grade, minlength=4))[:3] / (len(grade) - np.cumsum(np.bincount(grade, minlength=4))[:3])),
                          np.zeros(30), words, grade)[0]
    assert got > best - 0.15 * (best - flat)
    assert np.corrcoef(severity, own_severity)[0, 1] > 0.97 and np.abs(severity - own_severity).mean() < 0.25
    assert np.corrcoef(score, own_severity)[0, 1] > 0.85


def test_severity_is_the_sum_over_thresholds(spark):
    ship(spark)
    words = sorted(features.word_features("awful thing"))
    model = (np.array([0.5, 1.5, 3.0]), np.array(words, np.int64), np.linspace(0.3, 1.1, len(words)), 0.5)
    docs = spark.createDataFrame([(1, "Awful, awful thing"), (2, None), (3, "nice")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.severity(docs, model).collect()}
    for k, total in ((1, float(model[2].sum())), (2, 0.0), (3, 0.0)):
        over = [1 / (1 + math.exp(t - total)) for t in model[0]]
        assert got[k]["severity"] == pytest.approx(sum(over)) and got[k]["score"] == pytest.approx(over[0])


def test_grades_come_from_the_other_fold():
    rng = np.random.default_rng(5)
    toxic = np.array([k % 3 == 0 for k in range(300)]).astype(int)
    words = [np.unique(rng.integers(0, 40, 12) + (100 if t else 0)).astype(np.int64) for t in toxic]
    grade = toxicity.grades(toxic, words)
    assert (grade[toxic == 0] == 0).all() and set(grade[toxic == 1]) <= {1, 2, 3}
    own = np.array([5000, 5001, 5002, 5003], np.int64)
    words[0] = own  # words of one row only tie nothing to a label
    assert toxicity.grades(toxic, words)[0] == 1


def test_spans_equal_the_library():
    c = piece_encoding.PieceCodec(piece_model())
    rng = random.Random(12)
    for _ in range(300):
        text = "".join(rng.choice(["a", "B", " ", "  ", "é", "漢", "😀", "\n", "the ", "ing", "\x00", "ß", "٣"]) for _ in range(rng.randrange(30)))
        e = c.encode(text)
        want = c.library.encode(text, return_type="proto").pieces
        assert e.ids == [p.id for p in want]
        at = 0
        for k, p in enumerate(want):
            assert e.end[k] == p.end or c.library.is_byte(p.id)
            if not c.library.is_byte(p.id):
                assert e.begin[k] == p.begin
            assert e.begin[k] == at
            at = e.end[k]
        assert at == len(text.encode())


def test_spans_of_the_query(spark):
    import hashlib
    import struct

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    c = piece_encoding.PieceCodec(piece_model())
    for r in QUERIES["op6_piece_encoding"](spark, SF001).collect()[:60]:
        e = c.encode(docs[r["doc_id"]])
        raw = b"".join(struct.pack("<qq", a, b) for a, b in zip(e.begin.tolist(), e.end.tolist()))
        assert r["spans_sha256"] == hashlib.sha256(raw).hexdigest()
