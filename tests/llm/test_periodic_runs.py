"""Periodic runs against a plain search over all periods, and on edge rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from martwise.llm import periodic_runs as pr
from martwise.llm.common import ship
from martwise.llm.queries import QUERIES
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string"
COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def plain_runs(words, least=6, times=4):
    """For every period, the maximal stretches that keep it; those of a smaller period are left out."""
    ids = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if len(words) else np.empty(0, int)
    n, out, taken = len(ids), [], set()
    for q in range(1, n // times + 1):
        same = np.concatenate(([0], (ids[q:] == ids[:-q]).astype(int), [0]))
        edge = np.diff(same)
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            length = b - a + q
            if length >= 2 * q and (a, length) not in taken:
                taken.add((a, length))  # the same stretch has a smaller period
                if length >= max(least, times * q):
                    out.append((a, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    got = plain_runs(words)
    gone = {i for s, length, q in got for i in range(s + q, s + length)}
    best = None
    for r in got:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(got), head[0], head[1], head[2], head[3], sha("".join(f"{s},{n},{q}\n" for s, n, q in got)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def found(out):
    return sorted((tuple(r) for r in out.select(COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


def repetitive(rng, n, letters):
    """Words of few letters with parts said again."""
    words = []
    while len(words) < n:
        kind = rng.random()
        if words and kind < 0.4:
            a = rng.randrange(len(words))
            words += words[a:a + rng.randrange(1, 9)] * rng.randrange(1, 8)
        else:
            words += [rng.choice(letters) for _ in range(rng.randrange(1, 6))]
    return words[:n]


def test_squares_are_all_maximal_repetitions():
    rng = random.Random(2)
    for case in range(400):
        words = repetitive(rng, rng.randrange(0, 90), "ab" if case % 3 else "abcde")
        ids = [ord(w) for w in words]
        got = sorted(((s, e - s + 1, q) for (s, q), e in pr.squares(ids).items()), key=lambda r: (r[0], r[2]))
        # the plain search with two periods and two words
        n, want, taken = len(ids), [], set()
        for q in range(1, n // 2 + 1):
            i = 0
            while i + q < n:
                j = i
                while j + q < n and ids[j] == ids[j + q]:
                    j += 1
                if j - i >= q and (i, j) not in taken:
                    if not any(s <= i and e >= j + q - 1 and q % p == 0 and p < q for s, e, p in taken_runs(want)):
                        want.append((i, j + q - i, q))
                i = max(j, i) + 1
        assert got == sorted(want, key=lambda r: (r[0], r[2])), words


def taken_runs(runs):
    return [(s, s + n - 1, q) for s, n, q in runs]


def test_runs_equal_the_plain_search():
    rng = random.Random(7)
    for case in range(300):
        words = repetitive(rng, rng.randrange(0, 400), ("a", "b") if case % 2 else [f"w{k}" for k in range(30)])
        assert pr.runs(words) == plain_runs(words), words


def test_stretches_hold_every_run():
    rng = random.Random(11)
    for _ in range(100):
        words = repetitive(rng, 300, [f"w{k}" for k in range(60)])
        ids = np.unique(words, return_inverse=True)[1]
        held = list(pr.candidate_stretches(ids))
        assert all(any(a <= s and s + n <= b for a, b in held) for s, n, _ in plain_runs(words))


def test_long_runs_stay_cheap():
    assert pr.runs(["la"] * 60_000) == [(0, 60_000, 1)]
    a, b = "a", "ab"
    while len(b) < 40_000:  # Fibonacci words: many squares, no run of four periods
        a, b = b, b + a
    assert pr.runs(list(b)) == []
    block = [f"w{i}" for i in range(5000)]
    assert pr.runs(block * 5 + block[:7]) == [(0, 25_007, 5000)]
    comb = [w for k in range(1, 200) for w in ["a"] * k + ["b"]]
    assert pr.runs(comb) == plain_runs(comb)


def test_query_equals_the_plain_search(shipped):
    rows = [tuple(r) for r in shipped.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op13_periodic_runs"](shipped, SF001)
    got = found(out)
    assert got == sorted((expected(*r) for r in rows), key=str)
    assert any(r[1] for r in got) and dict(out.dtypes)["exponent_milli"] == "bigint"


def test_edge_rows(shipped):
    rng = random.Random(5)
    long_text = " ".join(repetitive(rng, 60_000, [f"w{k}" for k in range(3000)]))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "x " * 6), (5, "x " * 5), (None, "a b a b a b a b"), (6, "a b a b a b a b c"),
            (6, "a b a b a b a b c"), (7, "a a a a a a b b b b b b"), (None, None)]
    rows += [(k, "one two three four five six seven eight") for k in range(100, 140)]
    docs = shipped.createDataFrame(rows, DOC)
    from martwise.llm.queries import run_digests

    for name in ("runs", "start", "period", "collapsed", "n_words"):
        docs = docs.withColumn(name, docs["text"])
    assert found(run_digests(docs)) == sorted((expected(*r) for r in rows), key=str)
    assert run_digests(docs.limit(0)).count() == 0
    [row] = pr.find_runs(shipped.createDataFrame([(8, long_text)], DOC)).collect()
    got = [tuple(r) for r in row["runs"]]
    words = long_text.split(" ")
    assert row["n_words"] == 60_000 and got == pr.runs(words) and len(got) > 100
    for s, n, q in rng.sample(got, 60):
        assert words[s:s + n - q] == words[s + q:s + n] and n >= max(6, 4 * q)
        assert (s == 0 or words[s - 1] != words[s - 1 + q]) and (s + n == len(words) or words[s + n] != words[s + n - q])
