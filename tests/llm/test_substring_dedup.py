"""Repeated windows removed: against a walk over all windows, and on edge rows."""

import hashlib
import random
import re

import numpy as np
import pytest

from martwise.llm import substring_dedup as sd
from martwise.llm.common import ship
from martwise.llm.queries import QUERIES
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string"


def brute(rows, width=20):
    """Walks the windows in order; null ids last, texts of an id by Spark's hash, given with the row."""
    seen, out = set(), []
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2])):
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - width + 1):
            key = tuple(words[i:i + width])
            if key in seen:
                gone.update(range(i, i + width))
            seen.add(key)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def hashed(docs):
    return [tuple(r) for r in docs.selectExpr("doc_id", "text", "xxhash64(coalesce(text, ''))").collect()]


def found(out):
    return sorted((tuple(r) for r in out.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def passages(seed=5, docs=60):
    """Texts put together of shared passages, cut and joined at random, and of few words in turn."""
    rng = random.Random(seed)
    pool = [[f"p{k}w{rng.randrange(40)}" for _ in range(rng.randrange(15, 90))] for k in range(12)]
    out = []
    for d in range(docs):
        words = []
        for _ in range(rng.randrange(0, 5)):
            p = rng.choice(pool)
            a = rng.randrange(0, 20)
            words += p[a:] if rng.random() < 0.5 else p
            words += [f"d{d}x{rng.randrange(9)}" for _ in range(rng.randrange(0, 6))]
        if d % 9 == 0:
            words += ["la"] * rng.randrange(0, 60) + ["li", "lo", "lu"] * rng.randrange(0, 30)
        out.append((d // 2 if d % 7 == 0 else 100 + d, " ".join(words)))
    return out


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


def test_minimisers_of_equal_windows_are_equal():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 2 ** 62, 500).astype(np.uint64)
    h[300:360] = h[100:160]
    pieces, starts = sd.minimisers(h)
    of = np.repeat(pieces, np.diff(np.append(starts, len(h) - 19)))
    assert (of[300:341] == of[100:141]).all() and len(starts) < len(h) / 4
    z = sd.runs_of(h, sd.PIECE)
    assert all(of[i] in z[i:i + 15] for i in range(len(of)))


def test_query_equals_the_walk_over_all_windows(shipped):
    docs = shipped.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    out = QUERIES["op11_substring_dedup"](shipped, SF001)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    got = found(out)
    assert got == brute(hashed(docs)) and any(r[2] for r in got)


def test_passages_copies_shared_ids_and_turns(shipped):
    rows = passages()
    rows += rows[:6] + [(200 + k, t) for k, (_, t) in enumerate(rows[:6])] + [(None, rows[3][1]), (None, rows[4][1] + " tail")]
    for parts in (1, 5):
        docs = shipped.createDataFrame(rows, DOC).repartition(parts)
        assert found(sd.remove_repeats(docs)) == brute(hashed(docs))


def test_unlike_windows_under_one_hash_are_told_apart(shipped):
    docs = shipped.createDataFrame(passages(8, 80), DOC)
    corpus = sd._Corpus(docs, 20)
    spans = sd.repeated_spans(corpus, 20, 0xFFF).count()
    assert spans > sd.repeated_spans(corpus, 20).count()  # the short hash ties unlike windows
    assert found(sd.remove_repeats(docs, mask=0xFFF)) == brute(hashed(docs))


def test_paths_are_compacted(shipped):
    shared = " ".join(f"s{i}" for i in range(400))
    docs = shipped.createDataFrame([(i, f"a{i} {shared} b{i}") for i in range(8)], DOC)
    spans = sd.repeated_spans(sd._Corpus(docs, 20)).collect()
    assert len(spans) == 8 and {(r["at"], r["length"]) for r in spans} == {(1, 381)}
    assert [r["doc"] for r in spans if r["first"]] == [0]


def test_edge_rows(shipped):
    long_text = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n ", "x"), (4, "one two three", None), (4, "one two three", None), (None, None, None),
            (5, long_text, "x"), (6, "head " + long_text + " tail", "x"), (6, long_text, "x"), (7, "word " * 19, "x"), (8, "word " * 20, "x")]
    docs = shipped.createDataFrame(rows, DOC + ", n_words string")
    for name in ("low", "copy", "tie", "doc", "row", "h", "kept_sha256"):
        docs = docs.withColumn(name, docs["text"])
    out = sd.remove_repeats(docs)
    assert found(out) == brute(hashed(docs))
    assert sd.remove_repeats(docs.limit(0)).count() == 0
