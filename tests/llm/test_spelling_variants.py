"""Spelling variants against all edits of every word, and on edge rows."""

import random
import re
import zlib
from collections import Counter

import pytest

from martwise.llm import spelling_variants as sv
from martwise.llm.common import ship
from martwise.llm.queries import QUERIES
from tests.conftest import SF001

DOC = "doc_id long, text string"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def brute(rows):
    """Tries every edit with every letter in use."""
    words = counted(rows)
    letters = sorted(set("".join(words)))
    form, near_of = {}, {}
    for w in words:
        tried = set()
        for i in range(len(w) + 1):
            tried.update(w[:i] + c + w[i:] for c in letters)
            if i < len(w):
                tried.add(w[:i] + w[i + 1:])
                tried.update(w[:i] + c + w[i + 1:] for c in letters)
        near = [x for x in tried if x in words and x != w]
        near_of[w] = len(near)
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], near_of[w], words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def found(out):
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


def test_query_equals_all_edits(shipped):
    rows = [tuple(r) for r in shipped.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = found(QUERIES["op12_spelling_variants"](shipped, SF001))
    assert got == brute(rows) and any(r[1] for r in got)


def test_crowded_words_and_chains(shipped):
    """Words of two letters in all orders (every kind of edit, equal letters in a row), of very unlike counts."""
    rng = random.Random(4)
    rows = []
    for d in range(40):
        words = ["".join(rng.choice("ab") for _ in range(rng.randrange(6, 11))) for _ in range(150)]
        words += ["abababab"] * 120 + ["abababa"] * 9 + ["ababababÀ", "ABABABABà"] + ["ababababc"] * (d % 8 == 0)
        rows.append((d, " ".join(words)))
    want = brute(rows)
    assert any(r[2] != r[1] and r[1] for r in want)  # a chain of two forms
    docs = shipped.createDataFrame(rows, DOC)
    for parts in (1, 6):
        assert found(sv.variants(docs.repartition(parts))) == want


def test_numbers_are_one_a_node_over_many_ranges(shipped):
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 8))) for _ in range(900)})
    frame = shipped.createDataFrame([(w,) for w in words], "key string")
    shipped.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows, bases = sv.number_trie(frame)
        got = rows.collect()
    finally:
        shipped.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(bases) > 2
    node, ids = {}, {}
    for r in got:
        first, base, shared = bases[r["shard"]]
        ids[r["key"]] = first + r["at"]
        for depth, x in enumerate(r["path"]):
            number = shared[x] if x < len(shared) else base + x
            assert node.setdefault(r["key"][:depth], number) == number
    assert len(set(node.values())) == len(node)
    assert sorted(ids, key=ids.get) == words and sorted(ids.values()) == list(range(len(words)))


def test_edge_rows(shipped):
    long_run = "xyz" * 4000
    rows = [(1, None), (2, ""), (3, " \n 7 "), (4, "wonderful wonderful"), (4, "wonderful wonderful"), (None, "wonderfull wonderfull"),
            (5, long_run), (6, long_run + "q"), (7, long_run), (8, long_run + "Q"), (9, "÷÷÷÷×××÷ ÷÷÷÷×××÷ À123456 Straßenlaterne Straßenlaterne")]
    docs = shipped.createDataFrame(rows, DOC)
    for name in ("word", "n", "key", "shard", "path", "at"):
        docs = docs.withColumn(name, docs["text"])
    got = found(sv.variants(docs))
    want = counted(rows)
    assert {r[0]: r[3] for r in got} == want
    near = {r[0]: r[4] for r in got}
    assert near["wonderful"] == near["wonderfull"] == 1 and near["xyz" * 4000] == 1 and near["straßenlaterne"] == 0
    assert sv.variants(docs.limit(0)).count() == 0
