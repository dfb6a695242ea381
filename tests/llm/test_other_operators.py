"""Vectors, archives, the pipeline and the registered queries."""

import base64
import hashlib
import io
import struct

import numpy as np
import pytest

import corpus_pipeline
from martwise.llm import embedding_dedup, ngram_jaccard, piece_encoding, warc
from martwise.llm.common import ship
from martwise.llm.oracle import SQL
from martwise.llm.queries import QUERIES, piece_model
from tests.conftest import SF001
from tests.llm.test_text_operators import DOC, brute_links, brute_stats, classes, clash, edge_docs, reshared
from tests.oracle_compare import compare

SF01 = SF001.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(shipped, name):
    assert compare(shipped, SF001, [name], verbose=False)[name].get("hash_match")


# vectors -----------------------------------------------------------------------------------------

def brute_vectors(vectors, threshold=0.95):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if o else None for v, o in zip(vectors, ok)]
    links = [set() for _ in vectors]
    for i in range(len(vectors)):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i].add(j)
                links[j].add(i)
    return links


def check_vectors(spark, rows):
    df = clash(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumnRenamed("vec_id", "doc_id"))
    df = df.withColumnRenamed("doc_id", "vec_id")
    links = brute_vectors([v for _, v, _ in rows])
    top = classes(links)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(df).collect()}
    want = {r[0]: (len(links[i]), rows[top[i]][0], top[i] == i) for i, r in enumerate(rows)}
    total = sum(w[0] for w in want.values())
    assert sum(g[0] for g in got.values()) <= total
    return sum(min(got[k][0], want[k][0]) for k in want) / max(1, total), got == want


def vector_rows(n=400, dim=16, seed=4):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    out = [list(map(float, v)) for v in base]
    for k in range(60):  # partners from just above the threshold to nearly equal
        v = base[k] / np.linalg.norm(base[k])
        away = rng.normal(size=dim)
        away -= (away @ v) * v
        c = 0.951 + 0.0008 * k
        out.append(list(map(float, c * v + np.sqrt(1 - c * c) * away / np.linalg.norm(away))))
    out += [out[0]] * 5 + [[2 * x for x in out[1]]]
    out += [None, [], [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [float("inf")] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), out[2][:8]]
    group = rng.normal(size=dim)
    out += [list(map(float, group + 0.02 * rng.normal(size=dim))) for _ in range(90)]
    return [(i, v, 0) for i, v in enumerate(out)]


def test_vectors_equal_brute_force(shipped, monkeypatch):
    recall, _ = check_vectors(shipped, vector_rows())
    assert recall >= 0.98
    monkeypatch.setattr(embedding_dedup, "MEMBERS", 16)  # blocks are dealt out on the driver
    monkeypatch.setattr(embedding_dedup, "VISITORS", 32)
    again, _ = check_vectors(shipped, vector_rows())
    assert again == recall


def test_visited_cells_are_the_nearest():
    rng = np.random.default_rng(1)
    index = embedding_dedup.Index(rng.normal(size=(9, 4)), rng.normal(size=(7, 4)), 12)
    x = rng.normal(size=(30, 8))
    total = embedding_dedup._squares(x[:, :4], index.left)[:, :, None] + embedding_dedup._squares(x[:, 4:], index.right)[:, None, :]
    want = np.sort(total.reshape(30, -1), 1)[:, :12]
    got = np.take_along_axis(total.reshape(30, -1), index.cells(x).astype(int), 1)
    assert np.allclose(got, want)


def test_vectors_edges(shipped):
    for rows in ([], [(1, None, 0), (None, [0.0, 0.0], 0)], [(3, [1.0], 0), (2, [2.0], 0), (2, [2.0], 0), (None, [1.0], 1)]):
        df = shipped.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
        out = embedding_dedup.near_duplicates(df).collect()
        assert len(out) == len(rows)
    assert sorted((r["vec_id"] or -1, r["n_links"], r["component_id"]) for r in out) == [(-1, 3, 2), (2, 3, 2), (2, 3, 2), (3, 3, 2)]


# archives ----------------------------------------------------------------------------------------

PAGE = "page_id long, url string, html string"


def brute_pages(rows, least=0):
    first = {}
    for page_id, _, html in rows:
        payload = (html or "").encode()
        if page_id is not None and len(payload) >= least:
            first[payload] = min(first.get(payload, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        of = first.get(payload)
        revisit = of is not None and of != page_id
        out.append((page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "revisit" if revisit else "response", of if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 6])
def test_archives_round_trip(shipped, least):
    rows = [(i, f"http://x/{i}\r\nA: b", f"<p>{i % 7} é</p>" * 5) for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (None, "u", None), (102, "u", "tiny"), (103, "u", "tiny"), (104, None, "x" * 300_000),
             (105, "u", "x" * 300_000), (None, None, "alone"), (106, "u", "WARC/1.1\r\n\r\n"), (103, "u", "tiny")]
    pages = shipped.createDataFrame(rows, PAGE).withColumn("payload", shipped.createDataFrame([(1,)], "a int").first()["a"] + 0 * __import__("pyspark").sql.functions.rand())
    archives = warc.write_archives(pages.repartition(3), least)
    out = warc.read_archives(archives, with_payload=True).collect()
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out), key=repr)
    assert got == brute_pages(rows, least)
    assert all(bytes(r["payload"]) == b"" for r in out if r["record_type"] == "revisit")
    assert sum(r["records"] for r in archives.collect()) == len(rows)
    empty = warc.write_archives(pages.limit(0))
    assert warc.read_archives(empty).count() == 0


def test_archive_layout(shipped):
    import zstandard

    path = warc.write_archives(shipped.read.parquet(f"{SF01}/pages.parquet")).first()["path"].removeprefix("file:")
    data = open(path, "rb").read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.SKIPPABLE and 0 < size <= warc.DICTIONARY_BYTES
    words = zstandard.ZstdCompressionDict(data[8:8 + size])
    one = zstandard.ZstdDecompressor(dict_data=words).decompressobj()
    text = one.decompress(data[8 + size:])
    assert text.startswith(b"WARC/1.1\r\n") and one.unused_data[:4] == b"\x28\xb5\x2f\xfd"  # the next record is a frame of its own
    assert text.count(b"WARC/1.1\r\n") == 1


def test_damaged_payload_is_an_error():
    good = warc.record(1, "u", "some html", None, False)
    import zstandard

    press = zstandard.ZstdCompressor()
    rows = list(warc.read_archive(io.BytesIO(press.compress(good) + press.compress(good))))
    assert len(rows) == 2 and rows[0][1] == b"some html"
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(press.compress(good[:-4]))))


# pipeline ----------------------------------------------------------------------------------------

def test_stages_take_effect_and_keep_the_columns(shipped):
    docs = shipped.read.parquet(f"{SF01}/documents.parquet")
    columns, now = docs.columns, docs
    before = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(shipped, now, SF01)
        assert now.columns == columns, name
        rows = now.collect()
        if name == "quality_classifier":
            labels = {r["doc_id"]: r["quality"] for r in shipped.read.parquet(f"{SF01}/labels.parquet").collect()}
            kept = {r["doc_id"] for r in rows}
            assert np.mean([(k in kept) == bool(v) for k, v in labels.items()]) > 0.97
        elif name == "quality_rules":
            want = {k for k, r in before.items() if (s := brute_stats(r["text"]))[0] >= 50 and 2 * s[4] <= s[0]}
            assert {r["doc_id"] for r in rows} <= want and len(rows) > 0.9 * len(want)
        elif name == "ngram_jaccard":
            ids = sorted(before)
            top = classes(brute_links([before[k]["text"] for k in ids]))
            assert {r["doc_id"] for r in rows} == {ids[t] for t in top}
        else:
            sizes = {}
            for r in before.values():
                sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].split())
            took = {}
            for r in rows:
                took[r["source"]] = took.get(r["source"], 0) + len(r["text"].split())
            want = reshared(sizes)
            assert sum(took.values()) == pytest.approx(sum(want.values()), rel=0.05)
        before = {r["doc_id"]: r for r in rows}
    last = corpus_pipeline.STAGES[-1][1](shipped, now, SF01).collect()
    c = piece_encoding.codec(piece_model())
    assert len(last) == len(rows) and all(r["ids"] == c.encode(before[r["doc_id"]]["text"]).ids for r in last[:50])


def test_pipeline_on_edge_rows(shipped, tmp_path):
    good = " ".join(f"word{i}" for i in range(80))
    docs = edge_docs(shipped).unionByName(shipped.createDataFrame([(50 + k, good, "en", "z", 1) for k in range(3)], DOC))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    shipped.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    # without labels no model is fitted, and the classifier leaves all documents to the other stages
    assert {r["doc_id"] for r in corpus_pipeline.run(shipped, str(tmp_path)).collect()} <= {6, 50}
    now = clash(docs)
    assert corpus_pipeline.STAGES[0][1](shipped, now, str(tmp_path)).count() == docs.count()
    for name, stage in corpus_pipeline.STAGES:
        now = stage(shipped, now, str(tmp_path))
    assert {r["doc_id"] for r in now.collect()} <= {6, 50}


def test_pipeline_query_runs(shipped):
    out = QUERIES["pipeline"](shipped, SF001)
    assert out.count() > 0 and "doc_id" in out.columns


def test_jaccard_query_columns(shipped):
    out = QUERIES["op4_ngram_jaccard"](shipped, SF001)
    assert out.columns == ["doc_id", "class_id", "n_links", "kept"]
    assert ngram_jaccard.BANDS * ngram_jaccard.ROWS == ngram_jaccard.HASHES


def test_vectors_recall_on_a_large_grid(shipped, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "MIN_CODES", 32)
    recall, _ = check_vectors(shipped, vector_rows())
    assert recall >= 0.9
