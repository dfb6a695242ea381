"""Gzip arrays record by record, places in files, keys of events without an id."""

import gzip
import json
import os
import random

import pytest

from martwise import schemas
from martwise.plans.facts import fact_cart_events
from martwise.sources import json_chunks as jc
from martwise.sources import json_sources as js
from martwise.streaming import read_ingested, start_cart_event_ingest
from tests import fixtures


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(text)
    return path


def split(text):
    """The splitter alone, on text cut as the reader cuts it."""
    cuts = text.split("}")
    if cuts[-1] == "":
        cuts.pop()
    s = jc.RecordSplitter("f")
    out = [s.add(c) for c in cuts[:-1]] + ([s.end(cuts[-1])] if cuts else [])
    return [json.loads(x) for x in out if x is not None]


def awkward(rng, depth=0):
    strings = ["", "}", "{", '"', "\\", "a}b{c", '\\"}', "é}", "\n", "[1,2]", "\\\\", " "]
    kind = rng.random()
    if depth > 3 or kind < 0.4:
        return rng.choice([None, True, 1.5, -3, rng.choice(strings), "".join(rng.choice(strings) for _ in range(3))])
    if kind < 0.6:
        return [awkward(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {rng.choice(strings) + str(k): awkward(rng, depth + 1) for k in range(rng.randrange(4))}


def test_splitter_gives_back_any_array():
    rng = random.Random(1)
    for case in range(500):
        rows = [{f"k{i}": awkward(rng) for i in range(rng.randrange(3))} for _ in range(rng.randrange(5))]
        text = json.dumps(rows, ensure_ascii=bool(case % 2), indent=(None, 1)[case % 3 == 0])
        assert split(text + "\n" * (case % 2)) == rows
    assert split("") == [] and split(" \n") == [] and split("[ ]\n") == [] and split('{"a": {}}') == [{"a": {}}]
    assert split('{"a": {}}\n') == [{"a": {}}]


@pytest.mark.parametrize("text", [
    '[{"a": 1}', '[{"a": 1}, {"b": 2', '[{"a": 1},', '[{"a": "x}', '[{"a": 1}, 2]', '[1, {"a": 1}]', '[[{"a": 1}]]', "[",
    '{"a": {"b": 1}', '{"a": 1} {"b": 2}', '[{"a": 1} {"b": 2}]', '[{"a": 1}}]', "5", '[{"a": 1}, null]'])
def test_damaged_or_odd_texts_fail(text):
    with pytest.raises(ValueError, match="f: "):
        split(text)


def exports(folder, n=5):
    paths = []
    for i in range(n):
        rows = [dict(fixtures.CART[0], event_id=None if k % 3 == 0 else f"e{i}-{k}", device=f"d{i}", page=f"p{k}")
                for k in range(20 + 7 * i)]
        fixtures.write_json_gz(f"{folder}/part-{i}.json.gz", rows)
        paths.append(f"{folder}/part-{i}.json.gz")
    return paths


def test_equals_the_reader_of_whole_arrays(spark, tmp_dir):
    paths = exports(f"{tmp_dir}/a") + [write_text(f"{tmp_dir}/a/empty.json.gz", "[]"), write_text(f"{tmp_dir}/a/none.json.gz", "")]
    for chunk in (1, 7, 50_000):
        got = jc.read_json_chunked(spark, paths, schemas.RAW_CART_EVENT, chunk)
        want = js.read_json_gzip(spark, paths, schemas.RAW_CART_EVENT)
        assert got.drop("_seq").schema == want.drop("_seq").schema
        assert sorted(map(str, got.drop("_seq").collect())) == sorted(map(str, want.drop("_seq").collect()))
    places = {}
    for r in got.select("_seq.file", "_seq.pos").collect():
        places.setdefault(r["file"], []).append(r["pos"])
    assert sorted(map(len, places.values())) == [20, 27, 34, 41, 48]
    assert all(sorted(x) == list(range(len(x))) for x in places.values())


def test_items_are_parsed_one_by_one(spark, tmp_dir):
    path = f"{tmp_dir}/o.json.gz"
    rows = [{"id": 1, "line_items": [{"id": 5, "quantity": 2}, "str", None, 3]}, {"id": 2}, *fixtures.SHOPIFY]
    fixtures.write_json_gz(path, rows)
    got, want = (f(spark, path, schemas.RAW_ORDER).drop("_seq") for f in (jc.read_json_chunked, js.read_json_gzip))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_damaged_file_fails_the_load_and_plain_files_are_refused(spark, tmp_dir):
    bad = write_text(f"{tmp_dir}/bad.json.gz", '[{"event_id": "a"}, {"event_id": "b"')
    with pytest.raises(Exception, match="ends inside"):
        jc.read_json_chunked(spark, bad, schemas.RAW_CART_EVENT).collect()
    wrong = write_text(f"{tmp_dir}/wrong.json.gz", '[{"event_id": "a" "b"}]')
    with pytest.raises(Exception):
        jc.read_json_chunked(spark, wrong, schemas.RAW_CART_EVENT).collect()
    with pytest.raises(ValueError, match="gzip"):
        jc.read_json_chunked(spark, f"{tmp_dir}/x.json", schemas.RAW_CART_EVENT)


def test_keys_do_not_depend_on_packing_or_on_the_stream(spark, tmp_dir):
    paths = exports(f"{tmp_dir}/src")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    keys = []
    try:
        for size, cost in (("128m", "0"), ("1k", "1k"), (old)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", cost)
            raw = jc.read_json_chunked(spark, paths, schemas.RAW_CART_EVENT)
            keys.append((raw.rdd.getNumPartitions(), sorted(r["event_key"] for r in fact_cart_events(raw).collect())))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert len({n for n, _ in keys}) > 1 and keys[0][1] == keys[1][1] == keys[2][1]
    assert len(set(keys[0][1])) == 170
    for files in (1, 4):  # one file and several files a micro-batch
        target = f"{tmp_dir}/gold{files}"
        start_cart_event_ingest(spark, f"{tmp_dir}/src", target, f"{tmp_dir}/ckpt{files}", files).awaitTermination(300)
        assert sorted(r["event_key"] for r in read_ingested(spark, target).collect()) == keys[0][1]


def test_variant_records_keep_unlisted_fields(spark, tmp_dir):
    rows = [{"id": "a1", "name": "Main", "currentBalance": 10.5, "nickname": "x", "kind": {"deep": [1, 2]}, "type": None, "o'k": 3},
            {"id": 7, "status": "active"}, {}]
    fixtures.write_json_gz(f"{tmp_dir}/mercury/accounts.json.gz", rows)
    df = js.read_source(spark, tmp_dir, "mercury_accounts")
    got = df.select("id", "name", "currentBalance", jc.field("nickname").alias("nickname"), jc.field("o'k", "long").alias("ok"),
                    jc.field("kind", "struct<deep:array<int>>").alias("kind"), jc.states_null("type").alias("null_type"),
                    jc.states_null("name").alias("null_name"), "_seq.pos").orderBy("pos").collect()
    assert [r["id"] for r in got] == ["a1", "7", None] and got[0]["currentBalance"] == "10.5"
    assert got[0]["nickname"] == "x" and got[0]["kind"]["deep"] == [1, 2] and got[0]["ok"] == 3
    assert [r["null_type"] for r in got] == [True, None, None] and [r["null_name"] for r in got] == [False, None, None]
    assert [json.loads(r[0]) for r in df.selectExpr("to_json(record)", "_seq.pos").orderBy("pos").collect()] == [
        json.loads(json.dumps(r, sort_keys=True)) for r in rows]
