"""Ids that many rows share: one row of each is learnt from, and shards are cut within an id."""

from martwise.llm import quality_classifier, token_records
from martwise.llm.common import ship
from martwise.llm.queries import word_model
from tests.llm.test_text_operators import held_out_id

DOC = "doc_id long, text string"


def test_a_labelled_id_is_learnt_from_once(spark):
    ids = [k for k in range(40) if not held_out_id(k)][:10]
    rows = [(ids[0], f"text {i}") for i in range(300)] + [(ids[0], None)] * 9 + [(k, f"other {k}") for k in ids[1:]]
    known = spark.createDataFrame([(k, k % 2) for k in ids], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, DOC)
    got = [quality_classifier.labelled_texts(docs.repartition(n), known, "quality").collect() for n in (2, 5)]
    assert sorted(got[0]) == sorted(got[1])
    assert sorted(r["doc_id"] for r in got[0]) == ids and all(r["text"] for r in got[0])


def test_shards_are_cut_within_a_common_id(spark):
    ship(spark)
    rows = [(None, f"none {i}") for i in range(2000)] + [(7, f"seven {i}") for i in range(2000)] + [(i, f"one {i}") for i in range(10, 100)]
    docs = spark.createDataFrame(rows, DOC).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_records.write_records(docs, word_model())
        sizes = sorted(r["docs"] for r in manifest.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == len(rows) and sizes[-1] < 1900
    got = token_records.read_records(manifest).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [k for k, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
