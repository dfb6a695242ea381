"""Notices that are nearly alike, and notices in long lines."""

from martwise.llm import license_scan
from martwise.llm.common import ship


def labels_of(spark, texts):
    ship(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan.scan(docs, keep=["doc_id"]).collect()}
    return [got[i] for i in range(len(texts))]


def test_a_plain_attribution_notice_is_not_a_noncommercial_one(spark):
    plain = "This work is licensed under a Creative Commons Attribution 4.0 International License."
    limited = plain.replace("Attribution", "Attribution-NonCommercial")
    got = labels_of(spark, [plain, plain.replace(" Attribution", "\nAttribution"), limited, limited.replace("4.0", "\n4.0")])
    assert got[0] == got[1] == ("cc-by-notice", 1.0)
    assert all("cc-by-nc-notice" in labels.split(",") and score == 1.0 for labels, score in got[2:])


def test_words_far_apart_on_a_long_line_are_no_notice(spark):
    gap = " prose" * 200 + " "
    whole = "Released, as was said before, under the terms of the MIT License."
    got = labels_of(spark, [gap.join(["released", "under", "the", "mit", "license"]), whole, gap + whole + gap])
    assert got == [("", 0.0), ("mit,mit-notice", 1.0), ("mit,mit-notice", 1.0)]


def test_scattered_words_of_one_sentence_are_no_notice(spark):
    scattered = ("She was released early from work under grey skies, then met the dean of MIT in his office to ask about "
                 "a driving license for her brother.")
    got = labels_of(spark, [scattered, scattered.replace(", ", ",\n"), scattered * 40])
    assert got == [("", 0.0)] * 3


def test_one_line_and_many_are_judged_alike(spark):
    texts = [lead * n + t + " and more prose follows it here" * 3 for ts in license_scan.NOTICES.values() for t in ts
             for lead in ("some prose before ", "released under ") for n in (0, 1, 30)]
    plain, wrapped = labels_of(spark, texts), labels_of(spark, [t.replace(" ", "\n") for t in texts])
    assert plain == wrapped and all(score == 1.0 for _, score in plain)
