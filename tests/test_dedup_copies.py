"""Rows without a real id are all kept, equal ones and those that differ in a null only."""

from martwise.operators.dedup import keep_first_with_id


def test_equal_rows_without_an_id_are_all_kept(spark):
    rows = [("k", "", 1, 5)] * 3 + [("k", None, None, 5)] * 2 + [("k", " ", None, None)] * 4 + [("k", "a", 2, 5), ("k", "a", 1, 6)]
    rows += [("k", None, 5, None)]  # differs from the second in which value is null
    df = spark.createDataFrame(rows * 2, "key string, tid string, seq int, v int")
    for parts in (1, 3):
        for order in ([], ["seq"]):
            out = [tuple(r) for r in keep_first_with_id(df.repartition(parts), ["key"], "tid", order).collect()]
            want = [r for r in rows * 2 if not (r[1] or "").strip()] + ([("k", "a", 1, 6)])
            assert sorted(map(repr, out)) == sorted(map(repr, want))
