"""op1 with as many sources as there are hosts."""

import random

import pytest
from pyspark.sql import functions as F

from martwise.llm import mixing
from tests.llm.test_text_operators import reshared


def test_targets_of_many_sources_equal_resharing(spark):
    rng = random.Random(4)
    sizes = {f"host{k}.example": rng.choice([0, 1, 7, 90, 1000, 50_000]) for k in range(3000)}
    sizes[None] = 12
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long").repartition(5)
    got = {r["source"]: r for r in mixing.source_targets(frame).collect()}
    want = reshared(sizes)
    assert {s: r["target"] for s, r in got.items()} == pytest.approx(want)
    assert sum(r["target"] for r in got.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(r["target"] <= 2 * r["source_size"] for r in got.values())


def test_sums_before_equal_plain_ones(spark):
    values = [(k, (k * 37) % 101) for k in random.Random(1).sample(range(10_000), 500)] + [(None, 3)]
    frame = spark.createDataFrame(values, "k long, v long").repartition(3)
    order = F.col("k").asc_nulls_last()
    out = mixing.sums_before(frame, [order], {"before": F.col("v"), "place": F.lit(1)})
    total, want = 0, {}
    for n, (k, v) in enumerate(sorted(values, key=lambda r: (r[0] is None, r[0] or 0))):
        want[k] = (total, n)
        total += v
    assert {r["k"]: (r["before"], r["place"]) for r in out.collect()} == want
    assert mixing.sums_before(frame.limit(0), [order], {"before": F.col("v")}).count() == 0
