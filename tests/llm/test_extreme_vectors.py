"""Finite vectors whose squares leave the range of doubles, and partners at 0.95 to 0.96 on a large grid."""

import numpy as np
import pytest

from martwise.llm import embedding_dedup
from martwise.llm.common import ship


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


def links(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df).collect()}


def test_very_large_and_very_small_components(shipped):
    near, far = [1.0, 2.0, 3.0, 4.0], [4.0, -1.0, 0.5, 3.0]
    for size in (1e200, 1e-200, 5e307 / 4, 1e-310):
        rows = [[x * size for x in near], [x * size * 1.01 for x in near], [x * size for x in far]]
        assert links(shipped, rows) == {0: (1, 0), 1: (1, 0), 2: (0, 2)}, size
    got = links(shipped, [[x * 1e250 for x in near], [x * 1e-250 for x in near], far])
    assert got == {0: (1, 0), 1: (1, 0), 2: (0, 2)}


def test_partners_just_above_the_threshold_on_a_large_grid(shipped, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "MIN_CODES", 64)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(1200, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(1)[:, None] * base
    away /= np.linalg.norm(away, axis=1)[:, None]
    c = rng.uniform(0.9501, 0.96, (len(base), 1))
    rows = np.concatenate((base, c * base + np.sqrt(1 - c * c) * away))
    got = links(shipped, rows.tolist())
    assert sum(got[k][1] == got[k + 1200][1] == k for k in range(1200)) >= 0.95 * 1200
