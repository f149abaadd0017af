"""The largest inner products against all of them."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlab.llm import vector_search

SCHEMA = "vec_id bigint, embedding array<double>"


def plain(rows, k=5, every=50, scale=256):
    held = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(held):
        if i is None or i % every:
            continue
        scores = [(min(max(sum(x * y for x, y in zip(v, w)), -(2**63)), 2**63 - 1), j) for b, (j, w) in enumerate(held) if a != b]
        scores.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(i, r, j, s) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def found(df, k=5, every=50, **more):
    rows = vector_search.top_products(df, F.col("vec_id") % every == 0, k, **more).collect()
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in rows), key=str)


def made(n, width, seed, spread=1.0):
    rng = np.random.RandomState(seed)
    lengths = np.exp(rng.randn(n) * spread)[:, None]
    return [(int(i), [float(x) for x in v]) for i, v in enumerate(rng.randn(n, width) * lengths * np.linspace(2, 0.1, width))]


@pytest.mark.parametrize("cells,spread", [(1 << 18, 0.0), (256, 1.5), (2_000, 0.3)])
def test_equals_all_products(spark, cells, spread):
    rows = made(400, 12, 5, spread)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df, every=20, cells=cells) == plain(rows, every=20)


def test_ties_copies_and_few_rows(spark):
    rows = [(i, [1.0, 0.5]) for i in range(130)] + [(50, [1.0, 0.5])] + [(None, [3.0, 1.0]), (1_000, [-1.0, 0.0]), (2_000, [])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == plain(rows)
    few = rows[:3]
    assert found(spark.createDataFrame(few, SCHEMA)) == plain(few)
    assert found(spark.createDataFrame([(0, [1.0])], SCHEMA)) == []


def test_rows_that_take_no_part(spark):
    rows = made(60, 4, 1) + [(100, None), (150, [1.0, None, 0.0, 0.0]), (200, [float("nan")] * 4), (250, [float("inf"), 0.0, 0.0, 0.0]),
                             (300, [0.0] * 4), (350, [1.0]), (400, [-0.001] * 6)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("id", "row", "length", "block", "score", "vector", "asked")})
    assert found(df) == plain(rows)
    assert found(df.limit(0)) == []
    assert found(df.where("embedding is null")) == []


def test_large_numbers_stay_exact(spark):
    rows = [(0, [1e6 + 1 / 256, 1e7, -1e7]), (1, [1e7 + 3 / 256, 1.0, 1.0]), (2, [1e7 + 4 / 256, 1.0, 1.0]), (3, [1e300, 0.0, 0.0]), (4, [-1e200, 1.0, 2.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == plain(rows)


def test_long_vectors_settle_most_others(spark, monkeypatch):
    """With lengths that differ, few products are multiplied out."""
    seen = []
    honest = vector_search.products
    monkeypatch.setattr(vector_search, "products", lambda q, x, a, b: seen.append(len(a)) or honest(q, x, a, b))
    rows = made(4_000, 16, 3, 1.0)
    vectors = [np.floor(256 * np.array(v)) for _, v in rows]
    lengths = np.array([np.linalg.norm(v) for v in vectors])
    order = np.argsort(-lengths)
    import pyarrow as pa

    matrix, ids = np.array(vectors)[order], order
    block = (pa.array(ids), np.arange(len(ids)), lengths[order], matrix)
    asked = np.flatnonzero(ids % 50 == 0)
    queries = (pa.array(ids[asked]), asked, lengths[order][asked], matrix[asked])
    turn = np.linalg.eigh(matrix.T @ matrix)[1][:, ::-1]
    q, x, score = vector_search.search_block(queries, block, turn, np.full(len(asked), -np.inf), 5)
    assert sum(seen) < 0.2 * len(asked) * len(ids)
    for place in range(len(asked)):
        all_scores = matrix @ queries[3][place]
        all_scores[asked[place]] = -np.inf
        assert sorted(score[q == place])[::-1] == sorted(all_scores)[::-1][:5]
