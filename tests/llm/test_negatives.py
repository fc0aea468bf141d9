"""Hard negatives and their intervals against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablework.llm import negatives, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rng, n=900, dim=6):
    """Clusters, ties, a vector that a third of the rows share, and rows that take no part."""
    centres = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        x = centres[0] if i % 3 == 0 else centres[i % 6] + rng.normal(size=dim) * 0.2
        rows.append((i, x.astype(np.float32).tolist(), int(rng.integers(0, 4)) if i % 17 else None))
    rows += [(1000, None, 1), (1100, [float("nan")] * dim, 1), (1200, [None] + [1.0] * (dim - 1), 2), (1300, [0.0] * dim, 1), (1400, [], 1), (None, [1.0] * dim, 1)]
    rows += [(1500, [1.0, 2.0], 0), (1501, [1.0, 2.0], 0), (1502, [1.0, 1.8], 1), (100, rows[101][1], 3), (100, rows[100][1], 1), (1600, [1.0, float("inf")], 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def plain(rows, every=20, k=5):
    good = [(r.vec_id, r.label, np.floor(256 * np.array(r.embedding, float)).astype(int)) for r in rows if r.vec_id is not None and r.label is not None and r.embedding and all(x is not None and np.isfinite(x) for x in r.embedding)]
    asks = {}
    for r in good:
        if r[0] % every == 0 and (r[0] not in asks or (r[1], r[2].tolist()) < (asks[r[0]][1], asks[r[0]][2].tolist())):
            asks[r[0]] = r
    out = []
    for anchor, label, x in asks.values():
        scored = [(-int(x @ y), i, own == label) for i, own, y in good if i != anchor and len(y) == len(x)]
        for p, i, _ in sorted(s for s in scored if s[2])[:k]:
            fit = sorted((s, j) for s, j, same in scored if not same and 80 * -p <= 100 * -s <= 100 * -p)[:k]
            out += [(anchor, i, n + 1, j, -p, -s) for n, (s, j) in enumerate(fit)]
    return sorted(out)


def found(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


@pytest.mark.parametrize("dim", [6, 70])
def test_equals_brute_force(spark, dim):
    rows = table(spark, np.random.default_rng(dim), dim=dim).persist()
    wide = rows.withColumns({c: F.lit(1) for c in ("rank", "block", "dim", "score", "anchor_id", "own", "query_id", "own_label")})
    want = plain(rows.collect())
    assert len(want) > 500
    assert found(negatives.hard_negatives(wide, every=20)) == want


def test_blocks_of_few_rows(spark, monkeypatch):
    monkeypatch.setattr(vectors.blocks, "__defaults__", (40,))
    rows = table(spark, np.random.default_rng(1))
    assert found(negatives.hard_negatives(rows, every=20, positives=3, negatives=2)) == [x for x in plain(rows.collect(), k=3) if x[2] <= 2]


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(empty).count() == 0
    assert negatives.hard_negatives(spark.createDataFrame([(100, [1.0], 1), (101, [1.0], 2)], SCHEMA)).count() == 0


def test_intervals_hold_and_filter():
    rng = np.random.default_rng(4)
    for dim, spread in ((3, 50), (64, 300), (100, 10_000), (64, 0)):
        values = (rng.normal(size=(5, dim))[rng.integers(0, 5, 400)] * 2000 + rng.normal(size=(400, dim)) * spread).astype(np.int64)
        codes = negatives.Codes.from_bytes(negatives.Codes(values).to_bytes(), 400, dim)
        for query in (*values[:30], np.zeros(dim, np.int64), np.eye(dim, dtype=np.int64)[0] * 10**6):
            low, high = codes.intervals(query)
            true = (values @ query).astype(float)
            assert (low <= true).all() and (true <= high).all()
    # Three of four rows of other clusters go without being multiplied.
    values = (rng.normal(size=(20, 64))[rng.integers(0, 20, 2000)] * 500 + rng.normal(size=(2000, 64)) * 50).astype(np.int64)
    low, high = negatives.Codes(values).intervals(values[0])
    assert (high >= negatives._nth(low, 5)).mean() < 0.25
