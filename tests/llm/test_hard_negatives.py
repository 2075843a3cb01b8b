import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillhouse.llm import vectors
from rillhouse.llm.hard_negatives import hard_negatives as mine_negatives
from rillhouse.llm.hard_negatives import products

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, every=100, k=5):
    """Rows as (vec_id, components, label); None components never take part."""
    kept = []
    for number, (vec, parts, label) in enumerate(rows):
        if label is None or parts is None or any(x is None or not math.isfinite(x) for x in parts):
            continue
        exact = [math.floor(x * 256) if abs(x) < 2.0 ** 40 else int(x) * 256 for x in parts]
        kept.append((vec, exact, label, number))
    out = []
    for vec, parts, label, number in kept:
        if vec is None or vec % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(parts, p)), v is None, v or 0, n, l)
                        for v, p, l, n in kept if n != number)
        for top in [s for s in scored if s[4] == label][:k]:
            worse = [s for s in scored if s[4] != label and 80 * -top[0] <= 100 * -s[0] <= 100 * -top[0]]
            clip = lambda s: max(min(s, 2 ** 63 - 1), -2 ** 63)
            out += [(vec, None if top[1] else top[2], rank, None if s[1] else s[2], clip(-top[0]), clip(-s[0]))
                    for rank, s in enumerate(worse[:k], 1)]
    return sorted(out, key=repr)


def mined(spark, rows, every=100, **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, mine_negatives(frame, F.col("vec_id") % every == 0, **options).collect()), key=repr)


@pytest.mark.parametrize("low, high", [(-140, 130), (0, 9), (-5, -1), (-2 ** 20, 2 ** 20), (-2 ** 31, 2 ** 31),
                                       (-2 ** 62, 2 ** 62)])
def test_packed_products_are_exact(low, high):
    rng = np.random.default_rng(4)
    for n, m, width in ((3, 50, 64), (1, 1, 1), (4, 17, 3), (2, 5, 0)):
        a, c = (rng.integers(low, high, (x, width)) for x in (n, m))
        want = a.astype(object) @ c.T.astype(object) if width else np.zeros((n, m), object)
        assert products(a, c).astype(object).tolist() == want.tolist()


def test_products_of_different_widths_are_padded():
    assert products(np.array([[2, 3]]), np.array([[5], [-7]])).tolist() == [[10, -14]]


def test_like_brute_force(spark):
    rng = random.Random(7)
    rows = [(i, [rng.choice([-.5, -.25, 0., .1, .25, .5]) for _ in range(6)], rng.randrange(3)) for i in range(600)]
    got = mined(spark, rows)
    assert got == brute(rows)
    assert len(got) > 50


def test_many_blocks_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_COMPONENTS", 60)
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)], rng.randrange(2)) for i in range(300)]
    assert mined(spark, rows, every=30) == brute(rows, every=30)


def test_nulls_odd_components_and_short_vectors(spark):
    rows = [(0, [1., .5, .25], 1), (1, [1., None], 1), (2, None, 1), (3, [float("nan")], 1), (4, [float("inf")], 2),
            (5, [1., .5], 1), (6, [1.], 2), (7, [], 2), (8, [1., .5, .2], None), (None, [1., .5], 2), (9, [.9, .5], 2),
            (None, [1., .5], 1)]
    got = mined(spark, rows)
    assert got == brute(rows)
    assert any(r[3] is None for r in got) and any(r[1] is None for r in got)


def test_large_components_are_compared_exactly(spark):
    rows = [(0, [1e17, 1.], 1), (1, [1e17, 2.], 1), (2, [1e17, 1.5], 2), (3, [9.9e16, 0.], 2), (4, [1e300, 0.], 2),
            (5, [-1e200, 0.], 1), (6, [1e200, 0.], 1), (7, [9e199, 5.], 2)]
    assert mined(spark, rows) == brute(rows)


def test_repeated_rows_ties_and_no_positive(spark):
    rows = [(0, [1., 1.], 1)] * 3 + [(5, [1., 1.], 2)] * 8 + [(100, [1., 0.], 7), (7, [0., 0.], 1)]
    assert mined(spark, rows) == brute(rows)
    zero = [(0, [0., 0.], 1), (1, [0., 1.], 1), (2, [3., 3.], 2)]
    assert mined(spark, zero) == brute(zero) == [(0, 1, 1, 2, 0, 0)]
    below = [(0, [1.], 1), (1, [-1.], 1), (2, [-1.], 2)]
    assert mined(spark, below) == []


def test_empty_table_and_clashing_columns(spark):
    assert mined(spark, []) == []
    rows = [(i, [float(i % 7), 1.], i % 3) for i in range(120)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("rid", "anchor", "rank", "score", "positive", "parts"):
        frame = frame.withColumn(name, F.lit("x"))
    got = mine_negatives(frame, F.col("vec_id") % 100 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_query_relabels(spark, tmp_path):
    from rillhouse.llm.entries import op11_hard_negatives

    rng = random.Random(3)
    rows = [(i, [rng.uniform(-.3, .5) for _ in range(5)], rng.randrange(10)) for i in range(400)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    changed = [(v, p, (l + 1) % 10 if v % 7 == 0 else l) for v, p, l in rows]
    got = sorted(map(tuple, op11_hard_negatives(spark, str(tmp_path)).collect()), key=repr)
    assert got == brute(changed) and got
