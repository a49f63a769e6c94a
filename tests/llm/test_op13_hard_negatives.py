import math
import random

import pytest
from pyspark.sql import functions as F

from leadlens.llm import op13_hard_negatives as H
from leadlens.llm.common import table
from leadlens.llm.queries import QUERIES

ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, n_pos=5, n_neg=10, low=30, high=90):
    """All pairs of an anchor and a row; rows are (id, vector, label)."""
    whole = {(i, lab, tuple(math.floor(256 * x) for x in v)) for i, v, lab in rows
             if None not in (i, v, lab) and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for anchor, label, v in [r for r in whole if r[0] % every == 0]:
        others = [(-sum(a * b for a, b in zip(v, w, strict=True)), i, lab) for i, lab, w in whole if len(w) == len(v)]
        for p, pid, _ in sorted(r for r in others if r[2] == label and r[1] != anchor)[:n_pos]:
            fits = sorted(r for r in others if r[2] != label and low * -p <= 100 * -r[0] <= high * -p)[:n_neg]
            out += [(anchor, pid, k, nid, -p, -s) for k, (s, nid, _) in enumerate(fits, 1)]
    return sorted(out)


def mine(frame, **k):
    return sorted(tuple(r) for r in H.hard_negatives(frame, F.col("vec_id") % 100 == 0, **k).collect())


def vectors(n, seed, d=6):
    rng = random.Random(seed)
    return [(i * 5, [rng.choice([rng.uniform(-1, 1), 0.5, 0.0]) for _ in range(d)], rng.randrange(3)) for i in range(n)]


def floats(rows):
    import numpy as np

    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows]


def test_equals_all_pairs_with_ties_and_a_hot_vector(spark):
    rows = vectors(300, 1) + [(10_000 + i, [0.5] * 6, i % 3) for i in range(150)]
    frame = spark.createDataFrame(rows, ROWS).repartition(7)
    want = brute(floats(rows))
    assert len(want) > 300 and mine(frame) == want
    # More blocks, one task, other bounds of what is held: the same rows.
    assert mine(frame.coalesce(1), block_anchors=2) == want


def test_windows_and_numbers(spark):
    rows = vectors(200, 2)
    assert mine(spark.createDataFrame(rows, ROWS), n_positive=3, n_negative=2, low=0, high=99) == brute(floats(rows), 100, 3, 2, 0, 99)
    assert [H.window(s, 30, 90) for s in (10, 0, -10, 7, 1)] == [(3, 9), (0, 0), (-3, -9), (3, 6), (1, 0)]
    with pytest.raises(ValueError):
        mine(spark.createDataFrame(rows, ROWS), high=100)


def test_zero_scores_meet_negatives_of_smaller_ids(spark):
    rows = [(100, [1.0, 0.0], 1), (50, [0.0, 1.0], 1), (1, [0.0, 1.0], 2), (2, [0.0, 1.0], 2), (60, [-1.0, 0.0], 1)]
    assert mine(spark.createDataFrame(rows, ROWS)) == brute(rows) == [(100, 50, 1, 1, 0, 0), (100, 50, 2, 2, 0, 0)]


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [*vectors(60, 3, 3), (None, [1.0, 1.0, 1.0], 1), (7, None, 1), (8, [1.0, None, 1.0], 1), (9, [nan, 1.0, 1.0], 2),
            (11, [inf, 0.0, 0.0], 1), (12, [1.0, 1.0], 1), (200, [0.3, 0.4], 0), (13, [0.5, 0.5], 0), (14, [0.2, 0.2], 1),
            (15, [1.0, 1.0, 1.0], None), (300, [], 1), (16, [], 1), (17, [], 2), (400, [0.1, 0.2, 0.3], 1), (400, [0.3, 0.2, 0.3], 2),
            *[(500, [0.25, 0.5, 0.5], 1)] * 3]
    extra = spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], ROWS + ", anchor_id string, block int, score double")
    want = brute(floats(rows))
    assert any(r[0] == 300 for r in want) and any(r[0] == 400 for r in want) and mine(extra.repartition(3)) == want
    assert mine(spark.createDataFrame([], ROWS)) == []
    assert mine(spark.createDataFrame([(1, [1.0], 1)], ROWS)) == []


def test_scores_beyond_doubles_stay_exact(spark):
    rows = [(100, [3e6, 1.0], 1), (1, [3e6, 1.0], 1), (2, [1.5e6, 3.0], 2), (3, [1.5e6, 2.0], 2)]
    want = brute(rows)
    assert [r[3] for r in want] == [2, 3] and mine(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")) == want


def test_keys_sort_as_asked():
    rng = random.Random(0)
    rows = [(rng.choice([-5, 0, 7]), rng.choice([0, 3]), rng.choice([-9, 0, 2 ** 62]), rng.random() < 0.5, rng.choice([-1, 0, 9])) for _ in range(200)]
    keys = [H.pack(*r) for r in rows]
    assert [H.unpack(k) for k in sorted(keys)] == sorted(rows, key=lambda r: (r[0], r[1], -r[2], r[3], r[4]))


def test_query_equals_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, sf, "embeddings").collect()]
    moved = [(i, v, (lab + 1) % 10 if lab is not None and i % 7 == 0 else lab) for i, v, lab in rows]
    assert sorted(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, sf).collect()) == brute(moved)
