"""Hard negatives against all pairs in plain Python; what takes no part."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.llm import negatives

KINDS = "vec_id long, embedding array<float>, label int, rank string, score string, high string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], KINDS)


def brute(rows):
    kept = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        item = (label, [math.floor(256 * float(np.float32(x))) for x in vector])
        kept[vec_id] = min(kept.get(vec_id, item), item)
    out = []
    for a, (label, u) in kept.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(u, v)), i, l) for i, (l, v) in kept.items() if i != a)
        for s, p, _ in [r for r in scored if r[2] == label][:5]:
            fit = [r for r in scored if r[2] != label and 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out += [(a, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(fit)]
    return sorted(out)


def vector(rng, centre):
    return [c + rng.gauss(0, 0.3) for c in centre]


@pytest.mark.parametrize("tiles", [1, 5])
def test_equals_all_pairs(spark, tiles):
    rng = random.Random(tiles)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, vector(rng, rng.choice(centres)), rng.randrange(3)) for i in range(-200, 500)]
    rows += [(1000 + i, list(rows[0][1]), i % 3) for i in range(60)]  # one vector many times: ties
    rows += [(1100 + i, [0.0] * 6, i % 4) for i in range(20)]  # every score is 0
    rows += [(None, [1.0] * 6, 1), (1200, None, 1), (1201, [1.0, None], 1), (1300, [1.0] * 6, None)]
    rows += [(1400, [float("nan")] * 6, 1), (1401, [float("inf")] * 6, 1), (1500, [], 2), (1600, [2.0, 1.0], 2)]
    rows += [rows[0], rows[3], (5, [9.0] * 6, 9)]  # repeated rows and ids
    found = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0, tiles=tiles)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_empty(spark):
    assert negatives.hard_negatives(frame(spark, []), F.col("vec_id") % 100 == 0).collect() == []


def test_walk_ends_early_and_is_exact():
    rng = np.random.default_rng(3)
    centre = rng.normal(size=8)
    centre /= np.linalg.norm(centre)
    members = np.rint(256 * (centre + rng.normal(0, 0.02, (7, 8))))
    rows = np.rint(256 * rng.normal(size=(20_000, 8)))
    limit = negatives.bounds(rows, centre, negatives.widest_angle(members, centre))
    assert (members @ rows.T <= np.linalg.norm(members, axis=1)[:, None] * limit[None] + 1e-6).all()
    order = np.argsort(-limit, kind="stable")
    ids, low, high = np.arange(20_000), np.full(7, -(1 << 62)), np.full(7, 1 << 62)
    stops = limit[order].copy()
    slot, vec_id, score = negatives.walk(members, -np.ones(7), low, high, rows[order], ids[order], stops, 5)
    for m in range(7):
        every = (members[m] @ rows.T).astype(int)
        assert vec_id[slot == m].tolist() == np.lexsort((ids, -every))[:5].tolist()
    # rows far down the list are never read
    far = rows[order].copy()
    far[negatives.STEP * 5 :] = np.nan
    again = negatives.walk(members, -np.ones(7), low, high, far, ids[order], stops, 5)
    assert again[1].tolist() == vec_id.tolist()
