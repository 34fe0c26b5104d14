"""Hard negatives against brute force; intervals always hold."""

import math
import random

import numpy as np

from bankmart.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, row long, block int, grp int, code string, width int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "x", 4) for r in rows], SCHEMA)


def brute(rows, positives=5, negatives=10, every=100):
    live = [(i, np.array([math.floor(256 * x) for x in np.array(v, np.float32).astype(float)]), l)
            for i, v, l in rows if i is not None and l is not None and v and None not in v and np.isfinite(v).all()]
    out = []
    for n, (a, v, label) in enumerate(live):
        if a % every:
            continue
        other = [(-int(v @ w), b, l) for m, (b, w, l) in enumerate(live) if m != n and len(w) == len(v)]
        for s, p, _ in sorted(x for x in other if x[2] == label)[:positives]:
            near = [x for x in other if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s]
            out += [(a, p, rank + 1, x[1], -s, -x[0]) for rank, x in enumerate(sorted(near)[:negatives])]
    return sorted(out)


def answer(df):
    return sorted(tuple(r[c] for c in H.RESULT) for r in df.collect())


def vectors(seed, n, width=24, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    v = centres[rng.integers(0, 6, n)] * 0.4 + rng.normal(size=(n, width)) * 0.2
    return [(i, [float(x) for x in v[i]], int(rng.integers(0, labels))) for i in range(n)]


def test_equals_brute_force_in_many_blocks(spark):
    rows = vectors(1, 700)
    assert brute(rows)
    assert answer(H.mine(table(spark, rows), block_rows=64, group_anchors=3)) == brute(rows)


def test_awkward_rows(spark):
    rng = random.Random(3)
    rows = vectors(2, 300, 8)
    same = rows[5][1]
    rows += [(400 + i, same, i % 2) for i in range(60)]                  # ties, one of them an anchor
    rows += [(500, [0.0] * 8, 1), (600, [-x for x in same], 0), (700, [1.0, 2.0], 1), (800, [0.5, -1.0], 1),
             (801, [1.0, 0.5], 0), (900, None, 1), (1000, [], 1), (1100, same, None), (None, same, 1),
             (1200, [None] + same[1:], 1), (1300, [float("nan")] + same[1:], 1), (1400, [float("inf")] + same[1:], 1),
             (1500, [1e-30] * 8, 0), (1600, [3.0], 9)]
    rows += [(0, same, 1), (0, same, 1), (7, rows[7][1], rows[7][2])]    # repeated ids and rows
    rng.shuffle(rows)
    assert answer(H.mine(table(spark, rows), block_rows=50, group_anchors=2)) == brute(rows)


def test_empty_table(spark):
    assert H.mine(table(spark, [])).count() == 0


def test_intervals_hold(spark):
    rng = np.random.default_rng(5)
    for width in (1, 7, 64, 100):
        v = np.floor(rng.normal(size=(400, width)) * 100).astype(np.int64)
        q = np.floor(rng.normal(size=(30, width)) * 100).astype(np.int64)
        q[0] = 0
        lower, upper = H.Anchors(q).intervals(*H.encode(v))
        score = q @ v.T
        assert (lower <= score).all() and (score <= upper).all()
        if width == 64:                    # and are narrower than the plain bound
            plain = 2 * np.linalg.norm(q, axis=1)[1:, None] * np.linalg.norm(v, axis=1)
            assert ((upper - lower)[1:] / plain).mean() < 0.65
