"""Hard negatives against brute force: clustered, random, skewed, repeated and odd vectors."""

import numpy as np
import pytest

from wattlake.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, low=80, high=100):
    ok = [(i, lab, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for own, label, q in sorted({(i, lab, tuple(v)) for i, lab, v in ok if i % 100 == 0}):
        scored = [(-sum(x * y for x, y in zip(q, v)), i, lab) for i, lab, v in ok]
        mine = sorted(x for x in scored if x[2] == label and x[1] != own)[:k]
        for p, i, _ in mine:
            fit = sorted(x for x in scored if x[2] != label and low * -p <= 100 * -x[0] <= high * -p)[:k]
            out += [(own, i, r + 1, x[1], -p, -x[0]) for r, x in enumerate(fit)]
    return sorted(out)


def run(spark, rows, **more):
    v = hn.labelled_vectors(spark.createDataFrame(rows, SCHEMA))
    got = hn.mined(v, v.where("vec_id % 100 = 0"), **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def clustered(seed, n=900, d=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    rows = []
    for i in range(n):
        v = (centres[i % 6] + 0.25 * rng.normal(size=d)) * rng.choice([0.2, 1, 3])
        # one label holds a third
        rows.append((i, [float(x) for x in v.astype(np.float32)], 0 if i % 3 == 0 else int(rng.integers(0, 5))))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(hn, "SHARD_ROWS", 100)
    monkeypatch.setattr(hn, "ANCHOR_ROWS", 4)
    rows = clustered(seed)
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, low=50, high=90) == brute(rows, low=50, high=90)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(3, 120)
    rows += [(None, [1.0] * 12, 1), (200, None, 1), (300, [1.0, None] + [0.0] * 10, 1), (400, [nan] * 12, 1), (500, [inf] * 12, 2), (600, [1.0] * 12, None), (700, [0.0] * 12, 0), (800, [], 1), (900, [1.0, 2.0], 2), (901, [0.0] * 12, 1)]
    rows += [rows[3]] * 7 + [rows[0], (0, [0.5] * 12, 4), (0, [0.25] * 12, 0), (100, [-1.0] * 12, 3)]
    assert run(spark, rows) == brute(rows)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.5], i % 3) for i in range(40)] + [(100, [1.0, 0.5], 0), (200, [-1.0, -0.5], 1)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert [r[3] for r in got if r[:2] == (100, 0)] == [1, 2, 4, 5, 7]


def test_large_components_are_exact(spark):
    rows = [(100 * i, [float(2**20 + i), 2.0**18 * i], i % 2) for i in range(12)]
    assert run(spark, rows) == brute(rows)


def test_nothing(spark):
    assert run(spark, []) == []
    assert run(spark, [(100, [1.0], 1)]) == []


def test_feasible_rows_hold_all_that_score(monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8))  # of one length, as in a bucket
    x = np.round(256 * x / np.sqrt((x * x).sum(axis=1, keepdims=True)))
    lists, fewer = hn.Lists(x), 0
    for q in np.round(256 * rng.normal(size=(60, 8))):
        score = x @ q
        for least in (1, int(np.sort(score)[-30]), int(score.max())):
            found = lists.feasible(q, least)
            assert set(np.flatnonzero(score >= least)) <= set(found)
            fewer += len(found) < len(x) / 2
    assert fewer > 40
