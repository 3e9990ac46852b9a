"""Recall of near-duplicate vectors where it is hardest: pairs just above the threshold."""

import numpy as np

from wattlake.llm import vector_dedup


def test_recall_just_above_the_threshold(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=base.shape)
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.9801, 0.985, (1500, 1))
    twin = cosine * base + np.sqrt(1 - cosine**2) * side
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(np.concatenate([base, twin]))]
    got = {r.vec_id: r for r in vector_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    found = np.mean([got[1500 + i].component_id == i for i in range(1500)])
    print(f"recall {found:.4f}")
    assert found >= 0.97
    assert all(r.n_links <= 1 for r in got.values())
