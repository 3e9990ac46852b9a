"""Importance weights against counts of every text's n-grams, one text at a time."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from wattlake.llm import quality


def test_weights_are_log_ratios_of_the_two_models(spark):
    rng = np.random.default_rng(4)
    good, raw = [f"g{i}" for i in range(60)], [f"r{i}" for i in range(200)]
    docs = [(i, " ".join(rng.choice(good if i % 3 == 0 else raw, 30)) if i % 17 else None) for i in range(300)]
    labels = [(i, int(i % 3 == 0)) for i in range(0, 300, 2)]
    got = {r.doc_id: r for r in quality.resampled(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    # a text's own buckets: words, pairs of words, shapes and pairs of shapes
    grams = {i: quality.ngrams(pa.array([t], pa.string()))[0].tolist() for i, t in docs}
    words = {i: (t or "").split() for i, t in docs}
    assert all(len(g) == max(0, 4 * len(words[i]) - 2) for i, g in grams.items())
    by_gram = {}
    for i, w in words.items():
        found = [quality.ngrams(pa.array([x], pa.string()))[0].tolist()[0] for x in w]
        assert Counter(found) <= Counter(grams[i])
        for x, b in zip(w, found):
            assert by_gram.setdefault(x, b) == b
    target = Counter(b for i, q in labels if q and zlib.crc32(str(i).encode()) % quality.FOLDS for b in grams[i])
    everything = Counter(b for g in grams.values() for b in g)
    t, r = sum(target.values()) + quality.BUCKETS, sum(everything.values()) + quality.BUCKETS
    for i, g in grams.items():
        want = sum(np.log((target[b] + 1) / t) - np.log((everything[b] + 1) / r) for b in g)
        assert got[i].log_weight == pytest.approx(want, abs=1e-6)
    kept = [x for x in got.values() if x.kept]
    assert min(x.key for x in kept) >= max(x.key for x in got.values() if not x.kept)
