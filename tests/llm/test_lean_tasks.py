"""What tasks leave in their workers, and op2's prices against a plain walk over all decisions."""

import re
import sys

import numpy as np
import pyarrow as pa
import pytest

from wattlake.llm import lm_scoring, sentencepiece_codec
from wattlake.llm._runs import lean

kept = []


def own_mb() -> float:
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read())[1]) / 1024


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_a_task_gives_its_freed_memory_back():
    def task(batches):
        held = [bytes(b"x" * 5000) for _ in range(40_000)]
        kept.append(held[-1])  # the last block keeps the heap from shrinking by itself
        yield from batches

    before = own_mb()
    assert list(lean(task)(iter([1, 2]))) == [1, 2]
    assert own_mb() < before + 40


def test_slices_that_are_encoded_at_once_are_small():
    # encodings take some forty times their text
    assert 40 * sentencepiece_codec.SLICE <= 12 << 20


def test_prices_are_those_of_a_plain_walk_over_the_decisions():
    texts = ["the cat sat on the mat", "", None, "Aa aa AA a", "the mat sat on a cat, then on the other cat", "кот the 猫 " * 3]
    column = pa.array(texts)
    seq, place, at = lm_scoring.sequences(column)
    counts = np.bincount(seq, minlength=lm_scoring.SYMBOLS)
    tree = lm_scoring.huffman(counts)
    rng = np.random.default_rng(3)
    table = rng.integers(-90, 90, (lm_scoring.MODELS, 1 << lm_scoring.SLOT_BITS)).astype(np.int8)
    weights = rng.normal(0.3, 0.1, (lm_scoring.MODELS + 1, lm_scoring.DEPTHS * lm_scoring.PLACES)).astype(np.float32)
    came = rng.integers(1, 50, (lm_scoring.DEPTHS * lm_scoring.PLACES * lm_scoring.BUCKETS, 2)).astype(float)
    got = lm_scoring.Mixer(tree, table, weights, came).prices(column, False)
    length, begin, node, bit, gate = tree
    center = lm_scoring.Mixer._center()
    true = 1 / (1 + np.exp(-np.log((came[:, 1] + 20 * center) / (came[:, 0] + 20 * (1 - center)))))
    hashes = lm_scoring.contexts(seq, place, at)
    for t in range(len(texts)):
        own, step, total = np.zeros(lm_scoring.MODELS), np.zeros(lm_scoring.MODELS), 0.0
        for k in range(at[t], at[t + 1]):
            if (k - at[t]) % lm_scoring.BLOCK == 0:
                own, step = own + step, np.zeros(lm_scoring.MODELS)
            for c in range(begin[seq[k]], begin[seq[k]] + length[seq[k]]):
                g = gate[c] + min(place[k], lm_scoring.PLACES - 1)
                st = np.array([table[m][int(hashes[m][k]) ^ int(node[c])] / 16 for m in range(lm_scoring.MODELS)])
                dot = np.clip(weights[-1][g] + (st * (weights[:-1, g] + own)).sum(), -11, 11)
                p = 1 / (1 + np.exp(-dot))
                q = (p + true[g * lm_scoring.BUCKETS + int(np.clip(dot, -8, 8) * 2 + 16.5)]) / 2
                total += np.log(q if bit[c] else 1 - q)
                step = step + lm_scoring.RATE * (bit[c] - p) * st
        assert got[t] == pytest.approx(total, rel=1e-3)
