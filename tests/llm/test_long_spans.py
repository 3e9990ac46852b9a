"""Obfuscated spans of any length are restored."""

import time

import numpy as np
import pyarrow as pa

from wattlake.llm import toxicity


def model():
    text = np.frombuffer(b"you are a stupid moron and nobody likes what this awful liar wrote " * 50, np.uint8)
    c, k = toxicity.CLASS[text], toxicity.CLASSES
    n = np.bincount(c[:-2] * k**2 + c[1:-1] * k + c[2:], minlength=k**3).reshape(k, k, k)
    return -np.log((n + 0.01) / (n.sum(axis=2, keepdims=True) + 1)).astype(np.float32)


def test_long_spans_are_restored():
    restorer = toxicity.Restorer(model())
    texts = ["stu" + "u" * 70 + "pid", "  ".join("nobodylikesstupidmoronliar"), " ".join("youareastupidmoronandnobodylikeswhat"), "_".join(["y0u", "4re", "a", "stup1d", "m0ron", "and", "n0body", "l1kes", "what", "th1s", "awful", "l1ar", "wr0te", "stup1d"])]
    assert all(len(t) > 64 for t in texts)
    for text, got in zip(texts, restorer.texts(pa.array(texts))):
        assert b"stupid" in got and (b"moron" in got or "moron" not in text.replace("0", "o").replace(" ", "").replace("_", "")), (text, got)


def test_decoding_is_linear():
    cost = model()

    def took(n):
        began = time.process_time()
        toxicity.restore("a.b0" * n, cost)
        return time.process_time() - began

    took(500)
    assert took(8000) < 10 * took(2000)
