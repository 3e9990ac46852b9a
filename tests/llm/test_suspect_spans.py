"""Suspect spans: what one pattern over whole texts would find, in time linear in a token."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from wattlake.llm import toxicity

#: The spans as one pattern, which takes time quadratic in a token.
PATTERN = re.compile(toxicity.SPACED.pattern + rb"|[A-Za-z0-9@$!|+\x80-\xff]*(?:" + toxicity._CORE + rb")[A-Za-z0-9@$!|+*._\-\x80-\xff]*")


def test_spans_are_those_of_the_pattern():
    rng = random.Random(11)
    signs = ["a", "b", "c", "B", "0", "1", "$", "@", "!", "|", "+", "(", "<", ".", "-", "_", "*", " ", "  ", ",", "/", "é", "日", "\n", "aaa", "x y z", "a.b.c", "'"]
    for _ in range(30_000):
        raw = "".join(rng.choice(signs) for _ in range(rng.randrange(1, 26))).encode()
        assert toxicity.suspect_spans(raw) == [m.span() for m in PATTERN.finditer(raw)], raw


def cost():
    return np.random.default_rng(1).uniform(0.5, 4, (toxicity.CLASSES,) * 3).astype(np.float32)


@pytest.mark.parametrize("text", ["0" * 1_000_000 + "a", "1é" * 330_000, "a" * 1_000_000, "a1" * 500_000, "a b " * 250_000, "a(" * 500_000, "xa.b.c " * 140_000, "$" * 999_000 + " s h i", "ab0" * 330_000 + "(", "a.b c " * 160_000])
def test_long_tokens_take_linear_time(text):
    began = time.time()
    assert toxicity.Restorer(cost()).texts(pa.array([text]))[0]
    assert time.time() - began < 60
