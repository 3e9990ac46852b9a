"""Rows that share many keys come up as a pair about once, and no pair of a key is lost."""

import random

from wattlake.llm import ngram_join


def pairs(spark, keys):
    rows = [(k, rep, rep) for rep, ks in keys.items() for k in ks]
    bits = [f"b{j}" for j in range(ngram_join.BITMAP_WORDS)]
    facts = spark.createDataFrame([(rep, 100, *[0] * len(bits)) for rep in keys], ", ".join(f"{c} long" for c in ("rep", "n", *bits)))
    found = ngram_join.keys_pairs(spark.createDataFrame(rows, "key long, rep long, comp long"), facts, 80).repartition(1)
    return [(r.a, r.b) for r in found.collect()]


def test_copies_of_many_keys_are_paired_once(spark):
    got = pairs(spark, {rep: range(200) for rep in range(30)})
    assert sorted(got) == [(a, b) for a in range(30) for b in range(a + 1, 30)]


def test_every_pair_of_a_key_is_found(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 16)
    rng = random.Random(5)
    keys = {rep: set(rng.sample(range(-60, 60), rng.randrange(1, 30))) for rep in range(80)}
    assert set(pairs(spark, keys)) == {(a, b) for a in keys for b in keys if a < b and keys[a] & keys[b]}
