"""Token alignment against a version that walks over every byte, and its edge cases."""

import hashlib
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wattlake.llm import token_alignment as ta
from wattlake.llm.sentencepiece_codec import MODEL

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
TEXTS = [
    "The quick brown fox", "two  blanks   and\ttabs\n\nlines ", " leads", "naïve café été", "日本語 テキスト 日本", "🎉🎉 party 🎉", "", None, "   ", "a", " ", "marker ▁ inside", "ends ▁", "<|endoftext|> and <s> </s> <0x41>",
    "x y z 　 w", "it's they're 3.14 1,000,000", "a" * 5000, "ab" * 2000 + " " * 300, "é" * 700, "The quick brown fox", "zero\x00byte", "\r\n\r\n", "don't  don't don't", "1 2 3 4 5 " * 200, "word " * 500,
]


def brute(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_model, b_model = Tokenizer.from_file(ta.BYTE_MODEL), SentencePieceProcessor(model_file=MODEL)
    a_model.encode_special_tokens = True
    letters = ta.byte_letters()
    spelt = {i: bytes(letters[c] for c in p) for p, i in json.load(open(ta.BYTE_MODEL))["model"]["vocab"].items() if p != "<|endoftext|>"}

    def piece(i):
        p = b_model.id_to_piece(i)
        return bytes([int(p[3:-1], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()

    docs = []
    for text in texts:
        a = a_model.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(spelt[i] for i in a) != whole or b"".join(map(piece, b)) != whole:
            docs.append(([], Counter()))
            continue
        ends = [[], []]
        for side, ids, size in ((0, a, lambda i: len(spelt[i])), (1, b, lambda i: len(piece(i)))):
            at = 0
            for i in ids:
                at += size(i)
                ends[side].append(at)
        shared = sorted(set(ends[0]) & set(ends[1]))
        parts, links, lo = [], Counter(), 0
        for hi in shared:
            one = [[i for i, e in zip(ids, ends[side]) if lo < e <= hi] for side, ids in ((0, a), (1, b))]
            parts.append(one)
            links.update((x, y) for x in one[0] for y in one[1])
            lo = hi
        docs.append((parts, links))
    held = Counter(p for _, links in docs for p in links)
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for parts, links in docs:
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in parts)
        digest = hashlib.sha256(written.encode()).hexdigest() if parts else ""
        out.append((sum(len(a) for a, _ in parts), sum(len(b) for _, b in parts), len(parts), sum(links.values()), digest, sum(n for p, n in links.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in links.items())))
    return out


@pytest.fixture(scope="module")
def rows(spark, sf):
    found = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    return [(i, t) for i, t in enumerate(TEXTS + found)]


@pytest.mark.parametrize("most", [0, 500, ta.HOT_PAIRS])
def test_alignment_matches_brute_force(spark, rows, most, monkeypatch):
    """By the table of frequent pairs, by the join, and by both."""
    monkeypatch.setattr(ta, "SLICE", 20_000)
    monkeypatch.setattr(ta, "STEP", 3_000)
    docs = ta.written(ta.aligned(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    got = ta.with_counts(docs, ta.written(ta.pair_counts(docs)), most)
    assert sorted(got.columns) == sorted(COLUMNS)
    found = {r.doc_id: tuple(r[c] for c in COLUMNS[1:]) for r in got.collect()}
    want = brute([t for _, t in rows])
    for i, text in rows:
        assert found[i] == want[i], text
    assert len(found) == len(rows)


def test_repeated_and_null_ids_are_documents_of_their_own(spark):
    docs = spark.createDataFrame([(None, "one two"), (None, "one two"), (3, "three"), (3, "one"), (3, None)], "doc_id long, text string").withColumn("pairs", F.lit("x")).withColumn("row", F.lit(1)).withColumn("n_best", F.lit(1))
    got = [tuple(r[c] for c in COLUMNS) for r in ta.alignment(docs).collect()]
    want = brute(["one two", "one two", "three", "one", None])
    assert sorted(got, key=str) == sorted(((i, *w) for i, w in zip([None, None, 3, 3, 3], want)), key=str)


def test_nothing_to_align(spark):
    assert ta.alignment(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    only = ta.alignment(spark.createDataFrame([(1, None), (2, "")], "doc_id int, text string")).collect()
    assert [tuple(r)[1:] for r in only] == [(0, 0, 0, 0, "", 0, 0)] * 2


def test_overlaps_cover_both_sides(spark, rows):
    docs = spark.createDataFrame(rows[:26], "doc_id long, text string")
    found = ta.token_overlaps(docs).toPandas()
    sums = {r.doc_id: r for r in ta.aligned(docs).collect()}
    for i, mine in found.groupby("doc_id"):
        assert sorted(set(mine["a_index"])) == list(range(sums[i].n_a)) and sorted(set(mine["b_index"])) == list(range(sums[i].n_b))
        assert mine["ends_group"].sum() == sums[i].n_groups and mine["group"].max() == sums[i].n_groups - 1
        # overlaps of two tilings: one more token each time a boundary is passed
        assert len(mine) == sums[i].n_a + sums[i].n_b - sums[i].n_groups


def test_large_groups_are_linked_in_chunks(monkeypatch):
    import numpy as np

    monkeypatch.setattr(ta, "PAIRS", 50)
    rng = np.random.default_rng(1)
    of_a, of_b = np.sort(rng.integers(0, 5, 400)), np.sort(rng.integers(0, 5, 300))
    a, b = rng.integers(0, 9, 400), rng.integers(0, 7, 300)
    row = np.array([0, 0, 2, 2, 2])
    at, pair, times = ta.distinct_links(a, of_a, b, of_b, row, 4)
    want = Counter((row[g], x, y) for g, x in zip(of_a, a) for h, y in zip(of_b, b) if g == h)
    got = {(r, pair[k] >> 32, pair[k] & 0xFFFFFFFF): times[k] for r in range(4) for k in range(at[r], at[r + 1])}
    assert got == want
