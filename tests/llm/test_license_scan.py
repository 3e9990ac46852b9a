"""Licence scans against versions that try every run of words."""

import random
import re

import pytest
from pyspark.sql import functions as F

from wattlake.llm import license_scan as ls

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return [w.decode() for w in WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))]


def phrase_places(text, phrases=ls.PHRASES):
    w = split(text)
    return sorted((i, label) for label, p in phrases for i in range(len(w)) if w[i : i + len(split(p))] == split(p))


def longest(w, i, sequences):
    """Words of the longest run that ends at i and is in a sequence."""
    n = 0
    while n <= i and any(s[k : k + n + 1] == w[i - n : i + 1] for s in sequences for k in range(len(s) - n)):
        n += 1
    return n


def test_automaton_gives_matching_statistics_and_all_places():
    rng = random.Random(4)
    for _ in range(40):
        sequences = [[rng.randrange(4) for _ in range(rng.randrange(1, 14))] for _ in range(rng.randrange(1, 6))]
        auto = ls.Automaton(sequences)
        text = [rng.randrange(5) for _ in range(60)]
        for i, (state, n) in enumerate(auto.stream(text)):
            assert n == longest(text, i, sequences)
            if n:
                run = text[i - n + 1 : i + 1]
                assert auto.places[state] == [(k, e) for k, s in enumerate(sequences) for e in range(len(s)) if e >= n - 1 and s[e - n + 1 : e + 1] == run]
        assert len(auto.size) <= 2 * sum(map(len, sequences)) + 1


def test_scanner_agrees_with_every_word_through_the_automaton():
    """The stretches leave out only what has no match of two words."""
    rng = random.Random(8)
    pool = [w for _, t in ls.TEMPLATES for w in t.split()] + ["lorem", "ipsum", "dolor"] * 30
    texts = []
    for _ in range(30):
        parts = []
        for _ in range(8):
            t = rng.choice(ls.TEMPLATES)[1].split()
            at = rng.randrange(len(t))
            parts += t[at : at + rng.randrange(1, 20)] + [rng.choice(pool) for _ in range(rng.randrange(6))]
        texts.append(" ".join(parts))
    import pyarrow as pa

    scanner = ls.Scanner(ls.TEMPLATES, ls.PHRASES)
    sequences = [split(t) for _, t in ls.TEMPLATES + ls.PHRASES]
    found = list(scanner.scan(pa.array(texts)))
    for text, (n, places, _, _) in zip(texts, found):
        assert n == len(split(text)) and sorted(places) == phrase_places(text)
    h, at = ls.words(pa.array(texts), ls.BREAK)
    seen = {first + i: x for first, s in scanner.stretches(h, at) for i, (_, x) in enumerate(scanner.automaton.stream(s))}
    for row, text in enumerate(texts[:6]):
        w = split(text)
        for i in range(len(w)):
            n = longest(w, i, sequences)
            assert seen.get(int(at[row]) + i, n) == n and (n < 2 or int(at[row]) + i in seen)


def test_chains_find_the_best_cover():
    rng = random.Random(2)
    for _ in range(100):
        anchors = sorted({(rng.randrange(40), rng.randrange(20), rng.randrange(3, 6)) for _ in range(7)})

        def total(i):
            x, t, n = anchors[i]
            more = [total(j) + min(n, t - anchors[j][1], x - anchors[j][0]) for j in range(i) if 0 < min(t - anchors[j][1], x - anchors[j][0]) and t - n - anchors[j][1] <= ls.GAP and x - n - anchors[j][0] <= ls.GAP]
            return max([n, *more])

        found = ls.chains(anchors)
        assert max(c for _, _, c in found) == max(total(i) for i in range(len(anchors)))
        assert all(lo < hi for lo, hi, _ in found)


MIT = dict((lab, t) for lab, t in ls.TEMPLATES if t.startswith("Permission is hereby"))["mit"]
ROWS = [
    (1, "Intro. Licensed under the Apache License, Version 2.0. Outro."), (2, "x GNU General Public License y general PUBLIC-license"), (3, None), (4, ""), (5, "All rights\nreserved. Licensed under CC BY-NC 4.0."),
    (6, "clean words only, under the tree of the house"), (7, MIT.replace("free of charge", "at no cost").replace("distribute, sublicense", "share, resell").lower()), (7, MIT), (None, MIT[: len(MIT) // 4]), (8, "licensed 日本 under"),
    (9, "cc by " * 3000 + MIT + " filler" * 5000 + " " + MIT), (10, "all rights"), (11, "reserved all rights reserved"),
]


def test_query_columns(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("places", F.lit(1)).withColumn("score", F.lit("x"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = ls.op11_license_scan(spark, str(tmp_path)).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for i in {i for i, _ in ROWS}:
        want = sorted((len(split(t)), len(p := phrase_places(t)), p[0][0] if p else -1, p[-1][0] if p else -1, ",".join(sorted({x for _, x in p}))) for k, t in ROWS if k == i)
        assert sorted((r.n_words, r.n_base, -1 if r.first_word is None else r.first_word, -1 if r.last_word is None else r.last_word, r.base_labels) for r in by[i]) == want
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)
    one = {i: by[i][0] for i in by if len(by[i]) == 1}
    assert one[1].labels == "apache-2.0" and one[5].labels == "cc-by,cc-by-nc,reserved" and one[6].labels == "" and one[6].score < ls.SHARE
    assert [r.labels for r in by[7]] == ["mit", "mit"] and max(r.score for r in by[7]) == 1.0 and min(r.score for r in by[7]) > 0.8
    assert one[None].labels == "" and 0.2 < one[None].score < ls.SHARE


def test_spans(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    found = ls.license_spans(docs.where("doc_id = 9")).orderBy("first_word").collect()
    n = len(split(MIT))
    assert [(r.label, r.first_word, r.end_word, r.covered, r.share) for r in found] == [("mit", 6000, 6000 + n, n, 1.0), ("mit", 11000 + n, 11000 + 2 * n, n, 1.0)]
    own = ls.scanned(docs.where("doc_id = 6"), [("tree", "only under the old tree of the house")], [("w", "words")]).first()
    assert [(p.start, p.label) for p in own.places] == [(1, "w")] and own.spans[0].label == "tree" and own.spans[0].covered == 7
    assert ls.scanned(docs, [], []).where("score > 0").count() == 0


def test_phrases_of_all_documents(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in ls.op11_license_scan(spark, sf).collect()}
    assert len(found) == len(rows)
    for r in rows:
        p = phrase_places(r.text)
        f = found[r.doc_id]
        assert (f.n_base, f.first_word, f.last_word, f.base_labels) == (len(p), p[0][0] if p else None, p[-1][0] if p else None, ",".join(sorted({x for _, x in p})))


def test_empty_template_is_refused():
    with pytest.raises(ValueError):
        ls.Scanner([("x", "- -")], [])


def test_nothing(spark):
    assert ls.scanned(spark.createDataFrame([], "doc_id long, text string")).count() == 0
