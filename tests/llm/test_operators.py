"""Edge cases and brute-force versions of the operators over documents and vectors."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattlake.llm import line_dedup, lm_scoring, mixing, ngram_join, quality, sentencepiece_codec, sharding, toxicity, vector_dedup, vector_topk
from wattlake.llm._common import before, components
from wattlake.llm._text import words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, key string"
LONG = " ".join(f"word{i % 977} other{i % 31}" for i in range(20_000))
EDGE = [
    (0, None, None, None, None, "x", "k"), (1, "", "en", "a", 0, "x", "k"), (2, " \t\n ", "en", "a", 4, None, None), (3, "one two", "en", "a", 7, "x", "k"),
    (4, "the quick brown fox jumps over the lazy dog and runs far away", "en", "b", 60, "x", "k"), (5, "the quick brown fox jumps over the lazy dog and runs far away", "en", "b", 60, "x", "k"),
    (6, LONG, "en", None, len(LONG), "x", "k"), (7, "ONE two", "en", "é", 7, "x", "k"), (7, "ONE two", "en", "é", 7, "x", "k"), (8, "naïve café 日本 🎉\nsecond line\n\nsecond line", "fr", "é", 30, "x", "k"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i in (4, 5))) for i in range(9)], "doc_id long, quality int, toxic int")


def roots(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_words_follow_the_definition():
    texts = ["A b\tC", None, "", "  x\x0b\x0cY ", "ab", "a b"]
    h, at = words(pa.array(texts))
    assert list(np.diff(at)) == [3, 0, 0, 2, 1, 2]
    same, _ = words(pa.array(["a B c"]))
    assert list(h[:3]) == list(same)


def test_components_and_running_sums(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots(pairs, {x for p in pairs for x in p})
    assert got == {n: c for n, c in want.items() if any(n in p and p[0] != p[1] for p in pairs)}
    df = spark.range(500).select(F.lit(0).alias("g"), F.col("id"), (F.col("id") % 7).alias("v"))
    sums = before(df, ["g"], ["id"], "v", "s", "id").collect()
    assert sorted(r.s + r.v for r in sums)[-1] == sum(i % 7 for i in range(500))
    assert len({(r.s, r.v) for r in sums if r.v}) == sum(1 for i in range(500) if i % 7)


def test_ngram_join_matches_brute_force(spark, edge):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    docs = [(i, " ".join([rng.choice(vocabulary) for _ in range(rng.randrange(40, 90))] + passage)) for i in range(40)]
    base = docs[0][1].split()
    for i in range(40, 70):
        copy = list(base)
        for _ in range(rng.randrange(0, 7)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        docs.append((i, " ".join(copy)))
    docs += [(r[0] + 1000, r[1]) for r in EDGE]
    got = ngram_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()

    def shingles(text):
        w = (text or "").encode().lower().split()
        return {b" ".join(w)} if 0 < len(w) < 5 else {b" ".join(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = {i: shingles(t) for i, t in docs}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = roots(links, sets)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), want[i]) for i, s in sets.items()}
    assert len(got) == len(docs)
    kept = ngram_join.one_of_each(edge)
    assert kept.columns == edge.columns and kept.count() == 7


def test_ngram_join_of_nothing(empty):
    assert ngram_join.jaccard_components(empty).count() == 0


def test_bitmaps_never_turn_away_a_link():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.92], rng.integers(0, 2**63, 15, dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 80 * (len(a) + len(b) - common):
            assert ngram_join.bits_allow(len(a), len(b), ngram_join.wide_bitmap(a), ngram_join.wide_bitmap(b), 80)


def test_line_dedup_keeps_first_lines_and_finds_near_ones(spark, edge, empty):
    out = {(r.doc_id, r.n_lines, r.n_kept): r.text for r in line_dedup.dedup_lines(edge).collect()}
    assert out[0, 0, 0] is None and out[1, 1, 1] == "" and out[5, 1, 0] == "" and out[4, 1, 1] == EDGE[4][1]
    assert out[8, 4, 3] == "naïve café 日本 🎉\nsecond line\n"
    assert line_dedup.dedup_lines(edge).count() == len(EDGE) and line_dedup.dedup_lines(empty).count() == 0
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(2, 9)))
    lines = []
    for _ in range(60):
        line = [word() for _ in range(rng.randrange(8, 60))]
        lines.append(" ".join(line))
        near = list(line)
        near[rng.randrange(len(near))] = word()
        lines.append(" ".join(near))
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    sets = [{x[i : i + 8] for i in range(len(x) - 7)} for x in lines]
    true = {(a, b) for a in range(len(lines)) for b in range(a + 1, len(lines)) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    comp = {r.lh: r.comp for r in line_dedup.line_components(docs).collect()}
    h = {r.doc_id: r.lh for r in line_dedup.lines_of(docs).collect()}
    same = {(a, b) for a in range(len(lines)) for b in range(a + 1, len(lines)) if comp.get(h[a], a) == comp.get(h[b], -1 - b)}
    assert len(true) > 30 and len(true & same) >= 0.9 * len(true) and same <= true


def test_mixing_meets_targets(spark, edge, empty):
    rng = random.Random(2)
    docs = [(i, "w " * rng.randrange(1, 30), f"s{min(rng.randrange(9), 5)}") for i in range(3000)]
    rows = mixing.placed(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    taken, target, own = Counter(), {}, {}
    for r in rows:
        taken[r.source] += r["__copies"] * r["__size"]
        target[r.source], own[r.source] = r["__target"], r["__source_size"]
        assert r["__copies"] <= 2
    assert math.isclose(sum(target.values()), 1.5 * sum(own.values()), rel_tol=1e-9)
    assert all(abs(taken[s] - target[s]) <= 30 and target[s] <= 2 * own[s] + 1e-6 for s in target)
    again = mixing.mixed(edge).select("doc_id", "position").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, mixing.mixed(edge.repartition(3)).select("doc_id", "position").collect()))
    assert mixing.mixed(edge).columns == [*edge.columns, "position"]
    names = ["size", "start", "copies", "target", "source_size", "ramp", "position"]
    clash = edge.drop("size").withColumns({c: F.lit(f"own {c}") for c in names})
    got = mixing.mixed(clash)
    assert got.columns == [*clash.columns[:-1], "position"]
    assert sorted((r.doc_id, r.position) for r in got.collect()) == sorted(map(tuple, again))
    assert {tuple(r) for r in got.select(names[:-1]).collect()} == {tuple(f"own {c}" for c in names[:-1])}
    assert mixing.mixed(empty).count() == mixing.placed(empty).count() == 0


def test_sharding_is_even_and_gathers_copies(spark, edge, empty):
    docs = [(i, f"text {i} " * (1 + i % 9)) for i in range(2000)] + [(2000 + i, f"copy {i % 60} " * 5) for i in range(240)] + [(3000 + i, "hot group " * 4) for i in range(900)]
    rows = sharding.slotted(sharding.assign(spark.createDataFrame(docs, "doc_id long, text string"))).collect()
    size, slots, groups = Counter(), defaultdict(list), defaultdict(Counter)
    for r in rows:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        groups[r.text_crc32][r.shard] += 1
    mean = sum(size.values()) / 16
    assert len(size) == 16 and max(abs(x - mean) for x in size.values()) <= 0.03 * mean
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    small = [g for g in groups.values() if 1 < sum(g.values()) < 100]
    assert sum(len(g) == 1 for g in small) >= 0.8 * len(small)
    got = {r.doc_id: r for r in sharding.assign(edge).collect()}
    assert got[0].size == 1 and got[0].text_crc32 is None and got[1].size == 1 and len(got) == len(EDGE) - 1
    assert sharding.assign(empty).count() == 0


def test_sentencepiece_round_trip_and_parity(spark, edge, empty):
    import sentencepiece

    out = sentencepiece_codec.encoded(edge).collect()
    reference = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    assert all(r.ids == reference.encode(r.text or "") and r.round_trip for r in out) and len(out) == len(EDGE)
    assert sentencepiece_codec.encoded(empty).count() == 0


def test_toxicity_restores_and_scores(spark, edge, empty, labels):
    docs = []
    for i in range(400):
        bad = i % 4 == 0
        docs.append((i, f"some plain words about item number {i % 50} with nothing wrong" + (" and a " + ("stupid" if i % 8 else "moron") if bad else " and a friend"), int(bad)))
    frame = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    test = spark.createDataFrame([(10_000, "you s.t.u.p.i.d thing"), (10_001, "a m0r0n wrote this"), (10_002, "kind regards to all"), (10_003, None)], "doc_id long, text string")
    scores = {r.doc_id: r["__score"] for r in toxicity.scored(frame.select("doc_id", "text").union(test), frame.select("doc_id", "toxic")).collect()}
    assert scores[10_000] >= 0.5 and scores[10_001] >= 0.5 and scores[10_002] < 0.5 and scores[10_003] < 0.5
    assert all((scores[i] >= 0.5) == bool(b) for i, _, b in docs)
    assert toxicity.scored(edge, labels).count() == len(EDGE) and toxicity.scored(empty, labels).count() == 0


def test_quality_keeps_k(spark, edge, empty, labels):
    docs = [(i, (f"plain sentence number {i} about things" if i % 5 else "BUY!! NOW!! FREE!! " * 4), int(i % 5 > 0)) for i in range(500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, quality int")
    rows = quality.resampled(frame.select("doc_id", "text"), frame.select("doc_id", "quality")).collect()
    assert sum(r.kept for r in rows) == sum(r.predicted for r in rows)
    best = sorted(rows, key=lambda r: (-r.key, r.doc_id))[: sum(r.predicted for r in rows)]
    assert {r.doc_id for r in best} == {r.doc_id for r in rows if r.kept}
    assert all(bool(r.predicted) == bool(r.doc_id % 5) for r in rows)
    assert quality.resampled(edge, labels).count() == len(EDGE) and quality.resampled(empty, labels).count() == 0


def test_lm_base_is_exact_and_prices_are_probabilities(spark, edge, empty):
    rows = lm_scoring.scores(edge).collect()
    counts = Counter()
    tokens = {}
    for r in EDGE:
        tokens[r[0]] = [*(r[1] or "").encode().lower().split(), "end"]
        if zlib.crc32(str(r[0]).encode()) % 7 != 2:
            counts.update(tokens[r[0]])
    total, kinds = sum(counts.values()), len(counts)
    for r in rows:
        want = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens[r.doc_id])
        assert math.isclose(r.base_score, want, rel_tol=1e-9) and r.n_tokens == len(tokens[r.doc_id]) and r.n_known == sum(counts[t] > 0 for t in tokens[r.doc_id]) and r.train_tokens == total
        assert r.score < 0
    assert len(rows) == len(EDGE) and lm_scoring.scores(empty).count() == 0
    # neither the order of rows nor their partitions matter
    again = lm_scoring.scores(edge.orderBy(F.desc("doc_id")).repartition(5)).collect()
    assert sorted((r.doc_id, r.score) for r in again) == sorted((r.doc_id, r.score) for r in rows)
    tree = lm_scoring.huffman(np.ones(lm_scoring.SYMBOLS))
    assert math.isclose(sum(2.0 ** -int(n) for n in tree[0]), 1.0)


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 0.1, 16).round(2)], 0) for i in range(400)]
    rows += [(500 + i, rows[i % 7][1], 0) for i in range(30)] + [(600, None, 0), (601, [float("nan")] * 16, 0), (602, [None] * 16, 0), (700, [], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    v = vector_topk.integer_vectors(frame)
    got = defaultdict(list)
    for r in vector_topk.top_k(v, v.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    ints = {i: [math.floor(1024 * x) for x in e] for i, e, _ in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)}
    for q in (i for i in ints if i % 100 == 0):
        want = sorted(((-sum(a * b for a, b in zip(ints[q], y)), j) for j, y in ints.items() if j != q))[:10]
        assert got[q] == [(j, -s) for s, j in want]
    assert set(got) == {i for i in ints if i % 100 == 0}


def test_vector_dedup_matches_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(60):
        x = rng.normal(size=32)
        for k in range(1 + i % 4):
            rows.append((len(rows), [float(y) for y in (x + rng.normal(scale=0.06, size=32))], i % 3))
    rows += [(1000 + i, rows[0][1], 0) for i in range(5)] + [(2000, None, 0), (2001, [0.0] * 32, 0), (2002, [float("nan")] * 32, 0), (2003, rows[0][1], None)]
    out = {r.vec_id: r for r in vector_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    fine = [(i, np.array(e), l) for i, e, l in rows if l is not None and e and np.isfinite(e).all() and np.any(e)]
    links = [(a, b) for a, x, l in fine for b, y, m in fine if a < b and l == m and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98]
    degree = Counter(x for p in links for x in p)
    want = roots(links, [r[0] for r in rows])
    assert len(links) > 40 and len(out) == len(rows)
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in out.items()} == {i: (degree[i], want[i], want[i] == i) for i in out}
