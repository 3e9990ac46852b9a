"""The pipeline's stages and what the operators do with names of their own among the columns."""

import pytest
from pyspark.sql import functions as F

from wattlake.llm import line_dedup, sentencepiece_codec, toxicity

corpus_pipeline = pytest.importorskip("corpus_pipeline")

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (None, WORDS, "en", "a", 1), (1, WORDS, "en", "a", 1), (2, WORDS, "en", "b", 1), (3, None, None, None, None), (4, "", "en", "b", 0),
        (5, "one line here that is long enough\none line here that is long enough\nanother", "en", "b", 9), (5, "another text of the same id altogether", "en", "b", 9), (6, " \n ", "en", "a", 3),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_edge_rows_empty_tables_and_other_columns(spark, docs, sf, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    names = ["size", "n_lines", "n_kept", "start", "target", "ids", "n_tokens", "__x"]
    clash = docs.withColumns({c: F.lit(c) for c in names})
    assert stage(spark, docs.limit(0), sf).count() == 0
    got, more = stage(spark, docs, sf), stage(spark, clash, sf)
    assert set(docs.columns) <= set(got.columns) and set(clash.columns) <= set(more.columns)
    facts = lambda df: sorted((tuple(r) for r in df.select("doc_id", "text").collect()), key=str)
    assert facts(got) == facts(more)
    ids = [i for i, _ in facts(got)]
    if name == "toxicity" or name.startswith("SentencePiece"):
        assert facts(got) == facts(docs)
    if name == "line dedup":
        assert dict(facts(got.where("doc_id = 2 or doc_id is null"))) == {2: "", None: WORDS} and len(ids) == docs.count()
        assert got.where("doc_id = 5 and text like 'one%'").first().text == "one line here that is long enough\nanother"
    if name == "n-gram Jaccard join":
        assert ids.count(1) == 1 and ids.count(2) == 0 and ids.count(None) == 0 and ids.count(5) == 2 and {3, 4, 6} <= set(ids)
    if name.startswith("mixing"):
        assert set(ids) <= {None, 1, 2, 5} and got.where("position is null").count() == 0


def test_added_columns_replace_those_of_their_names(spark, docs):
    clash = docs.withColumns({"ids": F.lit("x"), "n_tokens": F.lit("x"), "decoded": F.lit("x"), "n_lines": F.lit("x")})
    rows = sentencepiece_codec.decoded(sentencepiece_codec.encoded(clash)).collect()
    assert len(rows) == docs.count() and all(r.round_trip and r.decoded == (r.text or "") and r.n_tokens == len(r.ids) for r in rows)
    assert dict(line_dedup.dedup_lines(clash).dtypes)["n_lines"] == "int"


def test_viterbi_is_the_best_path_of_the_whole_lattice(spark):
    """restore() against the enumeration of every path, under a made-up character model."""
    import itertools

    import numpy as np

    cost = np.random.default_rng(5).gamma(2.0, 1.0, (toxicity.CLASSES,) * 3).astype(np.float32)

    def total(parts):
        x = y = 0
        s = sum(p for _, p in parts)
        for byte in ("".join(o for o, _ in parts) + " ").encode():
            z = int(toxicity.CLASS[byte])
            s, x, y = s + float(cost[x, y, z]), y, z
        return s

    for span in ("st0p", "a55", "h.e.y", "loool", "$1ck", "b-4-d"):
        options, at = [], 0
        while at < len(span):
            ch, run = span[at], 1
            while at + run < len(span) and span[at + run] == ch:
                run += 1
            same = (ch * run, 0.0)
            if ch.isalpha():
                kept = [same] + [(ch * k, toxicity.SHRUNK) for k in (1, 2) if k < run]
            elif ch in toxicity.LOOKALIKES:
                letters = toxicity.LOOKALIKES[ch]
                kept = [(ch * run, toxicity.SUBSTITUTED if ch.isdigit() else toxicity.STAYED)] + [(x * run, toxicity.SUBSTITUTED) for x in letters]
                kept += [(x, toxicity.SUBSTITUTED + toxicity.SHRUNK) for x in letters if run > 1]
            else:
                kept = [(ch * run, toxicity.STAYED), ("", 0.0)]
            options.append(kept)
            at += run
        best = min(itertools.product(*options), key=total)
        got = toxicity.restore(span, cost)
        paths = {"".join(o for o, _ in p): total(p) for p in sorted(itertools.product(*options), key=total, reverse=True)}
        assert got in paths and abs(paths[got] - total(best)) < 1e-4, span
