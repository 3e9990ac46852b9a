"""Rows that share an id but no text, and rows without an id."""

import pytest
from pyspark.sql import functions as F

from wattlake.llm import line_dedup, ngram_join, toxicity

A = "one two three four five six seven eight nine ten"
B = "red orange yellow green blue indigo violet black white grey"
LONG = "z" * 40 + " this line comes back " + "q" * 40


@pytest.mark.parametrize("most", [0, ngram_join.ODD_IDS])
def test_components_of_repeated_and_null_ids(spark, most, monkeypatch):
    monkeypatch.setattr(ngram_join, "ODD_IDS", most)
    rows = [(1, A), (2, B), (3, A), (3, B), (None, B), (None, "alone in here"), (4, None), (4, ""), (5, A + " " + B)]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    key = lambda r: (r is None, r)
    assert sorted((tuple(r) for r in got), key=lambda r: (key(r[0]), r[1], key(r[2]))) == sorted([(1, 6, 1), (2, 6, 2), (3, 6, 1), (3, 6, 2), (None, 6, 2), (None, 1, None), (4, 0, 4), (4, 0, 4), (5, 16, 5)], key=lambda r: (key(r[0]), r[1], key(r[2])))


def test_rows_of_one_id_lose_only_lines_of_their_own(spark):
    keep = "keep me because I am unique text\nand me too as I am not a repeat at all"
    rows = [(1, LONG), (2, f"zzz a first line of a document\n{LONG}"), (2, keep), (2, keep), (None, LONG)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in out) == sorted([(0, LONG), (1, LONG), (2, "zzz a first line of a document"), (2, keep), (2, keep)])


def test_of_one_id_and_place_one_line_stays(spark):
    rows = [(7, f"{LONG}\nalpha beta gamma delta epsilon"), (7, f"{LONG}\nsomething else altogether stands here")]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(LONG in r.text for r in out) == 1 and sum(r.n_kept for r in out) == 3


def test_columns_of_clashing_names_stay(spark):
    rows = spark.createDataFrame([(1, f"{LONG}\nmore"), (2, LONG)], "doc_id long, text string").withColumns({c: F.lit("x") for c in ("__cut", "__doc", "__gone", "___th")})
    out = line_dedup.dedup_lines(rows)
    assert out.columns == [*rows.columns, "n_lines", "n_kept"] and {r.text for r in out.collect()} == {f"{LONG}\nmore", ""}


def test_score_replaces_a_column_of_its_name(spark):
    docs = spark.createDataFrame([(None, "some text", "x"), (1, None, "y"), (1, "", "z")], "doc_id long, text string, __score string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    out = toxicity.scored(docs, labels)
    assert out.columns == ["doc_id", "text", "__score"] and all(0 <= r["__score"] <= 1 for r in out.collect()) and out.count() == 3
