"""Vector operators over empty tables, clashing columns and vectors of several lengths."""

from pyspark.sql import functions as F

from wattlake.llm import hard_negatives, vector_dedup, vector_topk

SCHEMA = "vec_id long, embedding array<double>, label int"


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert vector_dedup.near_duplicates(none).count() == 0
    v = vector_topk.integer_vectors(none)
    assert vector_topk.top_k(v, v).count() == 0
    h = hard_negatives.labelled_vectors(none)
    assert hard_negatives.mined(h, h).count() == 0


def test_clashing_columns_and_lengths(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.001], 1), (3, [1.0, 0.0, 0.0], 1), (4, [2.0, 0.0, 0.0], 1), (5, [1.0, 0.0], 2), (None, [1.0, 0.0], 1), (6, [], 1), (7, [1.0, 0.0], None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("rep", "mult", "v", "code", "node", "score", "key")})
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_dedup.near_duplicates(df).collect()}
    assert got[1] == (1, 1, True) and got[2] == (1, 1, False) and got[3] == (1, 3, True) and got[4] == (1, 3, False) and got[5] == (0, 5, True) and got[7] == (0, 7, True) and got[6] == (0, 6, True) and len(got) == len(rows)
    top = vector_topk.top_k(vector_topk.integer_vectors(df), vector_topk.integer_vectors(df).where("vec_id = 1"), 3).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(top, key=lambda r: r.rank)] == [(1, 4, 2048 * 1024), (2, 2, 1024 * 1024), (3, 3, 1024 * 1024)]
