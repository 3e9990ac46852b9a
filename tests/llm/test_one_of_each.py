"""Which rows of near copies stay, with null and repeated ids."""

from wattlake.llm import ngram_join


def test_near_copies_keep_rows_without_or_with_repeated_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(None, a, 1), (None, a, 2), (None, b, 3), (5, b, 4), (6, c, 5), (6, a + " more", 6), (7, c, 7), (None, None, 8), (None, None, 9), (8, "", 10)]
    kept = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, n int"))
    assert kept.columns == ["doc_id", "text", "n"] and {r.n for r in kept.collect()} == {4, 5, 6, 8, 9, 10}
    copies = ngram_join.one_of_each(spark.createDataFrame([(None, a, i) for i in range(4)], "doc_id long, text string, n int"))
    assert copies.count() == 1
