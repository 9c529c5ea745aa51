from tabreg.llm import ngram_jaccard, toxicity


def test_sample_bounds_repeated_rows(spark, docs_of, monkeypatch):
    rows = [(i, "you bad thing" if i % 3 == 0 else "a nice day") for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    once, often = toxicity.train(docs_of(rows), labels), toxicity.train(docs_of(rows * 7), labels)
    assert once.w0 == often.w0 and (once.w == often.w).all() and (once.v == often.v).all()


def test_one_of_each_with_clashing_and_unordered_columns(spark):
    text = "one two three four five six"
    docs = spark.createDataFrame([(1, text, "p"), (1, text, "q"), (1, "another text of some six words", "r"), (2, text, "s"), (None, text, "t")],
                                 "doc_id long, text string, _row string").selectExpr("*", "map('a', 1) as m", "1 as _row_")
    out = ngram_jaccard.one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["_row"]) for r in out.collect()) in ([(0, "t"), (1, "r")], [(0, "t"), (1, "p")])
