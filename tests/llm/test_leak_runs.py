from threadloom.llm import leakage


def test_every_run_of_an_item_counts_and_goes(spark):
    q = [f"q{i}" for i in range(60)]
    p = spark.createDataFrame([(1, " ".join(q))], "item_id bigint, question string")
    parts = [["in"], q[:26], ["mid", "dle"], q[30:58], ["again"], q[:26], ["out"]]
    low = [["in"], q[:16], ["mid"], q[30:46], ["out"]]  # 32 of 60 words, no run of which exceeds a limit
    once = [["in"], q[:14], ["mid"], q[:14], ["out"]]  # the same 14 words twice
    d = spark.createDataFrame([(i, " ".join(w for x in t for w in x)) for i, t in enumerate((parts, low, once))], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_words"], r["coverage"]) for r in leakage.leaks(d, p).collect()}
    assert got == {0: (28, 0.9), 1: (16, round(32 / 60, 6)), 2: (14, round(14 / 60, 6))}
    clean = {r["doc_id"]: (r["n_spans"], r["n_words_removed"], r["text"].split()) for r in leakage.without_leaks(d, p).collect()}
    assert clean == {0: (3, 80, ["in", "mid", "dle", "again", "out"]), 1: (2, 32, ["in", "mid", "out"])}
