"""Models and thresholds that follow the whole input."""


def test_language_model_keeps_its_words(spark):
    from skyplan.llm.language_id import fit

    letters = "abcdefghijklmnopqrst"
    words = [a + b + c + d for a in letters[:8] for b in letters for c in letters for d in letters]
    model = fit(spark.createDataFrame([(1, "xx", " ".join(words))], "doc_id long, lang string, text string"))
    assert len(words) == 64_000 and set(model.words) == set(words)


def test_boilerplate_of_few_sites(spark):
    from skyplan.llm.line_dedup import with_removed

    # six sites: a line on three of them is boilerplate, a line on two is not
    docs = [(k, "\n".join(["three sites"] * (k < 3) + ["two sites"] * (k < 2) + [f"own {k}"]), f"site{k}") for k in range(6)]
    got = with_removed(spark.createDataFrame(docs, "doc_id long, text string, source string")).select("row.doc_id", "clean").collect()
    assert dict(map(tuple, got)) == {0: "three sites\ntwo sites\nown 0", 1: "two sites\nown 1", 2: "own 2", 3: "own 3", 4: "own 4", 5: "own 5"}
