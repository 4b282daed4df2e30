"""The pipeline on nulls, repeated rows, names that clash, and empty tables."""

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars int, row string, mix_copies int, th long, fp long, clean string, hit int, site string, h1 long, n int"
TEXT = "the quick brown fox jumps over the lazy dog while many other animals look on and wonder what comes next in this tale {}"


def rows_of():
    out = [(i, TEXT.format(" ".join(f"w{i}x{k}" for k in range(15))) + "\nshared boilerplate line", "en", f"s{i % 4}", 5, "r", 1, 2, 3, "c", 4, "s", 6, 7) for i in range(24)]
    out += [(100, out[3][1], "en", "s0", 5, None, None, None, None, None, None, None, None, None)]  # an exact copy
    out += [out[5], (None, out[7][1], None, None, None, "r", 1, 2, 3, "c", 4, "s", 6, 7), (None,) * 14, (8, None, None, "s1", None, *([None] * 9)), (9, "", "en", None, 0, *([None] * 9))]
    out += [(200, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen " + " ".join(f"q{k}" for k in range(40)), "en", "s2", 1, *([None] * 9))]
    return out


@pytest.mark.parametrize("items", [[(1, "one two three four five six seven eight nine ten eleven"), (None, None), (2, "")], []])
def test_odd_rows(spark, tmp_path, items):
    import corpus_pipeline

    df = spark.createDataFrame(rows_of(), COLUMNS)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == df.columns and docs.dtypes == df.dtypes, name
    kept = docs.collect()
    ids = [r.doc_id for r in kept]
    assert sorted(i for i in ids if i is not None) == [*range(24), 200]  # copies, repeated rows and wordless ones went
    assert sum("shared boilerplate line" in r.text for r in kept) == 1
    assert ("one two three" in next(r.text for r in kept if r.doc_id == 200)) == (not items)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [c for c in df.columns if c != "mix_copies"] + ["mix_copies", "mix_words"]
    assert out.count() <= len(kept) and out.where("mix_copies < 1 or mix_copies > 2").count() == 0


def test_no_rows(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
