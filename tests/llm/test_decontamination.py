"""Several blocks of items, in several groups, against one block."""


def test_window_hashes():
    from skyplan.llm.decontaminate import window_hashes

    assert len(window_hashes(b"", [1, 10])) == 0 and len(window_hashes(b"...", [1])) == 0
    a, b = window_hashes(b"One, two three", [2]), window_hashes(b"zero one TWO", [2])
    assert len(a) == 2 and a[0] == b[1] and a[1] != b[0]
    assert len(window_hashes("a b c é".encode(), [1, 3, 5])) == 6


def test_blocks_and_groups_agree(spark):
    from pyspark.sql import functions as F

    from skyplan.llm.decontaminate import decontaminate, scan_items

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.when(F.col("doc_id") % 97 != 0, F.col("text")).alias("text"), F.lit(1).alias("t1"), F.lit(2).alias("found"))
    docs = docs.unionByName(docs.where("doc_id < 50"))
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text")
    items = items.unionByName(spark.createDataFrame([(-1, "of the"), (-2, ""), (-3, None), (None, "in the morning")], items.schema))

    def answer(df):
        return sorted((tuple(r) for r in df.select("row.doc_id", "row.t1", "hit.n_words", "hit.n_hit", "hit.spans", "hit.items").collect()), key=repr)

    want = answer(scan_items(docs, items))
    assert sum(r[3] > 0 for r in want) > 20
    assert answer(scan_items(docs, items, block_words=400)) == want
    assert answer(scan_items(docs, items, block_words=900, group_words=3000)) == want
    a, b = decontaminate(docs, items), decontaminate(docs, items, block_words=900)
    assert a.columns == docs.columns and sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
