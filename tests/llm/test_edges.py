"""Every operator on nulls in any column, empty and long texts, ties and
repeated rows, an empty table, and columns whose names clash."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id int, th long, hit int, fp long, key string, n int, gone string"
LONG = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do " * 3000
ROWS = [
    (1, "one two three four five six seven eight nine ten eleven", "en", "a", 5, "r", 1, 2, 3, 4, "k", 5, "g"),
    (1, "one two three four five six seven eight nine ten eleven", "en", "a", 5, "r", 1, 2, 3, 4, "k", 5, "g"),
    (1, "another text under the same id with quite some words in it", "de", "b", None, None, None, None, None, None, None, None, None),
    (None, None, None, None, None, None, None, None, None, None, None, None, None),
    (None, "text without an id but with enough words to be kept by rules", "en", None, 1, "x", 7, 7, 7, 7, "x", 7, "x"),
    (4, "", "en", "a", 0, "", 0, 0, 0, 0, "", 0, ""),
    (5, " \n\t\n", None, "b", 3, None, 1, 1, 1, 1, None, 1, None),
    (6, LONG, "fr", "c", 9, "r", 1, 2, 3, 4, "k", 5, "g"),
    (7, LONG, "fr", "c", 9, "r", 1, 2, 3, 4, "k", 5, "g"),
    (8, "Ünïcödé 中文    words here and\u0085there \x00 with a NUL and more to come", "xx", "d", 1, "r", 1, 2, 3, 4, "k", 5, "g"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "three four five six seven eight nine ten eleven twelve"), (2, "another text under"), (None, None), (3, ""), (3, "same id with")], "item_id long, text string")


def test_quality(docs, none):
    from skyplan.llm.quality_rules import filter_quality, with_quality

    rows = with_quality(docs).select("row.doc_id", "q.*").collect()
    assert len(rows) == len(ROWS)
    assert [r.n_words for r in rows if r.doc_id == 4] == [0] and all(r.base_failed and not r.kept for r in rows if r.doc_id in (4, 5, 6, 7))
    assert with_quality(none).count() == 0
    kept = filter_quality(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert sum(r.doc_id == 1 for r in kept.collect()) == 3


def test_lines(docs, none):
    from skyplan.llm.line_dedup import dedup_lines, with_removed

    out = dedup_lines(docs, min_sites=2)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    assert {r.text for r in out.where("doc_id = 4").collect()} == {""} and out.where("doc_id is null and text is null").count() == 1
    assert dedup_lines(none).count() == 0
    assert with_removed(docs).agg({"n_removed": "sum"}).first()[0] == 0


def test_simhash(docs, none):
    from skyplan.llm.simhash import keep_one, near_components

    got = near_components(docs).collect()
    assert len(got) == len(ROWS)
    empty = [r for r in got if r.fp == 0]
    assert len(empty) == 3 and {r.component_id for r in empty} == {4}
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
    assert [i for i, _ in ids] == [0, 1, 1, 4, 6, 8]
    assert near_components(none).count() == 0 and keep_one(none).count() == 0


def test_decontaminate(docs, none, items):
    from skyplan.llm.decontaminate import decontaminate, scan_items

    for block in (100_000, 3):
        rows = {(r.doc_id, r.text): r for r in scan_items(docs, items, block_words=block).select("row.doc_id", "row.text", "hit.*").collect()}
        assert rows[1, ROWS[0][1]].n_hit == 0
        assert rows[1, ROWS[2][1]]["items"] == ["2", "3"] and rows[1, ROWS[2][1]].n_hit == 6
        assert rows[None, None].n_words == 0
    out = decontaminate(docs, items)
    assert out.columns == docs.columns
    assert decontaminate(none, items).count() == 0
    assert decontaminate(docs, items.limit(0)).count() == len(ROWS)


def test_mixing(docs, none):
    from skyplan.llm.mixing import mix, mixture

    rows = mixture(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r.copies <= 2 for r in rows)
    out = mix(docs)
    assert out.columns == [*docs.columns, "mix_copies", "mix_words"]
    assert mixture(none).count() == 0 and mix(none).count() == 0


def test_substrings(docs, none):
    from skyplan.llm.substring_dedup import with_cuts

    rows = {(r.doc_id, r.text): r for r in with_cuts(docs).select("row.doc_id", "row.text", "cut.*").collect()}
    n = len(LONG.encode())
    assert rows[7, LONG].n_removed == n and rows[7, LONG].n_spans == 1
    assert rows[6, LONG].n_removed == n - len("lorem ipsum dolor sit amet consectetur adipiscing elit sed do ") and rows[None, None].n_bytes == 0
    assert with_cuts(none).count() == 0


def test_tokens(docs, none):
    from skyplan.llm.token_counts import with_token_counts

    for r in with_token_counts(docs).select("row.text", "count.*").collect():
        assert sum(r.by_section) == r.n_tokens and bool(r.text) == bool(r.n_tokens)
    assert with_token_counts(none).count() == 0


def test_language(docs, none):
    from skyplan.llm.language_id import fit, predict

    model = fit(docs)
    rows = {(r.doc_id, r.text): r.answer for r in predict(docs, model).select("row.doc_id", "row.text", "answer").collect()}
    assert rows[4, ""].lang == "und" and rows[None, None] == ("und", 0.0) and rows[6, LONG].lang == "fr"
    assert all(r.answer.lang == "und" for r in predict(docs, fit(none)).collect())
    assert predict(none, model).count() == 0


def test_licences(docs, none):
    from pyspark.sql import functions as F

    from skyplan.llm.license_scan import scan_licenses

    assert scan_licenses(docs.withColumn("path", F.lit(None).cast("string"))).where("licence is not null").count() == 0
    assert scan_licenses(none.withColumn("path", F.lit("/a"))).count() == 0


def test_warc(spark, none):
    from skyplan.llm.warc import archive

    big = "x" * 1500
    pages = spark.createDataFrame([(1, "http://a/\r\nX: y", big, 1), (2, None, big, 2), (None, "u", big, 3), (3, "u", None, 4), (4, "u", "", 5), (2, "v", big, 6), (5, "é", "é" * 400, 7), (6, "é", "é" * 400, 8)], "page_id long, url string, html string, payload int")
    rows = archive(pages).collect()
    assert len(rows) == 8
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in rows if r.payload_bytes == 1500)
    assert kinds == [(0, "revisit", 2), (1, "revisit", 2), (2, "response", None), (2, "response", None)]
    assert all(r.record_type == "response" for r in rows if r.payload_bytes != 1500)
    assert archive(pages.limit(0)).count() == 0
