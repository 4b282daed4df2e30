"""WARC archives: the whole query against a plain re-computation."""

import hashlib
from collections import defaultdict

import pytest


def slow_records(pages):
    """pages: (page_id, url, html) -> sorted result rows."""
    groups = defaultdict(list)
    for i, _, html in pages:
        data = (html or "").encode()
        if len(data) >= 1000:
            groups[data].append(i)
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        last = max((x for x in groups[data] if x is not None), default=None) if data in groups else None
        revisit = last is not None and i != last
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=repr)


PAGES = [
    (1, "http://a/1", "x" * 1000), (2, "http://a/2", "x" * 1000), (9, "http://a/9", "x" * 1000), (3, "u", "x" * 999), (4, "u", "x" * 999), (5, None, None), (6, "", ""),
    (None, "u", "y" * 2000), (7, "u", "y" * 2000), (8, "u", "é" * 500), (10, "u", "é" * 500), (11, "u", "é" * 499), (12, "u", "z" * 3_000_000), (13, "v", "z" * 3_000_000),
    (None, "u", "w" * 1500), (None, "v", "w" * 1500), (14, "line\r\nWARC-Type: revisit", "WARC/1.1\r\n\r\n" * 200), (15, "u", "\x00" * 1200), (15, "u", "\x00" * 1200),
]


@pytest.mark.parametrize("small", [100_000, 0])
def test_records_as_recomputed(spark, monkeypatch, tmp_path, small):
    """With the repeated digests sent to tasks, and joined."""
    from skyplan.llm import common, queries, warc

    monkeypatch.setattr(warc, "sent_if_small", lambda t: common.sent_if_small(t, small))
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS sha1", "2 AS size", "3 AS key", "4 AS payload", "5 AS last")
    df.repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op1_warc(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == slow_records(PAGES)


def test_every_page_of_the_tables(spark):
    from skyplan.llm.queries import op1_warc

    sf = "/root/testdata/sf0.01"
    pages = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    pages += [(i + 10**6, u, h) for i, u, h in pages[::3]] + [(i + 2 * 10**6, u, h) for i, u, h in pages[::7]]
    folder = spark.createDataFrame(pages, "page_id long, url string, html string")
    import tempfile

    with tempfile.TemporaryDirectory() as where:
        folder.write.parquet(f"{where}/pages.parquet")
        got = sorted(map(tuple, op1_warc(spark, where).collect()), key=repr)
    assert got == slow_records(pages) and sum(r[3] == "revisit" for r in got) > 0


def test_an_attempt_that_failed_is_not_read(spark, tmp_path):
    """Files under names that the manifest lacks don't matter."""
    from skyplan.llm.warc import archive, plan_records, read_archives, write_archives

    pages = spark.createDataFrame(PAGES[:7], "page_id long, url string, html string")
    folder = f"file://{tmp_path}"
    (tmp_path / "part-00000-lost-0000.warc.zst").write_bytes(b"half an archive")
    manifest = write_archives(plan_records(pages), folder)
    assert read_archives(manifest, folder).count() == 7 and archive(pages, folder=folder).count() == 7
