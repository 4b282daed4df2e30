"""The threshold of line dedup follows one share of the sites, in the query
and in its SQL."""

import math
import tempfile

import duckdb
import pytest


def rows_of(n_sites):
    """Lines on every number of sites from 1 to all, each in two documents of
    its first site; a null site, null and empty texts, and a repeated row."""
    need = max(2, math.ceil(n_sites / 2))
    out, at = [], 0
    sites = [None, *[f"s{k:02}" for k in range(1, n_sites)]]
    for k, site in enumerate(sites):
        lines = [f"line of {w} sites" for w in range(1, n_sites + 1) if k < w]
        out.append((at, "\n".join([*lines, "", f"own {k}"]), site))
        out.append((at + 1, "\n".join([f"second of {k}", *lines[:1]]), site))
        at += 2
    return [*out, out[0], (at, None, sites[-1]), (at + 1, "", sites[-1])], need


@pytest.mark.parametrize("n_sites", [2, 8, 9, 18, 19, 20])
def test_share_of_sites(spark, n_sites):
    from skyplan.llm.queries import QUERIES
    from skyplan.llm.sql import ORACLE_SQL

    rows, need = rows_of(n_sites)
    folder = tempfile.mkdtemp(prefix="sites-")
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{folder}/documents.parquet")
    found = {tuple(r) for r in QUERIES["op9_line_dedup"](spark, folder).select("doc_id", "n_lines", "n_removed", "kept_sha256").collect()}
    con = duckdb.connect()
    con.sql(f"create view documents as from read_parquet('{folder}/documents.parquet/*.parquet')")
    assert found == set(con.sql(ORACLE_SQL["op9_line_dedup"]).fetchall())
    # lines of need sites or more go from all documents but the first
    gone = {d: n for d, _, n, _ in found}
    for k in range(n_sites):
        on = [w for w in range(need, n_sites + 1) if k < w]
        assert gone[2 * k] == (len(on) if k else 0)


def test_own_share(spark):
    from skyplan.llm.line_dedup import with_removed

    df = spark.createDataFrame(rows_of(20)[0], "doc_id long, text string, source string")
    total = [with_removed(df, site_share=s).agg({"n_removed": "sum"}).first()[0] for s in (0.0, 0.25, 0.5, 0.95, 1.0)]
    assert total[0] > total[1] > total[2] > total[3] > total[4] > 0
    assert with_removed(df, min_sites=10).agg({"n_removed": "sum"}).first()[0] == total[2]
