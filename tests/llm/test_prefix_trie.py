"""The prefix trie against a brute-force build, and its defined cases."""

import hashlib
import math
import random
import zlib

import duckdb
import pytest

COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, (r or "").encode(), (x or "").encode()))
    turns = {c: [(r.decode(), x.decode()) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(turns.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:])
    return out


def brute(rows):
    convs, nodes, kids = rebuilt(rows), {}, {}
    for c, v in convs.items():
        for d in range(len(v) + 1):
            nodes.setdefault(v[:d], []).append(c)
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    leaves, saved = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids.get(k, [])) or 1
        saved[k] = sum(saved[x] for x in kids.get(k, [])) + ((len(nodes[k]) - 1) * len(k[-1][1]) if k else 0)
    out = []
    for k, m in nodes.items():
        ends = ",".join(map(str, sorted(c for c in m if convs[c] == k)))
        parent = min(nodes[k[:-1]]) if k else None
        out.append((min(m), len(k), parent, len(m), len(kids.get(k, [])), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def random_rows(seed):
    """Few texts, so that families meet at every depth; gaps, ties, nulls and
    ids below zero."""
    rng = random.Random(seed)
    rows = []
    for c in [*rng.sample(range(-250, 900), 120), 0, 100, -100]:
        n = rng.choice([1, 2, 3, 4, 7, 9, 12])
        for t in range(n):
            rows.append((c, rng.choice([t, t, t, 0, None]), rng.choice(["user", None]), rng.choice(["", "a", "bb", "é日", None]) if rng.random() < 0.4 else "same"))
    rows += rows[:20] + [(None, 1, "user", "of no conversation")]
    return rows


def nodes_of(df, **how):
    from skyplan.llm.prefix_trie import conversation_trie

    return sorted([tuple(r) for r in conversation_trie(df, **how).select(*COLS).collect()], key=str)


@pytest.mark.parametrize("family_rows", [100_000, 30, 0])
def test_brute_force(spark, family_rows):
    """Families built in one call, some over written ranges, and all so."""
    rows = random_rows(7)
    assert nodes_of(spark.createDataFrame(rows, SCHEMA), family_rows=family_rows) == brute(rows)


@pytest.mark.parametrize("family_rows", [100_000, 50])
def test_long_and_hot(spark, family_rows):
    """A start of 70 turns that several families share, and one conversation
    copied hundreds of times."""
    deep = [(c, t, "user", f"turn {t}" if t < 70 else f"own {c % 3}") for c in (100, 200, 300, 401) for t in range(75)]
    hot = [(c, t, "user", "x" * t) for c in range(1000, 1700) for t in range(6)]
    long_text = [(5000, 0, "user", "word " * 200_000), (5100, 0, "user", "word " * 200_000)]
    rows = deep + hot + long_text
    got = nodes_of(spark.createDataFrame(rows, SCHEMA), family_rows=family_rows)
    assert got == brute(rows)
    assert max(r[3] for r in got if r[1] == 6) >= 500


def test_rebuilt_turns(spark):
    from skyplan.llm.prefix_trie import rebuilt_turns

    rows = random_rows(3)
    got = {}
    for c, at, r, x in rebuilt_turns(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(c, []).append((at, r, x))
    want = {c: v for c, v in rebuilt(rows).items() if v}
    assert {c: tuple((r, x) for _, r, x in sorted(v)) for c, v in got.items()} == want


def test_turnless_and_empty(spark):
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in range(1, 100)}
    bare = next(c for c, n in h.items() if n >= 1)  # no base, and all own turns go
    assert nodes_of(spark.createDataFrame([(bare, 0, "user", "gone")], SCHEMA)) == [(bare, 0, None, 1, 0, 1, 0, hashlib.sha256(str(bare).encode()).hexdigest())]
    assert nodes_of(spark.createDataFrame([], SCHEMA)) == []
    assert nodes_of(spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)) == []


def test_clashing_columns(spark):
    rows = random_rows(5)
    more = spark.createDataFrame([(*r, 1, "b", 2, 3, 4) for r in rows], SCHEMA + ", base long, h1 string, h long, k1 long, pos long")
    assert nodes_of(more) == brute(rows)


def test_sql(spark):
    from skyplan.llm.queries import QUERIES
    from skyplan.llm.sql import ORACLE_SQL

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view conversations as from '{sf}/conversations.parquet'")
    want = con.sql(ORACLE_SQL["op11_prefix_trie"]).fetchall()
    found = QUERIES["op11_prefix_trie"](spark, sf)
    assert found.columns == COLS and {t for c, t in found.dtypes if c != "ends_sha256"} == {"bigint"}
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_sql_of_odd_rows(spark):
    rows = random_rows(11)
    con = duckdb.connect()
    con.sql("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    from skyplan.llm.sql import ORACLE_SQL

    assert sorted(con.sql(ORACLE_SQL["op11_prefix_trie"]).fetchall(), key=str) == brute(rows)
