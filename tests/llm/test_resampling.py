"""Importance resampling against brute force, chunks and the draw's cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SCHEMA = "doc_id long, text string, at long, th string, own int, score string, resample_rank string"


def features(text, max_n=3, n_buckets=10_000):
    w = WORD.findall((text or "").encode().translate(LOWER))
    return len(w), [zlib.crc32(b" ".join(w[i : i + n])) % n_buckets for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def brute(docs, items, percent=5, min_words=20):
    found = [(d, *features(t)) for d, t in docs]
    s, t = Counter(b for x in found for b in x[2]), Counter(b for x in items for b in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in range(10_000)]
    out = []
    for d, n, bs in found:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in bs)
        out.append([d, n, len(bs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    may = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(may[: percent * len(may) // 100], 1):
        r[5] = k
    return sorted(out, key=str)


def texts(n=300, seed=1):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma9", "é", "日本", "x" * 60, "don't", "y" * 49, "z" * 48]
    out = [(i, rng.choice([" ", "\n", ", ", "\x00"]).join(rng.choices(words, k=rng.choice([0, 1, 2, 19, 20, 21, 90])))) for i in range(n)]
    out += [(n, None), (n + 1, ""), (n + 2, "..."), (None, "seven words under no id " * 6), (5, out[5][1]), (5, out[5][1])]
    out += [(n + 3, "long text with Words " * 9000), (n + 4, "q" * 100_000 + " tail of a word longer than chunks " * 3)]
    return out


ITEMS = ["alpha beta gamma9 words with long text", None, "", "é 日本 " * 40]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "t", 2, "s", "r") for r in rows], SCHEMA)


def items_of(spark):
    return spark.createDataFrame([(x,) for x in ITEMS], "text string")


def rows_of(df):
    return sorted([list(r) for r in df.select("id", "n_words", "n_features", "weight", "score", "rank").collect()], key=str)


@pytest.mark.parametrize("chunk_bytes", [1 << 15, 64, 7])
def test_brute_force(spark, chunk_bytes):
    from skyplan.llm.resampling import scored

    rows = texts() if chunk_bytes > 7 else texts(60)[:-2]
    assert rows_of(scored(frame(spark, rows), items_of(spark), percent=30, chunk_bytes=chunk_bytes)) == brute(rows, ITEMS, 30)


@pytest.mark.parametrize("size", [1, 5, 16, 1000])
def test_chunks_lose_no_feature(size):
    from skyplan.llm.resampling import _batch_buckets, chunks_of
    import pyarrow as pa

    for _, t in texts(40, 3):
        data = (t or "").encode()
        found = list(chunks_of(data, size))
        got = np.zeros(0, np.int64)
        if found:
            got = _batch_buckets(pa.array([x for x, _ in found], pa.binary()), [n for _, n in found], 3, 10_000)[1]
        n, want = features(t)
        assert Counter(got.tolist()) == Counter(want)
        assert sum(n for _, n in found) == n


def test_hot_text(spark):
    """Copies under one id and under many: the draw has as many as it should,
    ranked without gaps."""
    from skyplan.llm.resampling import resample, scored

    rows = texts(60) + [(7, "one text of thirty words that is there again and again " * 3)] * 400
    df = frame(spark, rows)
    want = brute(rows, ITEMS, 50)
    assert rows_of(scored(df, items_of(spark), percent=50)) == want
    drawn = resample(df, items_of(spark), percent=50)
    assert drawn.columns == [*df.columns[:-1], "resample_weight", "resample_score", "resample_rank"]
    assert sorted((str(r.doc_id), r.resample_weight, r.resample_score, r.resample_rank) for r in drawn.collect()) == sorted((str(r[0]), r[3], r[4], r[5]) for r in want if r[5])


def test_no_rows(spark):
    from skyplan.llm.resampling import resample, scored

    df = frame(spark, [])
    assert scored(df, items_of(spark)).count() == 0 and resample(df, items_of(spark)).count() == 0
    rows = texts(30)
    assert rows_of(scored(frame(spark, rows), items_of(spark).limit(0))) == brute(rows, [])


def test_sql(spark):
    from skyplan.llm.queries import QUERIES
    from skyplan.llm.sql import ORACLE_SQL

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as from '{sf}/{t}.parquet'")
    found = QUERIES["op12_resampling"](spark, sf)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in found.dtypes} == {"bigint"}
    assert sorted(map(tuple, found.collect())) == sorted(con.sql(ORACLE_SQL["op12_resampling"]).fetchall())
