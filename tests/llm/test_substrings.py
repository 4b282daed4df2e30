"""Substring dedup: crowded classes, copies in one task and in many, equal
documents, and the sorter alone, against brute force."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

LENGTH = 100


def slow_cuts(rows, length=LENGTH):
    """rows: (id, text) -> result by (id, text); equal rows are one document."""
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    spark = SparkSession.getActiveSession()
    distinct = list(dict.fromkeys(rows))
    hashes = dict(spark.createDataFrame([(t,) for t in {t for _, t in distinct if t is not None}], "t string").select("t", F.xxhash64("t")).collect())
    hashes[None] = 42  # of a null text, which has no bytes anyway
    seen, out = set(), {}
    for i, text in sorted(distinct, key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1]])):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\x01" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i, text] = (len(b), sum(gone), sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1])), hashlib.sha256(kept).hexdigest())
    return out


def words(rng, n):
    return " ".join("".join(map(chr, rng.integers(97, 123, rng.integers(2, 9)))) for _ in range(n))


def corpus():
    rng = np.random.default_rng(5)
    common, passage, whole = words(rng, 30)[:90], words(rng, 60), words(rng, 120)
    rows = [(i, words(rng, 20) + " " + common + " " + words(rng, 20)) for i in range(1000, 1900)]  # one common name, all contexts different
    rows += [(200 + i, f"{passage[:150]} {i} {passage[150:]}") for i in range(60)]  # near copies
    rows += [(300 + i, whole) for i in range(80)]  # exact copies
    rows += [(400 + i, words(rng, 5) + "\n" + passage + "\n" + words(rng, 5 + i)) for i in range(40)]
    rows += [(500, "abc" * 300), (501, "abc" * 200 + "d" * 500), (502, "é" * 400), (503, ""), (504, None), (505, whole[:99]), (505, whole[:101]), (505, whole[:101]), (505, passage)]
    return rows + [(None, passage), (None, None), (None, whole + passage)]


@pytest.mark.parametrize(("block", "tasks", "bits"), [(800_000, 1, 1 << 29), (12_000, 6, 1 << 29), (12_000, 1, 0)])
def test_as_by_brute_force(spark, monkeypatch, block, tasks, bits):
    from skyplan.llm import substring_dedup as S

    rounds, real = [], S._emit_parts
    monkeypatch.setattr(S, "_emit_parts", lambda *a: rounds.append(a[1]) or real(*a))
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS lo", "2 AS ctx", "3 AS name").repartition(tasks)
    got = S.with_cuts(df, block=block, max_bloom_bits=bits).select("row.doc_id", "row.text", "cut.*").collect()
    assert len(got) == len(rows)
    want = slow_cuts(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id, r.text], (r.doc_id, (r.text or "")[:80])
    assert (rounds != []) == (block < 20_000)


def test_sorter_in_constant_memory():
    """Ten thousand copies pass through a block of a few hundred rows."""
    from skyplan.llm.substring_dedup import _rows, resolve

    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 123, 150, np.uint8)) for _ in range(3)]
    n = 10_000

    def batch(a, b):
        i = np.arange(a, b)
        return _rows([pa.array(np.zeros(b - a, bool)), pa.array(i), pa.array(i)], np.full(b - a, 7), np.zeros(b - a), np.full(b - a, 51), np.zeros(b - a, bool), [texts[k % 3] for k in i])

    cut = left = 0
    for cuts, rows, over in resolve((batch(a, a + 500) for a in range(0, n, 500)), LENGTH, 50_000):
        cut += sum(cuts.column("size").to_pylist())
        left += sum(rows.column("size").to_pylist())
        assert not over
    assert (cut, left) == (51 * (n - 3), 51 * 3)


def test_a_class_with_too_much_left():
    from skyplan.llm.substring_dedup import _rows, resolve

    rng = np.random.default_rng(2)
    n = 1000
    rows = _rows([pa.array(np.zeros(n, bool)), pa.array(np.arange(n)), pa.array(np.arange(n))], np.full(n, 7), np.zeros(n), np.full(n, 51), np.zeros(n, bool), [bytes(rng.integers(97, 123, 150, np.uint8)) for _ in range(n)])
    other = _rows([pa.array([False]), pa.array([5]), pa.array([5])], np.full(1, 8), np.zeros(1), np.full(1, 51), np.zeros(1, bool), [b"x" * 150])
    found = list(resolve(iter([rows, other]), LENGTH, 50_000))
    assert sum(r.num_rows for _, r, over in found if over) == n and sum(r.num_rows for _, r, over in found if not over) == 1
    assert sum(c.num_rows for c, _, _ in found) == 0
