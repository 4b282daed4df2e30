"""Language identification against a scorer written plainly."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

DOCS = "/root/testdata/sf0.01/documents.parquet"


def words(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def grams(word, n):
    marked = f"\x02{word}\x03"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def slow_scorer(labelled):
    """labelled: (text, lang) pairs -> scores of a text by language."""
    langs = sorted({lang for _, lang in labelled})
    tables = [defaultdict(Counter) for _ in range(5)]
    for text, lang in labelled:
        for w in words(text):
            tables[0][w][lang] += 1
            for n in range(1, 5):
                for g in grams(w, n):
                    tables[n][g][lang] += 1
    total = [{x: sum(c[x] + 0.5 for c in t.values()) for x in langs} for t in tables]

    def log(n, name, lang):
        return math.log((tables[n][name][lang] + 0.5) / total[n][lang])

    known = {}

    def of_word(w):
        if w not in known:
            known[w] = dict.fromkeys(langs, 0.0)
            if w in tables[0]:
                known[w] = {x: log(0, w, x) for x in langs}
            else:
                for n in range(4, 0, -1):
                    found = [g for g in grams(w, n) if g in tables[n]]
                    if found:
                        known[w] = {x: sum(log(n, g, x) for g in found) / len(found) for x in langs}
                        break
        return known[w]

    def score(text):
        return {x: sum(of_word(w)[x] for w in words(text)) for x in langs}

    return score


def test_every_document_as_by_the_slow_scorer(spark):
    from pyspark.sql import functions as F

    from skyplan.llm.language_id import fit, held_out, predict

    docs = spark.read.parquet(DOCS)
    rows = docs.collect()
    trained = [(r.text, r.lang) for r in rows if r.lang is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    score = slow_scorer(trained)
    got = {r.doc_id: r.answer for r in predict(docs, fit(docs.where(~held_out()))).select("row.doc_id", "answer").collect()}
    assert len(got) == len(rows)
    for r in rows:
        want = score(r.text)
        best = max(sorted(want), key=want.get)
        if words(r.text):
            assert got[r.doc_id].lang == best, r.doc_id
            assert got[r.doc_id].score == pytest.approx(1 / sum(math.exp(x - want[best]) for x in want.values()), rel=1e-6)
        else:
            assert got[r.doc_id] == ("und", 0.0)
    again = predict(docs.repartition(7), fit(docs.where(~held_out()).repartition(5))).select("row.doc_id", "answer")
    assert {r.doc_id: r.answer for r in again.collect()} == got
    assert docs.where(F.col("doc_id").isNull()).count() == 0


def test_model_holds_its_whole_sample(spark):
    from skyplan.llm.language_id import Counts, fit

    rows = [(k, f"lang{k:04d}", f"common word{k} {'é' * (k % 5 + 1)}") for k in range(700)]
    model = fit(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    want = Counter(w for _, _, t in rows for w in words(t))
    assert len(model.langs) == 700 and {w: sum(model.words[w]) for w in model.words} == dict(want)
    assert model.words["common"] == (1,) * 700 and model.grams["\x02co"][699] == 1 and "absent" not in model.words
    assert isinstance(model.grams, Counts) and {len(g) for g in model.grams} == {1, 2, 3, 4}


def test_a_sample_too_large_is_halved(spark):
    from skyplan.llm.language_id import fit

    rows = [(k, "en", f"{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyz'[k % 6]}") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    whole, small = fit(df), fit(df, max_entries=400)
    assert 0 < len(small.words) + len(small.grams) <= 400 < len(whole.words) + len(whole.grams)
    assert set(small.words) < set(whole.words)


def test_ties_long_and_odd_texts(spark):
    from skyplan.llm.language_id import PIECE, Model, Scorer, pieces_of

    s = Scorer(Model(("a", "b"), {"same": (3, 3), "left": (4, 1), "right": (1, 4)}, {"q": (1, 1)}))
    assert s.answer("same same") == ("a", 0.5) and s.answer("qqq") == ("a", 0.5)
    long = "left same " * (PIECE // 4)
    assert "".join(pieces_of(long)) == long and len(list(pieces_of(long))) == 3
    assert s.answer(long)[0] == "a" and s.answer("x" * (3 * PIECE)) == ("a", 0.5) and s.answer(" \n" * PIECE) == ("und", 0.0)
    assert s.answer("ΑΣ left\x00left_left3left")[0] == "a"
