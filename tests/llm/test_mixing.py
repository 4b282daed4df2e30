"""Targets of equal sources, many sources, and names that clash."""

import math
from fractions import Fraction

import pytest


def docs_of(spark, sizes):
    return spark.createDataFrame([(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(sizes)], "doc_id long, text string, source string")


def slow_targets(sizes, weights, share, most):
    own = {}
    for s, n in sizes:
        own[s] = own.get(s, 0) + n
    names = sorted(own, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, rest, out = Fraction(share) * sum(own.values()), set(names), {}
    while rest:
        level = left / sum(Fraction(weight[s]) for s in rest)
        over = {s for s in rest if level * Fraction(weight[s]) > most * own[s]}
        if not over:
            return out | {s: float(level * Fraction(weight[s])) for s in rest}
        out |= {s: float(most * own[s]) for s in over}
        left -= sum(most * own[s] for s in over)
        rest -= over
    return out


EQUAL = [(f"s{k}", 30) for k in range(6)]


@pytest.mark.parametrize(
    ("sizes", "weights", "most"),
    [
        (EQUAL, (3, 1, 2), 2),
        (EQUAL[:4], (1,), 2),
        (EQUAL[:4], (1,), 9),
        ([("a", 10), ("b", 10), ("c", 10), (None, 10), ("", 0), ("é", 40)], (3, 1, 2), 2),
        ([(f"s{k:03d}", 1 + k * k % 17) for k in range(300)], (3, 1, 2), 2),
        ([(f"s{k:02d}", 3**k) for k in range(12)], (5, 1), 2),
        ([("a", 0), ("b", 0)], (3, 1, 2), 2),
    ],
)
def test_targets(spark, sizes, weights, most):
    from skyplan.llm.mixing import mixture

    rows = mixture(docs_of(spark, sizes), weights=tuple(map(float, weights)), most=float(most)).collect()
    want = slow_targets(sizes, weights, 1.5, most)
    assert {r.source: r.target for r in rows} == pytest.approx(want)
    total = sum(n for _, n in sizes)
    caps = all(math.isclose(want[s], most * sum(n for x, n in sizes if x == s)) for s in want)
    assert caps or sum(want.values()) == pytest.approx(1.5 * total)
    for s in want:  # one document of this size is all that can be missing
        got = sum(r.copies * r.size for r in rows if r.source == s)
        assert abs(got - want[s]) <= max(n for x, n in sizes if x == s)


def test_clashing_names(spark):
    from skyplan.llm.mixing import mix

    docs = docs_of(spark, [("a", 5), ("b", 7), ("a", 3)]).selectExpr("*", "'x' AS mix_copies", "0.5 AS Mix_Words", "1 AS place", "2 AS part", "3 AS level", "4 AS weight")
    out = mix(docs)
    assert out.columns == ["doc_id", "text", "source", "place", "part", "level", "weight", "mix_copies", "mix_words"]
    assert dict(out.dtypes)["mix_copies"] == "bigint" and out.where("mix_copies < 1").count() == 0
