"""Quality rules as a short-circuit cascade (operator 3).

Every rule is a pure predicate on one text, so the verdict (kept = no rule
rejects) does not depend on the order; the order only decides how much work
is spent. A rule needs figures of the text (its words, its distinct lines, its
repeated windows ...), which are computed when first asked for and then held.
A bounded sample of rows gives the cost of each figure and of each rule's own
test, and the joint pattern of rejections. Rules then run by rejection per
second: of those left, next comes the one with most rejections, on the rows
that the earlier ones let through, for the time of the figures that nobody
has asked for yet. The first rule that rejects ends the work on a text. The
base rules (too few words, too many repeated ones) are in the cascade.

Words are runs of bytes outside space and TAB..CR; lines are split at LF.

Defined results: null or empty text has no words and fails the base rule;
any length is read whole; repeated rows get equal results; an empty table
gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Collection, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, text_hash, unpacked, utf8

SYMBOLS = b"#*$%&|<>"
WINDOW = 5

METRICS = pa.struct(
    [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
     ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_())]
)
METRICS_SQL = "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,base_failed:boolean,kept:boolean>"

_NOT_SYMBOL = bytes(x for x in range(256) if x not in SYMBOLS)
_NOT_BANG = bytes(x for x in range(256) if x != 0x21)
_NOT_UPPER = bytes(x for x in range(256) if not 65 <= x <= 90)
_NOT_DIGIT = bytes(x for x in range(256) if not 48 <= x <= 57)
_CONTINUATION = bytes(range(0x80, 0xC0))


def count_repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more, the first included."""
    n = len(words)
    if n <= window:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    base = bound = len(ids)
    name = w
    for k in range(1, window):
        if bound * base >= 1 << 62:  # shorten the names, or they overflow
            name = np.unique(name, return_inverse=True)[1]
            bound = len(name)
        name = name[: n - k] * base + w[k:]
        bound *= base
    _, inverse, count = np.unique(name, return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[inverse] > 1)
    if not len(at):
        return 0
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


class Text:
    """One text; each figure is computed when first asked for."""

    def __init__(self, data: bytes):
        self.data = data

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points in words: bytes that don't continue one, less blanks."""
        return sum(map(len, self.words)) - len(self.data) + len(self.data.translate(None, _CONTINUATION))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data.translate(None, _NOT_SYMBOL))

    @cached_property
    def lines(self) -> tuple[int, int]:
        """Lines with a word, and those of them equal to an earlier line."""
        worded = [x for x in self.data.split(b"\n") if x and not x.isspace()]
        return len(worded), len(worded) - len(set(worded))

    @property
    def n_lines(self) -> int:
        return self.lines[0]

    @property
    def n_dup_lines(self) -> int:
        return self.lines[1]

    @cached_property
    def n_repeat_words(self) -> int:
        return count_repeat_words(self.words)

    @cached_property
    def n_bangs(self) -> int:
        return len(self.data.translate(None, _NOT_BANG))

    @cached_property
    def n_capitals(self) -> int:
        return len(self.data.translate(None, _NOT_UPPER))

    @cached_property
    def n_digits(self) -> int:
        return len(self.data.translate(None, _NOT_DIGIT))

    @cached_property
    def n_commonest(self) -> int:
        return max(Counter(self.words).values(), default=0)


#: The figures, each after those that it is made from.
FIGURES = ("words", "word_chars", "n_symbols", "lines", "n_repeat_words", "n_bangs", "n_capitals", "n_digits", "n_commonest")
#: Those that the operator returns, which are so paid for anyway.
RETURNED = FIGURES[:5]


@dataclass(frozen=True)
class Rule:
    name: str
    #: The figures that the test asks for, and those that these are made from.
    needs: tuple[str, ...]
    rejects: Callable[[Text], bool]


BASE = (
    Rule("few_words", ("words",), lambda t: t.n_words < 10),
    Rule("repeats", ("words", "n_repeat_words"), lambda t: 100 * t.n_repeat_words > 20 * t.n_words),
)
RULES = (
    Rule("symbols", ("words", "n_symbols"), lambda t: 10 * t.n_symbols > t.n_words),
    Rule("word_length", ("words", "word_chars"), lambda t: t.word_chars < 2 * t.n_words or t.word_chars > 15 * t.n_words),
    Rule("dup_lines", ("lines",), lambda t: 10 * t.n_dup_lines > 3 * t.n_lines),
    Rule("bangs", ("words", "n_bangs"), lambda t: 10 * t.n_bangs > 3 * t.n_words),
    Rule("capitals", ("words", "word_chars", "n_capitals"), lambda t: 10 * t.n_capitals > 6 * t.word_chars),
    Rule("digits", ("words", "word_chars", "n_digits"), lambda t: 10 * t.n_digits > 5 * t.word_chars),
    Rule("one_word", ("words", "n_commonest"), lambda t: 10 * t.n_commonest > 5 * t.n_words),
)


def base_failed(t: Text) -> bool:
    return any(rule.rejects(t) for rule in BASE)


def verdict(t: Text, rules: tuple[Rule, ...]) -> bool:
    """False at the first rule that rejects; the rest are not run."""
    return not any(rule.rejects(t) for rule in rules)


def order_rules(seconds: list[float], patterns: dict[int, int], needs: list[tuple[str, ...]] | None = None, figures: dict[str, float] | None = None, paid: Collection[str] = ()) -> list[int]:
    """Greedy order by rejections per second on the rows still left.

    seconds: of each rule's own test; patterns: how many sampled rows each set
    of rejecting rules (as bits) has; needs: each rule's figures; figures: the
    seconds of each figure; paid: figures that are computed anyway.
    """
    left, order, rest, have = dict(patterns), [], list(range(len(seconds))), set(paid)
    needs, figures = needs or [()] * len(seconds), figures or {}

    def gain(k: int) -> tuple[float, float, int]:
        cost = seconds[k] + sum(figures[f] for f in needs[k] if f not in have)
        return sum(n for bits, n in left.items() if bits >> k & 1) / max(cost, 1e-9), -cost, -k

    while rest:
        best = max(rest, key=gain)
        order.append(best)
        rest.remove(best)
        have.update(needs[best])
        left = {bits: n for bits, n in left.items() if not bits >> best & 1}
    return order


def plan_cascade(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = BASE + RULES, sample_rows: int = 1000, paid: Collection[str] = ()) -> tuple[Rule, ...]:
    """The rules in the order in which they are to run.

    sample_rows bounds the sample, drawn by a hash of the text, on which cost
    and selectivity are measured. Executors measure; the driver gets one row
    per rule, figure and pattern.
    """
    n = docs.count()
    lot = F.pmod(text_hash(text_col), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = docs.where(F.col(text_col).isNotNull() & (lot <= F.lit(min(1.0, 1.2 * sample_rows / max(n, 1)))))
    sample = sample.select(utf8(text_col).alias("t")).limit(sample_rows)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, patterns = [0.0] * (len(FIGURES) + len(rules)), Counter()

        def timed(k: int, f: Callable[[], object]) -> object:
            began = time.perf_counter()
            found = f()
            spent[k] += time.perf_counter() - began
            return found

        for batch in batches:
            for data in batch.column(0).to_pylist():
                t = Text(data)
                for k, figure in enumerate(FIGURES):
                    timed(k, lambda: getattr(t, figure))
                patterns[sum(bool(timed(len(FIGURES) + k, lambda: rule.rejects(t))) << k for k, rule in enumerate(rules))] += 1
        yield pa.RecordBatch.from_pydict(
            {"kind": [0] * len(spent) + [1] * len(patterns), "key": [*range(len(spent)), *patterns], "value": spent + [float(x) for x in patterns.values()]},
            schema=pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("value", pa.float64())]),
        )

    found = sample.mapInArrow(measure, "kind int, key long, value double").groupBy("kind", "key").agg(F.sum("value").alias("value")).collect()
    spent = [0.0] * (len(FIGURES) + len(rules))
    patterns: dict[int, int] = {}
    for r in found:
        if r.kind == 0:
            spent[r.key] = r.value
        else:
            patterns[r.key] = int(r.value)
    order = order_rules(spent[len(FIGURES) :], patterns, [rule.needs for rule in rules], dict(zip(FIGURES, spent)), paid)
    return tuple(rules[k] for k in order)


def with_quality(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = 1000) -> DataFrame:
    """Columns `row` (the input row) and `q` (the figures and the verdict)."""
    ordered = plan_cascade(docs, text_col, BASE + rules, sample_rows, RETURNED)

    def judge(texts: pa.Array) -> pa.Array:
        rows = []
        for data in texts:
            t = Text(data.as_py() or b"")
            rows.append((t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, base_failed(t), verdict(t, ordered)))
        return pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows) if rows else [()] * len(METRICS), METRICS)], fields=list(METRICS))

    judged = F.arrow_udf(judge, METRICS_SQL).asNondeterministic()
    return packed(docs).withColumn("q", judged(utf8(F.col("row")[text_col])))


def filter_quality(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = 1000) -> DataFrame:
    """The rows of docs that no rule rejects, with the columns of docs; no
    figure is computed that the cascade doesn't ask for."""
    ordered = plan_cascade(docs, text_col, BASE + rules, sample_rows)

    def keep(texts: pa.Array) -> pa.Array:
        return pa.array([verdict(Text(data.as_py() or b""), ordered) for data in texts], pa.bool_())

    return unpacked(packed(docs).where(F.arrow_udf(keep, "boolean").asNondeterministic()(utf8(F.col("row")[text_col]))))
