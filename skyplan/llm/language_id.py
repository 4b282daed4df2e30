"""Language identification by words first, then shorter and shorter character
n-grams (operator 7).

A word (a run of letters, lower-cased) that the model knows scores each
language by the smoothed log frequency of the word there. An unseen word is
spelled with edge marks; the longest n for which the model knows any of its
n-grams scores it by the mean log frequency of those it knows. A text's score
is the sum over its words, and the answer the best language, ties to the
first by code point.

The model is fitted on a bounded sample of labelled rows: those that a hash of
id, text and label draws, about train_docs different ones; where their
words and n-grams make more than max_entries pairs with a language, half of
the sample goes, and so on. Nothing else is cut: the model holds every
language, word and n-gram of its sample, as sorted hashes with counts, which
are sent to every task. Counts are summed by the cluster. Prediction reads
every whole text; very long ones are scored in pieces cut at white space.

Words and n-grams are looked up by 64-bit hashes, for many texts at once:
prefix sums of a polynomial of the characters give the hash of any run.

Defined results: null text, or text without a letter, gives `und` with score
0, as does every text if no row is labelled; a text of which nothing is known
gives the first language with an even score; rows that repeat are counted and
answered each; other columns pass through untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Points, expand, packed, release, slices, written

UNKNOWN = "und"
LONGEST = 4
#: Characters of one text, and of several, that are looked at together.
PIECE = 1 << 20
_BLANK = re.compile(r"\s")
_BEGIN, _END = 2, 3
_ANSWER_SQL = "struct<lang:string,score:double>"
_ANSWER = pa.struct([("lang", pa.string()), ("score", pa.float64())])
_COUNT = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("name", pa.string()), ("n", pa.int64())])
_COUNT_SQL = "lang string, size int, name string, n long"


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def pieces_of(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > PIECE:
        blank = _BLANK.search(text, start + PIECE)
        if blank is None:
            break
        yield text[start : blank.start()]
        start = blank.start()
    yield text[start:]


class Words:
    """The words of several pieces of text: the piece, first character and
    end of each, in order."""

    def __init__(self, pieces: list[str]):
        lower = [p.lower() for p in pieces]
        self.text = "\n".join(lower)
        self.chars = Points.of(self.text)
        inside = np.zeros(len(self.text) + 2, np.int8)
        inside[1:-1] = _letters()[self.chars.points]
        edge = np.diff(inside)
        self.begin, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        borders = np.cumsum(np.fromiter((len(x) + 1 for x in lower), np.int64, len(lower)))
        self.piece = np.searchsorted(borders, self.begin, "right")
        self.hashes = self.chars.hashes(self.begin, self.end)

    def spelled(self, which: np.ndarray) -> Spelled:
        return Spelled(self.chars.points, self.begin[which], self.end[which])


class Spelled:
    """Words with edge marks, one behind the other."""

    def __init__(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray):
        self.size = end - begin + 2
        self.at = np.cumsum(self.size) - self.size
        word, step = expand(self.size)
        marked = points[np.minimum(begin[word] + np.maximum(step - 1, 0), len(points) - 1)] if len(word) else np.zeros(0, np.uint32)
        marked[step == 0] = _BEGIN
        marked[step == self.size[word] - 1] = _END
        self.chars = Points(marked)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, first character) of each n-gram, in order."""
        word, step = expand(np.maximum(self.size - n + 1, 0))
        return word, self.at[word] + step


def grouped(pieces: Iterator[tuple[int, str]]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Pieces with their owners, some PIECE characters at a time."""
    owners, held, total = [], [], 0
    for owner, piece in pieces:
        owners.append(owner)
        held.append(piece)
        total += len(piece)
        if total >= PIECE:
            yield np.array(owners, np.int64), held
            owners, held, total = [], [], 0
    if held:
        yield np.array(owners, np.int64), held


class Counts(Mapping):
    """Names (words or n-grams) with their counts by language, as arrays in
    the order of the names' hashes."""

    def __init__(self, names: pa.Array, hashes: np.ndarray, starts: np.ndarray, lang: np.ndarray, n: np.ndarray, n_langs: int):
        self.names, self.hashes, self.starts, self.lang, self.n, self.n_langs = names, hashes, starts, lang, n, n_langs

    @classmethod
    def of_rows(cls, names: pa.Array, lang: np.ndarray, n: np.ndarray, n_langs: int) -> Counts:
        """One row for each name and language."""
        names = names.cast(pa.large_string())
        parts = names.to_pylist()
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        end = np.cumsum(size)
        hashes = Points.of("".join(parts)).hashes(end - size, end)
        order = np.lexsort((lang, hashes))
        hashes = hashes[order]
        first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))) if len(hashes) else np.zeros(0, np.int64)
        return cls(names.take(pa.array(order[first])), hashes[first], np.append(first, len(hashes)), lang[order].astype(np.int32), n[order].astype(np.int64), n_langs)

    @classmethod
    def of(cls, counts: Mapping[str, tuple[int, ...]], n_langs: int) -> Counts:
        if isinstance(counts, Counts):
            return counts
        rows = [(name, k, n) for name, by in counts.items() for k, n in enumerate(by) if n]
        return cls.of_rows(pa.array([r[0] for r in rows], pa.string()), np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64), n_langs)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The index of each name, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def __len__(self) -> int:
        return len(self.hashes)

    def __iter__(self) -> Iterator[str]:
        return iter(self.names.to_pylist())

    def __getitem__(self, name: str) -> tuple[int, ...]:
        at = int(self.find(Points.of(name).hashes(np.array([0]), np.array([len(name)])))[0])
        if at < 0:
            raise KeyError(name)
        out = [0] * self.n_langs
        for k in range(self.starts[at], self.starts[at + 1]):
            out[self.lang[k]] = int(self.n[k])
        return tuple(out)


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    #: Per word or n-gram, its counts by language.
    words: Mapping[str, tuple[int, ...]] = field(default_factory=dict)
    grams: Mapping[str, tuple[int, ...]] = field(default_factory=dict)


def _totals(owner: np.ndarray, lang: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of a row of each kind, its lang, its sum) of equal pairs."""
    order = np.lexsort((owner, lang))
    a, b = owner[order], lang[order]
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))) if len(a) else np.zeros(0, np.int64)
    return order[first], b[first], np.add.reduceat(weight[order], first) if len(a) else weight


def count_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, lang) -> (lang, size, name, n): words (size 0), and n-grams by
    their size, counted as often as the words they are in."""
    for batch in slices(batches):
        langs = batch.column(1).to_pylist()
        known = sorted(set(langs))
        index = np.array([known.index(x) for x in langs], np.int64)
        texts = batch.column(0).to_pylist()
        for owners, pieces in grouped((i, p) for i, t in enumerate(texts) for p in pieces_of(t)):
            words = Words(pieces)
            at, lang, n = _totals(words.hashes, index[owners[words.piece]], np.ones(len(words.hashes), np.int64))

            def rows(size: int, text: str, begin: np.ndarray, end: np.ndarray, lang: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
                names = [text[a:b] for a, b in zip(begin.tolist(), end.tolist())]
                return pa.RecordBatch.from_arrays([pa.array([known[k] for k in lang.tolist()], pa.string()), pa.array(np.full(len(n), size), pa.int32()), pa.array(names, pa.string()), pa.array(n)], schema=_COUNT)

            yield rows(0, words.text, words.begin[at], words.end[at], lang, n)
            spelled = words.spelled(at)
            text = spelled.chars.points.tobytes().decode("utf-32-le", "surrogatepass")
            for size in range(1, LONGEST + 1):
                word, begin = spelled.grams(size)
                one, of, total = _totals(spelled.chars.hashes(begin, begin + size), lang[word], n[word])
                yield rows(size, text, begin[one], begin[one] + size, of, total)


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", train_docs: int = 20_000, max_entries: int = 4_000_000) -> Model:
    """labelled: rows to learn from; rows without text or label don't count.
    train_docs and max_entries bound the sample of these rows."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    lot = F.pmod(F.xxhash64("id", "text", "lang"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = min(1.0, train_docs / max(labelled.where(F.col(lang_col).isNotNull()).count(), 1))
    while True:
        sample = rows.where(lot <= F.lit(share)).select("text", "lang")
        counts = written(sample.mapInArrow(count_names, _COUNT_SQL).groupBy("lang", "size", "name").agg(F.sum("n").alias("n")), "names")
        if counts.count() <= max_entries:
            break
        release(counts)
        share /= 2
    flat = counts.toArrow()  # max_entries rows at most, in Arrow's flat form
    langs = sorted(set(flat.column("lang").unique().to_pylist()))
    release(counts)
    column = flat.column("lang").combine_chunks().dictionary_encode() if flat.num_rows else None
    if column is None:
        return Model(())
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    place = np.array([langs.index(x) for x in column.dictionary.to_pylist()], np.int64)
    lang, size, n = place[column.indices.to_numpy()], flat.column("size").to_numpy(), flat.column("n").to_numpy()
    names = flat.column("name").cast(pa.large_string()).combine_chunks()
    names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names

    def table(on: np.ndarray) -> Counts:
        on = np.flatnonzero(on)
        return Counts.of_rows(names.take(pa.array(on)), lang[on], n[on], len(langs))

    return Model(tuple(langs), table(size == 0), table(size > 0))


class Scorer:
    """The model as log frequencies: a name's is that of a name with count 0,
    plus what its own count adds."""

    def __init__(self, model: Model):
        self.langs = model.langs
        k = len(model.langs)
        grams = Counts.of(model.grams, k)
        size = np.fromiter(map(len, grams), np.int64, len(grams))
        self.tables = [Counts.of(model.words, k)] + [self._part(grams, size == n) for n in range(1, LONGEST + 1)]
        for t in self.tables:
            t.names = None
        totals = [np.bincount(t.lang, t.n, k) + 0.5 * len(t) for t in self.tables]
        self.base = np.array([np.log(0.5 / t) if len(own) else np.zeros(k) for t, own in zip(totals, self.tables)]).reshape(LONGEST + 1, k)
        self.more = [np.log(2.0 * t.n + 1) for t in self.tables]

    @staticmethod
    def _part(table: Counts, on: np.ndarray) -> Counts:
        at = np.flatnonzero(on)
        sizes = np.diff(table.starts)[at]
        group, step = expand(sizes)
        rows = table.starts[at][group] + step
        return Counts(None, table.hashes[at], np.append(0, np.cumsum(sizes)), table.lang[rows], table.n[rows], table.n_langs)

    def _entries(self, kind: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which of `at`, lang, what the count adds) for names of a table."""
        t = self.tables[kind]
        begin = t.starts[at]
        which, step = expand(t.starts[at + 1] - begin)
        rows = begin[which] + step
        return which, t.lang[rows], self.more[kind][rows]

    def _scores(self, words: Words, n_pieces: int) -> np.ndarray:
        """The score of each piece in each language."""
        k = len(self.langs)
        _, first, same = np.unique(words.hashes, return_index=True, return_inverse=True)
        own = self.tables[0].find(words.hashes[first])
        kind = np.where(own >= 0, 0, -1)  # the table that answers for a word
        seen = np.flatnonzero(own >= 0)
        which, lang, more = self._entries(0, own[seen])
        parts = [(seen[which], lang, more)]
        left = np.flatnonzero(own < 0)
        spelled = words.spelled(first[left])
        for n in range(LONGEST, 0, -1):
            word, begin = spelled.grams(n)
            open_ = kind[left[word]] < 0
            word, begin = word[open_], begin[open_]
            at = self.tables[n].find(spelled.chars.hashes(begin, begin + n))
            word, at = word[at >= 0], at[at >= 0]
            number = np.bincount(word, minlength=len(left))
            kind[left[number > 0]] = n
            which, lang, more = self._entries(n, at)
            parts.append((left[word[which]], lang, more / number[word[which]]))
        word, lang, more = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(word, kind="stable")
        lang, more = lang[order], more[order]
        sizes = np.bincount(word, minlength=len(first))
        starts = np.cumsum(sizes) - sizes
        which, step = expand(sizes[same])
        rows = starts[same][which] + step
        out = np.bincount(words.piece[which] * k + lang[rows], more[rows], n_pieces * k).reshape(n_pieces, k)
        used = np.bincount(words.piece * (LONGEST + 2) + kind[same] + 1, minlength=n_pieces * (LONGEST + 2)).reshape(n_pieces, LONGEST + 2)
        return out + used[:, 1:] @ self.base

    def answers(self, texts: Iterable[str | None], n_texts: int) -> list[tuple[str, float]]:
        k = len(self.langs)
        total, n_words = np.zeros((n_texts, k)), np.zeros(n_texts, np.int64)
        for owners, pieces in grouped((i, p) for i, t in enumerate(texts) if t for p in pieces_of(t)):
            words = Words(pieces)
            n_words += np.bincount(owners[words.piece], minlength=n_texts)
            if k and len(words.hashes):
                np.add.at(total, owners, self._scores(words, len(pieces)))
        if not k:
            return [(UNKNOWN, 0.0)] * n_texts
        best = np.argmax(total, axis=1)
        score = np.minimum(1.0, 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1))
        return [(self.langs[b], s) if n else (UNKNOWN, 0.0) for b, s, n in zip(best.tolist(), score.tolist(), n_words.tolist())]

    def answer(self, text: str | None) -> tuple[str, float]:
        return self.answers([text], 1)[0]


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Columns `row` (the input row) and `answer` (lang, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(Scorer(model))

    def judge(texts: pa.Array) -> pa.Array:
        found = shared.value.answers((x.as_py() for x in texts), len(texts))
        return pa.StructArray.from_arrays([pa.array([x[k] for x in found], f.type) for k, f in enumerate(_ANSWER)], fields=list(_ANSWER))

    rows = packed(docs)
    return rows.select("row", F.arrow_udf(judge, _ANSWER_SQL).asNondeterministic()(F.col("row")[text_col]).alias("answer"))


def held_out(id_col: Column | str = "doc_id") -> Column:
    """crc32 of the id as text leaves 1 when divided by 3; false for null."""
    return F.coalesce(F.pmod(F.crc32((F.col(id_col) if isinstance(id_col, str) else id_col).cast("string")), F.lit(3)) == 1, F.lit(False))
