"""Benchmark decontamination by a generalised suffix automaton (operator 8).

Words: A-Z lower-cased, runs of digits, a-z and bytes over 0x7F. A window is
`window` consecutive words of an item; an item of fewer words, but not none,
is one window. The automaton holds every run of words of every item of a
block; streaming a text's words through it gives, at each word, the longest
run that ends there and lies in an item. Where that run reaches `window`
words, all its last words are hit; short items are found on the path of
suffix links.

The items are the query set. They are read in blocks of at most block_words
words, so that what is sent to the tasks is bounded whatever their number.
One block scans all rows as they are. Several are grouped, and the hashes of
a group's windows (group_words at most, 8 bytes each) are sent first: one scan
writes the texts that hold any such hash, no true one is missed, and only
these, usually few, go through the group's automata. Spans and item ids by
text are all that is written then; rows meet them in one join by text.

The scan skips stretches that can't hold a window: a window of m words needs
m - 2 consecutive three-word runs of the items, and a table of their hashes
lets false ones through, never drops a true one.

Defined results: null text or item has no words; repeated items count once
per distinct item id; an item without id counts under the empty id; empty
tables give no hits; other columns pass through untouched.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Points, packed, release, sent_if_small, splitmix, unpacked, utf8, words_of, written

WINDOW = 10
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GATE_BITS = 22


class Automaton:
    """Generalised suffix automaton over the words of a block of items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        texts = []
        for item_id, words in items:
            if words:
                ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words]
                texts.append((item_id, ids))
                last = 0
                for w in ids:
                    last = self._extend(last, w)
        self._mark(texts)
        self._gate([ids for _, ids in texts])

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The state of p's runs with w, cut off from q's longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:  # an earlier item has this run
            return self._split(last, w, q)
        new = self._state(self.length[last] + 1, {}, -1)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        self.link[new] = 0 if p < 0 else self._split(p, w, self.next[p][w])
        return new

    def _mark(self, texts: list[tuple[str, list[int]]]) -> None:
        """Items by the state of their windows; the nearest state up the links
        that holds a whole window or ends a short item."""
        n, size = len(self.link), self.window
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        by_length = sorted(range(1, n), key=self.length.__getitem__)
        self.whole = [-1] * n  # the state of the last `window` words
        for s in by_length:
            if self.length[s] >= size:
                self.whole[s] = s if self.length[self.link[s]] < size else self.whole[self.link[s]]
        for item_id, ids in texts:
            state = 0
            for w in ids:
                state = self.next[state][w]
                if self.whole[state] >= 0:
                    self.items.setdefault(self.whole[state], set()).add(item_id)
            if len(ids) < size:
                self.short.setdefault(state, {}).setdefault(len(ids), set()).add(item_id)
        self.up = [-1] * n  # the nearest state, itself included, that ends a short item
        for s in by_length:
            self.up[s] = s if s in self.short else self.up[self.link[s]]
        self.least = min([min(len(ids), size) for _, ids in texts], default=0)

    def _gate(self, texts: list[list[int]]) -> None:
        self.order = max(1, min(3, self.least))
        self.gate = np.zeros(1 << _GATE_BITS, bool)
        for ids in texts:
            if len(ids) >= self.order:
                self.gate[self._runs(np.array(ids, np.int64))] = True

    def _runs(self, ids: np.ndarray) -> np.ndarray:
        n = len(ids) - self.order + 1
        h = ids[:n].astype(np.uint64)
        for k in range(1, self.order):
            h = splitmix(h) + ids[k : n + k].astype(np.uint64)
        return (splitmix(h) >> np.uint64(64 - _GATE_BITS)).astype(np.int64)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans [a, b) of hit words, and the items with occurring windows."""
        n, order = len(words), self.order
        if not self.least or n < self.least:
            return [], set()
        ids = np.fromiter(map(self.vocab.get, words, repeat(0)), np.int64, n)
        known = ids > 0
        ok = self.gate[self._runs(ids)]
        for k in range(order):
            ok &= known[k : n - order + 1 + k]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], ok.view(np.int8), [0]))))
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        for a, b in zip(edge[::2].tolist(), (edge[1::2] + order - 1).tolist()):
            if b - a >= self.least:
                self._stream(ids[a:b].tolist(), a, spans, found)
        return spans, found

    def _stream(self, ids: list[int], offset: int, spans: list[tuple[int, int]], found: set[str]) -> None:
        follow, link, length, size = self.next, self.link, self.length, self.window
        state = run = 0
        for i, w in enumerate(ids, offset + 1):
            while state and w not in follow[state]:
                state = link[state]
                run = length[state]
            if w in follow[state]:
                state = follow[state][w]
                run += 1
            hit = 0
            if run >= size:
                found |= self.items[self.whole[state]]
                hit = run
            s = self.up[state]
            while s > 0:
                for m, who in self.short[s].items():
                    if m <= run:
                        found |= who
                        hit = max(hit, m)
                s = self.up[link[s]] if link[s] > 0 else -1
            if hit:
                a = i - hit
                while spans and spans[-1][1] >= a:
                    a = min(a, spans.pop()[0])
                spans.append((a, i))


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in blocks of at most block_words words, or one item; one
    partition is on the driver at a time."""
    block, size = [], 0
    for r in items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), utf8(text_col).alias("t")).toLocalIterator():
        words = words_of(None if r.t is None else bytes(r.t))
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((r.i, words))
        size += len(words)
    if block:
        yield block


_FOUND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
_FOUND_SQL = "struct<n_words:long,n_hit:long,spans:array<long>,items:array<string>>"


def _unite(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _pairs(flat: list[int]) -> list[tuple[int, int]]:
    return list(zip(flat[::2], flat[1::2]))


_BUILT: dict[str, Automaton] = {}


def _automaton(name: str, items: list[tuple[str, list[bytes]]], window: int) -> Automaton:
    """Built once in a Python worker, which holds the last one only."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Automaton(items, window)
    return _BUILT[name]


def _scanner(shared: Broadcast, window: int):
    """Text -> its words, hit words, spans and items."""
    name = uuid.uuid4().hex

    def scan(texts: pa.Array) -> pa.Array:
        automaton = _automaton(name, shared.value, window)
        out = []
        for text in texts:
            words = words_of(text.as_py())
            spans, found = automaton.scan(words)
            out.append({"n_words": len(words), "n_hit": sum(b - a for a, b in spans), "spans": [x for s in spans for x in s], "items": sorted(found)})
        return pa.array(out, _FOUND)

    return F.arrow_udf(scan, _FOUND_SQL).asNondeterministic()


def window_hashes(data: bytes, sizes: list[int]) -> np.ndarray:
    """The hashes of all runs of so many words; words are spaced by one blank."""
    chars = Points(np.frombuffer(b" ".join(words_of(data)), np.uint8))
    blank = np.flatnonzero(chars.points == 0x20)
    begin = np.concatenate(([0], blank + 1)) if len(chars.points) else blank
    end = np.append(blank, len(chars.points)) if len(chars.points) else blank
    return np.concatenate([chars.hashes(begin[: len(begin) - n + 1], end[n - 1 :]) for n in sizes if n <= len(begin)] or [np.zeros(0, np.uint64)])


def _gate(block: list[tuple[str, list[bytes]]], window: int) -> dict[int, set[int]]:
    """The hashes of a block's windows, by their number of words."""
    out: dict[int, set[int]] = {}
    for _, words in block:
        if words:
            n = min(window, len(words))
            out.setdefault(n, set()).update(window_hashes(b" ".join(words), [n]).tolist())
    return out


def _holding(shared: Broadcast):
    """Whether a text holds any of the hashes."""

    def hold(texts: pa.Array) -> pa.Array:
        sizes, hashes = shared.value
        out = []
        for text in texts:
            own = window_hashes(text.as_py() or b"", sizes)
            at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            out.append(bool(len(hashes)) and bool((hashes[at] == own).any()))
        return pa.array(out, pa.bool_())

    return F.arrow_udf(hold, "boolean").asNondeterministic()


def _united(texts: pa.Array, found: pa.Array) -> pa.Array:
    """The words of a text, and what the blocks found in it as one."""
    out = []
    for text, each in zip(texts, found):
        parts = each.as_py() or []
        spans = _unite([s for x in parts for s in _pairs(x["spans"])])
        out.append({"n_words": len(words_of(text.as_py())), "n_hit": sum(b - a for a, b in spans), "spans": [x for s in spans for x in s], "items": sorted({i for x in parts for i in x["items"]})})
    return pa.array(out, _FOUND)


def _grouped(blocks: Iterator[list[tuple[str, list[bytes]]]], group_words: int) -> Iterator[list[list[tuple[str, list[bytes]]]]]:
    group, size = [], 0
    for block in blocks:
        n = sum(len(words) for _, words in block)
        if group and size + n > group_words:
            yield group
            group, size = [], 0
        group.append(block)
        size += n
    if group:
        yield group


def _by_text(docs: DataFrame, blocks: Iterator[list[tuple[str, list[bytes]]]], text_col: str, window: int, group_words: int) -> DataFrame:
    """(t1, t2, found) of the texts in which any block found something; texts
    are named by two hashes."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).cast("string").alias("t")).where("t is not null").select("t", *text_names(F.col("t")))
    parts = []
    for group in _grouped(blocks, group_words):
        by_size: dict[int, set[int]] = {}
        for block in group:
            for n, hashes in _gate(block, window).items():
                by_size.setdefault(n, set()).update(hashes)
        table = np.unique(np.fromiter((h for hs in by_size.values() for h in hs), np.uint64))
        hold = _holding(spark.sparkContext.broadcast((sorted(by_size), table)))
        held = texts.where(hold(utf8("t"))).groupBy("t1", "t2").agg(F.first("t").alias("t"))
        held = written(held, "held")
        for block in group:
            found = _scanner(spark.sparkContext.broadcast(block), window)
            hits = held.select("t1", "t2", found(utf8("t")).alias("hit")).where("hit.n_hit > 0")
            parts.append(written(hits.select("t1", "t2", F.struct("hit.spans", "hit.items").alias("hit")), "hits"))
        release(held)
    return written(reduce(DataFrame.unionByName, parts).groupBy("t1", "t2").agg(F.collect_list("hit").alias("found")), "found")  # a row per block at most


def text_names(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def scan_items(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = 100_000, group_words: int = 8_000_000) -> DataFrame:
    """Columns `row` (the input row) and `hit` (n_words, n_hit, flat word
    spans a, b, a, b ... without overlap, item ids)."""
    spark = docs.sparkSession
    blocks = item_blocks(items, item_id, item_text, block_words)
    first = next(blocks, [])  # without items an empty automaton still counts words
    second = next(blocks, None)
    rows = packed(docs)
    text = F.col("row")[text_col]
    if second is None:
        found = _scanner(spark.sparkContext.broadcast(first), window)
        return rows.select("row", found(utf8(text)).alias("hit"))
    by_text = sent_if_small(_by_text(docs, chain((first, second), blocks), text_col, window, group_words), 1000)
    a, b = text_names(text.cast("string"))
    met = rows.select("row", a.alias("a"), b.alias("b")).join(by_text, (F.col("a") == F.col("t1")) & (F.col("b") == F.col("t2")), "left")
    return met.select("row", F.arrow_udf(_united, _FOUND_SQL)(utf8(text), "found").alias("hit"))


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def cut_spans(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """data without the words of the spans and what stands between them."""
    if not spans:
        return data
    at = [m.span() for m in _WORD.finditer(data.translate(LOWER))]
    out, end = [], 0
    for a, b in spans:
        out.append(data[end : at[a][0]])
        end = at[b - 1][1]
    out.append(data[end:])
    return b"".join(out)


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, max_coverage: float = 0.5, block_words: int = 100_000) -> DataFrame:
    """docs without the hit spans; rows of which more than max_coverage of
    the words are hit go. Rows without a hit stay as they are."""
    rows = scan_items(docs, items, text_col, item_id, item_text, window, block_words)

    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, flat in zip(texts, spans):
            out.append(cut_spans(text.as_py(), _pairs(flat.as_py())).decode() if text.is_valid else None)
        return pa.array(out, pa.string())

    rows = rows.withColumn("n_hit", F.col("hit.n_hit")).where(F.col("n_hit") <= max_coverage * F.col("hit.n_words"))
    clean = F.arrow_udf(cut, "string")
    text = F.when(F.col("n_hit") > 0, clean(utf8(F.col("row")[text_col]), F.col("hit.spans"))).otherwise(F.col("row")[text_col])
    rows = rows.withColumn("clean", text)
    return unpacked(rows.select(F.col("row").withField(f"`{text_col}`", F.col("clean")).alias("row")))
