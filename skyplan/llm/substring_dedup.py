"""Exact substring dedup: a byte goes if a string of `length` bytes that
covers it also starts earlier in the corpus (operator 4).

Suffix sorting by the difference cover modulo 3 (dc3.py), distributed by
content: every removal is read off a suffix array, as an equal neighbour in
the first 100 bytes. A suffix array of every byte of the corpus would sort it
several times over, so the sort is confined to suffixes that can match, and
these are dealt to blocks so that equal strings meet:

1. Names. Each string of 100 bytes is named by the least hash of the 32-byte
   strings in it, which has a place in it (the rightmost): equal strings have
   equal names and places. Neighbouring starts of one name are a run.
2. Names that occur at one place can't match. A Bloom table of those that
   occur again, sized by their number, drops them; a false hit costs work, not
   correctness. Where the table would be larger than MAX_BLOOM_BITS, places
   are joined with the repeated names instead.
3. Sorting. A row is a stretch of starts with the bytes that their strings
   cover; rows of one name are a class. Classes are packed into blocks of at
   most 2^20 bytes, and a block's suffixes are sorted by DC3: sampled triples,
   recursion on their names, merge of the rest. Of equal neighbours all but
   the earliest start are removed, and the rows shrink to the starts left. A
   class that is larger than a block is sorted a block at a time, with what
   is left carried on to the next. Tasks so sort the classes of which they have
   MANY rows before each exchange too: of a string with many copies, few
   leave a task.
4. Rounds. First, long stretches: rows of about eight places, cut and named
   by content. That settles most copies, with little overlap of rows. What is
   left is cut into the runs of single names, in which all strings that are
   equal do meet. A class of which too much is left to carry on (many
   different strings around one common name) is cut into parts of PART starts
   by the distance to the name's place, named by the bytes that all their
   strings share, and at last by all of its bytes. A class of more than half
   a block is first dealt to several tasks, so that no task takes all rows of
   a common name, and what is left of it goes on like this: it shrinks in
   every round, until one task settles it.

Order is by id, nulls last, then text hash, then start; rows that repeat id
and text are one document in this order and get equal results. Null or empty
text has no bytes; texts shorter than `length` lose nothing; cut text need not
be valid UTF-8 and is handled as bytes; an empty table gives an empty result.
Very long texts are scanned in overlapping pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import expand, packed, release, sent_if_small, slices, splitmix, text_hash, utf8, written
from .dc3 import suffix_array

LENGTH, GRAM = 100, 32
#: Bytes of text hashed at a time, and bits for a place in them.
PIECE, PLACE_BITS = 1 << 20, 22
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

#: Bytes that are sorted together, about; a quarter more at most.
BLOCK = 400_000
#: A long stretch ends before a name whose last bits are 0, one in eight, and
#: at so many starts.
STRETCH_BITS, MAX_STRETCH = 3, 2048
#: Starts in a run at most (but for the last place's), and in a part.
MAX_RUN, PART = 400, 8
#: Rows of a class, in a task, from which on they are sorted there first.
MANY = 8
#: A row of starts with the bytes of their strings; without these it is a cut:
#: starts that go. `again`: whether the row may hold equal strings itself.
_ROW = ["no_id", "id", "th", "name", "lo", "size", "again", "ctx", "over"]
ROW_SQL = "no_id boolean, id {id}, th long, name long, lo long, size int, again boolean, ctx binary, over boolean"


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes that start at each place, as one number."""
    n = len(data) - 7
    out = np.empty(n, np.uint64)
    for k in range(min(8, n)):
        part = data[k : k + (n - k + 7) // 8 * 8].view("<u8")
        out[k::8] = part
    return out


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def places_of(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts that have a name from one place: the name, the first start, the
    number of starts, and the distance from the first start to the place."""
    if len(data) < length:
        empty = np.empty(0, np.int64)
        return empty.view(np.uint64), empty, empty, empty
    w = _words(data)
    m = len(data) - gram + 1
    h = w[:m] * _P1
    for k in range(8, gram - 7, 8):
        h ^= h >> np.uint64(31)
        h += w[k : k + m]
        h *= _P2 if k & 8 else _P1
    h ^= h >> np.uint64(29)
    h *= _P2
    h ^= h >> np.uint64(32)
    # the rightmost place of the least hash, by its high bits
    place = np.uint64((1 << PLACE_BITS) - 1)
    least = _sliding_least((h & ~place) | (place - np.arange(m, dtype=np.uint64)), length - gram + 1)
    first = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    size = np.diff(np.concatenate((first, [len(least)])))
    at = (place - (least[first] & place)).astype(np.int64)
    return h[at], first, size, at - first


def pieces(texts: list[bytes | None], length: int = LENGTH) -> Iterator[tuple[int, int, np.ndarray]]:
    """(index of the text, offset, bytes): long texts in pieces that overlap
    by length - 1 bytes."""
    for i, data in enumerate(texts):
        whole = np.frombuffer(data or b"", np.uint8)
        for offset in range(0, max(1, len(whole) - length + 1), PIECE):
            yield i, offset, whole[offset : offset + PIECE + length - 1]


def _joined(texts: list[bytes | None], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Places over several short texts at once: (name, index of the text,
    start in it, number of starts, bytes, start in the bytes), in order."""
    held: list[tuple[int, int, np.ndarray]] = []
    total = 0

    def found() -> tuple[np.ndarray, ...]:
        data = np.concatenate([x for _, _, x in held])
        ends = np.cumsum([len(x) for _, _, x in held])
        begins = ends - [len(x) for _, _, x in held]
        name, first, size, _ = places_of(data, length)
        # cut at the borders of texts, and drop starts too near to an end
        owner, last = np.searchsorted(ends, first, "right"), np.searchsorted(ends, first + size - 1, "right")
        row, step = expand(last - owner + 1)
        owner = owner[row] + step
        start = np.maximum(first[row], begins[owner])
        size = np.minimum((first + size)[row], ends[owner] - length + 1) - start
        good = size > 0
        name, start, size, owner = name[row][good], start[good], size[good], owner[good]
        index = np.array([i for i, _, _ in held], np.int64)[owner]
        offset = np.array([o for _, o, _ in held], np.int64)[owner]
        return name, index, offset + start - begins[owner], size, data, start

    for i, offset, data in pieces(texts, length):
        if len(data) < length:
            continue
        held.append((i, offset, data))
        total += len(data)
        if total >= PIECE:
            yield found()
            held, total = [], 0
    if held:
        yield found()


def _hash_strings(data: np.ndarray, first: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each string data[first : first + size]: sums of mixed
    words, each with its place, over whole words and an overlapping last."""
    w = _words(data)
    out = splitmix(size.astype(np.uint64) + np.uint64(seed))
    for k in range(0, int(size.max()), 8):
        on = np.flatnonzero(size > k) if k else np.arange(len(size))
        at = np.minimum(first[on] + k, first[on] + size[on] - 8)
        out[on] = splitmix(out[on] ^ (w[at] * _P1))
    return out


def _stretches(name: np.ndarray, index: np.ndarray, start: np.ndarray, size: np.ndarray, new: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adjoining places of one text as rows, with a new row wherever `new` is
    set and at `most` starts: the first place, number of starts, and whether a
    name occurs twice."""
    n = len(name)
    if not n:
        return np.zeros(0, np.int64), size, np.zeros(0, bool)
    new = new.copy()
    new[0] = True
    new[1:] |= (index[1:] != index[:-1]) | (start[1:] != start[:-1] + size[:-1])
    group = np.cumsum(new) - 1
    part = (start - start[new][group]) // most
    new[1:] |= part[1:] != part[:-1]
    group, first = np.cumsum(new) - 1, np.flatnonzero(new)
    order = np.lexsort((name, group))
    twice = (name[order][1:] == name[order][:-1]) & (group[order][1:] == group[order][:-1])
    again = np.zeros(len(first), bool)
    again[group[order][1:][twice]] = True
    return first, np.add.reduceat(size, first), again


def _rows(keys: list[pa.Array], name: np.ndarray, lo: np.ndarray, size: np.ndarray, again: np.ndarray, ctx: list[bytes | None], over: np.ndarray | None = None) -> pa.RecordBatch:
    over = np.zeros(len(lo), bool) if over is None else over
    arrays = [*keys, pa.array(name.view(np.int64)), pa.array(lo.astype(np.int64)), pa.array(size.astype(np.int32)), pa.array(again), pa.array(ctx, pa.binary()), pa.array(over)]
    return pa.RecordBatch.from_arrays(arrays, names=_ROW)


def _joined_rows(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.concat_batches(batches) if len(batches) > 1 else batches[0]


def _bytes_of(rows: pa.RecordBatch) -> int:
    return pc.sum(pc.binary_length(rows.column("ctx"))).as_py() or 0


def _start_earlier(text: np.ndarray, valid: np.ndarray, length: int) -> np.ndarray:
    """text: segments in corpus order; valid: the starts that count, each
    with `length` bytes of its segment. Returns those that start earlier too."""
    order = suffix_array(text.astype(np.int64) + 1)
    mark = np.zeros(len(text), bool)
    mark[valid] = True
    order = order[mark[order]]
    w = _words(text)
    same = np.ones(len(order) - 1, bool)
    for k in [*range(0, length - 7, 8), length - 8]:
        x = w[k:].take(order)
        same &= x[1:] == x[:-1]
    group = np.concatenate(([0], np.cumsum(~same)))
    least = np.full(int(group[-1]) + 1, len(text))
    np.minimum.at(least, group, order)
    return np.sort(order[order != least[group]])


def _runs_of(mask: np.ndarray, row: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first step, number) of the longest stretches of marked starts."""
    at = np.flatnonzero(mask)
    if not len(at):
        return at, at, at
    r, s = row[at], step[at]
    first = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (s[1:] != s[:-1] + 1))))
    return r[first], s[first], np.diff(np.append(first, len(at)))


def settle(rows: pa.RecordBatch, length: int) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """One suffix array of the rows that aren't alone in their class: the cuts,
    and the rows of the starts that are left."""
    rows = rows.take(pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in ("no_id", "id", "th", "lo")]))
    _, same, number = np.unique(rows.column("name").to_numpy(), return_inverse=True, return_counts=True)
    need = (number[same] > 1) | rows.column("again").to_numpy(zero_copy_only=False)
    if not need.any():
        return rows.slice(0, 0), rows
    alone, rows = rows.filter(pa.array(~need)), rows.filter(pa.array(need))
    name, lo, size = rows.column("name").to_numpy(), rows.column("lo").to_numpy(), rows.column("size").to_numpy().astype(np.int64)
    raw = b"".join(rows.column("ctx").to_pylist())
    begin = np.cumsum(size + length - 1) - (size + length - 1)  # no start reaches another row
    row, step = expand(size)
    single = _one_each(rows, lo, size, row, step)
    at = begin[row] + step
    gone = np.zeros(len(raw), bool)
    gone[_start_earlier(np.frombuffer(raw, np.uint8), at[single], length)] = True
    gone = gone[at] & single

    def part(mask: np.ndarray, with_bytes: bool) -> pa.RecordBatch:
        r, s, n = _runs_of(mask, row, step)
        first = begin[r] + s
        ctx = [raw[a:b] for a, b in zip(first.tolist(), (first + n + length - 1).tolist())] if with_bytes else [None] * len(r)
        take = pa.array(r)
        again, over = (rows.column(c).to_numpy(zero_copy_only=False)[r] for c in ("again", "over"))
        return _rows([rows.column(c).take(take) for c in _ROW[:3]], name[r], lo[r] + s, n, again, ctx, over)

    return part(gone, False), _joined_rows([alone, part(single & ~gone, True)])


def _one_each(rows: pa.RecordBatch, lo: np.ndarray, size: np.ndarray, row: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Marks one of the starts that are the same: documents that repeat id and
    text are one."""
    keys = [pc.dictionary_encode(rows.column(c), null_encoding="encode").indices.to_numpy() for c in ("id", "th")]
    same = (keys[0][1:] == keys[0][:-1]) & (keys[1][1:] == keys[1][:-1])
    if not (same & (lo[1:] < lo[:-1] + size[:-1])).any():
        return np.ones(len(row), bool)
    doc = np.concatenate(([0], np.cumsum(~same)))
    _, first = np.unique((doc[row] << 40) + lo[row] + step, return_index=True)
    out = np.zeros(len(row), bool)
    out[first] = True
    return out


def _portions(rows: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Cut by the bytes of the rows: at most so many, or one row."""
    rows = pa.RecordBatch.from_arrays(rows.columns, names=_ROW)  # what may be null is the same everywhere
    ends, start = np.cumsum(pc.binary_length(rows.column("ctx")).to_numpy().astype(np.int64)), 0
    while start < rows.num_rows:
        end = max(start + 1, int(np.searchsorted(ends, most + (ends[start - 1] if start else 0), "right")))
        yield rows.slice(start, end - start)
        start = end


def resolve(batches: Iterator[pa.RecordBatch], length: int, block: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, pa.RecordBatch, bool]]:
    """Over rows sorted by name: (cuts, rows left, whether of a class of which
    too much is left). Holds about a block, and of a larger class what is left
    of it, half a block at most."""
    held: list[pa.RecordBatch] = []
    used, crowded = 0, None
    for batch in batches:
        for rows in _portions(batch, block // 4):
            if crowded is not None:
                n = int((rows.column("name").to_numpy() == crowded).sum())  # they come first
                if n:
                    yield rows.slice(0, 0), rows.slice(0, n), True
                rows = rows.slice(n)
                if not rows.num_rows:
                    continue
                crowded = None
            held.append(rows)
            used += _bytes_of(rows)
            if used < block:
                continue
            rows = _joined_rows(held)
            name = rows.column("name").to_numpy()
            first = int(np.argmax(name == name[-1]))  # of the class that may go on
            if first:
                yield *settle(rows.slice(0, first), length), False
                rows = rows.slice(first)
            used = _bytes_of(rows)
            if used >= block:
                cuts, rows = settle(rows, length)
                used = _bytes_of(rows)
                if used > block // 2:
                    crowded = name[-1]
                    yield cuts, rows, True
                    held, used = [], 0
                    continue
                yield cuts, rows.slice(0, 0), False
            held = [rows]
    if held:
        yield *settle(_joined_rows(held), length), False


def by_name(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _joined_rows(batches)
    return iter([rows.take(pc.sort_indices(rows.column("name")))])


def _sorted_here(batches: list[pa.RecordBatch], length: int, block: int) -> Iterator[pa.RecordBatch]:
    """Rows of one task: classes with MANY of them are sorted before they
    leave it. Cuts, and rows left."""
    if batches:
        rows = _joined_rows(batches)
        _, same, number = np.unique(rows.column("name").to_numpy(), return_inverse=True, return_counts=True)
        many = number[same] >= MANY
        yield from _full(rows.filter(pa.array(~many)))
        if many.any():
            for cuts, left, _ in resolve(by_name([rows.filter(pa.array(many))]), length, block):
                yield from _full(cuts, left)


def _full(*batches: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (b for b in batches if b.num_rows)


def _emit_names(length: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for name, *_ in _joined(batch.column(0).to_pylist(), length):
                yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64))], names=["name"])

    return emit


#: log2 of the Bloom table's parts; bits for each name, and at most in all.
BLOOM_PARTS, BITS_A_NAME, MAX_BLOOM_BITS = 6, 16, 1 << 29


def _slots(names: np.ndarray, bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The part of each name (a least hash is even in its low bits only), and
    the bits in it that it sets; bits: log2 of the table's."""
    h = splitmix(names)
    mask = np.uint64((1 << (bits - BLOOM_PARTS)) - 1)
    return (names & np.uint64((1 << BLOOM_PARTS) - 1)).astype(np.int64), [((h >> np.uint64(s)) & mask).astype(np.int64) for s in (0, 18, 36)]


def _bloom_part(bits: int):
    """Over names sorted by part: a table for each part, one at a time."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, table = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([np.packbits(table).tobytes()], pa.binary())], names=["part", "bits"])

        for batch in batches:
            part, slots = _slots(batch.column(0).to_numpy().view(np.uint64), bits)
            for p in np.unique(part).tolist():
                if p != current:
                    if current is not None:
                        yield row()
                    current, table = p, np.zeros(1 << (bits - BLOOM_PARTS), bool)
                for s in slots:
                    table[s[part == p]] = True
        if current is not None:
            yield row()

    return make


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables: dict[int, np.ndarray] = {}
    for batch in batches:
        for p, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = np.frombuffer(bits, np.uint8)
            tables[p] = own | tables[p] if p in tables else own
    for p, table in tables.items():
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([table.tobytes()], pa.binary())], names=["part", "bits"])


def bloom_table(again: DataFrame, bits: int) -> np.ndarray:
    """The table of 2^bits bits of names; each of its parts is made by several
    tasks, whose tables are united before they reach the driver."""
    part = F.col("name").bitwiseAND(F.lit((1 << BLOOM_PARTS) - 1))
    some = again.repartition(part, F.xxhash64("name") % 1024).sortWithinPartitions(part).mapInArrow(_bloom_part(bits), "part int, bits binary")
    table = np.zeros((1 << BLOOM_PARTS, 1 << (bits - BLOOM_PARTS - 3)), np.uint8)
    for r in some.repartition("part").mapInArrow(_united, "part int, bits binary").collect():  # the table, of bounded size
        table[r.part] |= np.frombuffer(r.bits, np.uint8)
    return table


def _in_table(shared, bits: int) -> Callable:
    """Whether names are in the Bloom table."""

    def marks(name: np.ndarray, index: np.ndarray, start: np.ndarray, given: pa.Array | None) -> np.ndarray:
        part, slots = _slots(name, bits)
        on = np.ones(len(name), bool)
        for s in slots:
            on &= (shared.value[part, s >> 3] >> (7 - (s & 7)).astype(np.uint8)) & 1 == 1
        return on

    return marks


def _in_list(name: np.ndarray, index: np.ndarray, start: np.ndarray, given: pa.Array) -> np.ndarray:
    """Whether places are in the lists that came with the texts."""
    flat, lists = given.flatten().to_numpy(), pc.list_parent_indices(given).to_numpy()
    return np.isin((index << 40) + start, (lists.astype(np.int64) << 40) + flat)


def _emit_places(length: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for name, index, start, *_ in _joined(batch.column(3).to_pylist(), length):
                take = pa.array(index)
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(take) for k in range(3)), pa.array(name.view(np.int64)), pa.array(start)], names=[*_ROW[:4], "lo"])

    return emit


def _emit_stretches(marks: Callable, length: int, block: int):
    """Texts -> long stretches of places that may match."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            given = batch.column(4) if batch.num_columns > 4 else None
            for name, index, start, size, data, first in _joined(batch.column(3).to_pylist(), length):
                on = np.flatnonzero(marks(name, index, start, given))
                name, index, start, size, first = name[on], index[on], start[on], size[on], first[on]
                head, n, again = _stretches(name, index, start, size, name & np.uint64((1 << STRETCH_BITS) - 1) == 0, MAX_STRETCH)
                begin, raw = first[head], data.tobytes()
                ctx = [raw[a:b] for a, b in zip(begin.tolist(), (begin + n + length - 1).tolist())]
                take = pa.array(index[head])
                out.append(_rows([batch.column(k).take(take) for k in range(3)], name[head], start[head], n, again, ctx))
            yield from _sorted_here(out, length, block)

    return emit


def _as_runs(rows: pa.RecordBatch, length: int) -> Iterator[pa.RecordBatch]:
    """Rows as the runs of single names."""
    for name, index, start, size, data, first in _joined(rows.column("ctx").to_pylist(), length):
        new = np.concatenate(([True], name[1:] != name[:-1]))
        head, n, again = _stretches(name, index, start, size, new, MAX_RUN)
        begin, raw = first[head], data.tobytes()
        ctx = [raw[a:b] for a, b in zip(begin.tolist(), (begin + n + length - 1).tolist())]
        take = pa.array(index[head])
        yield _rows([rows.column(c).take(take) for c in _ROW[:3]], name[head], rows.column("lo").to_numpy()[index[head]] + start[head], n, again, ctx)


def _settle_stretches(length: int, block: int):
    """Long stretches sorted by name -> cuts, and runs of what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, used = [], 0
        for cuts, rows, _ in resolve(batches, length, block):
            yield from _full(cuts)
            left += _as_runs(rows, length)
            used += _bytes_of(rows)
            if used > 4 * block:
                yield from _sorted_here(left, length, block)
                left, used = [], 0
        yield from _sorted_here(left, length, block)

    return run


def _settle_runs(length: int, block: int):
    """Runs or parts sorted by name -> cuts, and what is left of classes that
    are not settled: dealt to several tasks, or too much for one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cuts, rows, crowded in resolve(batches, length, block):
            yield from _full(cuts)
            if crowded:
                yield from _full(rows.set_column(8, "over", pa.array(np.ones(rows.num_rows, bool))))
            else:
                yield from _full(rows.filter(rows.column("over")))

    return run


def _emit_parts(length: int, part: int, block: int):
    """Rows as parts of at most `part` starts: starts whose distance to the
    name's place is the same but for the remainder by `part`, named by that
    distance and the bytes that all strings of such distances share."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 20):
            out = []
            for _, index, start, size, data, first in _joined(batch.column("ctx").to_pylist(), length):
                # the distances of a whole place; those that a border cut are found by its own strings again
                gap = _distances(data, first, length)
                n = (gap // part) - ((gap - size + 1) // part) + 1
                row, step = expand(n)
                band = gap[row] // part - step
                a = np.maximum(gap[row] - (band * part + part - 1), 0)  # first and last start of the part in its place
                b = np.minimum(gap[row] - band * part, size[row] - 1)
                begin, count = first[row] + a, b - a + 1
                core = first[row] + gap[row] - band * part
                shared = _hash_strings(data, core, np.full(len(core), length - part + 1), 3) ^ splitmix(band.astype(np.uint64))
                raw = data.tobytes()
                ctx = [raw[x:y] for x, y in zip(begin.tolist(), (begin + count + length - 1).tolist())]
                take = pa.array(index[row])
                lo = batch.column("lo").to_numpy()[index[row]] + start[row] + a
                out.append(_rows([batch.column(c).take(take) for c in _ROW[:3]], shared, lo, count, np.zeros(len(lo), bool), ctx))
            yield from _sorted_here(out, length, block)

    return emit


def _distances(data: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """The distance from each of the given starts to its name's place."""
    _, begin, _, gap = places_of(data, length)
    row = np.searchsorted(begin, first, "right") - 1
    return gap[row] + begin[row] - first


def _marked(keyed: DataFrame, length: int, max_bloom_bits: int) -> tuple[DataFrame, Callable]:
    """The texts, and what tells the places that may match."""
    spark = keyed.sparkSession
    names = keyed.select("t").mapInArrow(_emit_names(length), "name long")
    again = written(names.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"), "names")
    bits = max(20, (BITS_A_NAME * again.count() - 1).bit_length())
    if 1 << bits <= max_bloom_bits:
        return keyed, _in_table(spark.sparkContext.broadcast(bloom_table(again, bits)), bits)
    id_sql = keyed.schema["id"].dataType.simpleString()
    places = keyed.mapInArrow(_emit_places(length), f"no_id boolean, id {id_sql}, th long, name long, lo long")
    lists = places.join(again, "name", "left_semi").groupBy("id", "th").agg(F.collect_set("lo").alias("places"))  # of one document
    lists = written(lists.withColumnsRenamed({"id": "own", "th": "own_hash"}), "places")
    met = keyed.join(lists, F.col("id").eqNullSafe(F.col("own")) & (F.col("th") == F.col("own_hash")))
    return met.select("no_id", "id", "th", "t", "places"), _in_list


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, block: int = BLOCK, max_bloom_bits: int = MAX_BLOOM_BITS) -> DataFrame:
    """(id, th, a, b): byte intervals to remove, which may overlap."""
    row_sql = ROW_SQL.format(id=docs.schema[id_col].dataType.simpleString())
    keyed = docs.select(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), text_hash(text_col).alias("th"), utf8(text_col).alias("t"))
    texts, marks = _marked(keyed, length, max_bloom_bits)
    cuts: list[DataFrame] = []

    def noted(made: DataFrame, what: str) -> DataFrame:
        """A round's result, written; its cuts are put aside."""
        table = written(made, what)
        gone = table.where("ctx is null").select("id", "th", F.col("lo").alias("a"), (F.col("lo") + F.col("size") + (length - 1)).alias("b"))
        cuts.append(written(gone, "cuts"))
        return table

    def sorted_by(rows: DataFrame, task: Callable, what: str) -> DataFrame:
        """Rows sorted by class; a large class is dealt to several tasks, which
        leave of each of its strings one at most, marked `over`."""
        size = F.sum(F.octet_length("ctx"))
        large = written(rows.groupBy("name").agg(size.alias("bytes")).where(F.col("bytes") > block // 2).select("name", F.ceil(F.col("bytes") / (block // 8)).alias("pieces")), "large")
        if large.isEmpty():
            dealt = rows.withColumn("over", F.lit(False)).repartition("name")
        else:
            met = rows.join(sent_if_small(large), "name", "left")
            lot = F.pmod(F.xxhash64("id", "th", "lo"), F.coalesce("pieces", F.lit(1)))
            dealt = met.withColumn("over", F.col("pieces").isNotNull()).repartition("name", lot).select(*_ROW)
        return noted(dealt.sortWithinPartitions("name").mapInArrow(task, row_sql), what)

    rows = noted(texts.mapInArrow(_emit_stretches(marks, length, block), row_sql), "stretches")
    runs = sorted_by(rows.where("ctx is not null"), _settle_stretches(length, block), "runs")
    release(rows)
    left = sorted_by(runs.where("ctx is not null"), _settle_runs(length, block), "left")
    release(runs)
    names = iter((PART, 1))
    while not (over := left.where("ctx is not null")).isEmpty():
        part = next(names, None)
        rows = over if part is None else noted(over.mapInArrow(_emit_parts(length, part, block), row_sql), "parts").where("ctx is not null")
        before, left = left, sorted_by(rows, _settle_runs(length, block), "left")
        release(before)
    release(left)
    return reduce(DataFrame.unionByName, cuts)


def unite(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_CUT_SQL = "struct<n_bytes:long,n_removed:long,n_spans:long,kept_sha256:string,spans:array<long>>"
_CUT = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.int64()))])


def _cut(texts: pa.Array, cuts: pa.Array) -> pa.Array:
    out = []
    for text, given in zip(texts, cuts):
        data = text.as_py() or b""
        flat = given.as_py() or []
        spans = unite([(x["a"], x["b"]) for x in flat])
        digest, end = hashlib.sha256(), 0
        for a, b in spans:
            digest.update(data[end:a])
            end = b
        digest.update(data[end:])
        out.append({"n_bytes": len(data), "n_removed": sum(b - a for a, b in spans), "n_spans": len(spans), "kept_sha256": digest.hexdigest(), "spans": [x for s in spans for x in s]})
    return pa.array(out, _CUT)


def with_cuts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, block: int = BLOCK, max_bloom_bits: int = MAX_BLOOM_BITS) -> DataFrame:
    """Columns `row` (the input row) and `cut` (n_bytes, n_removed, n_spans,
    kept_sha256, and the maximal removed spans a, b, a, b ... in bytes)."""
    cuts = repeats(docs, id_col, text_col, length, block, max_bloom_bits).groupBy("id", "th").agg(F.collect_set(F.struct("a", "b")).alias("cuts"))
    rows = packed(docs).select("row", F.col("row")[id_col].alias("key"), text_hash(F.col("row")[text_col]).alias("key_hash"))
    met = rows.join(cuts, F.col("key").eqNullSafe(F.col("id")) & (F.col("key_hash") == F.col("th")), "left")
    return met.select("row", F.arrow_udf(_cut, _CUT_SQL)(utf8(F.col("row")[text_col]), "cuts").alias("cut"))
