"""Token counts by section from one encoding of the whole text (operator 5).

Each text is encoded once, whole, by a byte-level BPE whose vocabulary file is
a parameter. A token's span is known from the lengths of the tokens before it;
spans are joined to the sections they overlap by a merge of sorted intervals.
Byte offsets are used: sections begin and end at character borders, so bytes
and characters give the same answer, and a token that is part of a character
still has a span.

A token that crosses a border is allotted by a rule:
  - `most` (the default): to the section that holds most of its bytes, the
    earlier one if equal;
  - `first`: to the section that holds its first byte;
  - `share`: to each section by its share of the bytes.
So the sections' counts always add up to the text's tokens.

Sections are the lines of a text, each with its LF, or the spans that the
caller gives (sorted, adjoining; bytes outside all of them belong to the one
before, at the start to the first).

The tokenizer's regular expression keeps a place to go back to for each
character of a run of white space, and fails on runs of about a million. So a
long run is taken out first by the pattern's own rule (all of it, less the
last character if another one follows) and encoded as the one piece that it
is; the tokens are those of the whole text.

Defined results: null or empty text has no tokens and no sections; every
length is encoded whole; repeated rows get equal results; an empty table gives
an empty result; other columns pass through untouched.
"""

from __future__ import annotations

import base64
import re
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import utf8

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: How patterns end of which the rule for white space is known,
#: and the characters of \\s.
BLANK_RULE = r"|\s+(?!\S)|\s+"
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs of white space of this length or more are encoded apart.
LONG_BLANK = 10_000
RULES = ("most", "first", "share")
#: A vocabulary is sent to every task, so its size is checked.
MAX_VOCABULARY_BYTES = 64 << 20

_COUNTS_SQL = "struct<n_tokens:long,n_crossing:long,by_section:array<double>>"
_COUNTS = pa.struct([("n_tokens", pa.int64()), ("n_crossing", pa.int64()), ("by_section", pa.list_(pa.float64()))])


class Encoder:
    def __init__(self, vocabulary: bytes, pattern: str = PATTERN, long_blank: int = LONG_BLANK):
        self.long_blank = re.compile(f"[{BLANKS}]{{{long_blank},}}") if pattern.endswith(BLANK_RULE) else None
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def tokens(self, text: str) -> list[int]:
        if self.long_blank is None:
            return self.encoding.encode_ordinary(text)
        out, at = [], 0
        for run in self.long_blank.finditer(text):
            end = run.end() - (run.end() < len(text))
            out += self.encoding.encode_ordinary(text[at : run.start()])
            out += self.encoding._encode_single_piece(text[run.start() : end])
            at = end
        return out + self.encoding.encode_ordinary(text[at:])

    def ends(self, text: str) -> np.ndarray:
        """The byte offset at which each token of the text ends."""
        return np.cumsum(self.lengths[np.array(self.tokens(text), np.int64)])


def line_ends(data: bytes) -> np.ndarray:
    """The byte offsets at which the lines of a text end, each with its LF."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    return ends if not data or data.endswith(b"\n") else np.append(ends, len(data))


def allot(token_ends: np.ndarray, section_ends: np.ndarray, rule: str = "most") -> tuple[np.ndarray, int]:
    """Tokens per section, and how many tokens cross a border."""
    n = len(section_ends)
    if not len(token_ends) or not n:
        return np.zeros(n), 0
    starts = np.concatenate(([0], token_ends[:-1]))
    first = np.minimum(np.searchsorted(section_ends, starts, "right"), n - 1)
    last = np.minimum(np.searchsorted(section_ends, token_ends - 1, "right"), n - 1)
    inside = first == last
    counts = np.bincount(first[inside], minlength=n).astype(np.float64)
    crossing = np.flatnonzero(~inside)
    for t in crossing.tolist():
        a, b = int(first[t]), int(last[t])
        borders = np.concatenate(([starts[t]], section_ends[a:b], [token_ends[t]]))
        held = np.diff(borders)
        if rule == "share":
            counts[a : b + 1] += held / held.sum()
        else:
            counts[a + (int(np.argmax(held)) if rule == "most" else 0)] += 1
    return counts, len(crossing)


_ENCODERS: dict[str, Encoder] = {}


def with_token_counts(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN, rule: str = "most", section_ends: Column | None = None) -> DataFrame:
    """Columns `row` (the input row) and `count` (n_tokens, n_crossing,
    by_section). section_ends: byte offsets at which a text's sections end,
    as an array of longs; lines if not given."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")
    data = Path(vocabulary).read_bytes()  # on the driver; tasks get the bytes
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary} has {len(data)} bytes; {MAX_VOCABULARY_BYTES} is the most that is sent to tasks")
    shared, name = docs.sparkSession.sparkContext.broadcast(data), uuid.uuid4().hex

    def encoder() -> Encoder:
        if name not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[name] = Encoder(shared.value, pattern)
        return _ENCODERS[name]

    def count(texts: pa.Array, given: pa.Array) -> pa.Array:
        own, out = encoder(), []
        for text, ends in zip(texts, given):
            data = text.as_py() or b""
            borders = np.array(ends.as_py(), np.int64) if ends.is_valid else line_ends(data)
            tokens = own.ends(data.decode()) if data else np.zeros(0, np.int64)
            counts, crossing = allot(tokens, borders, rule)
            out.append((len(tokens), crossing, counts.tolist()))
        return pa.StructArray.from_arrays([pa.array([x[k] for x in out], f.type) for k, f in enumerate(_COUNTS)], fields=list(_COUNTS))

    ends = F.lit(None).cast("array<long>") if section_ends is None else section_ends
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), ends.alias("ends"))
    return rows.select("row", F.arrow_udf(count, _COUNTS_SQL)(utf8(F.col("row")[text_col]), "ends").alias("count"))
