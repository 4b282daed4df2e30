"""Token counts: the whole query against bytes attributed one by one, and
texts on which the tokenizer itself gives up."""

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoder():
    from skyplan.llm.token_counts import VOCABULARY, Encoder

    return Encoder(open(VOCABULARY, "rb").read())


def slow_counts(encoding, text):
    """(tokens, crossing tokens, tokens by line): each byte's line is found,
    and a token goes to the line that has most of its bytes."""
    data = text.encode()
    line, at = [], 0
    for b in data:
        line.append(at)
        at += b == 10
    sections = (line[-1] + 1) if line else 0
    counts, crossing, begin = [0] * sections, 0, 0
    tokens = encoding.encode_ordinary(text)
    for t in tokens:
        size = len(encoding.decode_single_token_bytes(t))
        held = [0] * sections
        for x in line[begin : begin + size]:
            held[x] += 1
        crossing += sum(1 for n in held if n) > 1
        counts[held.index(max(held))] += 1
        begin += size
    assert begin == len(data)
    return len(tokens), sections, crossing, counts


def test_query_as_by_bytes(spark, encoder, tmp_path):
    from skyplan.llm.queries import op5_token_counts

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.n_chars < 1500]
    docs += [(10**6, "a\n\n\n  b\n\n"), (10**6 + 1, ""), (10**6 + 2, None), (10**6 + 3, "中文\n\n🙂🙂\n \n"), (10**6 + 3, "中文\n\n🙂🙂\n \n")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in op5_token_counts(spark, str(tmp_path)).collect()), key=repr)
    want = [(i, *slow_counts(encoder.encoding, t or "")) for i, t in docs]
    assert len(want) > 50 and sum(w[3] for w in want) > 0
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("text", ["  x \n", " " * 7, "a" + "\n" * 9 + "b", "　  \t x\x85\x1c\x1c\x1c\x1cy", "it's  \n\n  over" + " " * 12, " " * 5 + "!", "1" + " " * 6 + "2" + "\n" * 6])
def test_long_blanks_as_the_whole(text):
    """A run taken out gives the tokens that the pattern gives."""
    from skyplan.llm.token_counts import VOCABULARY, Encoder

    cut = Encoder(open(VOCABULARY, "rb").read(), long_blank=2)
    assert cut.tokens(text) == cut.encoding.encode_ordinary(text)


def test_documents_with_cut_blanks(spark, encoder):
    from skyplan.llm.token_counts import VOCABULARY, Encoder

    cut = Encoder(open(VOCABULARY, "rb").read(), long_blank=2)
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        for t in (r.text, r.text.replace(" ", "   "), r.text.replace(" ", "\n \t")):
            assert cut.tokens(t) == encoder.encoding.encode_ordinary(t)


def test_a_million_of_one_character(spark):
    from skyplan.llm.token_counts import with_token_counts

    texts = [" " * 1_000_000, "\n" * 1_000_000, "a" * 1_000_000, "x" + "\t" * 1_000_000 + "y", "!" * 1_000_000]
    rows = with_token_counts(spark.createDataFrame(list(enumerate(texts)), "id int, text string")).select("row.id", "count.n_tokens", "count.by_section").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.n_tokens > 0 and sum(r.by_section) == r.n_tokens
        assert len(r.by_section) == (1_000_000 if r.id == 1 else 1)
