import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratus.llm.packing import BLOCK, CAPACITY, balance, joined_crc, pack, sequences, token_ids
from stratus.llm.packing import pieces as bare_pieces
from stratus.llm.tokencount import Automaton, automaton, pieces, token_counts

DOCS = "doc_id bigint, text string"


def greedy(word: bytes, vocabulary: set) -> int:
    n = at = 0
    longest = max(map(len, vocabulary))
    while at < len(word):
        size = next(k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in vocabulary)
        at, n = at + size, n + 1
    return n


SMALL = [bytes([b]) for b in range(256)] + [b"ab", b"abcd", b"bc", b"bcde", b"cdx", b"dab", b"aaaa", b" a", b" abc"]


@settings(max_examples=300, deadline=None)
@given(st.text("abcdex ", max_size=40))
def test_automaton_against_greedy_search(text):
    assert Automaton(SMALL).count(text.encode()) == greedy(text.encode(), set(SMALL)) if text else True


def test_public_vocabulary_against_greedy_search():
    vocabulary = set(pieces())
    for w in ("unbelievable", "naïveté", "a" * 500, "12345678901234567890", "日本語テキスト", "x"):
        word = b" " + w.encode()
        assert automaton().count(word) == greedy(word, vocabulary)


def test_counts_of_odd_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n\t"), (4, "the the"), (4, "the the"), (None, "the")], DOCS).withColumn("n_tokens", F.lit("clash"))
    got = sorted(((r.doc_id or 0, r.n_words, r.n_tokens) for r in token_counts(df).collect()))
    assert got == [(0, 1, 1), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 2, 2), (4, 2, 2)]
    assert token_counts(spark.createDataFrame([], DOCS)).count() == 0


def test_long_text(spark):
    df = spark.createDataFrame([(1, "word " * 300_000)], DOCS)
    assert token_counts(df).first().n_words == 300_000


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), min_size=1, max_size=700))
def test_joined_checksums(ids):
    a = np.array(ids, dtype="<u4")
    blocks = np.array([zlib.crc32(a[i : i + BLOCK].tobytes()) for i in range(0, len(a), BLOCK)], dtype="<u4")
    assert joined_crc(blocks, len(a)) == zlib.crc32(a.tobytes())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, CAPACITY - 1), min_size=1, max_size=200))
def test_balance_covers_every_token_once_within_capacity(lengths):
    lengths = sorted(lengths, reverse=True)
    parts = balance(lengths)
    used, spans = {}, {}
    for i, first, take, seq in parts:
        used[seq] = used.get(seq, 0) + take
        spans.setdefault(i, []).append((first, take))
    assert max(used.values()) <= CAPACITY
    for i, n in enumerate(lengths):
        at = 0
        for first, take in sorted(spans[i]):
            assert first == at and take > 0 and first % BLOCK == 0
            at += take
        assert at == n
    assert len(used) <= -(-sum(lengths) // CAPACITY) + 1 + len(lengths) // 20


def test_descending_lengths_go_to_the_cheapest_sequence():
    parts = balance([1500, 1400, 600, 500])
    assert [p[3] for p in parts] == [0, 1, 1, 0]


def reference_ids(text):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    reference_ids.coder = getattr(reference_ids, "coder", None) or Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    return [*reference_ids.coder.encode(text or "", add_special_tokens=False).ids, 1]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_agree_with_the_public_tokenizer(text):
    assert token_ids(text).tolist() == reference_ids(text)


def test_special_strings_and_spaces():
    for t in ("a<|endoftext|>b", "  x   y\n\n z", "don't we'll", "   x", None, ""):
        assert token_ids(t).tolist() == reference_ids(t)


@pytest.mark.parametrize("text", [" " * 400_000, "x" + "\n" * 400_000 + "y<|endoftext|>", "ab" * 200_000])
def test_long_runs_agree_with_the_public_tokenizer(text):
    assert token_ids(text).tolist() == reference_ids(text)


def test_the_vocabulary_is_a_parameter(spark, tmp_path):
    import public_tokenizers as public

    copy = tmp_path / "own.tiktoken"
    copy.symlink_to(public.path("byte_bpe_50k.tiktoken"))
    df = spark.createDataFrame([(1, "some words")], DOCS)
    assert pack(df, ranks_path=str(copy)).collect() == pack(df).collect()
    assert token_counts(df, vocabulary=str(copy)).collect() == token_counts(df).collect()


def test_repeated_rows_are_dealt_apart(spark):
    df = spark.createDataFrame([(None, "same text")] * 2000, DOCS)
    groups = [r["count"] for r in bare_pieces(df, 20).groupBy("bin").count().collect()]
    assert sum(groups) == 2000 and len(groups) == 20 and max(groups) < 200


def test_long_repeated_rows_are_dealt_apart(spark):
    """Rows longer than a slice, each in one of its own: their rests go to many groups."""
    df = spark.range(40).select(F.lit(1).cast("bigint").alias("doc_id"), F.repeat(F.lit("word "), F.lit(840_000)).alias("text")).repartition(4)
    rests = bare_pieces(df, 16).where("length < 2048").groupBy("bin").count().collect()
    assert sum(r["count"] for r in rests) == 40 and len(rests) >= 10


def test_full_pieces_are_sequences_of_their_own(spark):
    df = spark.createDataFrame([(i, "lorem ipsum dolor " * 4000) for i in range(6)], DOCS)
    got = pack(df).collect()
    full = [r for r in got if r.length == 2048 and r.sequence_id >= 1 << 62]
    assert len({r.sequence_id for r in full}) == len(full) >= 6 and all(r.offset == 0 for r in full)


def test_packing_round_trip(spark):
    rows = [(i, "lorem ipsum dolor sit amet " * (i * 7 % 90)) for i in range(120)] + [(500, "long text of words " * 3000), (501, None), (502, ""), (503, "same"), (504, "same")]
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in ("length", "start", "bin", "offset")})
    got = pack(df).collect()
    ids = {d: np.array(reference_ids(t), dtype="<u4") for d, t in rows}
    seen, room = {}, {}
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(part.tobytes()) == r.ids_crc32 and len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        seen.setdefault(r.doc_id, []).append((r.start, r.length))
        room.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, a in ids.items():
        at = 0
        for start, n in sorted(seen[d]):
            assert start == at
            at += n
        assert at == len(a)
    for parts in room.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= CAPACITY
    assert sum(map(len, ids.values())) / (len(room) * CAPACITY) > 0.97
    whole = {r.sequence_id: r.ids for r in sequences(df, pack(df)).collect()}
    for r in got:
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == ids[r.doc_id][r.start : r.start + r.length].tolist()


def test_packing_repeats_null_keys_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "c"), (1, "c")], DOCS)
    assert pack(df).count() == 4
    assert pack(spark.createDataFrame([], DOCS)).count() == 0
