from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from rollcall.llm import bpe, token_counts

from .helpers import awkward, docs

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")


def odd_text(seed: int, size: int) -> str:
    """White space of all kinds, contractions, combining marks, special strings and long runs."""
    pieces = ["a", "Be", "don't", "'s", "'ll", "!!", " ", "  ", "\n", "\t ", " ", " ", "é", "é", "≮", "12", "x1",
              "\x1c", "漢字", "🙂", "<|endoftext|>", "<|start", "'", "('s", "W" * 40, "K", "ß", "Σς", ".", ",a"]
    chosen = random.Random(seed)
    return "".join(chosen.choice(pieces) for _ in range(size))


ROWS = [*awkward(), *((100 + i, odd_text(i, 60 + 20 * i)) for i in range(12)), (200, "y" * 700), (201, " " * 700), (202, "ab " * 300)]


@pytest.fixture(scope="module")
def library():
    return bpe.encoding(RANKS, PATTERN), Tokenizer.from_file(WORDS)


@pytest.mark.parametrize(("chunk", "overlap"), [(32_768, 256), (97, 24), (50, 6)])
def test_ids_and_round_trip(spark, library, chunk, overlap):
    given = docs(spark, ROWS)
    found = bpe.digests(given, RANKS, PATTERN, chunk_chars=chunk, overlap=overlap).collect()

    def expected(doc_id, text):
        ids = library[0].encode_ordinary(text or "")
        return (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest())

    assert sorted(map(repr, map(tuple, found))) == sorted(repr(expected(*r)) for r in ROWS)


def test_pieces_are_real_ids(spark, library):
    given = docs(spark, ROWS)
    encoded = bpe.encode(given, RANKS, PATTERN, chunk_chars=97, overlap=24)
    by_row = {}
    for r in sorted(bpe.decode(encoded, RANKS, PATTERN).collect(), key=lambda r: (r.row, r.part)):
        assert library[0].decode_bytes(np.frombuffer(r.ids, "<u4").tolist()) == bytes(r.bytes)
        by_row[r.row] = by_row.get(r.row, b"") + bytes(r.bytes)
    assert sorted(by_row.values()) == sorted((t or "").encode() for _, t in ROWS)


@pytest.mark.parametrize(("chunk", "overlap"), [(65_536, 512), (120, 40), (60, 8)])
def test_counts(spark, library, chunk, overlap):
    found = token_counts.count(docs(spark, ROWS), WORDS, chunk_chars=chunk, overlap=overlap).collect()
    expected = [(i, len((t or "").encode()), len(library[1].encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_empty_tables(spark):
    empty = docs(spark, [])
    assert bpe.digests(empty, RANKS, PATTERN).collect() == []
    assert token_counts.count(empty, WORDS).collect() == []


def test_boundaries_do_not_depend_on_what_follows():
    import regex

    compiled = regex.compile(PATTERN)
    for seed in range(40):
        text = odd_text(seed, 50)
        whole = {m.start() for m in compiled.finditer(text)} | {len(text)}
        for end in range(len(text)):
            assert set(bpe.boundaries(text[:end], compiled).tolist()) <= whole


def test_one_encoding_of_the_library():
    """The rank file alone, with its pattern, is the encoding that is asked for."""
    assert isinstance(bpe.encoding(RANKS, PATTERN), tiktoken.Encoding)
    assert bpe.encoding(RANKS, PATTERN).n_vocab == 50_256
