import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from factloom.llm import bpe, token_files
from tests.llm.frames import awkward, docs

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "1", "23", "'s", "'re", "'", "!", "é", "e\u0301", "日本", "😀", "<|endoftext|>", "<|endo",
         "<|startoftext|>", "\t", "\xa0", "\u3000", "\x1c", "\x85", "Σ", "İ", "ZA"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=40).map("".join)


@pytest.fixture(scope="module")
def library():
    return {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(BYTE)


@settings(max_examples=300, deadline=None)
@given(text=TEXTS, step=st.sampled_from([1, 3, 7, 1 << 16]), longest=st.sampled_from([16, 4096]))
def test_streamed_ids_are_the_librarys(library, vocabulary, text, step, longest):
    encoder, out, before = bpe.Encoder(vocabulary), [], bpe.LONGEST
    bpe.LONGEST = longest
    try:
        for i in range(0, len(text), step):
            out += encoder.feed(text[i : i + step])
        out += encoder.finish()
    finally:
        bpe.LONGEST = before
    assert out == library[BYTE].encode(text, add_special_tokens=False).ids
    decoder = bpe.Decoder(vocabulary)
    assert "".join(decoder.feed([i]) for i in out) + decoder.finish() == text


@pytest.mark.parametrize("signs", ["ab", "etaoin", " ", " \n", "-=_", "0123", "aeé"])
def test_a_piece_longer_than_the_buffer(library, vocabulary, signs):
    r = random.Random(signs)
    text = "".join(r.choice(signs) for _ in range(9000)) + "x"
    assert [i for ids in bpe.encode(text, vocabulary) for i in ids] == library[BYTE].encode(text, add_special_tokens=False).ids


def test_memory_stays_bounded(vocabulary):
    encoder = bpe.Encoder(vocabulary)
    for _ in range(60):
        encoder.feed("ab" * 5000)
        assert len(encoder._held) + len(encoder._pending) <= 2 * bpe.LONGEST + 100
        assert len(encoder._bytes) <= 5 * (vocabulary.lookahead + bpe.WHOLE)


def test_decoding_of_any_ids(library, vocabulary):
    r = random.Random(4)
    for _ in range(200):
        ids = [r.randrange(50257) for _ in range(r.randrange(9))]
        decoder = bpe.Decoder(vocabulary)
        assert decoder.feed(ids) + decoder.finish() == library[BYTE].decode(ids, skip_special_tokens=False)


def test_round_trip_of_awkward_rows(spark, library):
    frame = awkward(spark).unionByName(docs(spark, ["a<|endoftext|>b" * 3, "x" * 70_000, " " * 70_000], [50, 51, 52]), allowMissingColumns=True)
    expected = []
    for row in frame.collect():
        ids = library[BYTE].encode(row.text or "", add_special_tokens=False).ids
        text = library[BYTE].decode(ids, skip_special_tokens=False)
        expected.append((row.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(tuple(r) for r in bpe.round_trip(frame, BYTE).collect()) == sorted(expected)
    for row in bpe.round_trip(frame, BYTE, keep_ids=True).collect():
        assert len(row.ids) == row.n_tokens
    assert bpe.round_trip(docs(spark, []), BYTE).count() == 0


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(TEXTS, max_size=8))
def test_word_ids_are_the_librarys(library, texts):
    tokenizer = token_files._tokenizer(WORD)
    got = [np.frombuffer(b, tokenizer.kind).tolist() for b in tokenizer.encode(pa.array(texts, pa.string()))]
    assert got == [e.ids for e in library[WORD].encode_batch(texts, add_special_tokens=False)]


def test_files_read_back(spark, library, tmp_path):
    frame = awkward(spark).unionByName(docs(spark, ["no id"], [None]), allowMissingColumns=True)
    bases = token_files.write_token_files(frame, str(tmp_path / "f"), WORD, 2)
    got = sorted((tuple(r) for r in token_files.read_token_files(bases, str(tmp_path / "f")).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, *sorted(r.doc_id for r in frame.collect() if r.doc_id is not None)]
    start = 0
    texts = {r.doc_id: r.text for r in frame.collect()}
    for doc_id, at, n, crc in got:
        ids = [*library[WORD].encode(texts[doc_id] or "", add_special_tokens=False).ids, 2]
        assert (at, n, crc) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += n
    assert sum((tmp_path / "f" / f"{r.name}.bin").stat().st_size for r in bases.collect()) == 2 * start


def test_no_files_of_an_empty_table(spark, tmp_path):
    bases = token_files.write_token_files(docs(spark, []), str(tmp_path / "e"), WORD, 2)
    assert token_files.read_token_files(bases, str(tmp_path / "e")).count() == 0


def test_files_need_a_mounted_folder():
    with pytest.raises(ValueError, match="mounted"):
        token_files.local_folder("s3a://bucket/x")


def test_files_of_about_equal_bytes(spark, tmp_path, monkeypatch):
    """Long texts at one end of the ids, and rows without an id, do not make large files; every file has a task of its own."""
    monkeypatch.setattr(token_files, "IDS_PER_FILE", 2_000)
    texts = ["word " * (400 if i < 60 else 4) for i in range(600)] + ["other words " * 40 + str(i) for i in range(120)]
    frame = docs(spark, texts, [*range(600), *[None] * 120])
    bases = token_files.write_token_files(frame, str(tmp_path / "f"), WORD, 2)
    parts = sorted(bases.collect(), key=lambda r: r.part)
    assert sum(r.docs for r in parts) == 720 and sum(r.part < 0 for r in parts) > 5 and sum(r.part >= 0 for r in parts) > 20
    assert max(r.ids for r in parts) < 4 * sum(r.ids for r in parts) / len(parts)
    got = token_files.read_token_files(bases, str(tmp_path / "f")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 120 + [*range(600)]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(720)]


def test_bounds_between_cells():
    limits, sizes = np.array([-(2**62), 0, 10, 20]), np.array([0, 5, 100, 100])
    bounds = token_files.even_bounds(limits, sizes, 50)
    assert bounds == sorted(bounds) and len(bounds) == 4 and all(-(2**62) < b <= 21 for b in bounds)
    assert token_files.even_bounds(np.zeros(0, np.int64), np.zeros(0, np.int64), 5) == []
    assert token_files.even_bounds(np.array([7]), np.array([0]), 1) == []


def test_words_of_one_piece_share_its_ids(library):
    texts = ["The the THE they're in. a1b", "zyzzyva Zyzzyva", None]
    encoder = token_files.WordTokenizer(WORD)
    got = [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(pa.array(texts, pa.string()))]
    assert got == [library[WORD].encode(t or "", add_special_tokens=False).ids for t in texts]
    assert encoder._words[b"The"] is encoder._words[b"the"] and encoder._words[b"Zyzzyva"] is encoder._words[b"zyzzyva"]
