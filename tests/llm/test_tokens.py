import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ratingloom.llm import packing, token_files
from ratingloom.llm.tokens import WordEncoder, encoder, public_path
from ratingloom.workspace import fresh_path

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def library(name):
    own = Tokenizer.from_file(public_path(name))
    return lambda text: own.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(max_size=40), st.text("ab'stre lvdm 09.\n\té!", max_size=60)), max_size=6))
def test_words_one_by_one_give_the_librarys_ids(name, texts):
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder(public_path(name)).encode(texts)]
    assert got == [library(name)(t) for t in texts]


@pytest.mark.parametrize("name", NAMES)
def test_added_tokens_in_texts_are_the_librarys(name):
    own = Tokenizer.from_file(public_path(name))
    marks = [t.content for t in own.get_added_tokens_decoder().values()]
    texts = [f"a {m} b" for m in marks] + [f"x{m}{m}" for m in marks] + [m.upper() + "!" for m in marks] + marks
    assert marks
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder(public_path(name)).encode(texts)]
    assert got == [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_full_dictionary_starts_anew(monkeypatch):
    monkeypatch.setattr("ratingloom.llm.tokens.WORDS_KEPT", 5)
    monkeypatch.setattr("ratingloom.llm.tokens._LONG", 50)
    own = WordEncoder(public_path(NAMES[0]))
    texts = ["one two three four", "five six seven " * 9, "one two"]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [library(NAMES[0])(t) for t in texts]


def expected(rows, name, end=1):
    return [(r.doc_id, np.array(library(name)(r.text) + [end], "<u4").tobytes()) for r in rows]


def test_files_hold_every_document_in_order(spark, odd_documents, monkeypatch):
    monkeypatch.setattr("ratingloom.llm.token_files.BLOCK_BYTES", 200)
    path = fresh_path(spark, "files")
    token_files.write(odd_documents.repartition(4), path, public_path(NAMES[1]))
    found = token_files.read(spark, path).orderBy("start").collect()
    wanted = expected(odd_documents.collect(), NAMES[1])
    assert sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.ids)) for r in found) == sorted((i is not None, i or 0, x) for i, x in wanted)
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    start = 0
    for r in found:
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(r.ids) // 4, zlib.crc32(r.ids))
        start += r.n_tokens
    assert token_files.document(spark, path, 2**60 + 1) == library(NAMES[1])("Straße 'tis o'clock 北京 😀 ²³ İ") + [1]
    assert token_files.document(spark, path, 424242) is None
    block = bytes(spark.read.parquet(f"{path}/blocks").first()["block"])
    with pytest.raises(ValueError, match="not a block"):
        list(token_files._frames(block, b"another dictionary"))


def test_no_documents_give_empty_files(spark, no_documents):
    path = fresh_path(spark, "files")
    token_files.write(no_documents, path, public_path(NAMES[1]))
    assert token_files.read(spark, path, with_ids=False).count() == 0


def check_pieces(pieces, wanted, size):
    """Every id once, sequences gapless and not too long."""
    parts = {}
    for p in pieces:
        parts.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    assert sum(p.length for p in pieces) == sum(len(x) // 4 for _, x in wanted)
    whole = {}
    for i, x in wanted:
        whole.setdefault((i, len(x) // 4), []).append(x)
    assert parts.keys() == whole.keys()
    for key, texts in whole.items():
        if len(texts) == 1:
            at = 0
            for p in sorted(parts[key], key=lambda p: p.start):
                assert p.start == at and p.length > 0
                assert p.ids_crc32 == zlib.crc32(texts[0][4 * at:4 * (at + p.length)])
                at += p.length
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
    return sum(size - sum(p.length for p in own) for own in sequences.values())


@pytest.mark.parametrize("size, fan_in, windows", [(2048, 16, 64), (64, 2, 2)])
def test_pieces_hold_every_id_once(odd_documents, monkeypatch, size, fan_in, windows):
    monkeypatch.setattr(packing, "FAN_IN", fan_in)
    docs = odd_documents.repartition(5)
    pieces = packing.pack(docs, public_path(NAMES[0]), size=size, open_windows=windows, min_piece=4, with_ids=True).collect()
    padding = check_pieces(pieces, expected(odd_documents.collect(), NAMES[0]), size)
    assert padding < size + 4 * len(pieces)
    assert all(zlib.crc32(p.ids) == p.ids_crc32 for p in pieces)


def test_nothing_to_pack(no_documents):
    assert packing.pack(no_documents, public_path(NAMES[0])).count() == 0


def test_best_fit_and_the_fullest_leaves():
    ids = lambda n: struct.pack("<I", 7) * n
    packer = packing.Packer(size=10, open_windows=2, min_piece=2)
    packer.add(1, 0, ids(6), 6)
    packer.add(2, 0, ids(7), 7)
    packer.add(3, 0, ids(3), 3)  # fits both, best the second, which is full then
    assert [[p[0] for p in w] for w in packer.take()] == [[2, 3]]
    packer.add(4, 0, ids(5), 5)
    packer.add(5, 0, ids(8), 8)  # fits none: the fullest takes four, the rest fits the other
    assert [[(p[0], p[1], len(p[2]) // 4) for p in w] for w in packer.take()] == [[(1, 0, 6), (5, 0, 4)]]
    packer.merge()
    assert packer.free == [1] and [(p[0], p[1]) for p in packer.pieces[0]] == [(4, 0), (5, 4)]
