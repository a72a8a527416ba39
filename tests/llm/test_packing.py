from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymart.llm import packing
from tallymart.llm.tokens import byte_bpe, default_path


def expected_ids(text):
    tokenizer = byte_bpe(default_path()).exact
    return np.asarray([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text("ab 'sé’\n\t\x1c ²٣中<|endoftext|>")))
def test_ids_are_those_of_the_tokenizers_library(text):
    bpe = byte_bpe(default_path())
    assert list(np.frombuffer(bpe.ids(text), "<u4")) == bpe.exact.encode(text, add_special_tokens=False).ids


@given(st.integers(0, 10_000), st.sampled_from([1, 2, 16, 100, 1024]))
def test_cuts_cover_the_document(total, capacity):
    pieces = packing.cut_lengths(total, capacity)
    assert sum(pieces) == total and all(0 < p <= capacity for p in pieces)


def test_round_trip(docs):
    texts = {1: "a b c " * 3000, 2: None, 3: "", 4: "Straße d'été", 5: "x", None: "y", 7: "same", 8: "<|endoftext|> 中文"}
    frame = docs(*texts.items(), (7, "same"))
    rows = packing.piece_digests(packing.pack_documents(frame.repartition(3))).collect()
    by_doc: dict = {}
    for r in rows:
        ids = expected_ids(texts[r.doc_id])
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        by_doc[r.doc_id] = by_doc.get(r.doc_id, 0) + r.length
    assert by_doc == {i: len(expected_ids(t)) * (2 if i == 7 else 1) for i, t in texts.items()}
    sequences: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
        total = r.padded_length
        assert total in (packing.CAPACITY, 1 << (total.bit_length() - 1))
    assert max(sequences.values()) <= packing.CAPACITY


def test_bins_of_a_class_hold_as_many_pieces_as_fit(spark, sf_dir):
    rows = packing.op3_packing(spark, sf_dir).collect()
    used = sum(r.length for r in rows)
    room = sum({r.sequence_id: r.padded_length for r in rows}.values())
    assert used / room > 0.98


def test_empty_table(docs):
    assert packing.op3_packing.__module__ and packing.pack_documents(docs((1, "a")).limit(0)).collect() == []


@pytest.mark.parametrize("length,want", [(1, 1), (512, 512), (600, 1024), (1024, 1024)])
def test_padding(length, want):
    assert packing.padded(length, 1024) == want
