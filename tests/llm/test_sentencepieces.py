from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm.helpers import awkward, frame

from tidemark.llm import sentencepieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a  b ", "\n", "\n\n a", "▁x▁ y", "日本語 текст 🙂\x00\t", "a\rb", "x" * 5000, "<s> </s> <0x41>", "é" * 30, " \n \n", "ﬁ à",
       "ab " * 3000, "   " * 50 + "z", "​﻿", "hello\nworld. Hello world!", "aaaaaaaabaaaa"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("text", ODD)
def test_as_the_library(library, text):
    pieces = sentencepieces.load(MODEL)
    ids = np.frombuffer(pieces.encode(text), "<u4")
    assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)
    assert pieces.decode(ids) == library.decode(ids.tolist())


def test_decoding_of_any_ids(library):
    pieces, rng = sentencepieces.load(MODEL), np.random.default_rng(3)
    for _ in range(300):
        ids = rng.integers(0, 32000, rng.integers(0, 12))
        few = np.where(rng.random(len(ids)) < 0.6, rng.integers(0, 259, len(ids)), ids)
        for x in (ids, few):
            assert pieces.decode(x.astype("<u4")) == library.decode(x.tolist())


def test_kept_words_are_dropped_without_effect(library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "KEPT_WORDS", 3)
    pieces = sentencepieces.Pieces(MODEL)
    for text in ["one two three four five", "two six seven", "one eight nine ten two"] * 2:
        assert np.frombuffer(pieces.encode(text), "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)
        pieces.check([])


def test_a_difference_raises():
    pieces = sentencepieces.Pieces(MODEL)
    pieces.fresh.append(("▁the", [5]))
    with pytest.raises(ValueError, match="differ"):
        pieces.check([])


def test_query_against_the_library(spark, library):
    docs = frame(spark).withColumnsRenamed({"lang": "__text", "source": "ids"})
    got = sentencepieces.encode_and_decode(docs, MODEL).collect()
    expect = []
    for doc_id, text, *_ in awkward():
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        expect.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest(), ids, library.decode(ids)))
    assert sorted(map(str, expect)) == sorted(str(tuple(r)) for r in got)
    assert sentencepieces.encode_and_decode(frame(spark, []), MODEL).collect() == []


def test_stage_keeps_all_columns(spark):
    docs = frame(spark).withColumnsRenamed({"lang": "__text", "source": "n_tokens"})
    got = sentencepieces.stage(spark, docs, "")
    assert got.columns == ["doc_id", "text", "__text", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert got.count() == len(awkward())


def test_list_and_heap_agendas_and_cut_words(monkeypatch):
    pieces = sentencepieces.Pieces(MODEL)
    rng = random.Random(5)
    letters = "etaoinshrdlué.,;'_²1😀\n▁-"
    some = ["▁" + "".join(rng.choice(letters) for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    short = [pieces.agenda(w) for w in some]
    monkeypatch.setattr(sentencepieces, "SHORT", 0)
    assert short == [pieces.agenda(w) for w in some]
    for w in some:
        text = w[1:].replace("▁", " ")
        assert np.frombuffer(pieces.encode(text), "<u4")[1:-1].tolist() == pieces.library.encode(text)
    assert pieces.words.findall("▁word,&&&▁word.") == ["▁word", ",&&&", "▁word", "."]
    pieces.check([])


def test_a_word_met_again_is_not_encoded_again():
    pieces = sentencepieces.Pieces(MODEL)
    for text in ("seldomword, other", "other. seldomword!"):
        pieces.encode(text)
    assert [w for w, _ in pieces.fresh].count("▁seldomword") == 1


@pytest.mark.parametrize("word", ["▁the", "x", ".&", "▁▁b", "▁▁"])
def test_a_difference_raises_among_many(word):
    pieces = sentencepieces.Pieces(MODEL)
    pieces.encode("many words, and  more of them.\nx y z")
    pieces.check([])
    pieces.encode("some other words; here\nand there")
    pieces.fresh.append((word, [300]))
    with pytest.raises(ValueError, match="differ"):
        pieces.check([])
