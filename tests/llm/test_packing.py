from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm.helpers import awkward, frame
from tokenizers import Tokenizer

from tidemark.llm import packing, wordwise

PATH = public_tokenizers.path("word_bpe_49k.json")
STRANGE = ["don't <|endoftext|> stop", "<|startoftext|>", "a b　c\x85d\x1ce", "É́ ́x ΑΣ ΟΔΥΣΣΕΥΣ", "tab\there  two\n\nlines \n", "İstanbul ǅ ﬁ", "9'99s we'll 'S", "😀👍🏽 ok"]


def checked(rows, pieces, capacity=2048, end=1):
    """Every document's ids lie in pieces once each, in order; sequences are gapless."""
    library = Tokenizer.from_file(PATH)
    documents = Counter()
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids + [end]
        documents[r[0], np.array(ids, "<u4").tobytes()] += 1
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert 0 < p.length <= capacity and p.start + p.length <= p.doc_tokens
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    found = Counter()
    for doc, parts in by_doc.items():
        # Documents with one id: chain the pieces of equal ids by their texts.
        wanted = [raw for (d, raw), n in documents.items() if d == doc for _ in range(n)]
        left = sorted(parts, key=lambda p: p.start)
        for raw in sorted(wanted, key=len, reverse=True):
            at = 0
            while at < len(raw) // 4:
                p = next(p for p in left if p.start == at and p.doc_tokens == len(raw) // 4
                         and raw[4 * at : 4 * (at + p.length)] == np.array(p.ids, "<u4").tobytes())
                left.remove(p)
                at += p.length
            found[doc, raw] += 1
        assert not left
    assert found == documents
    for parts in by_seq.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    return 1 - sum(p.length for p in pieces) / max(1, capacity * len(by_seq))


@pytest.mark.parametrize(("capacity", "open_windows", "slack", "fan", "partitions"), [(2048, 64, 8, 16, 3), (64, 3, 0, 2, 7), (100, 1, 99, 2, 5), (1, 2, 0, 4, 2)])
def test_every_id_lies_in_one_piece(spark, capacity, open_windows, slack, fan, partitions):
    rows = awkward() + [(1000 + i, t, None, None, None) for i, t in enumerate(STRANGE)]
    rows = [r for r in rows if len(r[1] or "") < 5000] if capacity < 64 else rows
    docs = frame(spark, rows).repartition(partitions).withColumnsRenamed({"lang": "start", "source": "__open"})
    pieces = packing.packed(docs, PATH, capacity=capacity, open_windows=open_windows, slack=slack, fan=fan).collect()
    waste = checked(rows, pieces, capacity)
    assert waste < (0.12 if capacity == 2048 else 0.05 if slack == 0 else 0.6)


def test_documents_that_fit_stay_whole_where_they_can(spark):
    rows = [(i, "word " * (i % 300), None, None, None) for i in range(2000)]
    pieces = packing.packed(frame(spark, rows).repartition(2), PATH).collect()
    assert checked(rows, pieces) < 0.01
    cut = {p.doc_id for p in pieces if p.start > 0}
    assert len(cut) < 100


def test_sequences(spark):
    rows = [(i, "some words here " * (i % 60), None, None, None) for i in range(300)]
    got = packing.sequences(packing.packed(frame(spark, rows), PATH, capacity=128), 128).collect()
    assert all(len(r.ids) == 128 and not any(r.ids[r.n_tokens :]) for r in got)
    library = Tokenizer.from_file(PATH)
    assert sum(r.n_tokens for r in got) == sum(len(library.encode(r[1], add_special_tokens=False).ids) + 1 for r in rows)


def test_empty_tables(spark):
    assert packing.packed(frame(spark, []), PATH).collect() == []
    got = packing.packed(frame(spark, [(None, None, None, None, None)]), PATH, keep=("doc_id", "lang"), ids=False).collect()
    assert [(r.doc_id, r.lang, r.start, r.length, r.doc_tokens, r.offset) for r in got] == [(None, None, 0, 1, 1, 0)]


def test_a_merge_keeps_what_a_group_may_hold():
    w = packing.Windows(10, 2, 0)
    for i, n in enumerate([6, 6, 6, 25]):
        packing._place(w, (i,), bytes(4 * n), 0)
    assert len(w.free) <= 2 and all(sum(len(raw) // 4 for (_, _, _, raw), _ in pieces) == 10 for _, pieces in w.done)


MORE = ["a  b   c \n d\n\n e\t f   g", "", " ", "   ", "x ", " x", "\n \n x  y", "a\x02b \x02 c", "!\x02", "\x02"]


@pytest.mark.parametrize(("kind", "file"), [(wordwise.SpacelessWords, "word_bpe_49k.json"), (wordwise.ByteWords, "byte_bpe_50k.json")])
def test_wordwise_equals_the_library(monkeypatch, kind, file):
    monkeypatch.setattr(wordwise, "KEPT_WORDS", 50)
    library = Tokenizer.from_file(public_tokenizers.path(file))
    library.encode_special_tokens = kind is wordwise.ByteWords
    encoder = kind(public_tokenizers.path(file))
    texts = STRANGE + MORE + [r[1] or "" for r in awkward()]
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for i in range(0, len(texts), 7) for x in encoder.encode(texts[i : i + 7])]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
