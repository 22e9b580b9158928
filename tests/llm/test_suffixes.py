from __future__ import annotations

import hashlib
import random
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from llm.helpers import awkward, frame, words

from tidemark.llm import suffixes


def brute(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append(str((r[0], len(t), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest())))
    return sorted(out)


def case(length):
    rng = random.Random(length)
    shared = [words(rng, length // 2) for _ in range(4)]
    texts = []
    for i in range(60):
        parts = [words(rng, rng.randrange(length)) for _ in range(rng.randrange(3))]
        if i % 2:
            a = rng.choice(shared)
            cut = sorted(rng.randrange(len(a)) for _ in range(2))
            parts.insert(rng.randrange(len(parts) + 1), a[cut[0] : cut[1]] if i % 3 else a)
        texts.append("é".join(parts))
    texts += ["a" * (3 * length), "ab" * (2 * length), "a" * (length - 1), "a" * length, "x" + "a" * length + "y", ("line one\n" * length), texts[5], shared[0] * 2]
    return awkward() + [(1000 + i, t, None, None, None) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("length", "gram", "hot"), [(40, 13, 4096), (40, 13, 2), (40, 30, 3), (400, 128, 4096), (9, 2, 3), (9, 2, 4096)])
def test_against_brute_force(spark, monkeypatch, length, gram, hot):
    monkeypatch.setattr(suffixes, "CHUNK_BITS", 4)
    rows = case(length)
    docs = frame(spark, rows).withColumnsRenamed({"lang": "chunk", "source": "id"})
    got = suffixes.remove_repeats(docs, length=length, gram=gram, partitions=3, with_text=True, hot=hot, at_once=50).collect()
    assert sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got) == brute(rows, length)
    for r in got:
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and sum(b - a for a, b in r.spans) == r.n_removed


def test_one_passage_with_many_neighbours_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK_BITS", 4)
    rng = random.Random(3)
    passage = words(rng, 30)
    rows = [(i, words(rng, 20) + passage + words(rng, 20), None, None, None) for i in range(200)]
    # What a partition gets of one anchor, or of one half of the passage, must not grow with the documents.
    held = spark.sparkContext.accumulator(0)
    compared = suffixes.repeated_starts

    def counting(before, starts, raw, length, gram):
        held.add(max(0, len(raw) - 24))
        return compared(before, starts, raw, length, gram)

    monkeypatch.setattr(suffixes, "repeated_starts", counting)
    texts = pa.table({"text": pa.array([r[1] for r in rows])})
    asked = pa.table(suffixes._ask(40, 13, 3)((pa.scalar(0),), texts))
    counted = pa.Table.from_batches(suffixes._count(8)(asked.sort_by("part").to_batches()))
    sent = suffixes._send(40, 13, 3)((pa.scalar(0),), texts, counted)
    for part in range(3):
        list(suffixes._compare(40, 13, 16)(sent.filter(pc.equal(sent.column("part"), part)).to_batches()))
    assert held.value == 0
    got = suffixes.remove_repeats(frame(spark, rows), length=40, gram=13, partitions=3, hot=8, at_once=16).collect()
    assert sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got) == brute(rows, 40)


@pytest.mark.parametrize("bits", [10, 13, 18])
def test_every_string_has_one_anchor(bits):
    rng = random.Random(0)
    texts = [words(rng, 300).encode(), b"a" * 500, b"", b"short", words(rng, 60000).encode()]
    doc, place, first, last, _ = suffixes.anchors(texts, 400, 128, bits)
    starts = Counter((d, s) for d, a, b in zip(doc, first, last, strict=True) for s in range(a, b + 1))
    assert starts == Counter((d, s) for d, t in enumerate(texts) for s in range(len(t) - 399))
    assert ((place >= last) & (place <= first + 400 - 128)).all()


def test_empty_table(spark):
    assert suffixes.remove_repeats(frame(spark, [])).collect() == []
