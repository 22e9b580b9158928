from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm.helpers import awkward, frame, words

from tidemark.llm import backoff


def brute(rows, order, factor=0.4, cutoff=2):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")) for r in rows]
    counts = Counter(tuple(w[i - n + 1 : i + 1]) for w in texts for i in range(len(w)) for n in range(1, order + 1) if i - n + 1 >= 0)
    total = sum(map(len, texts))
    out = []
    for r, w in zip(rows, texts, strict=True):
        score, backed = 0.0, 0
        for i in range(len(w)):
            longest = n = min(order, i + 1)
            while n > 1 and counts[tuple(w[i - n + 1 : i + 1])] < cutoff:
                n -= 1
            gram = tuple(w[i - n + 1 : i + 1])
            score += math.log(factor) * (longest - n) + math.log(counts[gram] / (counts[gram[:-1]] if n > 1 else total))
            backed += n < longest
        out.append((r[0], len(w), backed, round(score, 5), round(score / len(w), 7) if w else None))
    return sorted(map(str, out))


@pytest.mark.parametrize(("order", "chunk_bits", "partitions"), [(1, 10, None), (2, 2, 5), (2, 10, None), (3, 3, 11), (5, 10, 2)])
def test_against_brute_force(spark, monkeypatch, order, chunk_bits, partitions):
    monkeypatch.setattr(backoff, "CHUNK_BITS", chunk_bits)
    docs = frame(spark).withColumnsRenamed({"lang": "chunk", "source": "id"})
    got = backoff.backoff_scores(docs, order=order, partitions=partitions).collect()
    assert sorted(str((r.doc_id, r.n_tokens, r.n_backoff, round(r.log_score, 5) + 0.0, None if r.mean_log_score is None else round(r.mean_log_score, 7))) for r in got) == brute(awkward(), order)


def test_empty_table(spark):
    assert backoff.backoff_scores(frame(spark, [])).collect() == []
    got = backoff.backoff_scores(frame(spark, [(1, None, None, None, None), (2, " ", None, None, None)])).collect()
    assert sorted((r.doc_id, r.n_tokens, r.log_score, r.mean_log_score) for r in got) == [(1, 0, 0.0, None), (2, 0, 0.0, None)]


def test_what_is_summed_at_once_does_not_follow_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(backoff, "PART_BYTES", 256)
    whole, dealt = backoff._answer, []
    monkeypatch.setattr(backoff, "_answer", lambda parts: dealt.append(parts) or whole(parts))
    rng = random.Random(1)
    rows = [(i, words(rng, 300), None, None, None) for i in range(40)]
    got = backoff.backoff_scores(frame(spark, rows), order=3, partitions=2).collect()
    assert dealt[0] >= sum(len(r[1].encode()) for r in rows) // 256
    assert sorted(str((r.doc_id, r.n_tokens, r.n_backoff, round(r.log_score, 5) + 0.0, round(r.mean_log_score, 7))) for r in got) == brute(rows, 3)


def test_hashes_and_counts_travel_short():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 1 << 64, 200_000, np.uint64))
    firsts = backoff._firsts(7)
    cuts = backoff._cuts(hashes, firsts)
    counts = rng.integers(1, 3, len(hashes))
    size = 0
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        sent = [backoff._packed(np.diff(hashes[a:b], prepend=firsts[i])), backoff._packed(counts[a:b])]
        size += sum(map(len, sent))
        back = [backoff._unpacked(pa.scalar(x, pa.binary()).as_buffer()) for x in sent]
        assert np.array_equal(np.cumsum(back[0]) + firsts[i], hashes[a:b]) and np.array_equal(back[1], counts[a:b])
    assert size < 7 * len(hashes)


def test_long_texts_make_chunks_of_few_rows(spark):
    docs = frame(spark, [(i, "word " * 1000, None, None, None) for i in range(64)]).select("doc_id", "text").coalesce(1)
    assert docs.mapInArrow(backoff._chunks(1 << 12, 100_000), "chunk bigint, body binary").select("chunk").distinct().count() == 4
    assert docs.mapInArrow(backoff._chunks(1 << 12, 1 << 20), "chunk bigint, body binary").count() == 1
