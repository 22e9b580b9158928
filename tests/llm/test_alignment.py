from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st
from llm.helpers import awkward, frame
from tokenizers import Tokenizer

from tidemark.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
STRANGE = ["<|endoftext|> is text", "a▁b", "tabs\t\tand  spaces   ", "naïve café 东京 😀👍🏽", "\n\n x\n y", "　ideographic", "<0x41> <unk> <s>", "a\x00b", "ﬁ ½ Å"]


def brute(rows):
    a_lib, b_lib = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    decode = {v: k for k, v in alignment_bytes().items()}
    entry = {i: bytes(decode[c] for c in e) for e, i in a_lib.get_vocab(with_added_tokens=False).items()}

    def piece(i):
        p = b_lib.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    per_doc = []
    for r in rows:
        text = r[1] or ""
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        if b"".join(entry[i] for i in a) != (" " + text).encode() or b"".join(map(piece, b)) != (" " + text).encode():
            a, b = [], []
        ends_a, ends_b, at = {}, {}, 0
        for i in a:
            at += len(entry[i])
            ends_a[at] = i
        at = 0
        for i in b:
            at += len(piece(i))
            ends_b[at] = i
        both = [e for e in ends_a if e in ends_b]
        groups, low = [], 0
        for e in both:
            groups.append(",".join(str(i) for x, i in ends_a.items() if low < x <= e) + "|" + ",".join(str(i) for x, i in ends_b.items() if low < x <= e))
            low = e
        per_doc.append((r[0], len(a), len(b), [(ends_a[e], ends_b[e]) for e in both], ";".join(groups)))
    count = Counter(p for d in per_doc for p in d[3])
    top = Counter()
    for (_, b), c in count.items():
        top[b] = max(top[b], c)
    return sorted((str(doc), na, nb, len(links), len(links), sum(count[p] == top[p[1]] for p in links), sum(count[p] for p in links),
                   hashlib.sha256(g.encode()).hexdigest() if g else "") for doc, na, nb, links, g in per_doc), count


def alignment_bytes():
    """Byte -> shown character, by its published rule."""
    keep = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255]
    rest = iter(range(256, 512))
    return {x: chr(x) if x in keep else chr(next(rest)) for x in range(256)}


@pytest.mark.parametrize(("chunk_rows", "chunk_bytes", "partitions"), [(1024, 4 << 20, 3), (3, 1 << 20, 5), (1000, 50, 1)])
def test_against_brute_force(spark, chunk_rows, chunk_bytes, partitions):
    rows = [r for r in awkward() if len(r[1] or "") < 3000] + [(1000 + i, t, None, None, None) for i, t in enumerate(STRANGE)]
    docs = frame(spark, rows).repartition(partitions).withColumnsRenamed({"lang": "pair", "source": "__chunk", "n_chars": "n_a"})
    documents, links = alignment.aligned(docs, A, B, chunk_rows=chunk_rows, chunk_bytes=chunk_bytes)
    want, count = brute(rows)
    got = documents.collect()
    assert sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got) == want
    assert {(r.a_id, r.b_id): r.links for r in links.collect()} == count
    assert all(len(r.a_ids) == r.n_a and (not r.n_a or r.a_until[-1] == r.n_a) and len(r.b_until) == r.n_groups for r in got)


def test_empty_tables(spark):
    assert alignment.aligned(frame(spark, []), A, B)[0].collect() == []
    got = alignment.aligned(frame(spark, [(None, None, None, None, None), (2, "", None, None, None)]), A, B, lists=False)[0].collect()
    assert [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got] == [(0, 0, 0, 0, 0, 0, "")] * 2


def groups(a, b):
    found = alignment.stretches(a, b)
    return [x + 1 for x in alignment.group_ends(found, len(a), 0)], [x + 1 for x in alignment.group_ends(found, len(b), 1)]


@given(st.lists(st.integers(1, 60), min_size=1, max_size=40, unique=True), st.lists(st.integers(1, 60), max_size=40, unique=True))
def test_groups_end_at_the_common_ends(a, b):
    a = sorted(a)
    b = sorted({x for x in b if x <= a[-1]} | {a[-1]})
    common = sorted(set(a) & set(b))
    assert groups(a, b) == ([a.index(x) + 1 for x in common], [b.index(x) + 1 for x in common])


def test_long_one_to_one_runs_are_skipped():
    rng = random.Random(1)
    a = sorted(rng.sample(range(10**6), 5000))
    b = [x for i, x in enumerate(a) if i % 997 or x == a[-1]]
    common = sorted(set(a) & set(b))
    got = groups(a, b)
    assert [a[x - 1] for x in got[0]] == common == [b[y - 1] for y in got[1]]
    assert len(alignment.stretches(a, b)) == 1 + sum(i % 997 == 0 for i in range(5000))
