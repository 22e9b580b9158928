from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from llm.helpers import awkward, frame

from tidemark.llm import collocations as co


def brute(rows, support=10, max_words=3, covered=50, top=2000):
    f, n = Counter(), Counter()
    for r in rows:
        lang = r[2] if r[2] is not None else "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + m])) for i in range(len(w)) for m in range(1, max_words + 1) if i + m <= len(w))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= support}
    out = {}
    for (lang, w), a in found.items():
        if any(k[0] == lang and len(k[1]) > len(w) and 100 * b >= covered * a and any(k[1][i : i + len(w)] == w for i in range(len(k[1]))) for k, b in found.items()):
            continue
        cuts = [(1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, v in out.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:top], 1))


def got(docs, top=2000, **kw):
    cols = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in cols) for r in co.top_collocations(co.collocations(docs, **kw), top).collect())


def speech(seed=3, rows=120):
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        w = [rng.choice(["a", "b", "c", "d", "Ä", "e f", "new", "york", "city", "the"]) for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w) + 1):0] = ["New", "York", "City"]
        text = "".join(x + rng.choice([" "] * 9 + ["  ", "\t", ". ", "\n", ", ", "!"]) for x in w)
        out.append((i, text, rng.choice(["en", "de", None]), None, None))
    return out


@pytest.mark.parametrize(("shards", "slice_bytes", "max_words", "support", "covered", "top"),
                         [(4, 4 << 20, 3, 10, 50, 7), (7, 100, 4, 6, 80, 2000), (256, 1, 2, 3, 50, 2000)])
def test_against_brute_force(spark, shards, slice_bytes, max_words, support, covered, top):
    rows = speech() + awkward()
    docs = frame(spark, rows).repartition(3).withColumnsRenamed({"source": "phrase", "n_chars": "h"})
    assert got(docs, top, shards=shards, slice_bytes=slice_bytes, max_words=max_words, support=support, covered=covered) == brute(rows, support, max_words, covered, top)


def test_no_candidate_is_lost_where_the_bitmap_is_crowded(spark, monkeypatch):
    monkeypatch.setattr(co, "MAX_BITS", 16)
    rows = speech()
    assert got(frame(spark, rows).coalesce(2)) == brute(rows)


def test_repeated_words_count_overlaps(spark):
    rows = [(i, "x y " * 400, "en", None, None) for i in range(40)]
    assert got(frame(spark, rows).coalesce(2)) == brute(rows)


def test_empty_tables(spark):
    assert got(frame(spark, [])) == []
    assert got(frame(spark, [(1, None, None, None, None), (2, "", "en", None, None)])) == []
    assert got(frame(spark, [(1, "a b " * 10, None, None, None)])) == brute([(1, "a b " * 10, None)])
