from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from llm.helpers import awkward, frame

from tidemark.llm import simhash
from tidemark.llm.components import components


def slow_fingerprint(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def classes(values: list[int], budget: int = 3) -> dict[int, int]:
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = sorted(root)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= budget:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in distinct}


@pytest.mark.parametrize("text", ["", " \t", "One", "One two", "a b c", "a b c d", "ÀB c\x0bd\x1ce f g", "x " * 70000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_hash_is_that_of_spark(spark):
    from pyspark.sql import functions as F

    got = spark.createDataFrame([("é b c",)], "s string").select(F.xxhash64("s")).first()[0]
    assert got % 2**64 == xxhash.xxh64_intdigest("é b c".encode(), 42)


@pytest.mark.parametrize("node_size", [2, 1024])
def test_links_against_all_pairs(spark, node_size):
    rng = random.Random(3)
    values = [rng.getrandbits(64) for _ in range(30)]
    for _ in range(400):  # chains of near values, and values that share a quarter
        v = rng.choice(values)
        for _ in range(rng.randrange(1, 6)):
            v ^= 1 << rng.randrange(64)
        values.append(v)
    values += [0, 2**64 - 1, 1, 2**63]
    fps = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in set(values)], "fp bigint")
    got = components(simhash.links(fps, node_size=node_size)).collect()
    by_root, expect = defaultdict(set), defaultdict(set)
    for r in got:
        by_root[r.root].add(r.node % 2**64)
    for v, root in classes(list(set(values))).items():
        expect[root].add(v)
    assert sorted(map(sorted, by_root.values())) == sorted(sorted(x) for x in expect.values() if len(x) > 1)


def test_query_against_brute_force(spark):
    rows = awkward()
    fps = [slow_fingerprint(r[1] or "") for r in rows]
    root = classes(fps)
    least = {}
    for r, fp in zip(rows, fps, strict=True):
        if r[0] is not None:
            least[root[fp]] = min(least.get(root[fp], r[0]), r[0])
    expect = sorted(str((r[0], f"{fp:016x}", least.get(root[fp]))) for r, fp in zip(rows, fps, strict=True))
    got = simhash.near_duplicates(frame(spark)).collect()
    assert sorted(str(tuple(r)) for r in got) == expect


def test_stage_keeps_one_of_each_class(spark):
    docs = frame(spark).withColumnsRenamed({"lang": "fp", "source": "first"})
    kept = simhash.stage(spark, docs, "")
    assert kept.columns == docs.columns
    root = classes([slow_fingerprint(r[1] or "") for r in awkward()])
    found = [root[slow_fingerprint(r.text or "")] for r in kept.collect()]
    assert sorted(found) == sorted(set(root.values()))
    assert simhash.near_duplicates(frame(spark, [])).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(50)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {1000 + i: 1000 for i in range(50)}
