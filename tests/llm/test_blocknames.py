from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from llm.helpers import awkward, frame

from tidemark.llm import blocknames


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    rank = lambda i: (i is not None, i or 0)
    return {t: (max(ids, key=rank), len(ids)) for t, ids in groups.items()}


@pytest.mark.parametrize("block_bytes", [7, 64, blocknames.BLOCK_BYTES])
def test_against_brute_force(spark, block_bytes):
    rows = awkward()
    expect = brute(rows)
    got = blocknames.exact_duplicates(frame(spark), block_bytes=block_bytes).collect()
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in expect.items()}
    assert len(got) == len(rows)
    kept = defaultdict(int)
    for r in got:
        assert (r.keep_id, r.group_size) == by_digest[r.text_sha256]
        if r.kept:
            assert r.doc_id == r.keep_id
            kept[r.text_sha256] += 1
    assert kept == dict.fromkeys(by_digest, 1)


def test_equal_hashes_do_not_make_texts_equal(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(blocknames.F, "xxhash64", lambda c: F.lit(0).cast("bigint"))
    rows = [(i, f"{i % 4:03d}" * (1 + i % 3), None, None, None) for i in range(24)]
    got = blocknames.exact_duplicates(frame(spark, rows), block_bytes=4).collect()
    expect = brute(rows)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in expect.items()}
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(r[0], *expect[r[1]]) for r in rows}
    assert {r.text_sha256 for r in got} == set(by_digest)


def test_empty_table_and_stage(spark):
    assert blocknames.exact_duplicates(frame(spark, [])).collect() == []
    docs = frame(spark).withColumnsRenamed({"lang": "name", "source": "__row"})
    kept = blocknames.stage(spark, docs, "")
    assert kept.columns == docs.columns
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({r[1] or "" for r in awkward()})


def test_stored_tables_are_released(spark):
    from tidemark.llm.tables import release_stored, stored

    release_stored(spark)
    kept = stored(frame(spark), "t")
    path = kept.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
    assert kept.count() == len(awkward())
    assert release_stored(spark) == 1
    import os

    assert not os.path.exists(path)
