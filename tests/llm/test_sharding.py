from __future__ import annotations

from collections import defaultdict

import pytest
from llm.helpers import awkward, frame

from tidemark.llm import sharding
from tidemark.llm.tables import numbered


@pytest.mark.parametrize("limit", [300, 5000, 1 << 20])
def test_every_shard_fits_and_no_split_was_needless(spark, limit):
    rows = awkward()
    got = sharding.assign_shards(frame(spark), limit=limit).collect()
    assert len(got) == len(rows)
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append(r)
    for name, members in shards.items():
        assert len(name) == members[0].depth
        total = sum(r.n_bytes for r in members)
        assert {(r.shard_bytes, r.shard_docs) for r in members} == {(total, len(members))}
        assert total <= limit or len(members) == 1
        if name:  # its parent bucket was too large
            parent = [r for r in got if r.shard.startswith(name[:-1])]
            assert sum(r.n_bytes for r in parent) > limit and len(parent) > 1
    assert not any(a != b and b.startswith(a) for a in shards for b in shards)


def test_repeated_rows_part_and_empty_table(spark):
    rows = [(1, "x" * 100, None, None, None)] * 50
    got = sharding.assign_shards(frame(spark, rows), limit=1000).collect()
    assert len(got) == 50 and max(r.shard_bytes for r in got) <= 1000
    assert sharding.assign_shards(frame(spark, [])).collect() == []


def test_written_shards(spark):
    docs, row = numbered(frame(spark), "t")
    assigned = sharding.assign_shards(docs, limit=5000, row=row)
    back = spark.read.parquet(sharding.write_shards(docs, assigned, row))
    assert sorted(str(r.text) for r in back.collect()) == sorted(str(r[1]) for r in awkward())
