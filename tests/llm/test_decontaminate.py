from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from llm.helpers import DOCS, frame, words

from tidemark.llm import decontaminate


def tokens(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def bag(parts, k):
    return Counter(tuple(parts[i : i + k]) for i in range(len(parts) - k + 1))


def brute(rows, items):
    found = {}
    for doc_id, text, *_ in rows:
        have = tokens(text)
        for item_id, item in items:
            want = tokens(item)
            if not want or not have:
                continue
            k, best, n = min(5, len(want)), (0.0, 0), 0
            theirs = bag(want, k)
            for s in range(max(1, len(have) - len(want) + 1)):
                ours = bag(have[s : s + len(want)], k)
                lesser = sum((ours & theirs).values())
                sim = lesser / sum((ours | theirs).values())
                if sim >= 0.8:
                    n += 1
                    best = max(best, (sim, -s))
            if n:
                found[doc_id, item_id] = (round(best[0], 9), -best[1], n)
    return found


def case():
    rng = random.Random(5)
    items = [(i, words(rng, rng.randrange(14, 60))) for i in range(25)] + [(100, "Two words"), (101, ""), (102, None), (103, "one"), (104, "a a a a a a a a a a")]
    rows = []
    for n in range(80):
        body = words(rng, rng.randrange(5, 150), 60).split()
        if n % 2:
            item = items[n % 25][1].split()
            if n % 4 == 1:
                at = rng.randrange(len(item))
                item[at : at + 1] = ["edited"] * rng.randrange(3)
            if n % 8 == 3:
                item = item[rng.randrange(3) : len(item) - rng.randrange(3)]
            at = rng.randrange(len(body))
            body[at:at] = item
        rows.append((n, " ".join(body).title().replace(" ", ", " if n % 3 else "\n"), None, None, None))
    rows += [(200, items[3][1], None, None, None), (201, "so, TWO-words!", None, None, None), (202, None, None, None, None), (203, "", None, None, None),
             (204, "a " * 30, None, None, None), (205, "one", None, None, None), (None, items[4][1], None, None, None), (200, items[3][1], None, None, None)]
    return rows, items


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_against_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST", broadcast)
    rows, items = case()
    docs = frame(spark, rows)
    matches = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id bigint, text string"))
    found = docs.select("doc_id", decontaminate.F.sha2(decontaminate.text_of(), 256).alias("key")).join(matches, "key").collect()
    got = {(r.doc_id, r.item): (round(r.similarity, 9), r.start, r.n_windows) for r in found}
    assert got == brute(rows, items)


def test_stage_drops_only_what_matches(spark, tmp_path):
    rows, items = case()
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frame(spark, rows).withColumnsRenamed({"lang": "key", "source": "__key"})
    kept = decontaminate.stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    bad = {d for d, _ in brute(rows, items)}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in rows if r[0] not in bad)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "a b c d e f g h")], "item_id bigint, text string")
    assert decontaminate.contaminated(frame(spark), none).collect() == []
    assert decontaminate.contaminated(spark.createDataFrame([], DOCS), some).collect() == []
