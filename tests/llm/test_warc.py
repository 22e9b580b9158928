from __future__ import annotations

import base64
import hashlib
import random
from collections import defaultdict

import pytest

from tidemark.llm import warc

PAGES = "page_id bigint, url string, html string"


def pages():
    rng = random.Random(4)
    inner = f"{warc.MAGIC}WARC-Type: response\r\nX-Page-Id: 77\r\nContent-Length: 5\r\n\r\nhello{warc.END}"
    rows = [(i, f"http://h{i % 3}/{i}", f"<p>{i % 40} é " + "x" * rng.randrange(300)) for i in range(150)]
    rows += [(200 + i, "http://x/", f"<p>same {i % 3}") for i in range(20)]
    rows += [(300, "u", inner), (301, "u", "a" + inner + inner + "z"), (302, "u", warc.MAGIC), (303, "u", warc.MAGIC * 5 + warc.END), (304, "u", f"{warc.END}{inner}"),
             (305, "u", "a" + inner + inner + "z"), (306, "u", "WARC/1.0\r"), (307, "u\r\nWARC-Type: bad", "\r\n\r\n"), (308, None, None), (309, "u", ""), (310, None, "\r\n")]
    rows += [(None, "n1", "null id"), (None, "n1", "null id"), (None, None, "null id"), (5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2]), (309, "u", ""), (3, "other", "<p>same 1")]
    return rows


def brute(rows):
    groups = defaultdict(list)
    for page_id, url, html in rows:
        groups[html or ""].append((page_id is None, page_id or 0, url is None, url or ""))
    out = []
    for html, members in groups.items():
        raw = html.encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        members.sort()
        ids = [None if m[0] else m[1] for m in members]
        out += [(i, len(raw), digest, "revisit" if k else "response", ids[0] if k else None) for k, i in enumerate(ids)]
    return sorted(map(str, out))


@pytest.mark.parametrize("split", [200, 1000, 1 << 27])
def test_there_and_back(spark, split):
    rows = pages()
    docs = spark.createDataFrame([(*r, "extra") for r in rows], PAGES + ", type string").repartition(3)
    path = warc.write_archives(docs)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.read_archives(spark, path, payload=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(r.intact for r in got)
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == brute(rows)
    for r in got:
        if r.record_type == "response":
            assert len(r.payload) == r.payload_bytes and base64.b32encode(hashlib.sha1(r.payload).digest()).decode() == r.payload_digest
    assert len({r.record_id for r in got}) == len(got)


def test_small_payloads_are_all_responses(spark):
    docs = spark.createDataFrame([(1, "a", "xx"), (2, "a", "xx"), (3, "a", "longer"), (4, "a", "longer")], PAGES)
    got = warc.read_archives(spark, warc.write_archives(docs, min_bytes=3)).collect()
    assert sorted((r.page_id, r.record_type) for r in got) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def test_cut_file_and_changed_byte(spark, tmp_path):
    docs = spark.createDataFrame([(i, "u", f"page {i} " * 5) for i in range(9)], PAGES).coalesce(1)
    path = warc.write_archives(docs, f"{tmp_path}/a")
    (file,) = (tmp_path / "a").glob("part-*")
    raw = file.read_bytes().replace(b"page 3 page 3", b"page 3 pagE 3")
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "cut.warc").write_bytes(raw[:-60])
    got = warc.read_archives(spark, f"{tmp_path}/b").collect()
    assert sorted((r.page_id, r.intact) for r in got) == [(i, i != 3) for i in range(8)]


def test_empty_table(spark):
    assert warc.read_archives(spark, warc.write_archives(spark.createDataFrame([], PAGES))).collect() == []
