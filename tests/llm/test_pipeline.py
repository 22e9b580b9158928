"""The pipeline against its stages' brute-force versions, one after the other."""

from __future__ import annotations

import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import sentencepiece
from llm import test_blocknames, test_decontaminate, test_simhash
from llm.helpers import DOCS, words

from tidemark.llm import quality, sentencepieces


def tables(tmp_path, spark):
    rng = random.Random(11)
    items = [(i, words(rng, rng.randrange(14, 50))) for i in range(6)]
    texts = [words(rng, rng.randrange(2, 120)) for _ in range(120)]
    texts += texts[:20]
    texts += [t + " tail" for t in texts[20:40]] + [None, "", "  ", words(rng, 4000)]
    texts += [words(rng, 40) + " " + rng.choice(items)[1] + " " + words(rng, 30) for _ in range(12)]
    texts += [" ".join(w + "$$$" for w in words(rng, 60).split()) for _ in range(40)]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, texts[7], None, None, None), (None, "alone here without an id", None, None, None)]
    labels = [(i, 0 if t and "$$$" in t else 1, 0) for i, t in enumerate(texts) if i % 3 != 2]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return rows, labels, items


def accepted(rows, labels):
    """The classifier with plain Python around its features and its fit."""
    first = {}
    for r in rows:
        if r[0] is not None:
            first[r[0]] = min(first.get(r[0], r[1] or ""), r[1] or "")
    learn = sorted({(q, d) for d, q, _ in labels if zlib.crc32(str(d).encode()) % 4 != 2})
    x, y = np.array([quality.features(first[d]) for _, d in learn]), np.array([q for q, _ in learn])
    mean, spread = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = (x - mean) / spread
    w = quality.bradley_terry(z[y == 1], z[y == 0])
    worth = np.sort(z @ w)
    zeros = int((y == 0).sum())
    limit = (worth[zeros - 1] + worth[zeros]) / 2
    return [r for r in rows if (np.array(quality.features(r[1] or "")) - mean) / spread @ w >= limit]


def brute(rows, labels, items):
    rank = lambda i: (i is not None, i or 0)
    rows = accepted(rows, labels)
    best = {t: keep for t, (keep, _) in test_blocknames.brute(rows).items()}
    seen, kept = set(), []
    for r in rows:
        t = r[1] or ""
        if r[0] == best[t] and t not in seen:
            seen.add(t)
            kept.append(r)
    prints = [test_simhash.slow_fingerprint(r[1] or "") for r in kept]
    root = test_simhash.classes(prints)
    least = {}
    for r, p in zip(kept, prints, strict=True):
        key = (r[0] is None, rank(r[0]))
        if root[p] not in least or key < least[root[p]][0]:
            least[root[p]] = (key, r)
    kept = [r for _, r in least.values()]
    bad = {d for d, _ in test_decontaminate.brute(kept, items)}
    return [r for r in kept if r[0] not in bad]


def test_run_against_brute_force(spark, tmp_path):
    rows, labels, items = tables(tmp_path, spark)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    expect = brute(rows, labels, items)
    assert sorted(str((r.doc_id, r.text)) for r in got) == sorted(str(r[:2]) for r in expect)
    assert 60 < len(got) < len(rows) - 60
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert all(list(r.ids) == library.encode(r.text or "", add_bos=True, add_eos=True) for r in got)


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    tables(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "sentencepiece"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).dtypes == docs.dtypes
    last = corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), str(tmp_path))
    assert last.columns == docs.columns + list(sentencepieces.ADDED) and last.collect() == []
