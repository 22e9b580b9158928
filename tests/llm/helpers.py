"""Small documents with the awkward cases every operator must stand."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng: random.Random, n: int, size: int = 400) -> str:
    return " ".join(f"w{rng.randrange(size):03d}" for _ in range(n))


def awkward(seed: int = 7) -> list[tuple]:
    """Copies, near copies, nulls, empty and long texts, repeated rows and ids."""
    rng = random.Random(seed)
    base = [words(rng, rng.randrange(1, 90)) for _ in range(40)]
    texts = base + base[:10] + [base[0]] * 15
    for t in base[:20]:
        parts = t.split()
        parts[rng.randrange(len(parts))] = "changed"
        texts.append(" ".join(parts))
    texts += ["", None, None, " \n\t ", "a", "A", "a b", "a  b", "é ü ß", "😀 x y z", words(rng, 9000), words(rng, 9000)]
    texts += [texts[-1], texts[-2]]
    rows = [(i, t, "en", "src0" if i % 3 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, base[5], None, None, None), (None, base[5], None, None, None), (None, "", None, None, 0), (3, "other", "de", "s", 5)]
    return rows


def frame(spark, rows=None, schema: str = DOCS):
    return spark.createDataFrame(awkward() if rows is None else rows, schema)
