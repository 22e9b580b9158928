"""A quality classifier by Bradley-Terry ranking of pairs.

Labels give preferences: a document of label 1 beats one of label 0.  The model
gives every document a worth, linear in features of its whole text, such that
the logistic of the difference of two worths is the chance that the first wins;
it is fitted by Newton steps on the feature differences of the pairs.  The
threshold is a quantile of the worths of all labelled rows that may be learned from, at
the share of label 0 among them, and the score puts it at 0.7.

Fitting the weights uses at most ``SAMPLE`` rows of each label, those first by hash.  The
threshold uses every labelled row at every size: its rank is off by at most one part in
``ACCURACY`` of them.  Every document is scored, in Arrow batches, without a shuffle.

Defined results: null and empty texts have the features of a text without words
and are scored by them; labels without a document, and null labels, are passed
over; with no row of one of the labels every document scores 0.7; of several
texts under one labelled id the least is learned from; repeated rows each give a
row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import map_texts, small, text_of

SAMPLE = 10_000  # labelled rows of each label that the fit may use
PAIRINGS = 8  # pairs in which each row of the larger class takes part
PENALTY = 1e-3
ACCEPT = 0.7
ACCURACY = 100_000  # the threshold's rank among the labelled rows is exact to one part in so many
STRONG = np.frombuffer(b"#$%&*+<=>@[\\]^_`{|}~!", np.uint8)


def features(text: str) -> list[float]:
    """Shares of kinds of characters, words and lines (small shares lifted by a root)."""
    raw = np.frombuffer(text.encode(), np.uint8)
    counts = np.bincount(raw, minlength=256)
    n = max(1, len(raw))
    words = text.split()
    many = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    caps = sum(map(str.isupper, words))
    same = sum(a == b for a, b in pairwise(words))
    ends = len(re.findall(r"[^\w\s.,;:]\B", text))
    return [
        (counts[STRONG].sum() / n) ** 0.5,
        (ends / many) ** 0.5,
        (counts[65:91].sum() / n) ** 0.5,
        caps / many,
        (same / many) ** 0.5,
        len(set(words)) / many if words else 1.0,
        len(set(lines)) / max(1, len(lines)) if lines else 1.0,
        sum(map(len, words)) / many / 10,
        counts[48:58].sum() / n,
        counts[33] / n,
        np.log1p(len(words)) / 10,
    ]


def _feature_rows(docs: DataFrame, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    source = docs.select(*keep, text_of(text).alias("__text"))
    schema = ", ".join([f"`{c}` {t}" for c, t in source.dtypes if c != "__text"] + ["features array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = pa.array([features(x) for x in batch.column("__text").to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), found], names=[*keep, "features"])

    return map_texts(source, run, schema)


def bradley_terry(better: np.ndarray, worse: np.ndarray, penalty: float = PENALTY, steps: int = 60) -> np.ndarray:
    """Weights that minimise the mean of log(1 + exp(-w (better - worse))) over pairs
    of rows, each row of the larger side in ``PAIRINGS`` of them, plus the penalty."""
    size = max(len(better), len(worse))
    rng = np.random.default_rng(0)
    sides = [[rng.permutation(np.resize(np.arange(len(x)), size)) for _ in range(PAIRINGS)] for x in (better, worse)]
    gap = better[np.concatenate(sides[0])] - worse[np.concatenate(sides[1])]

    def loss(w):
        return np.logaddexp(0, -(gap @ w)).mean() + penalty * w @ w / 2

    w = np.zeros(gap.shape[1])
    for _ in range(steps):
        lost = 1 / (1 + np.exp(np.clip(gap @ w, -500, 500)))
        slope = -(gap * lost[:, None]).mean(0) + penalty * w
        curve = (gap * (lost * (1 - lost))[:, None]).T @ gap / len(gap) + penalty * np.eye(len(w))
        step, rate = np.linalg.solve(curve, slope), 1.0
        while rate > 1e-4 and loss(w - rate * step) > loss(w):
            rate /= 2
        w = w - rate * step
        if np.abs(rate * step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality", text: str = "text", sample: int = SAMPLE) -> tuple[list[float], float]:
    """(weights, offset) of the worth, the threshold taken off; from the rows of
    ``labels`` whose id is not held out.  At most 2 * ``sample`` rows reach the driver."""
    learn = labels.where(F.crc32(F.col(id_col).cast("string")) % 4 != 2).select(F.col(id_col).alias("__id"), F.col(label).cast("int").alias("__label"))
    sides = [learn.where(F.col("__label") == v).distinct().orderBy(F.xxhash64("__id"), "__id").limit(sample) for v in (0, 1)]
    # The sample holds at most 2 * ``sample`` ids and labels, so it may be broadcast.
    texts = docs.select(F.col(id_col).alias("__id"), text_of(text).alias("text")).join(F.broadcast(sides[0].union(sides[1])), "__id")
    texts = texts.groupBy("__id", "__label").agg(F.min("text").alias("text"))
    rows = sorted((r["__label"], r["__id"], r["features"]) for r in _feature_rows(texts, ("__id", "__label")).collect())
    x, y = np.array([r[2] for r in rows]), np.array([r[0] for r in rows])
    if len(set(y.tolist())) < 2:
        return [0.0] * len(features("")), 0.0
    mean, spread = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = (x - mean) / spread
    w = bradley_terry(z[y == 1], z[y == 0])
    weights = (w / spread).tolist()
    worths = _worths(docs.select(F.col(id_col).alias("__id"), text_of(text).alias("text")), weights, ("__id",))
    judged = worths.join(learn.where(F.col("__label").isin(0, 1)).distinct(), "__id").groupBy("__id", "__label").agg(F.min("worth").alias("worth"))
    low = judged.agg(F.avg((F.col("__label") == 0).cast("double"))).first()[0]
    threshold = judged.agg(F.percentile_approx("worth", F.lit(low), ACCURACY)).first()[0]
    above = judged.where(F.col("worth") > threshold).agg(F.min("worth")).first()[0]
    return weights, -float(threshold if above is None else (threshold + above) / 2)


def _worths(docs: DataFrame, weights: list[float], keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """The ``keep`` columns and each text's worth, before a threshold is taken off."""
    rows = _feature_rows(docs, keep, text)
    return rows.select(*keep, F.aggregate(F.zip_with("features", F.array(*map(F.lit, weights)), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b).alias("worth"))


def scored(docs: DataFrame, model: tuple[list[float], float], keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """The ``keep`` columns, ``score`` (0 to 1; 0.7 at the threshold) and ``predicted``."""
    weights, offset = np.array(model[0]), model[1] + float(np.log(ACCEPT / (1 - ACCEPT)))
    own_text = "__text" + "_" * len("".join(keep))
    source = docs.select(*keep, text_of(text).alias(own_text))
    schema = ", ".join([f"`{c}` {t}" for c, t in source.dtypes if c != own_text] + ["score double", "predicted int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            x = np.array([features(t) for t in batch.column(own_text).to_pylist()]).reshape(-1, len(weights))
            score = 1 / (1 + np.exp(-np.clip(x @ weights + offset, -500, 500)))
            # A worth at the threshold scores 0.7 exactly, however the logistic rounds.
            score = np.where(np.isclose(score, ACCEPT, rtol=0, atol=1e-12), ACCEPT, score)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(score), pa.array((score >= ACCEPT).astype("i4"))], names=[*keep, "score", "predicted"])

    return map_texts(source, run, schema)


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out")
    return scored(docs, model, ("doc_id",)).select("doc_id", held_out, "score", "predicted")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents predicted to be of low quality go."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    keep = tuple(docs.columns)
    clash = {c: f"__doc_{c}" for c in keep if c in ("score", "predicted")}
    inner = docs.withColumnsRenamed(clash)
    return scored(inner, model, tuple(inner.columns)).where("predicted = 1").drop("score", "predicted").withColumnsRenamed({v: k for k, v in clash.items()})
