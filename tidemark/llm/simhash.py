"""SimHash near-duplicates by a self-join of a binary trie.

Fingerprints come from Arrow batches.  The distinct ones form a binary trie;
the join walks pairs of nodes from the root down, adds a bit to a pair's error
where its two children differ, and drops a pair once its error is over the
budget.  To deal the walk out, the trie is built over each of four rotations of
the bits and only nodes equal in their first quarter start: two fingerprints
that differ in at most three bits agree in one quarter.  A quarter held by many
fingerprints is dealt out further, to pairs of deeper nodes within the budget.

A task returns a spanning forest of its links, not the links; connected
components over all forests give the classes.

Defined results: null and empty texts, and texts of white space, have
fingerprint zero and link like any other; repeated rows each give a row; a null
id belongs to its text's class but never names it while the class has another.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.tables import map_texts, numbered, partitions_for, small, stored, text_of

WORDS = 3
MAX_BITS = 3
QUARTER = 16
NODE_SIZE = 1024  # fingerprints of a starting node; above it the node's pairs are dealt out
PAIRS_AT_ONCE = 1 << 20


def fingerprint(text: str, words: int = WORDS) -> int:
    """64-bit SimHash of the word shingles: A-Z lowered, split at ASCII white space."""
    parts = text.encode().lower().split()
    if not parts:
        return 0
    whole = b" ".join(parts)
    ends = list(accumulate((len(p) + 1 for p in parts), initial=-1))
    n = max(1, len(parts) - words + 1)
    digest = xxhash.xxh64_intdigest
    if n == 1:
        return digest(whole, 42)
    counts, k = np.zeros(64, np.int64), ends[words:]
    for at in range(0, n, 1 << 16):  # long texts in pieces
        hashes = np.fromiter((digest(whole[s + 1 : e], 42) for s, e in zip(ends[at : min(n, at + (1 << 16))], k[at:])), np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, keep: tuple[str, ...], text: str = "text", words: int = WORDS) -> DataFrame:
    """The ``keep`` columns and ``fp`` (the 64 bits as a bigint)."""
    source = docs.select(*keep, text_of(text).alias("__text"))
    schema = ", ".join([f"`{c}` {t}" for c, t in source.dtypes if c != "__text"] + ["fp bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = np.array([fingerprint(x, words) for x in batch.column("__text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(found.view(np.int64))], names=[*keep, "fp"])

    return map_texts(source, run, schema)


def _walk(values: np.ndarray, depth: int, a: np.ndarray, b: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of pairs of ``values`` (sorted, distinct) within ``budget`` bits,
    below the pairs of nodes a, b (prefixes of ``depth`` bits)."""
    shift = np.uint64(64 - depth)
    prefixes = values >> shift
    state = [np.searchsorted(prefixes, x, s) for x in (a, b) for s in ("left", "right")]
    state = (*state, np.bitwise_count(a ^ b).astype(np.int8))
    ones: dict[int, np.ndarray] = {}
    stack = [(depth, state)]
    while stack:
        at, state = stack.pop()
        al, ah, bl, bh, error = state
        alone = (ah - al == 1) & (bh - bl == 1)
        i, j = al[alone], bl[alone]
        near = (i != j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
        if near.any():
            yield i[near], j[near]
        state = [x[~alone] for x in state]
        if not len(state[0]) or at == 64:
            continue
        if len(state[0]) > PAIRS_AT_ONCE:
            half = len(state[0]) // 2
            stack += [(at, [x[:half] for x in state]), (at, [x[half:] for x in state])]
            continue
        al, ah, bl, bh, error = state
        if at not in ones:
            ones[at] = np.concatenate([[0], np.cumsum((values >> np.uint64(63 - at)) & np.uint64(1)).astype(np.int64)])
        count = ones[at]
        am, bm = ah - (count[ah] - count[al]), bh - (count[bh] - count[bl])
        same = (al == bl) & (ah == bh)
        children = []
        for x, y, cost in (((al, am), (bl, bm), 0), ((am, ah), (bm, bh), 0), ((al, am), (bm, bh), 1), ((am, ah), (bl, bm), 1)):
            live = (x[1] > x[0]) & (y[1] > y[0]) & (error + cost <= budget)
            if x[0] is am and cost:
                live &= ~same  # a node with itself: one of the two crossings is enough
            children.append([x[0][live], x[1][live], y[0][live], y[1][live], error[live] + np.int8(cost)])
        stack.append((at + 1, [np.concatenate(x) for x in zip(*children, strict=True)]))


def _join_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the classes of i and j in ``labels`` (index of each one's least member)."""
    while True:
        x, y = labels[i], labels[j]
        apart = x != y
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        x, y = x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def _forest(budget: int):
    """Arrow map: all rows of a partition (r, v, depth, lo, hi) to edges (r, a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        col = {c: table.column(c).to_numpy() for c in table.column_names}
        values = col["v"].view(np.uint64)
        for r in np.unique(col["r"]):
            mine = col["r"] == r
            sorted_values = np.unique(values[mine])
            labels = np.arange(len(sorted_values))
            for depth in np.unique(col["depth"][mine]):
                at = mine & (col["depth"] == depth)
                starts = np.unique(np.stack([col["lo"][at], col["hi"][at]]), axis=1).view(np.uint64)
                for i, j in _walk(sorted_values, int(depth), starts[0], starts[1], budget):
                    _join_labels(labels, i, j)
            moved = np.flatnonzero(labels != np.arange(len(labels)))
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(moved), r, np.int32)), pa.array(sorted_values[moved].view(np.int64)),
                                                  pa.array(sorted_values[labels[moved]].view(np.int64))], names=["r", "a", "b"])

    return run


def _turn(v: str, left: str) -> str:
    """SQL: the 64 bits of ``v`` turned left by ``left`` bits (0 to 63)."""
    return f"if({left} = 0, {v}, shiftleft({v}, {left}) | shiftrightunsigned({v}, 64 - {left}))"


def links(fps: DataFrame, budget: int = MAX_BITS, node_size: int = NODE_SIZE) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of distinct ``fp``
    within ``budget`` bits (at most 3)."""
    if not 0 <= budget <= 3:
        raise ValueError("four quarters serve up to three differing bits")
    turned = fps.select(F.explode(F.sequence(F.lit(0), F.lit(3))).alias("r"), "fp").select(
        "r", F.expr(_turn("fp", "r * 16")).alias("v")).withColumn("top", F.expr("shiftrightunsigned(v, 48)"))
    large = turned.groupBy("r", "top").count().where(F.col("count") > node_size)
    large = stored(large.select("r", "top", F.least(F.ceil(F.log2(F.col("count") / node_size)) + 1, F.lit(12)).cast("int").alias("more")), "large-nodes")
    dealt = turned.join(large, ["r", "top"], "left").withColumn("more", F.coalesce("more", F.lit(0)))
    dealt = dealt.withColumn("own", F.expr("shiftrightunsigned(v, 48 - more)"))
    partners = F.expr(f"if(more = 0, array(0L), filter(sequence(0L, shiftleft(1L, more) - 1), x -> bit_count(x) <= {budget}))")
    dealt = dealt.select("r", "v", (F.col("more") + QUARTER).alias("depth"), "own", F.explode(partners).alias("mask"))
    dealt = dealt.select("r", "v", "depth", F.expr("least(own, own ^ mask)").alias("lo"), F.expr("greatest(own, own ^ mask)").alias("hi"))
    spark = fps.sparkSession
    forests = dealt.repartition(partitions_for(spark), "r", "lo", "hi").mapInArrow(_forest(budget), "r int, a bigint, b bigint")
    return forests.select(*(F.expr(_turn(c, "((4 - r) % 4) * 16")).alias(c) for c in ("a", "b")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", row: str | None = None,
                    words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Per row of ``docs``: the id, ``fingerprint`` (16 hex digits), ``component_id``
    (least id reachable); with ``row`` also that and ``kept`` (one row per class,
    that of the least id)."""
    source = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"), *([row] if row else []))
    found = stored(fingerprints(source, ("__id", *([row] if row else [])), "__text", words), "fingerprints")
    first = F.min(F.struct(F.col("__id").isNull().alias("last"), "__id", *([F.col(row).alias("row")] if row else [])))
    fps = stored(found.groupBy("fp").agg(first.alias("first")), "distinct-fingerprints")
    roots = stored(components(stored(links(fps.select("fp"), max_bits), "links")), "roots")
    classes = fps.join(roots, fps.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    least = stored(classes.groupBy("root").agg(F.min("first").alias("first")), "classes")
    classes = stored(classes.select("fp", "root").join(least, "root").select("fp", "first"), "class-of")
    out = found.join(classes, "fp")
    columns = [F.col("__id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first.__id").alias("component_id")]
    return out.select(*columns, *([F.col(row), (F.col("first.row") == F.col(row)).alias("kept")] if row else []))


def op4(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class of near-duplicates the row with the least doc_id stays."""
    rows, row = numbered(docs, "near")
    gone = stored(near_duplicates(rows, row=row).where("not kept").select(row), "gone")
    return rows.join(gone, row, "left_anti").select(*docs.columns)
