"""Language-model scores by stupid backoff over the corpus's own n-gram counts.

The words of a text are scored by the longest n-gram that ends in them and whose
count reaches the cutoff: its count over that of its context; each order given
up costs a factor.  A single word is scored by its count over that of all words.

The tables do not fit anywhere whole, so they are parted by ranges of the n-gram hash:

1. Rows are dealt to chunks of up to 4,096 consecutive ones and 24 MB.  A chunk explodes into its
   distinct n-grams with their counts in it (so a frequent n-gram costs one entry
   a chunk, not one a row) and sends each to the part of its hash.
2. A part, which is the n-grams of some 4 MB of text however many there are, sums the
   counts of its hashes over all chunks and joins the sums back to the entries.
3. The sums return to their chunk, where every row's scores are summed.

N-grams are told apart by 64-bit hashes.  Defined results: null and empty texts
have no words, score 0 and no mean; repeated rows each count and each give a row;
null ids are kept; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import map_texts, partitions_for, small, text_of

ORDER = 3
FACTOR = 0.4
CUTOFF = 2  # an n-gram of two or more words met less often is not in the tables
CHUNK_BITS = 12
CHUNK_BYTES = 24 << 20  # of rows; a longer text is a chunk of its own
ENTRY_BYTES = 32 << 20  # text whose n-grams share one partition
PART_BYTES = 4 << 20  # text whose n-grams are summed at once
_HEAD = struct.Struct("<BQ")


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text.
    A-Z are lowered; words end at ASCII white space."""
    parts, lengths = [], []
    for text in texts:
        words = text.encode().lower().split()
        lengths.append(len(words))
        parts.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
    return np.concatenate(parts) if parts else np.empty(0, np.uint64), np.array(lengths, np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngrams(words: np.ndarray, lengths: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 to ``order``: the hash of the n words that end at each word; of
    fewer where the text begins (see ``_depth``)."""
    out = [_mixed(words)]
    for n in range(2, order + 1):
        before = np.concatenate([np.zeros(1, np.uint64), out[-1]])[: len(words)]
        out.append(_mixed(before * np.uint64(0x9E3779B97F4A7C15) + words + np.uint64(n)))
    return out


def _depth(lengths: np.ndarray) -> np.ndarray:
    """How many words of its text end at each word, itself included."""
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.arange(lengths.sum()) - starts + 1


def _used(texts: list[str], order: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The hashes of all n-grams of a chunk, shortest first, per order the words that end one, and the texts' lengths."""
    words, lengths = _tokens(texts)
    depth = _depth(lengths)
    ends = [np.flatnonzero(depth >= n) for n in range(1, order + 1)]
    return np.concatenate([g[at] for g, at in zip(ngrams(words, lengths, order), ends)]), ends, lengths


def _firsts(parts: int) -> np.ndarray:
    """The smallest hash of each part: parts are equal ranges of the hashes."""
    step = -(-(1 << 64) // parts)
    return np.array([i * step for i in range(parts)], np.uint64)


def _cuts(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where each part begins in ascending hashes, and their number."""
    return np.append(np.searchsorted(hashes, firsts), len(hashes))


def _packed(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed planes of their bytes, without the leading planes that are zero throughout."""
    planes = max(1, -(-int(values.max()).bit_length() // 8))
    raw = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()
    return _HEAD.pack(planes, len(values)) + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(raw) -> np.ndarray:
    planes, n = _HEAD.unpack_from(raw)
    out = np.zeros((n, 8), np.uint8)
    out[:, :planes] = np.frombuffer(pa.decompress(raw.slice(_HEAD.size), decompressed_size=planes * n, codec="zstd"), np.uint8).reshape(planes, n).T
    return out.view("<u8").ravel()


def _chunks(most_rows: int, most_bytes: int):
    """Consecutive rows as one compressed value, named by partition and place."""

    def run(batches):
        name, held, rows, size = TaskContext.get().partitionId() << 32, [], 0, 0

        def chunk():
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(pa.Table.from_batches(held).combine_chunks())
            return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["chunk", "body"])

        for batch in small(batches, min(most_rows, 16)):
            if held and (rows + batch.num_rows > most_rows or size + batch.nbytes > most_bytes):
                yield chunk()
                name, held, rows, size = name + 1, [], 0, 0
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
        if held:
            yield chunk()

    return run


def _rows(chunk: pa.Table) -> pa.Table:
    """The rows of a chunk."""
    return pa.ipc.open_stream(chunk.column("body")[0].as_buffer()).read_all()


def _ask(order: int, parts: int):
    def run(key, table):
        used, _, _ = _used(_rows(table).column("text").to_pylist(), order)
        hashes, counts = np.unique(used, return_counts=True)
        firsts = _firsts(parts)
        cuts = _cuts(hashes, firsts)
        rows = [(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        return pa.table({
            "part": pa.array([i for i, _, _ in rows], pa.int64()), "chunk": pa.array([key[0].as_py()] * len(rows), pa.int64()),
            "hashes": pa.array([_packed(np.diff(hashes[a:b], prepend=firsts[i])) for i, a, b in rows], pa.binary()),
            "counts": pa.array([_packed(counts[a:b]) for _, a, b in rows], pa.binary())})

    return run


def _answer(parts: int):
    """Sum each hash's counts over a part's rows; every row gets the sums of its hashes."""

    def run(key, table):
        first = _firsts(parts)[key[0].as_py()]
        hashes = [np.cumsum(_unpacked(x.as_buffer())) + first for x in table.column("hashes")]
        cuts = np.cumsum([0] + [len(h) for h in hashes])
        every = np.concatenate(hashes)
        del hashes
        order = np.argsort(every)
        every = every[order]
        new = np.concatenate([[True], every[1:] != every[:-1]])
        del every
        counts = np.concatenate([_unpacked(x.as_buffer()) for x in table.column("counts")])[order]
        found = np.empty(len(order), np.uint64)
        found[order] = np.add.reduceat(counts, np.flatnonzero(new))[np.cumsum(new) - 1]
        sums = pa.array([_packed(found[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())
        return pa.table([table.column("chunk"), table.column("part"), sums], names=["chunk", "part", "sums"])

    return run


def _score(order: int, parts: int, total: int, factor: float, cutoff: int):
    def run(key, table, answers):
        texts = _rows(table)
        used, ends, lengths = _used(texts.column("text").to_pylist(), order)
        by = np.argsort(used)
        used = used[by]
        new = np.concatenate([[True], used[1:] != used[:-1]]) if len(used) else np.empty(0, bool)
        cuts = _cuts(used[new], _firsts(parts))
        del used
        sums = np.zeros(cuts[-1], np.int64)
        for part, raw in zip(answers.column("part").to_pylist(), answers.column("sums")):
            sums[cuts[part] : cuts[part + 1]] = _unpacked(raw.as_buffer())
        found = np.empty(len(by), np.int64)
        found[by] = sums[np.cumsum(new) - 1]
        rows = np.repeat(np.arange(len(lengths)), lengths)
        own, at = found[: len(rows)], len(rows)  # of the n-grams of one order, 0 where the text began too late
        logs = np.log(own / max(1, total))
        orders = np.ones(len(rows), np.int64)
        longest = np.minimum(_depth(lengths), order)  # words that start a text have no longer n-gram to give up
        for n in range(2, order + 1):
            # The context of the n-gram that ends at a word ends at the word before.
            context = np.concatenate([[0], own])[: len(rows)]
            own = np.zeros(len(rows), np.int64)
            own[ends[n - 1]] = found[at : at + len(ends[n - 1])]
            at += len(ends[n - 1])
            seen = (longest >= n) & (own >= cutoff)
            logs[seen] = np.log(own[seen] / context[seen])
            orders[seen] = n
        logs += np.log(factor) * (longest - orders)
        score = np.bincount(rows, logs, len(lengths)).astype(float)
        backed = np.bincount(rows, orders < longest, len(lengths)).astype(np.int64)
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = pa.array(score / lengths, mask=lengths == 0)
        return pa.table({"id": texts.column("id"), "n_tokens": pa.array(lengths), "n_backoff": pa.array(backed), "log_score": pa.array(score), "mean_log_score": mean})

    return run


def backoff_scores(docs: DataFrame, id_col: str = "doc_id", text: str = "text", order: int = ORDER, factor: float = FACTOR, cutoff: int = CUTOFF,
                   partitions: int | None = None) -> DataFrame:
    """Per row: the id, ``n_tokens``, ``n_backoff`` (words whose longest n-gram was given
    up), ``log_score`` (sum of natural logs) and ``mean_log_score`` (null without words)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), text_of(text).alias("text"))
    n_words = F.size(F.array_remove(F.split("text", "[ \\t-\\r]+"), ""))
    total, size = rows.agg(F.sum(n_words), F.sum(F.octet_length("text"))).first()
    partitions = partitions or max(partitions_for(spark), -(-(size or 0) // ENTRY_BYTES))
    parts = max(partitions, -(-(size or 0) // PART_BYTES))
    # Both readers of the chunks share this one shuffle.
    chunks = map_texts(rows, _chunks(1 << CHUNK_BITS, CHUNK_BYTES), "chunk bigint, body binary").repartition(partitions, "chunk")
    asked = chunks.groupBy("chunk").applyInArrow(_ask(order, parts), "part bigint, chunk bigint, hashes binary, counts binary")
    answered = asked.repartition(partitions, "part").groupBy("part").applyInArrow(_answer(parts), "chunk bigint, part bigint, sums binary")
    kind = dict(rows.dtypes)["id"]
    scored = chunks.groupBy("chunk").cogroup(answered.repartition(partitions, "chunk").groupBy("chunk")).applyInArrow(
        _score(order, parts, total or 0, factor, cutoff), f"id {kind}, n_tokens bigint, n_backoff bigint, log_score double, mean_log_score double")
    return scored.withColumnRenamed("id", id_col)


def op10(spark, sf_dir: str) -> DataFrame:
    scored = backoff_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return scored.select("doc_id", "n_tokens", "n_backoff", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


OP10_SQL = f"""
with d as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
t as (select doc_id, i, w[i] as c, case when i > 1 then w[i - 1] end as b, case when i > 2 then w[i - 2] end as a from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from d)),
uni as (select c, count(*) as n from t group by c),
bi as (select b, c, count(*) as n from t where b is not null group by b, c),
tri as (select a, b, c, count(*) as n from t where a is not null group by a, b, c),
words as (select count(*) as n from t),
s as (select t.doc_id, case when tri.n >= {CUTOFF} then 3 when bi.n >= {CUTOFF} then 2 else 1 end as used, least(t.i, 3) as longest,
             ln(case when tri.n >= {CUTOFF} then tri.n / before2.n when bi.n >= {CUTOFF} then bi.n / before1.n else one.n / words.n end) as l
      from t cross join words join uni one on one.c = t.c left join uni before1 on before1.c = t.b left join bi on bi.b = t.b and bi.c = t.c
             left join bi before2 on before2.b = t.a and before2.c = t.b left join tri on tri.a = t.a and tri.b = t.b and tri.c = t.c)
select d.doc_id, len(d.w) as n_tokens, cast(count(*) filter (s.used < s.longest) as bigint) as n_backoff,
       round(coalesce(sum(s.l + ln({FACTOR}) * (s.longest - s.used)), 0), 4) as log_score,
       round(sum(s.l + ln({FACTOR}) * (s.longest - s.used)) / count(s.l), 6) as mean_log_score
from d left join s on s.doc_id = d.doc_id group by d.doc_id, d.w
"""
