"""Phrase collocation mining by SON partitioning (Savasere, Omiecinski, Navathe).

A phrase is a run of 2 to ``max_words`` words within a piece of a text; pieces end
at ``.,;:!?`` and line breaks, words at spaces and tabs.  Counts are per language.

1. **Mine each shard.**  The partitions of the table are dealt to ``SHARDS`` shards.
   A phrase that occurs ``support`` times in all occurs ``support / SHARDS`` times in
   at least one of them, so that is a shard's support.  Shards are mined level by
   level: one and two words first, then every longer phrase whose two phrases of one
   word less were frequent in some shard.  Phrases are told apart by a hash here,
   which can only add candidates: nothing frequent is missed.
2. **Unite.**  The hashes that are frequent in some shard are the candidates.  They
   travel to the second pass as a bitmap of at most 2 ** ``MAX_BITS`` bits (32 MiB);
   where it is crowded more phrases are counted than need be, and none is lost.
3. **Count.**  The texts are read again, and every phrase the bitmap lets through is
   counted by its words, exactly and over all texts.  The support is applied to
   these counts.

Scores are integer arithmetic in ``decimal(38, 0)``: exact up to counts of 10 ** 15.

Nothing gathers a language or a frequent phrase in one task: slices of a few MB are
counted before the shuffle, tasks again by Spark's partial aggregation, and the
report's rank is taken in ``RANK_PARTS`` parts of a language first.

Defined results: null texts are empty, a null language is ``und``; empty texts add
nothing; repeated rows each count; an empty table gives no rows; further columns are
not read.  Ties rank by count, then by the phrase's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import map_texts, stored

SUPPORT = 10
MAX_WORDS = 3
TOP = 2000
COVERED = 50  # per cent of a phrase's occurrences; a longer phrase with as many replaces it
SHARDS = 4
MAX_BITS = 28
SLICE_BYTES = 4 << 20  # text counted at a time; a longer text is a slice of its own
RANK_PARTS = 256

# What ends a piece, and A-Z to lower case; tab counts as space.
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_PIECE_ENDS + b"\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n" * len(_PIECE_ENDS) + b" abcdefghijklmnopqrstuvwxyz")
_HASH_BITS = 56  # of a candidate's hash; the rest of 64 holds the shard


def _slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, bytes]]:
    """The texts of a partition by language, joined by line breaks to about ``size`` bytes."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, text in zip(batch.column("lang").to_pylist(), texts):
            raw = text.as_py()
            held.setdefault(lang, []).append(raw)
            sizes[lang] = sizes.get(lang, 0) + len(raw)
            if sum(sizes.values()) >= size:
                largest = max(sizes, key=sizes.get)
                sizes.pop(largest)
                yield largest, b"\n".join(held.pop(largest))
    for lang, parts in held.items():
        yield lang, b"\n".join(parts)


def _words(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """The slice's vocabulary and its words as places in it; place 0 ends a piece."""
    names: dict[bytes, int] = {b"\n": 0}
    tokens = text.translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
    ids = np.fromiter((names.setdefault(w, len(names)) for w in tokens), np.int64, len(tokens))
    if b"" in names:
        ids = ids[ids != names[b""]]
    return list(names), ids


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grams(ids: np.ndarray, hashes: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For n = 1 to ``longest``: n, where a phrase of n words starts, and its hash there (0 elsewhere)."""
    inside = ids != 0
    own = hashes[ids]
    whole, h = inside, np.where(inside, _mixed(own), 0).astype(np.uint64)
    yield 1, whole, h
    for n in range(2, longest + 1):
        size = len(ids) - n + 1
        if size <= 0:
            return
        whole = whole[:size] & inside[n - 1 :]
        h = np.where(whole, _mixed(h[:size] * np.uint64(0x9E3779B97F4A7C15) + own[n - 1 :] + np.uint64(n)), 0).astype(np.uint64)
        yield n, whole, h


def _hashes(lang: str, vocabulary: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in vocabulary), np.uint64, len(vocabulary))


class Candidates:
    """Bitmap of hashes; ``has`` may be true for others too, never false for one of them."""

    def __init__(self, bits: int, raw: bytes):
        self.mask, self.raw = np.uint64((1 << bits) - 1), raw

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (np.frombuffer(self.raw, np.uint8)[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _frequent_places(grams, levels: dict[int, Candidates]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, start places, hashes there) of the phrases whose shorter parts are candidates,
    and which are candidates themselves where their level has been mined."""
    before = None
    for n, whole, h in grams:
        fits = whole
        if before is not None and n - 1 in levels:
            fits = whole & before[: len(whole)] & before[1 : len(whole) + 1]
        if n in levels:
            fits = fits & levels[n].has(h)
        before = fits
        at = np.flatnonzero(fits)
        yield n, at, h[at]


def _mine(level: tuple[int, ...], levels, shards: int, size: int):
    """Hash counts of one level of a partition's phrases, slice by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = np.uint64(TaskContext.get().partitionId() % shards) << np.uint64(_HASH_BITS)
        known = {n: c.value for n, c in levels.items()}
        for lang, text in _slices(batches, size):
            vocabulary, ids = _words(text)
            grams = _grams(ids, _hashes(lang, vocabulary), max(level))
            found = [h for n, _, h in _frequent_places(grams, known) if n in level]
            if not found:  # fewer words than the level's phrases
                continue
            keys, counts = np.unique(np.concatenate(found) & np.uint64((1 << _HASH_BITS) - 1), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array((keys | shard).view(np.int64)), pa.array(counts, pa.int64())], names=["h", "c"])
        pa.default_memory_pool().release_unused()

    return run


def _count(longest: int, levels, size: int):
    """Exact counts of the phrases of a slice that are candidates, and of all its words (n = 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {n: c.value for n, c in levels.items()}
        for lang, text in _slices(batches, size):
            vocabulary, ids = _words(text)
            words = pa.array(vocabulary, pa.binary())
            total = int((ids != 0).sum())
            yield _rows(lang, 0, pa.array([""]), np.array([total]))
            for n, at, _ in _frequent_places(_grams(ids, _hashes(lang, vocabulary), longest), known):
                # A phrase of n words as one integer: the rank of its first n - 1 words
                # among those of the slice, and its last word.
                rank = ids[at]
                for i in range(1, n):
                    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64) if i > 1 else rank
                    rank = (rank << np.int64(31)) | ids[at + i]
                _, first, counts = np.unique(rank, return_index=True, return_counts=True)
                parts = [words.take(pa.array(ids[at[first] + i])).cast(pa.string()) for i in range(n)]
                for a in range(0, len(first), 1 << 16):
                    cut = [p.slice(a, 1 << 16) for p in parts]
                    yield _rows(lang, n, pc.binary_join_element_wise(*cut, " ") if n > 1 else cut[0], counts[a : a + (1 << 16)])
        pa.default_memory_pool().release_unused()

    return run


def _rows(lang: str, n: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    size = len(phrases)
    return pa.RecordBatch.from_arrays([pa.array([lang] * size, pa.string()), pa.array(np.full(size, n, np.int32)), phrases, pa.array(counts, pa.int64())],
                                      names=["lang", "n_words", "phrase", "c"])


def _bitmap(candidates: DataFrame) -> Candidates:
    """The candidates' hashes as a bitmap: 16 bits each, at most 2 ** MAX_BITS in all."""
    bits = min(MAX_BITS, max(16, (16 * candidates.count()).bit_length()))
    at = F.col("h").bitwiseAND((1 << bits) - 1)
    blocks = (candidates.select(F.shiftright(at, 15).alias("block"), at.bitwiseAND(0x7FFF).alias("bit"))
              .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap")))
    raw = bytearray(1 << (bits - 3))
    for row in blocks.toLocalIterator():  # at most 2 ** (MAX_BITS - 15) rows of 4 KiB
        raw[row.block * 4096 : (row.block + 1) * 4096] = row.bitmap
    return Candidates(bits, bytes(raw))


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, max_words: int = MAX_WORDS, shards: int = SHARDS,
                     lang: str = "lang", text: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Every word and phrase of up to ``max_words`` words that occurs ``support`` times in its
    language: ``lang``, ``n_words``, ``phrase``, ``f``; and a row with ``n_words`` 0 that counts all words."""
    if not 0 < shards <= 1 << (64 - _HASH_BITS):
        raise ValueError(f"shards must be from 1 to {1 << (64 - _HASH_BITS)}")
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    local = -(-support // shards)  # of support occurrences in so many shards, one shard has as many
    levels: dict = {}
    for level in [(1, 2), *[(n,) for n in range(3, max_words + 1)]]:
        mined = map_texts(rows, _mine(level, levels, shards, slice_bytes), "h bigint, c bigint")
        frequent = (mined.groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= local)
                    .select(F.col("h").bitwiseAND((1 << _HASH_BITS) - 1).alias("h")))
        found = sc.broadcast(_bitmap(stored(frequent, "phrase-candidates")))
        levels = {**levels, **dict.fromkeys(level, found)}
    counted = map_texts(rows, _count(max_words, levels, slice_bytes), "lang string, n_words int, phrase string, c bigint")
    totals = counted.groupBy("lang", "n_words", "phrase").agg(F.sum("c").alias("f"))
    return totals.where((F.col("f") >= support) | (F.col("n_words") == 0))


def collocations(docs: DataFrame, support: int = SUPPORT, max_words: int = MAX_WORDS, covered: int = COVERED, shards: int = SHARDS,
                 lang: str = "lang", text: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Frequent phrases of 2 to ``max_words`` words: ``lang``, ``phrase``, ``n_words``, ``a`` (its
    count), ``l`` and ``r`` (counts of both sides of the cut with the lowest score, the first of equal
    ones), ``n`` (words of the language) and ``score`` = floor(10**6 * a * a / (l * r)).  A phrase that a
    longer frequent one holds is left out where that has ``covered`` per cent of its occurrences."""
    counts = stored(frequent_phrases(docs, support, max_words, shards, lang, text, slice_bytes), "phrase-counts")
    phrases = counts.where("n_words > 1")
    words = F.split("phrase", " ")
    cuts = (phrases.select("lang", "phrase", "n_words", F.col("f").alias("a"), words.alias("w"))
            .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
            .select("lang", "phrase", "n_words", "a", "k", F.concat_ws(" ", F.slice("w", F.lit(1), F.col("k"))).alias("left"),
                    F.concat_ws(" ", F.slice("w", F.col("k") + 1, F.col("n_words") - F.col("k"))).alias("right")))
    sides = counts.where("n_words > 0")
    both = (cuts.join(sides.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
            .join(sides.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]))
    score = F.expr("(cast(1000000 as decimal(7,0)) * (cast(a as decimal(15,0)) * cast(a as decimal(15,0)))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    scored = (both.withColumn("score", score.cast("bigint")).groupBy("lang", "phrase", "n_words", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    inner = F.transform(F.sequence(F.lit(2), F.col("n_words") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.col("n_words") - size + 1), lambda at: F.concat_ws(" ", F.slice("w", at, size))))
    longer = (phrases.where("n_words > 2").select("lang", "n_words", F.col("f").alias("longer"), words.alias("w"))
              .select("lang", "longer", F.explode(F.flatten(inner)).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    totals = counts.where("n_words = 0").select("lang", F.col("f").alias("n"))
    return kept.join(totals, "lang").select("lang", "phrase", "n_words", "a", "cut.l", "cut.r", "n", "cut.score")


def top_collocations(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language by score, count and bytes, with their ``rank``."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = (found.withColumn("__part", part)
             .withColumn("__rank", F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*order))).where(F.col("__rank") <= top))
    ranked = first.drop("__part", "__rank").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top)


def op11(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return top_collocations(collocations(docs)).select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP11_SQL = f"""
with p as (select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
w as (select lang, list_filter(string_split_regex(piece, '[ \\x09]'), lambda x: x <> '') as w from p),
t as (select lang, w, unnest(range(1, len(w) + 1)) as i from w),
g as (select lang, 1 as m, w[i] as phrase from t
      union all select lang, 2, w[i] || ' ' || w[i + 1] from t where i + 1 <= len(w)
      union all select lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] from t where i + 2 <= len(w)),
f as (select lang, m, phrase, count(*) as f from g group by all),
n as (select lang, count(*) as n from t group by lang),
c as (select lang, m, phrase, f as a, string_split(phrase, ' ') as w from f where m > 1 and f >= {SUPPORT}),
cuts as (select c.*, unnest(range(1, m)) as k from c),
s as (select cuts.lang, cuts.m, cuts.phrase, a, k, x.f as l, y.f as r,
             cast((1000000::hugeint * a * a) // (x.f::hugeint * y.f) as bigint) as score
      from cuts join f x on x.lang = cuts.lang and x.phrase = array_to_string(w[1:k], ' ')
                join f y on y.lang = cuts.lang and y.phrase = array_to_string(w[k + 1:cuts.m], ' ')),
lowest as (select lang, m, phrase, a, l, r, score from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
parts as (select lang, a, array_to_string(w[1:2], ' ') as phrase from c where m = 3 union all select lang, a, array_to_string(w[2:3], ' ') from c where m = 3),
longer as (select lang, phrase, max(a) as longer from parts group by all),
kept as (select lowest.* from lowest left join longer using (lang, phrase) where longer is null or 100 * longer < {COVERED} * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept join n using (lang) qualify rank <= {TOP}
"""
