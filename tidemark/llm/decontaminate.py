"""Benchmark decontamination with SimHash windows; DataFrame operations only.

Words are runs of letters and digits, lowered.  Every item is compared with
windows of its own number of words, at every start in a document:

1. A window that is at all similar shares a shingle with its item, so only texts
   with a shingle of some item go on, and of these the windows that hold one.
2. Each window and item has a 64-bit SimHash of its shingles.  Its bits are cut
   into one block more than the radius; fingerprints within the radius agree in
   a block, so joining on the blocks finds all of them.
3. The weighted shingle similarity (shingles with their counts: the sum of the
   lesser counts over that of the greater) of the found pairs decides.

Texts are named by SHA-256, so the copies of a text are searched once.  A counted,
bounded number of item shingles is broadcast, so texts without a hit are never
shuffled; more are joined.  The tables of items are stored, so
Spark broadcasts them only while their size is under its threshold.

Defined results: null or empty texts and items match nothing; an item of fewer
words than a shingle has one shingle, the whole of it; a document shorter than
an item is one window; repeated rows and a null id give the same pairs again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored, text_of

WORDS = 5
SIMILARITY = 0.8
# Similarity 0.8 puts 9.7 of 64 bits at odds on average (sd 2.9); 20 is 3.6 sd above.
RADIUS = 20
BROADCAST = 1_000_000  # item shingles, of 8 bytes each, up to which they are broadcast


def words_of(text: str = "text") -> Column:
    return F.array_remove(F.split(F.lower(text_of(text)), r"[^\p{L}\p{N}]+"), "")


def _shingles(words: str, k: int, of) -> Column:
    """One value for each start of ``k`` words; empty where there are fewer."""
    last = F.size(words) - k
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: of(*(F.get(words, i + j) for j in range(k))))).otherwise(F.array())


def _hashes(words: str, k: int) -> Column:
    return F.when(F.size(words) < k, F.array().cast("array<bigint>")).otherwise(_shingles(words, k, F.xxhash64))


def _items(items: DataFrame, item_id: str, text: str, k: int) -> DataFrame:
    """(item, size, k, words, hashes) of the items that have words."""
    words = items.select(F.col(item_id).alias("item"), words_of(text).alias("words")).where("size(words) > 0")
    words = words.withColumn("size", F.size("words")).withColumn("k", F.least("size", F.lit(k)))
    per_k = [words.where(F.col("k") == j).withColumn("hashes", _hashes("words", j)) for j in range(1, k + 1)]
    return stored(reduce(DataFrame.unionByName, per_k), "items")


def _simhash(exploded: DataFrame, *key: str) -> DataFrame:
    """SimHash of the rows (key, h): a bit is 1 if set in over half of the hashes.
    Two counts go into each sum, 32 bits apart."""
    two = lambda b: F.expr(f"(shiftrightunsigned(h, {b}) & 1L) + shiftleft(shiftrightunsigned(h, {b + 32}) & 1L, 32)")
    sums = exploded.groupBy(*key).agg(F.count("*").alias("n"), *(F.sum(two(b)).alias(f"c{b}") for b in range(32)))
    low = [F.expr(f"if(2 * (c{b} & 4294967295L) > n, shiftleft(1L, {b}), 0L)") for b in range(32)]
    high = [F.expr(f"if(2 * shiftrightunsigned(c{b}, 32) > n, shiftleft(1L, {b + 32}), 0L)") for b in range(32)]
    return sums.select(*key, reduce(Column.bitwiseOR, low + high).alias("fp"))


def _blocks(radius: int) -> Column:
    """(block number, value) for radius + 1 blocks of the 64 bits of ``fp``."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    parts = [F.struct(F.lit(i).alias("block"), F.expr(f"shiftrightunsigned(fp, {a}) & {(1 << (b - a)) - 1}L").alias("value")) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return F.array(*parts)


def _bag(shingles: str) -> Column:
    """Shingles with their occurrence number, so that a set holds counts."""
    numbered = F.expr(f"transform({shingles}, (x, i) -> concat(x, '#', size(filter(slice({shingles}, 1, i), y -> y = x))))")
    return F.when(F.size(F.array_distinct(shingles)) == F.size(shingles), F.transform(shingles, lambda x: F.concat(x, F.lit("#0")))).otherwise(numbered)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_id: str = "item_id", text: str = "text",
                 words: int = WORDS, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(``key``, item, similarity, start, n_words, n_windows) for every text, named by
    its SHA-256, and item that a window matches; the best window, the first of equals."""
    items = _items(items, item_id, text, words)
    sizes = [r[0] for r in items.select("k").distinct().collect()]  # at most ``words`` numbers
    if not sizes:
        return docs.sparkSession.createDataFrame([], "key string, item bigint, similarity double, start int, n_words int, n_windows bigint")
    known = stored(items.select("k", "size", F.explode("hashes").alias("h")).distinct(), "item-shingles")
    texts = docs.select(F.sha2(text_of(text), 256).alias("key"), words_of(text).alias("words"))
    texts = _with_hits(texts, known, sizes).withColumns({f"h{k}": _hashes("words", k) for k in sizes})
    texts = stored(texts.withColumn("length", F.size("words")), "hit-texts")
    hits = [texts.select("key", F.posexplode(f"h{k}").alias("pos", "h")).withColumn("k", F.lit(k)) for k in sizes]
    hits = reduce(DataFrame.unionByName, hits).join(known, ["k", "h"]).select("key", "size", "k", "pos").distinct()

    # Every window of an item's size that holds one of its shingles.
    start = F.sequence(F.greatest(F.lit(0), F.least(F.col("pos") - (F.col("size") - F.col("k")), F.col("length") - F.col("size"))),
                       F.greatest(F.lit(0), F.least(F.col("pos"), F.col("length") - F.col("size"))))
    windows = hits.join(texts.select("key", "length"), "key").select("key", "size", "k", F.explode(start).alias("start")).distinct()
    windows = stored(windows, "windows")
    prints = []
    for k in sizes:
        own = texts.select("key", F.col(f"h{k}").alias("hashes"))
        cut = windows.where(F.col("k") == k).join(own, "key").select("key", "size", "start", F.explode(F.expr(f"slice(hashes, start + 1, size - {k} + 1)")).alias("h"))
        prints.append(_simhash(cut, "key", "size", "start"))
    prints = reduce(DataFrame.unionByName, prints)
    index = _simhash(items.select("item", "size", F.explode("hashes").alias("h")), "item", "size")
    index = stored(index.withColumn("b", F.explode(_blocks(radius))).select("item", "size", F.col("fp").alias("item_fp"), "b.*"), "item-blocks")
    found = prints.withColumn("b", F.explode(_blocks(radius))).select("key", "size", "start", "fp", "b.*").join(index, ["size", "block", "value"])
    found = found.where(F.expr(f"bit_count(fp ^ item_fp) <= {radius}")).select("key", "start", "item").distinct()

    # No more shingles can be shared than those that are not known to be missing.  What
    # this leaves is stored, or else Spark would join the exact test to the same filter.
    near = []
    for k in sizes:
        pairs = found.join(items.where(F.col("k") == k).select("item", "size", F.col("hashes").alias("theirs")), "item").join(texts.select("key", F.col(f"h{k}").alias("hashes")), "key")
        pairs = pairs.withColumn("ours", F.expr(f"slice(hashes, start + 1, size - {k} + 1)"))
        most = F.size("ours") - F.size(F.array_except("ours", "theirs"))
        near.append(pairs.where(most >= similarity * (F.size("ours") + F.size("theirs") - most)).select("key", "start", "item"))
    near = stored(reduce(DataFrame.unionByName, near), "near")

    matches = []
    for k in sizes:
        pairs = near.join(items.where(F.col("k") == k).select("item", "size", F.col("words").alias("item_words")), "item").join(texts.select("key", "words"), "key")
        text_shingles = lambda c: _shingles(c, k, lambda *w: F.concat_ws(" ", *w))  # noqa: E731, B023
        pairs = pairs.withColumn("window", F.expr("slice(words, start + 1, size)")).withColumns({"ours": text_shingles("window"), "theirs": text_shingles("item_words")})
        pairs = pairs.select("key", "item", "start", F.col("size").alias("n_words"), _bag("ours").alias("ours"), _bag("theirs").alias("theirs"))
        both = F.size(F.array_intersect("ours", "theirs"))
        pairs = pairs.withColumn("similarity", both / (F.size("ours") + F.size("theirs") - both))
        matches.append(pairs.where(F.col("similarity") >= similarity).select("key", "item", "start", "n_words", "similarity"))
    best = reduce(DataFrame.unionByName, matches).groupBy("key", "item").agg(F.max(F.struct("similarity", -F.col("start"), "n_words")).alias("b"), F.count("*").alias("n_windows"))
    return best.select("key", "item", "b.similarity", (-F.col("b.col2")).alias("start"), "b.n_words", "n_windows")


def _with_hits(texts: DataFrame, known: DataFrame, sizes: list[int]) -> DataFrame:
    """The different texts (key, words) that hold a shingle of some item.

    Up to ``BROADCAST`` shingles are broadcast: a text's hits then collapse to one row
    where it is read, and only texts with a hit are shuffled.  With more, the keys of
    texts with a hit are found first and joined with the texts.
    """
    per_k = {k: known.where(F.col("k") == k).select("h").distinct() for k in sizes}
    if sum(x.count() for x in per_k.values()) <= BROADCAST:
        found = [texts.select("key", "words", F.explode(_hashes("words", k)).alias("h")).join(F.broadcast(per_k[k]), "h", "left_semi") for k in sizes]
        found = reduce(DataFrame.unionByName, found).select("key", "words")
    else:
        keys = [texts.select("key", F.explode(_hashes("words", k)).alias("h")).join(per_k[k], "h", "left_semi").select("key") for k in sizes]
        found = texts.join(stored(reduce(DataFrame.unionByName, keys).distinct(), "hit-keys"), "key", "left_semi")
    return stored(found.groupBy("key").agg(F.first("words").alias("words")), "hit-words")


def decontaminate(docs: DataFrame, matches: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text has a match."""
    name = "__key" + "_" * max(map(len, docs.columns))
    return docs.join(matches.select(F.col("key").alias(name)).distinct(), F.sha2(text_of(text), 256) == F.col(name), "left_anti")


def op9(spark, sf_dir: str) -> DataFrame:
    """A row per document and benchmark item it holds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    matches = stored(contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "matches")
    found = docs.select("doc_id", F.sha2(text_of(), 256).alias("key")).join(matches, "key")
    return found.select("doc_id", F.col("item").alias("item_id"), "similarity", "start", "n_words", "n_windows")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go."""
    matches = stored(contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "matches")
    return decontaminate(docs, matches)
