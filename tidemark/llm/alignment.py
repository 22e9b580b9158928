"""Cross-tokenizer alignment by diagonal run skipping.

Two vocabularies cut the same bytes; the byte offsets where tokens of both end part
the tokens into groups.  The end offsets of both sides are ascending arrays.  At the
current shift between their places, blocks of 1, 2, 4 ... ends are compared until one
differs, and the block that differs is halved to the last equal end: a stretch of
one-to-one groups costs a logarithm of its length in comparisons.  Behind it lies an
irregular group; its sides are advanced by whichever ends first until both end
together, which gives the shift to go on with.

A group's last tokens end together: a link.  How often the corpus links a pair of ids
is counted in Spark: chunks of documents send their distinct pairs with their counts,
the sums return to the chunks that asked, and each document adds up its own.  A pair
that every document holds costs one row a chunk.

Defined results: null and empty texts, and texts whose tokens do not give their bytes
back, have no tokens: zeros and an empty digest; repeated rows each count and each
give a row; null ids are kept; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import wordwise
from tidemark.llm.sentencepieces import MARK
from tidemark.llm.tables import map_texts, small, stored, text_of

KEPT_WORDS = 600_000  # words a worker has met; those not met again while as many others were are dropped
PROBE = 4  # ends in the first block that is compared
CHUNK_ROWS = 1024
CHUNK_BYTES = 4 << 20  # of text; a longer text is a chunk of its own
_OWN = {"n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "groups_sha256": "string"}
_LISTS = {"a_ids": "array<int>", "b_ids": "array<int>", "a_until": "array<int>", "b_until": "array<int>"}


_STEM = re.compile(r"( [A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]{1,3})")
Stretch = tuple[int, int, int, int, int]  # see ``stretches``


def stretches(a: list[int], b: list[int]) -> list[Stretch]:
    """(i, j, run, x, y): from tokens i of A and j of B on ``run`` one-to-one groups, then an
    irregular group of x tokens of A and y of B (0 and 0 at the end).

    ``a`` and ``b`` are the sides' ascending end offsets; the last ones are equal.
    """
    out: list[Stretch] = []
    i = j = 0
    n = len(a)
    while i < n:
        run, step = 0, PROBE
        while True:
            block = a[i + run : i + run + step]
            if not block or block != b[j + run : j + run + step]:
                break
            run += len(block)
            step += step
        while step > 1:
            step >>= 1
            block = a[i + run : i + run + step]
            if block and block == b[j + run : j + run + step]:
                run += len(block)
        k, m = i + run, j + run
        if k >= n:
            out.append((i, j, run, 0, 0))
            break
        x, y = a[k], b[m]
        while x != y:
            if x < y:
                k += 1
                x = a[k]
            else:
                m += 1
                y = b[m]
        out.append((i, j, run, k + 1 - i - run, m + 1 - j - run))
        i, j = k + 1, m + 1
    return out


def group_ends(found: list[Stretch], tokens: int, side: int) -> np.ndarray:
    """Places of the tokens of a side (0: A, 1: B) that end a group."""
    ends = np.ones(tokens, bool)
    for s in found:
        if s[3 + side] > 1:
            at = s[side] + s[2]
            ends[at : at + s[3 + side] - 1] = False
    return np.flatnonzero(ends)


def digest_of(a: list[str], b: list[str], found: list[Stretch]) -> str:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3``, the groups in order; '' without tokens.
    ``a`` are the ids of A with a bar behind each, ``b`` those of B with a semicolon."""
    if not found:
        return ""
    parts: list[str] = []
    for i, j, run, x, y in found:
        k, m = i + run, j + run
        pairs = [""] * (2 * run)
        pairs[::2], pairs[1::2] = a[i:k], b[j:m]
        parts += pairs
        if x:
            parts += [s[:-1] + "," for s in a[k : k + x - 1]]
            parts.append(a[k + x - 1])
            parts += [s[:-1] + "," for s in b[m : m + y - 1]]
            parts.append(b[m + y - 1])
    return hashlib.sha256("".join(parts)[:-1].encode()).hexdigest()


def piece_tokens(library) -> list[bytes]:
    """The bytes of every id of a SentencePiece vocabulary: marks are spaces, byte pieces their byte."""
    return [bytes([int(library.id_to_piece(i)[3:5], 16)]) if library.is_byte(i) else library.id_to_piece(i).replace(MARK, " ").encode()
            for i in range(library.get_piece_size())]


class Aligner:
    """Both encoders of a worker and the bytes of their ids."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = wordwise.load(a_path, wordwise.ByteWords)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        if any(MARK in self.b.id_to_piece(i).lstrip(MARK) for i in range(self.b.get_piece_size())):
            raise ValueError("pieces cross word starts; words cannot be encoded on their own")
        self.a_bytes, self.b_bytes = self.a.token_bytes, piece_tokens(self.b)
        self.a_sizes = self.a.sizes
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_shown, self.b_shown = [f"{i}|" for i in range(len(self.a_bytes))], [f"{i};" for i in range(len(self.b_bytes))]
        # Pairs of ids as one number.
        self.width = len(self.b_bytes)
        self.kind = np.dtype("<u4" if len(self.a_bytes) * self.width <= 1 << 32 else "<u8")

        # Words between single spaces met lately: ids of a space and the word by both sides.  False:
        # the word decides nothing on its own, and its text is encoded whole.
        self.known: dict[str, tuple[bytes, bytes] | bool] = {}
        self.older: dict[str, tuple[bytes, bytes] | bool] = {}
        self.tails: dict[str, bytes] = {}  # runs of up to three punctuation marks

    def _same_bytes(self, a: list[int], b: list[int], whole: bytes) -> bool:
        return b"".join(map(self.a_bytes.__getitem__, a)) == whole == b"".join(map(self.b_bytes.__getitem__, b))

    def _new(self, words: list[str]) -> None:
        """Both libraries' ids of a space and each word.

        A space in front of a visible character begins a token on both sides: A's
        pre-token and, as no piece holds its mark behind another character, B's piece.
        """
        plain = [w for w in words if w and not w[0].isspace() and not w[-1].isspace() and MARK not in w and len(w) <= wordwise.KEPT_LENGTH]
        self.known.update(dict.fromkeys(words, False))
        for at in range(0, len(plain), 1 << 14):
            some = plain[at : at + (1 << 14)]
            # A parts letters from the punctuation behind them, so words share their stems.
            parts = [_STEM.fullmatch(" " + w) for w in some]
            stems = dict.fromkeys(m[1] if m else " " + w for w, m in zip(some, parts))
            ids = dict(zip(stems, self.a.joined(list(stems)), strict=True))
            a_ids = [ids[m[1]] + self._tail(m[2]) if m else ids[" " + w] for w, m in zip(some, parts)]
            for w, a, b in zip(some, a_ids, self.b.encode(some, num_threads=1), strict=True):
                if self._same_bytes(np.frombuffer(a, "<u4").tolist(), b, b" " + w.encode()):
                    self.known[w] = (a, np.array(b, "<u4").tobytes())

    def _tail(self, marks: str) -> bytes:
        if marks not in self.tails:
            self.tails[marks] = self.a.ids(marks).tobytes()
        return self.tails[marks]

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per text the ids of A over a space and the text, and of B; none if they do not give its bytes."""
        known, older = self.known, self.older
        cuts = [x.split(" ") for x in texts]
        fresh = list(dict.fromkeys(w for c in cuts for w in c if w not in known))
        known.update((w, older[w]) for w in fresh if w in older)
        self._new([w for w in fresh if w not in known])
        none = np.empty(0, "<u4")
        for text, cut in zip(texts, cuts):
            found = list(map(known.__getitem__, cut))
            if text and False not in found:
                yield np.frombuffer(b"".join([x[0] for x in found]), "<u4"), np.frombuffer(b"".join([x[1] for x in found]), "<u4")
                continue
            a, b = np.frombuffer(self.a.encode([" " + text])[0], "<u4") if text else none, np.array(self.b.encode(text), "<u4")
            whole = self._same_bytes(a.tolist(), b.tolist(), f" {text}".encode())
            yield (a, b) if text and whole else (none, none)
        if len(known) > KEPT_WORDS:
            self.older, self.known = known, {}

    def align(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, list[Stretch]]]:
        """Per text the ids of both sides and their ``stretches``."""
        for a, b in self.encode(texts):
            yield a, b, stretches(np.cumsum(self.a_sizes[a]).tolist(), np.cumsum(self.b_sizes[b]).tolist()) if len(a) else []

    def digest(self, a: np.ndarray, b: np.ndarray, found: list[Stretch]) -> str:
        return digest_of(list(map(self.a_shown.__getitem__, a.tolist())), list(map(self.b_shown.__getitem__, b.tolist())), found)


_LOADED: dict[tuple[str, str], Aligner] = {}


def _loaded(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Aligner(a_path, b_path)
    return _LOADED[a_path, b_path]


def _chunk(key_columns: list[pa.Array], rows: list[tuple], links: list[np.ndarray], name: int, keep, lists: bool) -> pa.RecordBatch:
    """A chunk's documents; the first one carries the chunk's distinct pairs and their counts."""
    pairs, counts = np.unique(np.concatenate(links), return_counts=True)
    asked = pa.StructArray.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(counts.astype(np.int64))], names=["pair", "c"])
    carried = pa.ListArray.from_arrays(pa.array([0] + [len(pairs)] * len(rows), pa.int32()), asked)
    n_a, n_b, groups, digests, *more = zip(*rows)
    columns = [*key_columns, *(pa.array(x, pa.int64()) for x in (n_a, n_b, groups)), pa.array(digests, pa.string())]
    if lists:
        columns += [pa.array(x, pa.list_(pa.int32())) for x in more]
    columns += [pa.array([x.tobytes() for x in links], pa.binary()), carried, pa.array(np.full(len(rows), name, np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=[*keep, *_OWN, *(_LISTS if lists else ()), "__links", "__asked", "__chunk"])


def _align(a_path: str, b_path: str, keep: tuple[str, ...], lists: bool, chunk_rows: int, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _loaded(a_path, b_path)
        name = TaskContext.get().partitionId() << 32
        keys, rows, links, size = [], [], [], 0

        def chunk():
            own = [pa.concat_arrays([k[i] for k in keys]) for i in range(len(keep))]
            return _chunk(own, rows, links, name, keep, lists)

        for batch in small(batches, 32):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            keys.append(batch.columns[:-1])
            for text, (a, b, found) in zip(texts, aligner.align(texts), strict=True):
                ends_a, ends_b = group_ends(found, len(a), 0), group_ends(found, len(b), 1)
                links.append((a[ends_a].astype(np.uint64) * np.uint64(aligner.width) + b[ends_b]).astype(aligner.kind))
                row = (len(a), len(b), len(ends_a), aligner.digest(a, b, found))
                rows.append((*row, a.astype("i4"), b.astype("i4"), (ends_a + 1).astype("i4"), (ends_b + 1).astype("i4")) if lists else row)
                size += len(text)
            if len(rows) >= chunk_rows or size >= chunk_bytes:
                yield chunk()
                keys, rows, links, size = [], [], [], 0
                name += 1
        if rows:
            yield chunk()

    return run


def _sums(names: list[str], kind: str):
    """Each document of a chunk adds up the counts of its links."""

    def run(key, documents, answers):
        pairs = answers.column("pair").to_numpy()
        order = np.argsort(pairs)
        pairs, counts, best = pairs[order], answers.column("links").to_numpy()[order], answers.column("best").to_numpy(zero_copy_only=False)[order]
        own = [np.searchsorted(pairs, np.frombuffer(x.as_buffer(), kind).astype(np.int64)) for x in documents.column("__links")]
        out = documents.select(names)
        out = out.append_column("n_links", pa.array([len(x) for x in own], pa.int64()))
        out = out.append_column("n_best", pa.array([int(best[x].sum()) for x in own], pa.int64()))
        return out.append_column("count_sum", pa.array([int(counts[x].sum()) for x in own], pa.int64()))

    return run


def aligned(docs: DataFrame, a_path: str, b_path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", lists: bool = True,
            chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(documents, links).  Documents: the ``keep`` columns, ``n_a``, ``n_b``, ``n_groups``,
    ``groups_sha256``, ``n_links``, ``n_best`` (links whose count is the highest of their B id),
    ``count_sum`` and, if asked for, the ids of both sides and how many lie before each group's end.
    Links: ``a_id``, ``b_id``, ``links`` (how many the corpus holds) and ``best``.

    ``a_path`` is a byte-level vocabulary, ``b_path`` a SentencePiece model that puts a space first.
    """
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    kind = "<u4" if len(wordwise.ByteWords(a_path).token_bytes) * width <= 1 << 32 else "<u8"
    own = "__text" + "_" * len("".join(keep))
    source = docs.select(*keep, text_of(text).alias(own))
    kept = [f"`{c}` {t}" for c, t in source.dtypes if c != own] + [f"{c} {t}" for c, t in {**_OWN, **(_LISTS if lists else {})}.items()]
    hidden = ["__links binary", "__asked array<struct<pair:bigint,c:bigint>>", "__chunk bigint"]
    # Stored: the texts are encoded once, and chunks keep their names.
    chunks = stored(map_texts(source, _align(a_path, b_path, keep, lists, chunk_rows, chunk_bytes), ", ".join(kept + hidden)), "aligned")
    asked = chunks.select("__chunk", F.explode("__asked").alias("p")).select("__chunk", "p.pair", "p.c")
    counts = stored(asked.groupBy("pair").agg(F.sum("c").alias("links")), "aligned-links")
    b_id = F.pmod("pair", F.lit(width))
    highest = counts.groupBy(b_id.alias("b_id")).agg(F.max("links").alias("highest"))
    links = counts.withColumn("b_id", b_id).join(highest, "b_id").select(
        "pair", F.expr(f"pair div {width}").alias("a_id"), "b_id", "links", (F.col("links") == F.col("highest")).alias("best"))
    answers = asked.select(F.col("__chunk").alias("__to"), "pair").join(links.select("pair", "links", "best"), "pair")
    names = [*keep, *_OWN, *(_LISTS if lists else ())]
    documents = chunks.drop("__asked").groupBy("__chunk").cogroup(answers.groupBy("__to")).applyInArrow(
        _sums(names, kind), ", ".join([*kept, "n_links bigint", "n_best bigint", "count_sum bigint"]))
    return documents, links.drop("pair")


def op13(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    documents, _ = aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), lists=False)
    return documents.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
