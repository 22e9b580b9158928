"""Packing of documents into fixed windows: bounded-space online best fit.

Every partition keeps at most ``OPEN`` windows open.  A document gives full windows
while it is longer than one; what is left goes to the open window it fits best, or
to a new one.  Where ``OPEN`` are open and none fits, the fullest is emitted: a gap
of up to ``SLACK`` tokens is padded, a larger one is filled with the head of the
document, and its tail is placed in the same way.  A window that is full is emitted.

The windows still open at the end of a partition are merged: their pieces are packed
again, best fit from the longest, by ``FAN`` partitions at a time, then by ``FAN`` of
these groups, until one group is left.  A group passes on its ``OPEN`` emptiest windows,
so a task holds ``FAN * OPEN`` windows at most, whatever the table's size.

Defined results: a null text is an empty one, whose only token is the end token;
repeated rows and ids are documents of their own; null ids are kept; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import wordwise
from tidemark.llm.tables import map_texts, small, stored, text_of

CAPACITY = 2048
OPEN = 64
SLACK = 8
FAN = 16
_ROUND, _GROUP = 56, 24  # bits of a sequence id below its round and its group

_MORE = {"start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"}


class Windows:
    """Open windows ordered by free space; ``done`` receives (window id, pieces)."""

    def __init__(self, capacity: int, limit: int | None, first_id: int):
        self.capacity, self.limit, self.next = capacity, limit, first_id
        self.free: list[tuple[int, int]] = []  # (free, id), ascending
        self.held: dict[int, list] = {}
        self.done: list[tuple[int, list]] = []

    def emit(self, at: int) -> None:
        _, name = self.free.pop(at)
        self.done.append((name, self.held.pop(name)))

    def put(self, at: int, piece, length: int) -> None:
        """Place a piece in the window at this place of the order."""
        space, name = self.free.pop(at)
        self.held[name].append((piece, self.capacity - space))
        place = (space - length, name)
        insort(self.free, place)
        if space == length:
            self.emit(bisect_left(self.free, place))

    def open(self) -> int:
        self.held[self.next] = []
        self.free.append((self.capacity, self.next))
        self.next += 1
        return len(self.free) - 1

    def best(self, length: int) -> int | None:
        """The fullest window with so much space."""
        at = bisect_left(self.free, (length, -1))
        return at if at < len(self.free) else None

    def full(self) -> bool:
        return self.limit is not None and len(self.free) >= self.limit


def _place(windows: Windows, key: tuple, raw: bytes, slack: int) -> None:
    """Place a document's ids, four bytes each; a piece is (key, tokens of the document, start, its bytes)."""
    total, start = len(raw) // 4, 0

    def piece(length: int):
        return key, total, start, raw[4 * start : 4 * (start + length)]

    while total - start >= windows.capacity:  # needs no open window
        windows.done.append((windows.next, [(piece(windows.capacity), 0)]))
        windows.next += 1
        start += windows.capacity
    while start < total:
        rest = total - start
        at = windows.best(rest)
        if at is None and windows.full():
            space = windows.free[0][0]
            if space <= slack:
                windows.emit(0)
            else:
                windows.put(0, piece(space), space)
                start += space
                continue
        windows.put(windows.open() if at is None else at, piece(rest), rest)
        start = total


def _packer(encode_path: str, keep: tuple[str, ...], end_id: int, capacity: int, limit: int, slack: int, ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = wordwise.load(encode_path, wordwise.SpacelessWords)
        end = np.array([end_id], "<u4").tobytes()
        windows = Windows(capacity, limit, TaskContext.get().partitionId() << _GROUP)

        def rows(done, still_open: bool) -> pa.RecordBatch:
            pieces = [(*piece, name, offset) for name, held in done for piece, offset in held]
            keys, totals, starts, raw, names, offsets = zip(*pieces)
            numbers = [starts, [len(x) // 4 for x in raw], [zlib.crc32(x) for x in raw], totals, names, offsets]
            columns = [pa.array([k[i] for k in keys], t) for i, t in enumerate(kinds)] + [pa.array(x, pa.int64()) for x in numbers]
            if ids:
                columns.append(pa.array([np.frombuffer(x, "<u4").astype("i4") for x in raw], pa.list_(pa.int32())))
            columns.append(pa.array([still_open] * len(pieces), pa.bool_()))
            return pa.RecordBatch.from_arrays(columns, names=[*keep, *_MORE, *(["ids"] if ids else []), "__open"])

        kinds: list = []
        for batch in small(batches, 64):
            kinds = [batch.schema.field(c).type for c in keep]
            own = list(zip(*(batch.column(c).to_pylist() for c in keep))) if keep else [()] * batch.num_rows
            for key, raw in zip(own, encoder.encode(batch.column(batch.num_columns - 1).to_pylist()), strict=True):
                _place(windows, key, raw + end, slack)
            if windows.done:
                yield rows(windows.done, False)
                windows.done.clear()
        if windows.held:
            yield rows(windows.held.items(), True)

    return run


def _merger(round_: int, capacity: int, limit: int):
    """Pack a group's pieces again; its emptiest windows stay open."""

    def run(key, table):
        windows = Windows(capacity, None, (round_ << _ROUND) | (key[0].as_py() << _GROUP))
        lengths = table.column("length").to_numpy()
        for at in np.lexsort((table.column("offset").to_numpy(), table.column("sequence_id").to_numpy(), -lengths)).tolist():
            length = int(lengths[at])
            place = windows.best(length)
            windows.put(windows.open() if place is None else place, at, length)
        while len(windows.free) > limit:
            windows.emit(0)
        names, offsets, still = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), np.zeros(len(lengths), bool)
        for held, open_ in ((windows.done, False), (windows.held.items(), True)):
            for name, pieces in held:
                for at, offset in pieces:
                    names[at], offsets[at], still[at] = name, offset, open_
        for column, values in (("sequence_id", names), ("offset", offsets), ("__open", still)):
            table = table.set_column(table.schema.get_field_index(column), column, pa.array(values))
        return table.drop_columns(["__group"])

    return run


def packed(docs: DataFrame, tokenizer: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", end_id: int = 1, capacity: int = CAPACITY,
           open_windows: int = OPEN, slack: int = SLACK, fan: int = FAN, ids: bool = True) -> DataFrame:
    """One row per piece: the ``keep`` columns, ``start`` (tokens of its document before it),
    ``length``, ``ids_crc32``, ``doc_tokens`` (end token included), ``sequence_id``, ``offset`` in the
    sequence and, if asked for, ``ids``.  ``tokenizer`` is a vocabulary that drops white space."""
    if not (capacity > 0 and open_windows > 0 and 0 <= slack < capacity and fan > 1):
        raise ValueError("capacity and open_windows must be positive, slack below capacity, fan above 1")
    own = "__text" + "_" * len("".join(keep))
    source = docs.select(*keep, text_of(text).alias(own))
    fields = [f"`{c}` {t}" for c, t in source.dtypes if c != own] + [f"{c} {t}" for c, t in _MORE.items()]
    schema = ", ".join([*fields, *(["ids array<int>"] if ids else []), "__open boolean"])
    # Stored: windows must not be dealt differently between the reads below.
    pieces = stored(map_texts(source, _packer(tokenizer, keep, end_id, capacity, open_windows, slack, ids), schema), "packed")
    result, left, round_ = pieces.where("not __open"), pieces.where("__open"), 0
    groups = left.agg(F.max(F.shiftright("sequence_id", _GROUP))).first()[0]
    if groups is None:
        return result.drop("__open")
    while True:
        round_ += 1
        groups //= fan
        last = groups == 0
        group = F.shiftright(F.col("sequence_id").bitwiseAND((1 << _ROUND) - 1), _GROUP)
        merged = left.withColumn("__group", F.floor(group / fan).cast("bigint")).groupBy("__group").applyInArrow(
            _merger(round_, capacity, 0 if last else open_windows), schema)
        merged = stored(merged, "packed-left")
        result = result.unionByName(merged.where("not __open"))
        if last:
            return result.drop("__open")
        left = merged.where("__open")


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The training rows: ``sequence_id``, ``n_tokens`` and ``ids`` padded to ``capacity``; a
    sequence holds at most ``capacity`` tokens, so its pieces are few."""
    rows = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    ids = F.flatten(F.col("p.ids"))
    return rows.select("sequence_id", "n_tokens", F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(capacity).cast("int") - F.size(ids))).alias("ids"))


def op12(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"), ids=False).select("doc_id", *_MORE)
