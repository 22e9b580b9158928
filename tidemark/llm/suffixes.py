"""Removal of long repeated strings by column-wise construction of a collection's order.

Every ``LENGTH``-byte string of every text is compared with all others, overlaps
included, in these steps:

1. Anchors.  Of the ``GRAM``-byte substrings of a string, the one with the least
   hash (the leftmost of equals) is its anchor.  Equal strings have their anchor at
   the same offset, so they can only be found among the strings of equal anchors.
   The strings that share one anchor are consecutive; the bytes they span are a
   context, and the contexts cover every string exactly once.
2. Counts.  Anchors and contexts are counted over all documents by hash partition.
   A string whose anchor stands nowhere else has no equal and goes no further.
   Each different context of the others is sent once, with its number of copies.
3. Columns.  The contexts of a partition, aligned at their anchors, are a
   collection of documents.  Going from the last column to the first, each round
   inserts one symbol of every document: a stable sort of the previous order by
   that symbol gives the new one (the documents' Burrows-Wheeler transform at this
   column), and the common prefix of neighbours is one more than the least between
   their old places.  A round reads only the order and prefixes the last one left,
   front to back.  Neighbours with a common prefix of ``LENGTH`` hold equal strings.
4. The found strings return to their documents, which drop the bytes they cover.

The plain construction over whole documents needs as many rounds over the whole
collection as the longest one has bytes; alignment at anchors bounds the rounds by
3 * LENGTH and a round's work by the documents that have that column.

Work is dealt to hash partitions and to chunks of consecutive rows; copies within
a chunk cost one entry.  The strings of an anchor with more than ``HOT`` contexts are
not put in columns: each is dealt by a 128-bit hash of its own, counted in its chunk
first, so that no task holds what one anchor or one half of a passage has in common.

Defined results: a null text is empty; a text shorter than ``LENGTH`` loses
nothing; repeated rows are documents of their own, so long ones vanish whole; null
ids are kept; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import partitions_for, text_of

LENGTH = 400
GRAM = 128
BUFFER_BITS = 18
CHUNK_BITS = 9
HOT = 4096
CONTEXTS_AT_ONCE = 16_384
PART_BYTES = 32 << 20
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
BASE = 0x9E3779B97F4A7C15
SYMBOLS = np.random.default_rng(1).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


UP = _powers(BASE, (1 << BUFFER_BITS) + 1)
DOWN = _powers(pow(BASE, -1, 2**64), (1 << BUFFER_BITS) + 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _buffers(texts: list[bytes], length: int, bits: int):
    """Lists of (text number, first byte, last byte) of at most a buffer together.
    Parts of a long text overlap so that every string lies whole in one of them."""
    size = 1 << bits
    held, room = [], size
    for i, text in enumerate(texts):
        at = 0
        while len(text) - at >= length:
            stop = min(len(text), at + size)
            if stop - at > room:
                yield held
                held, room = [], size
            held.append((i, at, stop))
            room -= stop - at
            at = stop - length + 1
    if held:
        yield held


def anchors(texts: list[bytes], length: int, gram: int, bits: int = BUFFER_BITS) -> tuple[np.ndarray, ...]:
    """(text, place, first start, last start, hash): the anchors of all strings of the
    texts, each with the consecutive starts of the strings it is the anchor of."""
    found = [tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)]
    width, low = length - gram + 1, np.uint64((1 << bits) - 1)
    for parts in _buffers(texts, length, bits):
        lengths = np.array([b - a for _, a, b in parts])
        raw = np.frombuffer(b"".join(texts[i][a:b] for i, a, b in parts), np.uint8)
        n, ends = len(raw), np.cumsum(lengths)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(SYMBOLS[raw] * UP[:n], out=sums[1:])
        grams = _mixed((sums[gram:] - sums[:-gram]) * DOWN[: n - gram + 1])
        end = np.repeat(ends, lengths)
        place = np.arange(len(grams))
        order = (grams & ~low) | place.astype(np.uint64)
        order[place + gram > end[: len(grams)]] = FULL  # it would cross into the next part
        rows = np.full(-(-len(order) // width) * width, FULL, np.uint64)
        rows[: len(order)] = order
        rows = rows.reshape(-1, width)
        after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        before = np.minimum.accumulate(rows, axis=1).ravel()
        count = n - length + 1
        least = np.minimum(after[:count], before[width - 1 : width - 1 + count])
        starts = np.flatnonzero(np.arange(count) + length <= end[:count])
        own = (least[starts] & low).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)]))
        at, first, last = own[new], starts[new], starts[np.concatenate([new[1:] - 1, [len(starts) - 1]])]
        part = np.searchsorted(ends, first, side="right")
        shift = np.array([a for _, a, _ in parts])[part] - (ends - lengths)[part]
        found.append((np.array([i for i, _, _ in parts])[part], at + shift, first + shift, last + shift, grams[at]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Chunk:
    """The contexts of a chunk's texts, and its distinct ones in the order of (hash, digest)."""

    def __init__(self, texts: list[str], length: int, gram: int):
        self.texts = [t.encode() for t in texts]
        self.doc, self.place, self.first, self.last, hashes = anchors(self.texts, length, gram)
        rows = zip(self.doc.tolist(), self.place.tolist(), self.first.tolist(), self.last.tolist(), strict=True)
        digest = np.fromiter((xxhash.xxh3_64_intdigest(self.texts[d][a : b + length], p - a) for d, p, a, b in rows), np.uint64, len(hashes))
        keys = np.stack([hashes, digest], axis=1)
        by = np.lexsort((digest, hashes))
        new = np.concatenate([[True], (keys[by[1:]] != keys[by[:-1]]).any(axis=1)]) if len(by) else np.zeros(0, bool)
        self.entry = np.empty(len(by), np.int64)  # of each context
        self.entry[by] = np.cumsum(new) - 1
        self.example = by[new]  # a context of each entry
        self.keys = keys[self.example]
        self.counts = np.bincount(self.entry, minlength=len(self.example))

    def dealt(self, partitions: int):
        """(partition, its entries), for every partition that has any."""
        to = (self.keys[:, 0] % np.uint64(partitions)).astype(np.int64)
        by = np.argsort(to, kind="stable")
        cuts = np.searchsorted(to[by], np.arange(partitions + 1))
        return [(i, by[a:b]) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]

    def strings(self, entries: list[int], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every string of these entries' contexts: the entry, its number there, and its
        hash as a row of two numbers."""
        of, numbers, digests = [], [], []
        for e in entries:
            i = self.example[e]
            text, first, n = self.texts[self.doc[i]], int(self.first[i]), int(self.last[i] - self.first[i]) + 1
            of.append(np.full(n, e))
            numbers.append(np.arange(n))
            digests += [xxhash.xxh3_128_digest(text[s : s + length]) for s in range(first, first + n)]
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *of]), np.concatenate([none, *numbers]), np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)

    def back(self, partitions: int, rows: list[tuple[int, np.ndarray]], kind) -> np.ndarray:
        """Values by entry from the partitions' answers."""
        out = np.zeros(len(self.keys), kind)
        places = dict(self.dealt(partitions))
        for part, values in rows:
            out[places[part]] = values
        return out


def _ask(length: int, gram: int, partitions: int):
    def run(key, table):
        c = Chunk(table.column("text").to_pylist(), length, gram)
        rows = c.dealt(partitions)
        return pa.table({"part": pa.array([i for i, _ in rows], pa.int64()), "chunk": pa.array([key[0].as_py()] * len(rows), pa.int64()),
                         "keys": pa.array([c.keys[at].tobytes() for _, at in rows], pa.binary()),
                         "counts": pa.array([c.counts[at].astype("<u4").tobytes() for _, at in rows], pa.binary())})

    return run


def _entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and counts of all rows of a partition, and the rows' cuts."""
    keys = [np.frombuffer(x.as_buffer(), "<u8").reshape(-1, 2) for x in table.column("keys")]
    counts = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in table.column("counts")]).astype(np.int64)
    return np.concatenate(keys), counts, np.cumsum([0] + [len(k) for k in keys])


def _grouped(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per entry: its context's number, whether it is that number's first, the context's copies; and the order."""
    by = np.lexsort((np.arange(len(keys)), keys[:, 1], keys[:, 0]))
    new = np.concatenate([[True], (keys[by[1:]] != keys[by[:-1]]).any(axis=1)])
    number, first = np.empty(len(by), np.int64), np.zeros(len(by), bool)
    number[by] = np.cumsum(new) - 1
    first[by[new]] = True
    return number, first, np.bincount(number, counts).astype(np.int64), by[new]


NONE, REPEATED, SEND, SEND_STRINGS = range(4)
CONTEXT, STRINGS = range(2)  # kinds of rows sent


def _codes(keys: np.ndarray, counts: np.ndarray, hot: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each entry: what its chunk does with its context, whether the anchor is hot, and the context's copies."""
    number, first, copies, examples = _grouped(keys, counts)
    hashes = keys[examples, 0]  # of the contexts, in order
    new = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    group = np.cumsum(new) - 1
    occurrences, contexts = np.bincount(group, copies), np.bincount(group)
    own = group[number]
    strings = contexts[own] > hot
    # All strings of a hot anchor's context that has copies are known to be repeated; it is still sent once, to be counted.
    code = np.where(occurrences[own] < 2, NONE, np.where(~first, REPEATED, np.where(strings, SEND_STRINGS, SEND))).astype(np.uint8)
    return code, strings, copies[number]


def _count(hot: int):
    """Of each entry: whether its anchor stands elsewhere, and whether this chunk sends its context."""

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        keys, counts, cuts = _entries(table)
        code, _, copies = _codes(keys, counts, hot)
        parts, chunks = table.column("part").to_pylist(), table.column("chunk").to_pylist()
        weight = copies.astype("<i8")
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            yield pa.RecordBatch.from_arrays([pa.array([chunks[i]], pa.int64()), pa.array([parts[i]], pa.int64()), pa.array([code[a:b].tobytes()], pa.binary()),
                                              pa.array([weight[a:b].tobytes()], pa.binary())], names=["chunk", "part", "codes", "copies"])

    return run


def _send(length: int, gram: int, partitions: int):
    """The contexts a chunk was asked for, to the partition of their anchor, and, of hot
    anchors, the hashes and counts of their strings, each to the partition of its hash."""

    def run(key, texts, answers):
        c = Chunk(texts.column("text").to_pylist(), length, gram)
        of = answers.column("part").to_pylist()
        codes = c.back(partitions, [(p, np.frombuffer(x.as_buffer(), np.uint8)) for p, x in zip(of, answers.column("codes"))], np.uint8)
        copies = c.back(partitions, [(p, np.frombuffer(x.as_buffer(), "<i8")) for p, x in zip(of, answers.column("copies"))], np.int64)
        chunk, flat = key[0].as_py(), []
        for e in np.flatnonzero(codes == SEND).tolist():
            i = c.example[e]
            text, place, first, last = c.texts[c.doc[i]], int(c.place[i]), int(c.first[i]), int(c.last[i])
            home = int(c.keys[e, 0] % np.uint64(partitions))
            flat.append((home, CONTEXT, chunk, int(c.keys[e, 0]), int(c.keys[e, 1]), place - first, last - first + 1, int(copies[e]), text[first : last + length]))
        entry, _, digests = c.strings(np.flatnonzero(codes == SEND_STRINGS).tolist(), length)
        if len(entry):
            number, _, counts, examples = _grouped(digests, copies[entry])
            distinct = digests[examples]
            to = (distinct[:, 0] % np.uint64(partitions)).astype(np.int64)
            for part in np.unique(to).tolist():
                # Two are as good as more: a string's count only says whether it is repeated.
                own = to == part
                flat.append((part, STRINGS, chunk, 0, 0, 0, 0, 0, np.minimum(counts[own], 2).astype(np.uint8).tobytes() + distinct[own].tobytes()))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.uint64(), pa.uint64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        names = ["part", "kind", "chunk", "hash", "digest", "before", "starts", "copies", "bytes"]
        out = {n: pa.array([r[i] for r in flat], k) for i, (n, k) in enumerate(zip(names, kinds, strict=True))}
        for n in ("hash", "digest"):
            out[n] = out[n].view(pa.int64())
        return pa.table(out)

    return run


def repeated_starts(before: np.ndarray, starts: np.ndarray, raw: list[bytes], length: int, gram: int) -> np.ndarray:
    """For contexts aligned at their anchors: a row of flags, one for each start, true
    where another context holds the same ``length`` bytes at the same column."""
    span = length - gram + 1  # starts of a context, at most; the anchor is at column ``span - 1``
    sizes = np.array([len(x) for x in raw])
    left = span - 1 - before
    right = left + sizes
    columns = np.zeros((length + 2 * span, len(raw)), np.uint8)
    flat = np.frombuffer(b"".join(raw), np.uint8)
    row = np.repeat(np.arange(len(raw)), sizes)
    columns[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + left[row], row] = flat
    enter, leave = np.argsort(right, kind="stable"), left
    entering = np.searchsorted(right[enter], np.arange(len(columns) + 2))
    flags = np.zeros((len(raw), span), bool)
    order, common = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for x in range(len(columns) - 1, -1, -1):
        fresh = enter[entering[x + 1] : entering[x + 2]]  # documents whose last symbol this is
        if len(order):
            stay = leave[order] <= x
            if not stay.all():
                kept = np.flatnonzero(stay)
                common = np.minimum.reduceat(common[: kept[-1] + 1], np.concatenate([[0], kept[:-1] + 1])) if len(kept) else common[:0]
                order = order[kept]
        if len(fresh):
            order, common = np.concatenate([fresh, order]), np.concatenate([np.zeros(len(fresh), np.int64), common])
        if not len(order):
            continue
        common[0] = 0
        symbols = columns[x, order]
        by = np.argsort(symbols, kind="stable")
        least = np.minimum.reduceat(np.append(common, 0), by + 1)
        symbols = symbols[by]
        new = np.zeros(len(by), np.int64)
        same = symbols[1:] == symbols[:-1]
        new[1:][same] = least[:-1][same] + 1
        order, common = order[by], new
        if x < span:
            hit = common >= length
            hit[:-1] |= hit[1:]
            rows = order[hit]
            flags[rows, x - leave[rows]] = True
    return flags


def _repeated_strings(table: pa.Table) -> pa.RecordBatch:
    """Of the strings each chunk sent, the hashes of those that stand more than once."""
    raw = [np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("bytes")]
    sizes = [len(x) // 17 for x in raw]
    keys = np.concatenate([x[n:].view("<u8").reshape(-1, 2) for x, n in zip(raw, sizes)])
    number, _, copies, _ = _grouped(keys, np.concatenate([x[:n] for x, n in zip(raw, sizes)]))
    found, cuts = copies[number] > 1, np.cumsum([0, *sizes])
    rows = [keys[a:b][found[a:b]].tobytes() for a, b in zip(cuts, cuts[1:])]
    n = table.num_rows
    none = pa.array([0] * n, pa.int64())
    return pa.RecordBatch.from_arrays([table.column("part").combine_chunks(), pa.array([STRINGS] * n, pa.int32()), table.column("chunk").combine_chunks(), none, none, pa.array(rows, pa.binary())], names=FOUND)


FOUND = ["home", "kind", "chunk", "hash", "digest", "flags"]


def _compare(length: int, gram: int, at_once: int):
    """Arrow map over a partition of what was sent: of a context its flags as packed bits,
    of a chunk's strings the hashes of the repeated ones."""

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        strings = table.filter(pc.equal(table.column("kind"), STRINGS))
        if strings.num_rows:
            yield _repeated_strings(strings)
        table = table.filter(pc.equal(table.column("kind"), CONTEXT)).sort_by("hash")
        if not table.num_rows:
            return
        hashes = table.column("hash").to_numpy()
        # An anchor's contexts, at most ``hot``, stay together; small anchors share a construction.
        change = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        cuts, at = [0], 0
        for a, b in zip(change, [*change[1:], len(hashes)]):
            if b - at > at_once and a > at:
                cuts.append(int(a))
                at = int(a)
        for a, b in zip(cuts, [*cuts[1:], len(hashes)]):
            part = table.slice(a, b - a).combine_chunks()
            flags = repeated_starts(part.column("before").to_numpy(), part.column("starts").to_numpy(), part.column("bytes").to_pylist(), length, gram)
            flags |= (part.column("copies").to_numpy() > 1)[:, None]
            flags &= np.arange(flags.shape[1]) < part.column("starts").to_numpy()[:, None]
            some = flags.any(axis=1)
            packed = np.packbits(flags[some], axis=1)
            keep = pa.array(some)
            own = part.rename_columns({"part": "home"})
            yield pa.RecordBatch.from_arrays([*(own.column(c).combine_chunks().filter(keep) for c in FOUND[:-1]), pa.array([x.tobytes() for x in packed], pa.binary())], names=FOUND)

    return run


def _reply(width: int, hot: int):
    """To every chunk that asked: the found starts of a partition's contexts (``flags`` of the
    entries ``which``), its entries of hot anchors whose strings it is to look up (``look``)
    or that are repeated whole (``whole``), and its repeated strings (``strings``)."""

    def run(key, asked, found):
        rows = []
        kind = found.column("kind").to_numpy()
        strings, found = found.filter(pa.array(kind == STRINGS)), found.filter(pa.array(kind == CONTEXT))
        for chunk, raw in zip(strings.column("chunk").to_pylist(), strings.column("flags").to_pylist()):
            rows.append((chunk, key[0].as_py(), b"", b"", b"", b"", raw))
        if asked.num_rows:
            keys, counts, cuts = _entries(asked)
            known = np.stack([found.column(c).to_numpy().view(np.uint64) for c in ("hash", "digest")], axis=1)
            flags = np.frombuffer(b"".join(found.column("flags").to_pylist()), np.uint8).reshape(-1, width)
            code, strings_of, copies = _codes(keys, counts, hot)
            number, _, _, _ = _grouped(np.concatenate([keys, known]), np.zeros(len(keys) + len(known), np.int64))
            place = np.full(number.max() + 1, -1)
            place[number[len(keys) :]] = np.arange(len(known))
            at = place[number[: len(keys)]]
            whole, look = strings_of & (copies > 1), strings_of & (copies == 1) & (code == SEND_STRINGS)
            parts, chunks = asked.column("part").to_pylist(), asked.column("chunk").to_pylist()
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                which = np.flatnonzero(at[a:b] >= 0)
                rows.append((chunks[i], parts[i], which.astype("<u4").tobytes(), flags[at[a:b][which]].tobytes(),
                             *(np.flatnonzero(x[a:b]).astype("<u4").tobytes() for x in (look, whole)), b""))
        kinds = [pa.int64(), pa.int64()] + [pa.binary()] * 5
        names = ["chunk", "part", "which", "flags", "look", "whole", "strings"]
        return pa.table({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds, strict=True))})

    return run


def _cut(length: int, gram: int, partitions: int, with_text: bool):
    width, span = -(-(length - gram + 1) // 8), length - gram + 1

    def run(key, texts, replies):
        c = Chunk(texts.column("text").to_pylist(), length, gram)
        flags = np.zeros((len(c.keys), span), bool)
        places = dict(c.dealt(partitions))
        look, repeated = [], [np.zeros(0, "<u8")]
        for row in replies.select(["part", "which", "flags", "look", "whole", "strings"]).to_pylist():
            repeated.append(np.frombuffer(row["strings"], "<u8"))
            if row["which"] or row["look"] or row["whole"]:
                which, own, whole = (places[row["part"]][np.frombuffer(row[k], "<u4")] for k in ("which", "look", "whole"))
                flags[which] = np.unpackbits(np.frombuffer(row["flags"], np.uint8).reshape(-1, width), axis=1, count=span).astype(bool)
                look.append(own)
                i = c.example[whole]
                flags[whole] = np.arange(span) <= (c.last[i] - c.first[i])[:, None]
        if look:
            entry, number, digests = c.strings(np.concatenate(look).tolist(), length)
            known = np.concatenate(repeated).reshape(-1, 2)
            of, _, _, _ = _grouped(np.concatenate([known, digests]), np.zeros(len(known) + len(digests), np.int64)) if len(entry) else (number,) * 4
            flags[entry, number] = np.isin(of[len(known) :], of[: len(known)]) if len(entry) else False
        context, offset = np.nonzero(flags[c.entry])
        doc, start = c.doc[context], c.first[context] + offset
        rows = []
        by = np.argsort(doc, kind="stable")
        cuts = np.searchsorted(doc[by], np.arange(len(c.texts) + 1))
        for i, text in enumerate(c.texts):
            own = start[by[cuts[i] : cuts[i + 1]]]
            if not len(own):
                rows.append((len(text), 0, 0, hashlib.sha256(text).hexdigest(), text, []))
                continue
            edge = np.zeros(len(text) + 1, np.int32)
            np.add.at(edge, own, 1)
            np.add.at(edge, own + length, -1)
            gone = np.cumsum(edge[:-1]) > 0
            turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            rows.append((len(text), int(gone.sum()), len(turn) // 2, hashlib.sha256(kept).hexdigest(), kept, turn.reshape(-1, 2).tolist()))
        out = {"id": texts.column("id"), "n_bytes": pa.array([r[0] for r in rows], pa.int64()), "n_removed": pa.array([r[1] for r in rows], pa.int64()),
               "n_spans": pa.array([r[2] for r in rows], pa.int64()), "kept_sha256": pa.array([r[3] for r in rows], pa.string())}
        if with_text:
            out["kept"] = pa.array([r[4] for r in rows], pa.binary())
            out["spans"] = pa.array([r[5] for r in rows], pa.list_(pa.list_(pa.int64())))
        return pa.table(out)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, with_text: bool = False,
                   partitions: int | None = None, hot: int = HOT, at_once: int = CONTEXTS_AT_ONCE) -> DataFrame:
    """Per row: the id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``; with
    ``with_text`` also ``kept`` (the bytes left, which may cut a character) and ``spans``."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = partitions or max(partitions_for(docs.sparkSession), -(-size // PART_BYTES))
    # Consecutive rows make a chunk; all readers of the chunks share this one shuffle.
    chunks = rows.withColumn("chunk", F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS)).repartition(partitions, "chunk")
    by_chunk = lambda df: df.repartition(partitions, "chunk").groupBy("chunk")
    asked = chunks.groupBy("chunk").applyInArrow(_ask(length, gram, partitions), "part bigint, chunk bigint, keys binary, counts binary").repartition(partitions, "part")
    counted = asked.mapInArrow(_count(hot), "chunk bigint, part bigint, codes binary, copies binary")
    sent = chunks.groupBy("chunk").cogroup(by_chunk(counted)).applyInArrow(
        _send(length, gram, partitions), "part bigint, kind int, chunk bigint, hash bigint, digest bigint, before int, starts int, copies bigint, bytes binary")
    found = sent.repartition(partitions, "part").mapInArrow(_compare(length, gram, at_once), "home bigint, kind int, chunk bigint, hash bigint, digest bigint, flags binary")
    replies = asked.groupBy("part").cogroup(found.withColumnRenamed("home", "part").repartition(partitions, "part").groupBy("part")).applyInArrow(
        _reply(-(-(length - gram + 1) // 8), hot), "chunk bigint, part bigint, which binary, flags binary, look binary, whole binary, strings binary")
    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary, spans array<array<bigint>>" * with_text
    return chunks.groupBy("chunk").cogroup(by_chunk(replies)).applyInArrow(_cut(length, gram, partitions, with_text), schema).withColumnRenamed("id", id_col)


def op3(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
