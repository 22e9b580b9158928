"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding is a score-ordered agenda: every adjacent pair of symbols that joins
to a vocabulary piece is an entry (score, position); the best one is merged,
its new neighbours are entered, and entries that a merge has made stale are
passed over.  Characters outside the vocabulary fall back to byte pieces.

No piece of such a vocabulary holds a space mark after another character, so
no merge crosses the start of a word, nor the end of its letters where no piece holds
the mark behind them: the agenda runs once for every distinct word a worker has not met
lately.  Every word the agenda encodes is also encoded by the sentencepiece library, hundreds
in one call, whose decoding of the ids is compared with ours, and of every 256 rows one
whole text; a difference raises.

Defined results: a null text is an empty one; an empty text gives the begin and
end ids alone and decodes to the empty text; repeated rows each give a row;
further columns are not read and never clash.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import string
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import map_texts, small, text_of

MARK = "▁"  # the library's visible form of a space
KEPT_WORDS = 200_000  # newly used words after which a worker drops those not used since the last time
SHORT = 32  # characters of a word whose agenda is searched as a list; of a longer one it is a heap
CALL_WORDS = 256  # checked in one call
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
ADDED = ("n_tokens", "ids_sha256", "decoded_sha256", "ids")  # by the stage; earlier columns of these names give way
KEPT_LENGTH = 64  # longer words are encoded each time


class Pieces(dict):
    """A vocabulary, and the words encoded so far (word -> little-endian ids)."""

    def __init__(self, model_path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        super().__init__()
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        model = proto.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        spec, kinds = model.normalizer_spec, proto.ModelProto.SentencePiece
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE:
            raise ValueError("the vocabulary is not of merge type")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not (spec.add_dummy_prefix and spec.escape_whitespaces):
            raise ValueError("the vocabulary asks for a normalisation this encoder lacks")
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids = [self.library.unk_id()] * 256
        self.surface: list[bytes] = []
        self.is_byte = np.zeros(len(model.pieces), bool)
        for i, p in enumerate(model.pieces):
            shown = b""
            if p.type in (kinds.NORMAL, kinds.USER_DEFINED):
                if p.type == kinds.USER_DEFINED:
                    raise ValueError("user-defined symbols are not supported")
                self.scores[p.piece], self.ids[p.piece] = p.score, i
                shown = p.piece.replace(MARK, " ").encode()
            elif p.type == kinds.BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_ids[value], self.is_byte[i], shown = i, True, bytes([value])
            elif p.type == kinds.UNKNOWN:
                shown = (model.trainer_spec.unk_surface or " ⁇ ").encode()
            self.surface.append(shown)
        if any(re.search(f"[^{MARK}]{MARK}", x) for x in self.scores):
            raise ValueError("pieces cross word starts; words cannot be encoded on their own")
        line = "\n" if not any("\n" in x and len(x) > 1 for x in self.scores) else ""
        # Punctuation that follows a letter in no piece: a word is cut there too.
        apart = [re.escape(x) for x in string.punctuation if not any(re.search(f"[{LETTERS}]{re.escape(x)}", p) for p in self.scores)]
        stem = f"{MARK}*[{LETTERS}]+(?=[{''.join(apart)}])|" if apart else ""
        self.words = re.compile(f"\n|{stem}{MARK}*[^{MARK}\n]+|{MARK}+" if line else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.costs = {piece: -score for piece, score in self.scores.items()}
        self.begin = np.array([self.library.bos_id()], "<u4").tobytes()
        self.end = np.array([self.library.eos_id()], "<u4").tobytes()
        self.fresh: list[tuple[str, list[int]]] = []
        self.older: dict[str, bytes] = {}

    def agenda(self, word: str) -> list[int]:
        """Ids of one word by merging the best adjacent pair, the first of equal ones, until none is left."""
        if len(word) <= SHORT:
            return self._ids(self._merged(word))
        scores = self.scores
        symbols = list(word)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            joined = symbols[i] + symbols[i + 1]
            if joined in scores:
                heap.append((-scores[joined], i, i + 1, joined))
        heapq.heapify(heap)
        while heap:
            _, left, right, joined = heapq.heappop(heap)
            a, b = symbols[left], symbols[right]
            if not a or not b or len(a) + len(b) != len(joined):
                continue  # one of the two has been merged since
            symbols[left], symbols[right] = joined, ""
            following = after[right]
            after[left] = following
            if following < n:
                before[following] = left
                pair = joined + symbols[following]
                if pair in scores:
                    heapq.heappush(heap, (-scores[pair], left, following, pair))
            preceding = before[left]
            if preceding >= 0:
                pair = symbols[preceding] + joined
                if pair in scores:
                    heapq.heappush(heap, (-scores[pair], preceding, left, pair))
        return self._ids([s for s in symbols if s])

    def _merged(self, word: str) -> list[str]:
        """The symbols of a short word: its agenda is the list of the costs of adjacent pairs."""
        cost, none = self.costs.get, math.inf
        symbols = list(word)
        pairs = [cost(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while pairs and (best := min(pairs)) != none:
            at = pairs.index(best)
            joined = symbols[at] + symbols[at + 1]
            symbols[at : at + 2] = [joined]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = cost(joined + symbols[at + 1], none)
            if at:
                pairs[at - 1] = cost(symbols[at - 1] + joined, none)
        return symbols

    def _ids(self, symbols: list[str]) -> list[int]:
        ids = list(map(self.ids.get, symbols))
        if None not in ids:
            return ids
        return [i for s, known in zip(symbols, ids) for i in ([known] if known is not None else [self.byte_ids[x] for x in s.encode()])]

    def __missing__(self, word: str) -> bytes:
        raw = self.older.get(word)
        if raw is None:
            ids = self.agenda(word)
            self.fresh.append((word, ids))
            raw = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= KEPT_LENGTH:
            self[word] = raw
        return raw

    def encode(self, text: str) -> bytes:
        """Ids with begin and end, as little-endian unsigned 32-bit integers."""
        if not text:
            return self.begin + self.end
        words = self.words.findall(MARK + text.replace(" ", MARK))
        return b"".join([self.begin, *map(self.__getitem__, words), self.end])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: marks are spaces, the one the encoder put first goes,
        runs of byte pieces are UTF-8, bytes that are not give U+FFFD each."""
        shown = list(map(self.surface.__getitem__, ids.tolist()))
        seen = np.flatnonzero(ids > self.library.eos_id())
        if len(seen) and not self.is_byte[ids[seen[0]]] and shown[seen[0]].startswith(b" "):
            shown[seen[0]] = shown[seen[0]][1:]
        raw = b"".join(shown)
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return _each_bad_byte(raw)

    def check(self, texts: list[str]) -> None:
        """Compare with the library: words set aside since the last check, and ``texts``."""
        # Words that begin with one mark follow each other as they do in a text; others stand
        # behind a line break each.  The library puts a mark before a text.
        spaced = [x for x in self.fresh if len(x[0]) > 1 and x[0][0] == MARK != x[0][1]]
        broken = [x for x in self.fresh if x[0][0] not in (MARK, "\n")]
        rest = [x for x in self.fresh if x[0][0] == MARK and (len(x[0]) == 1 or x[0][1] == MARK)]
        mark, line = self.agenda(MARK), self.agenda("\n")
        calls = [("".join([w for w, _ in some])[1:], [i for _, ids in some for i in ids]) for some in _slices(spaced)]
        calls += [("".join(["\n" + w for w, _ in some]), mark + [i for _, ids in some for i in line + ids]) for some in _slices(broken)]
        calls += [(w[1:], ids) for w, ids in rest if len(w) > 1]
        ours = [ids for _, ids in calls] + [ids for w, ids in self.fresh if w in (MARK, "\n")]
        for (words, ids), theirs in zip(calls, self.library.encode([words for words, _ in calls], num_threads=1), strict=True):
            if theirs != ids:
                raise ValueError(f"agenda and library differ on one of {words!r}")
        for ids, theirs in zip(ours, self.library.decode(ours, num_threads=1), strict=True):
            if theirs != self.decode(np.array(ids, "<u4")):
                raise ValueError(f"decodings differ on {theirs!r}")
        self.fresh.clear()
        for text in texts:
            ids = np.frombuffer(self.encode(text), "<u4")
            theirs = self.library.encode(text, add_bos=True, add_eos=True)
            if theirs != ids.tolist() or self.library.decode(theirs) != self.decode(ids):
                raise ValueError(f"agenda and library differ on a text of {len(text)} characters")
        if len(self) > KEPT_WORDS:
            self.older = dict(self)
            self.clear()


def _slices(words: list) -> list[list]:
    return [words[at : at + CALL_WORDS] for at in range(0, len(words), CALL_WORDS)]


def _each_bad_byte(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[at : at + e.start].decode() + "�")
            at += e.start + 1
    return "".join(out)


_LOADED: dict[str, Pieces] = {}


def load(model_path: str) -> Pieces:
    """The vocabulary, loaded once in a Python worker."""
    if model_path not in _LOADED:
        _LOADED[model_path] = Pieces(model_path)
    return _LOADED[model_path]


def encode_and_decode(docs: DataFrame, model_path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
                      ids: bool = True, decoded: bool = True) -> DataFrame:
    """Per row of ``docs``: the ``keep`` columns, ``n_tokens``, ``ids_sha256``,
    ``decoded_sha256`` and, if asked for, ``ids`` (array of int) and ``decoded``.

    A map over Arrow batches: no shuffle, memory bounded by a batch and the kept words.
    """
    own_text = "__text" + "_" * len("".join(keep))
    source = docs.select(*keep, text_of(text).alias(own_text))
    schema = [f"`{c}` {t}" for c, t in source.dtypes if c != own_text]
    more = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"} | ({"ids": "array<int>"} if ids else {}) | ({"decoded": "string"} if decoded else {})
    schema += [f"{c} {t}" for c, t in more.items()]
    added = list(more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model_path)
        for batch in small(batches):
            texts = batch.column(own_text).to_pylist()
            raw = [pieces.encode(x) for x in texts]
            own = [np.frombuffer(x, "<u4") for x in raw]
            shown = [pieces.decode(x) for x in own]
            pieces.check(texts[:1])
            columns = [batch.column(c) for c in keep]
            columns += [pa.array([len(x) for x in own], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in shown], pa.string())]
            if ids:
                ends = np.cumsum([0] + [len(x) for x in own]).astype("i4")
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(own).astype("i4"))))
            if decoded:
                columns.append(pa.array(shown, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *added])

    return map_texts(source, run, ", ".join(schema))


def op8(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), ids=False, decoded=False).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: every document with its ids and the digests of both directions."""
    import public_tokenizers

    return encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=tuple(c for c in docs.columns if c not in ADDED), decoded=False)
