"""Encoding of whole texts by the tokenizers library, each distinct word once.

A text is cut where the library's own pre-tokenizer always cuts, so that the ids
of a text are those of its cuts in order; the library encodes every cut a worker
has not met lately, thousands in one call.
"""

from __future__ import annotations

import os
import re

import numpy as np

KEPT_WORDS = 600_000  # cuts a worker has met; those not met again while as many others were are dropped
KEPT_LENGTH = 64  # characters; longer cuts are not kept
CALL_CHARS = 1 << 16  # of new cuts in one call


class Wordwise:
    """``encode`` gives each text's ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, plain: bool):
        """``plain``: special tokens' strings inside a text are ordinary text."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def cut(self, text: str) -> list[str]:
        raise NotImplementedError

    def joinable(self, word: str) -> bool:
        """Whether the cut can share a call with others."""
        raise NotImplementedError

    def joined(self, words: list[str]) -> list[bytes]:
        """The ids of cuts that share a call."""
        raise NotImplementedError

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _new(self, words: list[str]) -> None:
        held, size = [], 0
        for word in words:
            if not self.joinable(word):
                self.known[word] = self.ids(word).tobytes()
                continue
            held.append(word)
            size += len(word)
            if size >= CALL_CHARS:
                self.known.update(zip(held, self.joined(held), strict=True))
                held, size = [], 0
        if held:
            self.known.update(zip(held, self.joined(held), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        known, older = self.known, self.older
        cuts = [self.cut(x) for x in texts]
        found = [list(map(known.get, c)) for c in cuts]
        fresh = list(dict.fromkeys(w for c, got in zip(cuts, found) if None in got for w, x in zip(c, got) if x is None))
        if fresh:
            known.update((w, older[w]) for w in fresh if w in older)
            self._new([w for w in fresh if w not in known])
            found = [got if None not in got else [known[w] if x is None else x for w, x in zip(c, got)] for c, got in zip(cuts, found)]
            for w in fresh:
                if len(w) > KEPT_LENGTH:
                    del known[w]
            if len(known) > KEPT_WORDS:
                self.older, self.known = known, {}
        return list(map(b"".join, found))


class SpacelessWords(Wordwise):
    """For a vocabulary that drops white space: cuts at space and line feed, which are left out.

    Cuts share a call with a control character between them, which is then a token of its own.
    """

    BETWEEN = "\x02"

    def __init__(self, path: str, plain: bool = False):
        super().__init__(path, plain)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        found = self.ids(self.BETWEEN)
        if len(found) != 1 or len(self.ids(f"a {self.BETWEEN}  {self.BETWEEN} b")) != 2 + len(self.ids("a b")):
            raise ValueError("the vocabulary does not drop white space")
        self.between = found[0]

    # Letters that lower-case one by one, and a run of punctuation behind them: the
    # pre-tokenizer parts the two, and the vocabulary knows lower case only.
    _PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")

    _LETTERS = re.compile("[a-zà-öø-ÿ]+")

    def cut(self, text: str) -> list[str]:
        return text.replace("\n", " ").split(" ")

    def _new(self, words: list[str]) -> None:
        known, older = self.known, self.older
        plain = {w: (m[1].lower(), m[2]) for w in words if (m := self._PLAIN.fullmatch(w))}
        parts = dict.fromkeys(p for w in words for p in plain.get(w, (w,)) if p not in known)
        known.update((p, older[p]) for p in parts if p in older)
        new = [p for p in parts if p not in known]
        super()._new([p for p in new if self._LETTERS.fullmatch(p)])
        super()._new([p for p in new if not self._LETTERS.fullmatch(p)])
        known.update((w, known[stem] + known[tail]) for w, (stem, tail) in plain.items())

    def joinable(self, word: str) -> bool:
        return self.BETWEEN not in word and not any(s in word for s in self.special)

    def joined(self, words: list[str]) -> list[bytes]:
        # Between letters the character parts words without spaces around it.
        spaced = any(not w.isalpha() for w in words)
        ids = self.ids((f" {self.BETWEEN} " if spaced else self.BETWEEN).join(words))
        ends = (4 * np.flatnonzero(ids == self.between)).tolist()
        if len(ends) != len(words) - 1:
            raise ValueError("words and their separators do not match")
        raw = ids.tobytes()
        return [raw[i:j] for i, j in zip([0, *(x + 4 for x in ends)], [*ends, len(raw)])]


class ByteWords(Wordwise):
    """For a byte-level vocabulary: cuts before a space that a visible character follows.

    That space always begins a pre-token: of a run of white space the last space joins the
    word, and no pre-token holds a space after a visible character.  Cuts that begin so
    and end visibly share a call end to end, and are told apart by the bytes of their tokens.
    """

    _BEFORE_WORD = re.compile(r"(?= \S)")
    _WORD = re.compile(r" \S(.*\S)?", re.DOTALL)

    def __init__(self, path: str, plain: bool = True):
        super().__init__(path, plain)
        self.token_bytes = byte_level_tokens(self.library)
        self.sizes = np.array([len(x) for x in self.token_bytes], np.int64)

    def cut(self, text: str) -> list[str]:
        return self._BEFORE_WORD.split(text)

    def joinable(self, word: str) -> bool:
        return self._WORD.fullmatch(word) is not None

    def joined(self, words: list[str]) -> list[bytes]:
        ids = self.ids("".join(words))
        ends = np.cumsum(self.sizes[ids])
        wanted = np.cumsum([len(w.encode()) for w in words])
        at = np.searchsorted(ends, wanted)
        if len(ends) == 0 or ends[-1] != wanted[-1] or not np.array_equal(ends[at], wanted):
            raise ValueError("words do not end where tokens do")
        raw, cuts = ids.tobytes(), (4 * (at + 1)).tolist()
        return [raw[i:j] for i, j in zip([0, *cuts], cuts)]


def byte_level_tokens(library) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary.

    Its entries show bytes as characters: printable ones of Latin-1 stand for
    themselves, the others, ascending, for the characters from U+0100 on.
    """
    themselves = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [x for x in range(256) if x not in set(themselves)]
    shown = {chr(x): x for x in themselves} | {chr(256 + i): x for i, x in enumerate(others)}
    vocabulary = library.get_vocab(with_added_tokens=False)
    out = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        out[i] = bytes(shown[c] for c in entry)
    return out


_LOADED: dict[tuple, Wordwise] = {}


def load(path: str, kind: type[Wordwise]) -> Wordwise:
    """The encoder, loaded once in a Python worker."""
    if (path, kind.__name__) not in _LOADED:
        _LOADED[path, kind.__name__] = kind(path)
    return _LOADED[path, kind.__name__]
