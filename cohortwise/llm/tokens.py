"""Token ids of whole texts by a tokenizers file, each distinct piece of text encoded once per worker.

The tokenizers used here split a text before merging, and never join letters across a space that stands
between two other characters. Texts are therefore cut at such spaces, the ids of each piece are kept in a
bounded table of the worker process, and a text's ids are the concatenation of its pieces' ids. Whatever can
not be cut safely is encoded in one go. Added tokens in a text stand for themselves, as the file says; the text
between them is encoded by itself. The result equals ``encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import os
import re
import sys
import types
from array import array

#: Pieces (about 200 bytes each) that a worker process keeps before those not met since the last time are dropped.
KEPT_PIECES = 500_000

#: Runs of marks behind words whose ids a worker process keeps.
KEPT_MARKS = 10_000

#: Letters whose splitting and lower case need no tables, and marks that a splitter leaves together behind them.
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^`{|}~"
_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level tokenizers write for each byte: itself if it can be printed, else from 256 on."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printed]
    return {b: b for b in printed} | {b: 256 + i for i, b in enumerate(others)}


_BYTES = _byte_letters()


def _of_process() -> dict:
    """A table that lives as long as the worker process, shared by its tasks."""
    return vars(sys.modules.setdefault("cohortwise_of_process", types.ModuleType("cohortwise_of_process")))


class _Known(dict):
    """Ids of pieces. One that is not there is taken from the ``older`` table, or encoded, when it is looked up."""

    def __init__(self, encode, older: dict):
        self.encode, self.older = encode, older

    def __missing__(self, piece: str) -> bytes | bool:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encode(piece)
        self[piece] = ids
        return ids


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, kept: int | None = None):
        self.kept = KEPT_PIECES if kept is None else kept
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        flags = ("normalized", "lstrip", "rstrip", "single_word")
        #: Added tokens that are cut out of a text as they stand, and the others, whose texts are encoded whole.
        self.added = {t.content: array("I", [i]).tobytes() for i, t in added.items() if not any(getattr(t, f) for f in flags)}
        bound = [t.content for t in added.values() if t.content not in self.added]
        self.cuts = self._any_of(self.added)
        self.whole = self._any_of(bound, re.IGNORECASE)
        #: A space belongs to the word after it, or is dropped, whichever the file's splitter does.
        self.lead = " " if self.tokenizer.encode("a b", add_special_tokens=False).ids != self.tokenizer.encode("ab", add_special_tokens=False).ids and self.tokenizer.normalizer is None else ""
        self.model = self.tokenizer.model
        self.marks: dict[str, bytes] = {}
        self.pieces = _Known(self._encode_piece, {})

    @property
    def older(self) -> dict[str, bytes | bool]:
        """The pieces met before the table was last begun anew."""
        return self.pieces.older

    @staticmethod
    def _any_of(strings, flags: int = 0) -> re.Pattern | None:
        longest_first = sorted(strings, key=len, reverse=True)
        return re.compile("(" + "|".join(map(re.escape, longest_first)) + ")", flags) if longest_first else None

    @classmethod
    def of(cls, path: str, kept: int | None = None) -> Encoder:
        table = _of_process()
        if path not in table:
            table[path] = cls(path, kept)
        return table[path]

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, text: str) -> list[str]:
        """The first piece, then pieces that follow a space or begin with a line feed."""
        return text.replace("\n", " \n" if self.lead else " ").split(" ")

    def _encode_piece(self, piece: str) -> bytes | bool:
        """Ids of a piece that follows others; False for one that cannot be encoded alone.

        Words of Latin letters, with or without marks behind, are given to the merging model itself: for them
        the steps before it do nothing but map bytes and, in files that do so, lower the case.
        """
        word = piece.rstrip(_MARKS)
        plain = word.isascii() and word.isalpha()
        if not plain and not _LETTERS.fullmatch(word):
            if not self._whole(piece):
                return False
            return self._encode([piece if piece[:1] == "\n" or not self.lead else self.lead + piece])[0]
        marks = piece[len(word) :]
        if not self.lead:
            word = word.lower()
        ids = None
        if word != piece:  # the same word may be known without its marks
            ids = self.pieces.get(word) or self.older.get(word)
        if ids is None:
            whole = self.lead + word
            letters = whole if plain and not self.lead else whole.encode().decode("latin-1").translate(_BYTES)
            ids = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        if not marks:
            return ids
        if marks not in self.marks:
            if len(self.marks) >= KEPT_MARKS:
                self.marks.clear()
            self.marks[marks] = self._encode([marks])[0]
        return ids + self.marks[marks]

    def _whole(self, piece: str) -> bool:
        """Whether a piece from ``_cut`` is encoded alone as it is in its text."""
        if not self.lead:
            return True
        inner = piece[1:] if piece[:1] == "\n" else piece
        return bool(inner) and not inner[0].isspace() and not inner[-1].isspace()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text."""
        if self.whole and any(map(self.whole.search, texts)):
            return [self._encode([t])[0] if self.whole.search(t) else self.encode([t])[0] for t in texts]
        if not self.cuts or not any(map(self.cuts.search, texts)):
            return self._plain(texts)
        parts = [self.cuts.split(t) for t in texts]  # text, token, text, ...
        ids = iter(self._plain([p for part in parts for p in part[::2]]))
        return [b"".join(self.added[p] if k % 2 else next(ids) for k, p in enumerate(part)) for part in parts]

    def _plain(self, texts: list[str]) -> list[bytes]:
        """The ids of texts without added tokens."""
        if len(self.pieces) > self.kept:
            self.pieces.older = {}
            self.pieces = _Known(self._encode_piece, self.pieces)
        first = self._encode([t.split(" ", 1)[0].split("\n", 1)[0] for t in texts]) if self.lead else ()
        look_up, out = self.pieces.__getitem__, []
        for i, text in enumerate(texts):  # one at a time, so that its pieces stay in the processor's cache
            cut = self._cut(text)
            found = list(map(look_up, cut))
            if self.lead:  # nothing stands before the first piece; where spaces are dropped, that is no difference
                found[0] = first[i]
            whole = not self.lead or len(cut) == 1 or (cut[0] and not cut[0][-1].isspace())
            try:
                out.append(b"".join(found) if whole else None)
            except TypeError:  # False among the ids
                out.append(None)
        odd = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(odd, self._odd([texts[i] for i in odd]), strict=True):
            out[i] = ids
        return out

    def _odd(self, texts: list[str]) -> list[bytes]:
        """Texts with runs of white space: cut only at single inner spaces."""
        cut = [_INNER_SPACE.split(t) for t in texts]
        flat = [self.lead * (k > 0) + p for c in cut for k, p in enumerate(c)]
        distinct = list(dict.fromkeys(flat))
        ids = dict(zip(distinct, self._encode(distinct), strict=True))
        at, out = iter(flat), []
        for c in cut:
            out.append(b"".join(ids[next(at)] for _ in c))
        return out

