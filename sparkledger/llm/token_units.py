"""Exact tokenisation by units: texts are cut where no token can span, and each distinct unit is encoded once per worker.

A boundary is *safe* for a tokenizer if encoding the two sides apart gives the same ids as encoding them together:

* ``word`` (the pre-tokenizer drops white space): at every ASCII space or line feed;
* ``byte`` (a token may start with one space, and none has white space after another character): before an ASCII space
  that is followed by a character other than white space, and on both sides of a lone line feed.

Texts that hold one of the tokenizer's added tokens are encoded in one piece, since these are matched on the raw text.
A unit of Latin letters goes to the model directly, also with a single full stop or comma at its end (``word``) or with
any ASCII punctuation there (``byte``: letters and what follows them are pre-tokens of their own); any other new unit goes
to the whole tokenizer.
"""

from __future__ import annotations

import os
import re
import string
import struct

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Units kept by a worker; beyond it the memory of ``lengths`` is emptied and filled anew, and that of ``ids`` drops the half
#: met longest ago (results do not change).
MEMORY_UNITS = 500_000
#: Characters of new units that go to the tokenizer in one call.
CALL_CHARS = 1 << 18

_SPACED = re.compile(r"[ \n]\s")
_CUT = re.compile(r" (?=\S)")
_LATIN_END = "İ"
_LOADED: dict[tuple, "UnitEncoder"] = {}


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins that byte-level vocabularies use for the 256 byte values."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    return table | {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in table)}


class _UnitIds(dict):
    """Ids of units after one space, or as they are behind a line feed; a missing unit is learned when it is looked up.

    A full half becomes the older one, from which units come back when they are met again.
    """

    def __init__(self, encoder: "UnitEncoder"):
        super().__init__()
        self.encoder, self.older = encoder, {}

    def __missing__(self, unit: str) -> bytes:
        value = self.older.get(unit)
        if value is None:
            value = self.encoder._learn(unit)
        if len(self) >= MEMORY_UNITS // 2:
            self.older = dict(self)
            self.clear()
        self[unit] = value
        return value


class UnitEncoder:
    """Lengths or ids of whole texts, from a memory of units."""

    def __init__(self, path: str, kind: str, lengths_only: bool):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model = self.tok.model
        self.kind, self.lengths_only = kind, lengths_only
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.first: dict = {}  # lengths of units as they are
        self.units = _UnitIds(self)
        self.line = b"" if lengths_only else self._whole("\n")

    @classmethod
    def of(cls, path: str, kind: str, lengths_only: bool) -> "UnitEncoder":
        """The worker's encoder: its memory outlives a task."""
        key = (path, kind, lengths_only)
        if key not in _LOADED:
            _LOADED[key] = cls(path, kind, lengths_only)
        return _LOADED[key]

    def _value(self, ids: list[int]):
        return len(ids) if self.lengths_only else struct.pack(f"<{len(ids)}I", *ids)

    def _whole(self, text: str):
        return self._value(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def _learn(self, unit: str) -> bytes:
        """Ids of a unit as ``_UnitIds`` names it."""
        core = unit.rstrip(string.punctuation)
        lead, bare, line = ("", core[1:], self.line) if core[:1] == "\n" else (self.letters[32], core, b"")
        if not bare.isalpha() or not (bare.isascii() or max(bare) < _LATIN_END):
            return line + self._whole(" " + unit if lead else unit[1:])
        if len(core) < len(unit):
            return self.units[core] + self.units["\n" + unit[len(core) :]][len(self.line) :]
        mapped = bare if bare.isascii() else bare.encode().decode("latin-1").translate(self.letters)
        return line + self._value([t.id for t in self.model.tokenize(lead + mapped)])

    def _learn_lengths(self, units: set[str]) -> None:
        memory = self.first
        if len(memory) + len(units) > MEMORY_UNITS:
            memory.clear()
        rest = []
        for u in units:
            if u in memory:
                continue
            core, tail = (u[:-1], u[-1]) if u[-1:] in (".", ",") else (u, "")
            if core and core.isalpha() and max(core) < _LATIN_END:
                if self.kind == "word":
                    core = core.lower()
                value = len(self.model.tokenize(core if core.isascii() else core.encode().decode("latin-1").translate(self.letters)))
                memory[u] = value + self._tail(tail) if tail else value
            elif u:
                rest.append(u)
            else:
                memory[u] = 0
        lo = 0
        while lo < len(rest):
            hi, size = lo, 0
            while hi < len(rest) and (hi == lo or size + len(rest[hi]) <= CALL_CHARS):
                size += len(rest[hi])
                hi += 1
            for u, e in zip(rest[lo:hi], self.tok.encode_batch(rest[lo:hi], add_special_tokens=False), strict=True):
                memory[u] = len(e.ids)
            lo = hi

    def _tail(self, tail: str):
        if tail not in self.first:
            self.first[tail] = self._whole(tail)
        return self.first[tail]

    def lengths(self, texts: list[str]) -> list[int]:
        """Tokens of each text, by a tokenizer of kind ``word``."""
        cut = [None if any(a in t for a in self.added) else t.replace("\n", " ").split(" ") for t in texts]
        seen = set().union(*(c for c in cut if c))
        if not seen <= self.first.keys():
            self._learn_lengths(seen)
            if not seen <= self.first.keys():  # emptied on the way
                self._learn_lengths(seen)
        get = self.first.__getitem__
        return [self._whole(t) if c is None else sum(map(get, c)) for t, c in zip(texts, cut, strict=True)]

    def ids(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers, by a tokenizer of kind ``byte``."""
        if any(a in text for a in self.added):
            return self._whole(text)
        parts = _CUT.split(text) if _SPACED.search(text) else text.replace("\n", " \n").split(" ")
        parts[0] = "\n" + parts[0]
        return b"".join(map(self.units.__getitem__, parts))[len(self.line) :]
