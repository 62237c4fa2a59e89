"""Token ids of whole texts by the ``tokenizers`` library, memoised by unit.

A text is cut into units at places where the tokenizer itself always cuts, so
the ids of the text are the ids of its units in order.  Each distinct unit is
encoded once per worker and kept as its little-endian unsigned 32-bit ids;
a text is then a join of byte strings.
The memo has two generations of ``MEMO_UNITS`` / 2 entries: units in use move
to the younger, the older is dropped when that is full.  This bounds a
worker's memory and changes no result.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

from gridlens.llm.common import worker_cache

MEMO_UNITS = 1_500_000

# Where a tokenizer always cuts.  A run of Latin letters ends
# before any ASCII character that isn't one (possessive, so never earlier).
# Word BPE drops white space and never spans it; byte BPE glues one blank to
# the word after it.  White space is Unicode White_Space: Python's \s without
# x1c-x1f.
_LETTERS = r"[A-Za-zÀ-ÖØ-öø-įı-ɏ]++(?=[\x00-\x7f]|\Z)"
WORD_UNITS = _LETTERS + r"|[^ \n]+"
BYTE_UNITS = " ?" + _LETTERS + r"| ?[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+(?![\S\x1c-\x1f])|[^\S\x1c-\x1f]+"

# Texts with none of these may be lower-cased before a lower-casing tokenizer
# sees them: no composition, special casing or special token is at stake.
_KEEP_CASE = re.compile("[^\\x00-įı-ɏ]|<\\|").search

assert array("I").itemsize == 4 and sys.byteorder == "little"


class _Memo(dict):
    def __init__(self, tokenizer):
        super().__init__()
        self.old = {}
        self.batch = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)  # without offsets

    def whole(self, text: str) -> bytes:
        return array("I", self.batch([text], add_special_tokens=False)[0].ids).tobytes()

    def __missing__(self, unit):
        got = self[unit] = self.old[unit] if unit in self.old else self.whole(unit)
        return got

    def rotate(self) -> None:
        if len(self) > MEMO_UNITS // 2:
            self.old = dict(self)
            self.clear()


class UnitEncoder:
    """Encodes texts to little-endian u32 id bytes, equal to encoding each whole text."""

    def __init__(self, path: str, units: str, lower: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.find = re.compile(units).findall
        self.lower = lower
        marks = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(marks) or r"(?!)").search
        self.memo = _Memo(self.tokenizer)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.special(text):  # cuts around special tokens are the tokenizer's own
            return self.memo.whole(text)
        self.memo.rotate()
        if self.lower and not _KEEP_CASE(text):
            text = text.lower()
        return b"".join(map(self.memo.__getitem__, self.find(text)))

    def encode_many(self, texts):
        return map(self.encode, texts)


def encoder(path: str, units: str, lower: bool = False) -> UnitEncoder:
    """The encoder of this worker for ``path``; kept while the worker stays with it."""
    kept = worker_cache("tokens")
    if path not in kept:
        kept[path] = UnitEncoder(path, units, lower)
    return kept[path]
