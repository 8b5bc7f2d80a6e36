"""Cutting texts into the pieces that a tokenizer merges apart."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import regex


class Cutter:
    """Finds pieces by a pattern with ``LETTER``, ``NUMBER`` and ``SPACE`` as class members.

    The tokenizers' own pattern engine knows the letters of an older Unicode than the
    ``regex`` package does. Texts that hold a newer one are cut by a slower pattern that
    leaves those out.
    """

    def __init__(self, pattern: str, space: str = r"\s"):
        self.pattern = pattern.replace("SPACE", space)
        plain = self.pattern.replace("LETTER", r"\p{L}").replace("NUMBER", r"\p{N}")
        self.plain = regex.compile(plain)
        self.exact = None

    def pieces(self, text: str) -> list[str]:
        data = np.frombuffer(text.encode(), np.uint8)
        # The first of those letters begins with byte 0xD5 in UTF-8.
        if not len(data) or data.max() < 0xD5 or not newer_letter().search(text):
            return self.plain.findall(text)
        if self.exact is None:
            new = newer_letter().pattern[1:-1]
            letter, number = rf"[\p{{L}}--[{new}]]", rf"[\p{{N}}--[{new}]]"
            exact = self.pattern.replace("LETTER", letter).replace("NUMBER", number)
            self.exact = regex.compile(exact, regex.V1)
        return self.exact.findall(text)


@lru_cache(maxsize=1)
def newer_letter() -> regex.Pattern:
    """Letters and numbers that Unicode has got since the tokenizers' engine was made.

    They are those that Python's own character table, of the same age as that engine,
    does not know yet.
    """
    unknown = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
    ranges: list[list[int]] = []
    for c in map(ord, "".join(regex.findall(r"[\p{L}\p{N}]+", unknown))):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return regex.compile("[" + "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in ranges) + "]")
