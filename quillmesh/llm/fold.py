"""Folding of Vietnamese text to plain lower-case letters."""

from __future__ import annotations

import re
from functools import lru_cache
from unicodedata import category, combining, normalize

_WORDS = re.compile(r"[^\W_]+")


@lru_cache(maxsize=200_000)
def fold_char(c: str) -> str:
    """The letter without its marks, in lower case; đ and eth are d; format characters vanish."""
    if category(c) == "Cf":
        return ""
    out = "".join(x for x in normalize("NFKD", c.lower()) if not combining(x))
    return out.replace("đ", "d").replace("ð", "d")


class _Table(dict):
    def __missing__(self, code: int) -> str:
        self[code] = out = fold_char(chr(code)) if not combining(chr(code)) else ""
        return out


_TABLE = _Table()


def fold(text: str) -> str:
    """``text`` in lower case without accents; lengths may change."""
    return text.translate(_TABLE)


def fold_words(text: str) -> list[str]:
    """The folded words of ``text``; everything else separates."""
    return _WORDS.findall(fold(text))
