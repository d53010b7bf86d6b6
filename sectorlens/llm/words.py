"""Word splitting shared by the corpus operators.

Both splitters work on the UTF-8 bytes of a text: only A-Z are lower-cased
and every separator is ASCII, so bytes of longer code points are never cut.
"""

from __future__ import annotations

WHITESPACE_WORD = r"[^\x20\x09-\x0D]+"

_ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def whitespace_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased."""
    return text.lower().split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.translate(_ALNUM).split() if text else []
