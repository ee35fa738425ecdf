"""Statistics of one whole text, from its UTF-8 bytes."""

from __future__ import annotations

import operator
from collections import Counter
from typing import NamedTuple

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_SYMBOLS = b"#*$%&|<>"
_DIGITS = b"0123456789"
_SPACE = b" \t\n\r\x0b\x0c"
_CONTINUATION = bytes(range(0x80, 0xC0))


def count_of(text: bytes, which: bytes) -> int:
    return len(text) - len(text.translate(None, which))


def code_points(text: bytes) -> int:
    return len(text) - count_of(text, _CONTINUATION)


class TextStats(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_lines: int
    n_upper: int
    n_lower: int
    n_digits: int
    n_exclaim: int
    n_distinct: int
    n_adjacent: int
    n_top: int


def repeated_words(words: list[bytes]) -> int:
    """Words lying in a three-word window that the text has twice or more, the first included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    marks = bytearray(len(words))
    for i, w in enumerate(windows):
        if counts[w] > 1:
            marks[i : i + 3] = b"\1\1\1"
    return sum(marks)


def text_stats(text: bytes) -> TextStats:
    words = text.split()
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    counts = Counter(words)
    return TextStats(
        n_words=len(words),
        word_chars=code_points(text.translate(None, _SPACE)),
        n_symbols=count_of(text, _SYMBOLS),
        n_dup_lines=len(lines) - len(set(lines)),
        n_repeat_words=repeated_words(words),
        n_lines=len(lines),
        n_upper=count_of(text, _UPPER),
        n_lower=count_of(text, _LOWER),
        n_digits=count_of(text, _DIGITS),
        n_exclaim=text.count(b"!"),
        n_distinct=len(counts),
        n_adjacent=sum(map(operator.eq, words, words[1:])),
        n_top=max(counts.values(), default=0),
    )
