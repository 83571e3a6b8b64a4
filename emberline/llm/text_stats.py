"""Statistics of one text, as numbers: counted once, used by the quality rules and the quality classifier."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from emberline.llm.common import SPACES

#: Fixed values of the result contract.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_ENDS = (".", "!", "?", ":", '."', "…", "。")


class TextStats(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_lines: int
    n_ended_lines: int
    n_distinct_words: int
    n_upper: int
    n_lower: int
    n_digits: int
    n_exclaim: int
    n_same_as_before: int
    n_punctuation: int


def _count(data: bytes, wanted: bytes) -> int:
    return len(data) - len(data.translate(None, wanted))


def repeated_words(ids: np.ndarray, distinct: int) -> tuple[int, int]:
    """Words inside a window of five that occurs at least twice, and words equal to the word before.

    Windows are compared by value: ids are packed into one integer where they fit, and ranked in two steps
    where they don't.
    """
    n = len(ids)
    same = int(np.count_nonzero(ids[1:] == ids[:-1])) if n > 1 else 0
    if n <= WINDOW:
        return 0, same
    base = max(distinct, 2)
    if base ** WINDOW < 2 ** 63:
        code = ids[:n - 4]
        for i in range(1, WINDOW):
            code = code * base + ids[i:n - 4 + i]
    else:
        pairs = ids[:-1] * base + ids[1:]
        rank = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        first, second = rank[:n - 4], rank[2:n - 2]
        fours = np.unique(first * n + second, return_inverse=True)[1].astype(np.int64)
        code = fours * base + ids[4:]
    order = np.argsort(code, kind="stable")
    ordered = code[order]
    twin = ordered[1:] == ordered[:-1]
    if not twin.any():
        return 0, same
    again = np.zeros(n - 4, bool)
    again[order[1:][twin]] = True
    again[order[:-1][twin]] = True
    steps = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(steps[:n]) > 0)), same


def text_stats(text: str | None) -> TextStats:
    """NULL counts as the empty text; all numbers are then 0."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    repeats, same = repeated_words(ids, len(seen))
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    return TextStats(
        n_words=len(words), word_chars=len(text) - _count(data, SPACES), n_symbols=_count(data, SYMBOLS),
        n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=repeats, n_lines=len(lines),
        n_ended_lines=sum(line.rstrip(" \t\x0b\x0c\r").endswith(_ENDS) for line in lines),
        n_distinct_words=len(seen), n_upper=_count(data, _UPPER), n_lower=_count(data, _LOWER),
        n_digits=_count(data, _DIGITS), n_exclaim=data.count(b"!"), n_same_as_before=same,
        n_punctuation=_count(data, _PUNCTUATION))
