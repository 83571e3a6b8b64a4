"""Cutting texts for byte-level tokenizers.

Their pre-tokenizing pattern never makes a token that runs from a character into white space that follows it. So a
text may be cut before each run of white space, and the chunks be encoded one by one, and each distinct chunk once.
"""

from __future__ import annotations

import re

#: White space of the pattern (Unicode's White_Space).
_SPACE = "\t-\r \x85\xa0  -     　"
_RUN_BEFORE_BLANK = re.compile(f"[{_SPACE}] ")
_RUN_BEFORE_BLANK_OR_BREAK = re.compile(f"[{_SPACE}][ \n]")
_CHUNKS = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")


def chunks(text: str) -> tuple[list[str], list[str]]:
    """(whole chunks, chunks that follow without their leading blank), in order; together they are ``text``.

    Where every blank stands behind another character, blanks alone are cut at: the quick and usual case.
    """
    if not text:
        return [], []
    if text[0] == " " or _RUN_BEFORE_BLANK.search(text):
        return _CHUNKS.findall(text), []
    first, *rest = text.split(" ")
    return [first], rest


def chunks_by_line(text: str) -> tuple[list[str], str | None]:
    """(whole chunks, the rest of the text, to be split at blanks), where line breaks of the rest have a blank before them.

    A chunk of the rest stands behind a blank, or begins with a line break, which stands for that blank. This is for texts
    where each blank and line break stands behind another character; others are whole chunks.
    """
    if not text:
        return [], None
    if text[0] == " " or _RUN_BEFORE_BLANK_OR_BREAK.search(text):
        return _CHUNKS.findall(text), None
    first, blank, rest = text.replace("\n", " \n").partition(" ")
    return [first], rest if blank else None
