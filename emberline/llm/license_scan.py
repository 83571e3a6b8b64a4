"""License scan: exact phrases, and short notices with a bounded number of edits.

A notice that occurs with at most k edits holds at least one of any k + 1 pieces of it unchanged. All pieces of all
notices and all exact phrases are in one Aho-Corasick automaton, so that one pass over a text finds every seed; only
the windows around seeds are given to the regex library, whose bounded-error matching verifies them and reports
spans. Each text is scanned where it lies: nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable
from dataclasses import dataclass

import ahocorasick
import regex
from pyspark.sql import DataFrame

from emberline.llm.common import map_rows

#: Fixed values of the result contract: phrases that count exactly, with their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 12


@dataclass(frozen=True)
class Notice:
    """Words as the scan sees them: lower case, one blank apart."""

    label: str
    words: str

    @property
    def edits(self) -> int:
        return max(1, len(self.words) // CHARS_PER_EDIT)

    def pieces(self) -> list[tuple[int, str]]:
        """edits + 1 pieces that make up the notice, with their places in it."""
        n = self.edits + 1
        cuts = [len(self.words) * i // n for i in range(n + 1)]
        return [(a, self.words[a:b]) for a, b in zip(cuts, cuts[1:])]


#: Short notices as their licenses recommend or contain them.
NOTICES = (
    Notice("apache-2.0", "licensed under the apache license version 2 0"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Notice("cc-by", "licensed under the creative commons attribution 4 0 international license"),
    Notice("cc-by-nc", "licensed under cc by nc 4 0"),
    Notice("cc-by-sa", "licensed under cc by sa 4 0"),
    Notice("cc0", "dedicated to the public domain under cc0 1 0"),
    Notice("gpl", "licensed under the gnu general public license version 3"),
    Notice("lgpl", "licensed under the gnu lesser general public license version 3"),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Notice("mit", "released under the mit license"),
    Notice("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    Notice("public-domain", "released into the public domain"),
    Notice("reserved", "all rights reserved no part of this publication may be reproduced"),
)

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def normal_words(text: str | None) -> list[bytes]:
    """A-Z in lower case; every other ASCII character than letters and digits separates words."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


@dataclass(frozen=True)
class Found:
    label: str
    start: int  # characters of the blank-joined words
    end: int
    edits: int
    length: int

    @property
    def similarity(self) -> float:
        return max(0.0, 1 - self.edits / self.length)


class LicenseScanner:
    def __init__(self, notices: Iterable[Notice] = NOTICES, phrases: Iterable[tuple[str, str]] = PHRASES):
        self.notices, self.phrases = tuple(notices), tuple(phrases)
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n.words, literal_spaces=True)}){{e<={n.edits}}}")
                         for n in self.notices]
        keys: dict[str, list[tuple[int, int]]] = {}
        for i, (words, _) in enumerate(self.phrases):
            keys.setdefault(f" {words} ", []).append((-1 - i, 0))
        for i, notice in enumerate(self.notices):
            for at, piece in notice.pieces():
                keys.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for key, uses in keys.items():
            self.automaton.add_word(key, (len(key), uses))
        self.automaton.make_automaton()

    def seeds(self, padded: str) -> tuple[list[tuple[int, int]], dict[int, list[tuple[int, int]]]]:
        """Exact phrases as (place of the blank before, phrase), and per notice the windows to verify."""
        exact: list[tuple[int, int]] = []
        begins: dict[int, set[int]] = {}  # where a notice would begin by its seeds
        for end, (size, uses) in self.automaton.iter(padded):
            for which, at in uses:
                start = end + 1 - size
                if which < 0:
                    exact.append((start, -1 - which))
                    continue
                begins.setdefault(which, set()).add(start - at)
        windows: dict[int, list[tuple[int, int]]] = {}
        for which, places in begins.items():
            notice, runs = self.notices[which], []
            for place in sorted(places):  # seeds of one copy differ by its edits; those of the next one lie further off
                if runs and place - runs[-1][0] <= 2 * notice.edits:
                    runs[-1][1] = place
                else:
                    runs.append([place, place])
            windows[which] = [(max(0, first - notice.edits), min(len(padded), last + len(notice.words) + notice.edits))
                              for first, last in runs]
        return exact, windows

    def matches(self, which: int, padded: str, windows: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """(edits, start, end) of matches of one notice that don't overlap, those with the fewest edits first.

        A search tells the best match of its window only. What lies before and behind it, and what a match of another
        window leaves over, is searched again, down to what is too short for a match.
        """
        least = len(self.notices[which].words) - self.notices[which].edits
        taken: list[tuple[int, int, int]] = []
        starts: list[int] = []  # of what is taken, in order, with the ends beside
        ends: list[int] = []
        while windows:
            found = []
            for low, high in set(windows):
                m = self.patterns[which].search(padded, low, high)
                if m:
                    found.append((sum(m.fuzzy_counts), m.start(), m.end(), low, high))
            windows = []
            for edits, start, end, low, high in sorted(found):
                at = bisect_right(starts, start)
                if (at == 0 or ends[at - 1] <= start) and (at == len(starts) or starts[at] >= end):
                    taken.append((edits, start, end))
                    starts.insert(at, start)
                    ends.insert(at, end)
                windows.append((low, high))
            free = []
            for low, high in windows:
                at = bisect_right(ends, low)
                while at < len(starts) and starts[at] < high:
                    free.append((low, starts[at]))
                    low, at = max(low, ends[at]), at + 1
                free.append((low, high))
            windows = [(low, high) for low, high in free if high - low >= least]
        return taken

    def notices_in(self, padded: str, windows: dict[int, list[tuple[int, int]]]) -> list[Found]:
        """Verified notices; of overlapping ones the most similar stays, then the longest, then the first."""
        found = []
        for which, places in windows.items():
            notice = self.notices[which]
            found += [Found(notice.label, start, end, edits, len(notice.words))
                      for edits, start, end in self.matches(which, padded, places)]
        kept: list[Found] = []
        for one in sorted(found, key=lambda f: (-f.similarity, -f.length, f.start, f.label)):
            if all(one.end <= other.start or one.start >= other.end for other in kept):
                kept.append(one)
        return sorted(kept, key=lambda f: f.start)

    def scan(self, text: str | None) -> tuple:
        """(n_words, n_base, first_word, last_word, base_labels, labels, score, spans)"""
        words = normal_words(text)
        padded = " " + b" ".join(words).decode("utf-8", "surrogatepass") + " "
        exact, windows = self.seeds(padded)
        notices = self.notices_in(padded, windows) if windows else []
        starts = sorted(at for at, _ in exact)
        first = padded.count(" ", 0, starts[0]) if exact else None
        last = padded.count(" ", 0, starts[-1]) if exact else None
        base = {self.phrases[i][1] for _, i in exact}
        labels = base | {f.label for f in notices}
        score = 1.0 if exact else max((f.similarity for f in notices), default=0.0)
        # every word follows a blank: those up to a character count the words begun before or at it
        spans = ",".join(f"{f.label}:{max(0, padded.count(' ', 0, f.start + 1) - 1)}:{padded.count(' ', 0, f.end)}:{f.edits}"
                         for f in notices)
        return len(words), len(exact), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score, spans


def scan_licenses(docs: DataFrame) -> DataFrame:
    """License phrases and notices for every row of ``docs`` (doc_id, text).

    n_words; n_base, first_word, last_word and base_labels of the exact phrases (every place, also overlapping
    ones; words from 0, NULL without any); labels with those of fuzzy notices added; score, 1 for an exact phrase
    and else the similarity of the best notice, or 0; spans, label:first word:end word:edits of each notice. NULL
    texts count as empty, repeated rows and NULL ids are scanned like any row, an empty table gives an empty
    result, other columns are ignored.
    """
    schema = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
              "labels string, score double, spans string")

    def make():
        scanner = LicenseScanner()
        return lambda ids, texts: [(i, *scanner.scan(t)) for i, t in zip(ids, texts)]

    return map_rows(docs, ["doc_id", "text"], schema, make)
