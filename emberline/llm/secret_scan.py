"""Secret scan over a trigram index.

From each rule's regex a Boolean query over trigrams is derived that every match must satisfy. Documents are indexed
shard by shard (a shard is a slice of an Arrow batch): for each trigram that any query mentions, the postings are
the documents of the shard that hold it. The queries intersect and unite postings, and only the documents left are
searched with the regex. A rule with no mandatory trigram searches every document. No text leaves its shard, so
that nothing is shuffled and memory follows one shard.

Everything is folded to lower case for the index (A-Z only), which can only add candidates.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as op
from re import _parser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from emberline.llm.common import ASCII_LOWER, SLICE_ROWS, map_rows

#: Sets of strings beyond these sizes are treated as unknown.
_MOST_STRINGS = 64
_MOST_CHARS = 16
_PART_BYTES = 4 << 20


# ---- Boolean trigram queries: True (every document), a trigram, or ("and" | "or", frozenset of queries)

def conjunction(parts: Iterable) -> object:
    flat = {p for p in parts if p is not True}
    return True if not flat else next(iter(flat)) if len(flat) == 1 else ("and", frozenset(flat))


def disjunction(parts: Iterable) -> object:
    flat = set(parts)
    return True if True in flat or not flat else next(iter(flat)) if len(flat) == 1 else ("or", frozenset(flat))


def _of_strings(strings: frozenset[str]) -> object:
    """What holds for a text that contains one of ``strings``; trigrams are of UTF-8 bytes, read as Latin-1."""
    def of(s: str) -> object:
        b = s.encode("utf-8").decode("latin-1")
        return conjunction(b[i:i + 3] for i in range(len(b) - 2))

    return disjunction(of(s) for s in strings)


@dataclass(frozen=True)
class _Known:
    """Of what a part of a regex matches: all strings, or how it starts and ends, and a query it implies."""

    exact: frozenset[str] | None = None
    prefix: frozenset[str] = frozenset([""])
    suffix: frozenset[str] = frozenset([""])
    query: object = True

    def starts(self) -> frozenset[str]:
        return self.prefix if self.exact is None else self.exact

    def ends(self) -> frozenset[str]:
        return self.suffix if self.exact is None else self.exact

    def implied(self) -> object:
        return self.query if self.exact is None else conjunction([self.query, _of_strings(self.exact)])


_UNKNOWN = _Known()


def _strings(strings: Iterable[str]) -> _Known:
    found = frozenset(strings)
    return _Known(found) if len(found) <= _MOST_STRINGS else _UNKNOWN


def _then(a: _Known, b: _Known) -> _Known:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= _MOST_STRINGS:
        return _strings(x + y for x, y in product(a.exact, b.exact))
    around = True
    if len(a.ends()) * len(b.starts()) <= _MOST_STRINGS:
        around = _of_strings(frozenset(x[-2:] + y[:2] for x, y in product(a.ends(), b.starts())))
    first, last = a.starts(), b.ends()
    if a.exact is not None and len(first) * len(b.starts()) <= _MOST_STRINGS:
        first = frozenset(x + y for x, y in product(first, b.starts()))
    if b.exact is not None and len(last) * len(a.ends()) <= _MOST_STRINGS:
        last = frozenset(x + y for x, y in product(a.ends(), last))
    return _Known(None, first, last, conjunction([a.implied(), b.implied(), around]))


def _either(a: _Known, b: _Known) -> _Known:
    if a.exact is not None and b.exact is not None and len(a.exact | b.exact) <= _MOST_STRINGS:
        return _Known(a.exact | b.exact)
    return _Known(None, a.starts() | b.starts(), a.ends() | b.ends(), disjunction([a.implied(), b.implied()]))


def _characters(items: list) -> _Known:
    found: set[str] = set()
    for kind, value in items:
        low, high = (value, value) if kind is op.LITERAL else value if kind is op.RANGE else (0, 1 << 30)
        if high - low >= 2 * _MOST_CHARS:
            return _UNKNOWN
        found |= {_fold(chr(c)) for c in range(low, high + 1)}
    return _strings(found) if len(found) <= _MOST_CHARS else _UNKNOWN


def _fold(c: str) -> str:
    return chr(ASCII_LOWER[ord(c)]) if ord(c) < 128 else c


def _analyse(nodes: Iterable) -> _Known:
    known = _strings([""])
    for kind, value in nodes:
        if kind is op.LITERAL:
            part = _strings([_fold(chr(value))])
        elif kind is op.IN:
            part = _characters(value)
        elif kind is op.BRANCH:
            part = reduce(_either, map(_analyse, value[1]))
        elif kind is op.SUBPATTERN:
            part = _analyse(value[3])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            low, high, inner = value
            part = _analyse(inner)
            if low == 0:
                part = _either(part, _strings([""])) if high == 1 else _UNKNOWN
            elif high > 1:
                part = _Known(None, part.starts(), part.ends(), part.implied())
        elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
            part = _strings([""])
        else:
            part = _UNKNOWN
        known = _then(known, part)
    return known


def trigram_query(pattern: re.Pattern) -> object:
    """A query that holds for every text with a match, True where nothing is mandatory."""
    return _analyse(_parser.parse(pattern.pattern, pattern.flags)).implied()


def trigrams(query: object) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


class TrigramIndex:
    """Postings of the wanted trigrams for one shard of documents."""

    def __init__(self, wanted: list[str]):
        self.number = {t: i + 1 for i, t in enumerate(wanted)}
        self.table = np.zeros(1 << 24, np.uint16)
        for t, i in self.number.items():
            self.table[int.from_bytes(t.encode("latin-1"))] = i
        self.postings: dict[int, np.ndarray] = {}
        self.documents = np.arange(0)

    def fill(self, texts: list[str]) -> None:
        parts = [t.encode("utf-8", "surrogatepass").translate(ASCII_LOWER) for t in texts]
        self.documents = np.arange(len(parts))
        found, first, size = [], 0, 0
        for i, part in enumerate(parts):  # a few MB of text at a time
            size += len(part) + 1
            if size >= _PART_BYTES or i + 1 == len(parts):
                found.append(self._places(parts[first:i + 1], first, len(parts)))
                first, size = i + 1, 0
        which, document = np.divmod(np.unique(np.concatenate(found)) if found else self.documents, len(parts) or 1)
        ends = np.searchsorted(which, np.arange(1, len(self.number) + 2))
        self.postings = {i: document[ends[i - 1]:ends[i]] for i in self.number.values()}

    def _places(self, parts: list[bytes], first: int, n: int) -> np.ndarray:
        """trigram number * n + document, once each."""
        data = np.frombuffer(b"\0".join(parts), np.uint8).astype(np.int32)
        numbers = self.table[(data[:-2] << 16) | (data[1:-1] << 8) | data[2:]]
        places = np.flatnonzero(numbers)
        starts = np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1]
        return np.unique(numbers[places].astype(np.int64) * n + first + np.searchsorted(starts, places, "right") - 1)

    def candidates(self, query: object) -> np.ndarray:
        if query is True:
            return self.documents
        if isinstance(query, str):
            return self.postings.get(self.number[query], self.documents[:0])
        found = [self.candidates(q) for q in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(found))
        return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), sorted(found, key=len))


# ---- rules

@dataclass(frozen=True)
class SecretRule:
    """``least`` characters are asked of ``group``; a match that has fewer is dropped, the search goes on behind it."""

    kind: str
    pattern: re.Pattern
    group: int = 0
    least: int = 0

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in self.pattern.finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]


#: Fixed values of the result contract.
BASE_RULES = (
    SecretRule("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
                                    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
                                    r"""([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    SecretRule("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    SecretRule("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)

#: From the header through the key's fields and lines of base64 up to the END line, if that follows; whatever else comes
#: first, such as prose, ends the span. Lines stand alone, or are long runs anywhere, or words between header and END
#: where nothing but such words is between them. Between them may stand white space, also written as escapes, and the
#: marks of quotes, comments and joined strings.
_KEY_BEGIN = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
_KEY_END = r"-----END [A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
_KEY_GAP = r"""(?:[\s>#*|"'`,;]|\\+[nrt]?|[+-](?=\s)|//(?=\s))*+"""
_KEY_FIELD = r"[A-Z][A-Za-z0-9]*(?:-[A-Za-z0-9]+)*+:[^\S\r\n]*[^\r\n\\]+"
_KEY_LINE = r"""(?:[A-Za-z0-9+/]{24,}+={0,2}|=?[A-Za-z0-9+/]++={0,2}(?=[ \t"'`,;+]*(?:[\r\n\\]|\Z|-----)))"""
_KEY_BODY = rf"(?:{_KEY_GAP}{_KEY_FIELD}(?=\s|\\))*+(?:{_KEY_GAP}{_KEY_LINE})*+"
_PRIVATE_KEY = rf"{_KEY_BEGIN}{_KEY_BODY}(?:{_KEY_GAP}{_KEY_END})?"

#: Formats that their issuers have published.
MORE_RULES = (
    SecretRule("private_key", re.compile(_PRIVATE_KEY)),
    SecretRule("github", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,255}")),
    SecretRule("slack", re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,250}")),
    SecretRule("google", re.compile(r"AIza[0-9A-Za-z_-]{35}")),
    SecretRule("gitlab", re.compile(r"glpat-[A-Za-z0-9_-]{20,255}")),
    SecretRule("npm", re.compile(r"npm_[A-Za-z0-9]{36,255}")),
    SecretRule("openai", re.compile(r"sk-proj-[A-Za-z0-9_-]{20,255}")),
    SecretRule("aws_secret", re.compile(r"""[Aa][Ww][Ss]_[Ss][Ee][Cc][Rr][Ee][Tt]_[Aa][Cc][Cc][Ee][Ss][Ss]_[Kk][Ee][Yy]["']?\x20*[:=]\x20*["']?"""
                                         r"""[A-Za-z0-9+/]{40}""")),
    SecretRule("stripe", re.compile(r"[rs]k_live_[0-9A-Za-z]{16,250}")),
    SecretRule("jwt", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    SecretRule("bearer", re.compile(r"[Bb]earer\x20+[A-Za-z0-9._~+/-]{20,}")),
)

MASK = "[SECRET]"


class Scanner:
    """Finds the spans of every rule in a shard of texts."""

    def __init__(self, rules: tuple[SecretRule, ...]):
        self.rules = [(rule, trigram_query(rule.pattern)) for rule in rules]
        self.index = TrigramIndex(sorted(set().union(*(trigrams(q) for _, q in self.rules))))

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Per text (start, rule number, end), sorted."""
        self.index.fill(texts)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for number, (rule, query) in enumerate(self.rules):
            for i in self.index.candidates(query):
                found[i] += [(start, number, end) for start, end in rule.spans(texts[i])]
        return [sorted(spans) for spans in found]


def _joined(spans: list[tuple[int, int, int]], rules: tuple[SecretRule, ...]) -> str:
    return ",".join(f"{rules[n].kind}:{start}:{end}" for start, n, end in spans)


def _per_document(docs: DataFrame, schema: str, rules: tuple[SecretRule, ...], make_row: Callable) -> DataFrame:
    def make():
        scanner = Scanner(rules)

        def work(ids, texts):
            texts = [t or "" for t in texts]
            return [make_row(i, t, spans) for i, t, spans in zip(ids, texts, scanner.scan(texts))]
        return work

    return map_rows(docs, ["doc_id", "text"], schema, make)


def scan_secrets(docs: DataFrame, base: tuple[SecretRule, ...] = BASE_RULES,
                 more: tuple[SecretRule, ...] = MORE_RULES) -> DataFrame:
    """Counts per base kind, digest of the base spans and all spans, for every row of ``docs`` (doc_id, text).

    Spans are kind:start:end in code points, by start and then in the order of the rules. NULL texts count as
    empty and have none; a NULL doc_id and repeated rows are scanned like any row; very long texts are scanned whole; an
    empty table gives an empty result; other columns are ignored.
    """
    rules = (*base, *more)
    schema = ("doc_id long, " + ", ".join(f"n_{r.kind} long" for r in base) + ", base_sha256 string, spans string")

    def make_row(doc_id, text, spans):
        own = [s for s in spans if s[1] < len(base)]
        counts = [sum(s[1] == n for s in own) for n in range(len(base))]
        digest = hashlib.sha256(_joined(own, rules).encode()).hexdigest()
        return (doc_id, *counts, digest, _joined(spans, rules))

    return _per_document(docs, schema, rules, make_row)


def masked(text: str, spans: list[tuple[int, int, int]], mask: str = MASK) -> str:
    """``text`` with every span, or run of overlapping spans, replaced."""
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def mask_secrets(docs: DataFrame, rules: tuple[SecretRule, ...] = (*BASE_RULES, *MORE_RULES)) -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced by MASK; all other columns and rows stay as they are.

    NULL stays NULL and empty texts stay empty; very long texts are masked whole; an empty table stays empty.
    """

    @pandas_udf("string")
    def mask(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(rules)
        for column in parts:
            out = []
            for start in range(0, len(column), SLICE_ROWS):
                texts = column.iloc[start:start + SLICE_ROWS].tolist()
                found = scanner.scan([t or "" for t in texts])
                out += [masked(t, spans) if spans else t for t, spans in zip(texts, found)]
            yield pd.Series(out, dtype=object)

    return docs.withColumn("text", mask(F.col("text")))
