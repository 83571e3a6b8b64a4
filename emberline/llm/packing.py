"""Tokenizing into pieces and packing these into sequences: hierarchical best-fit.

Items are dealt into groups of bounded size. Each group packs its own by best fit, largest first; bins that are full
or nearly so are done, the others go up as items of their own into the next round, where a group takes in what
several groups left. The rounds end when one group held everything or when another round would save hardly any bin.
A bin is named by one of its items, so that a piece finds its sequence by following at most as many names as there
were rounds.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain, compress, islice
from operator import not_
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.functions.storage import materialize
from emberline.llm.common import map_rows
from emberline.llm.text_chunks import chunks_by_line

#: Fixed values of the result contract.
LENGTH = 1024
END_ID = 2

#: A bin with no more room than this is done.
NEARLY_FULL = 4
GROUP_ITEMS = 65_536
#: Another round must save this share of the bins that are still open.
WORTH = 0.001
MAX_ROUNDS = 20

#: Chunks longer than this aren't kept; where the cache would have more, only those that the next texts hold stay.
CACHE_CHARS = 48
CACHE_CHUNKS = 600_000

#: Rows, and characters of their texts, that are cut into chunks at a time; a longer text is cut by itself.
TOGETHER_ROWS = 2_048
TOGETHER_CHARS = 2_000_000
#: Texts whose ids are put together at a time.
GATHERED_TEXTS = 64

#: How byte-level vocabularies write a blank and a line break.
BLANK, BREAK = "\u0120", "\u010a"


class ChunkEncoder:
    """Token ids of whole texts as little-endian 32-bit bytes; each distinct chunk is encoded once.

    With ``added_tokens`` the ids are those of the plain library call: where the string of an added token stands, its
    id, and the text between encoded for itself. Without, the strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, added_tokens: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()} if added_tokens else {}
        if added_tokens:
            odd = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()
                   if t.lstrip or t.rstrip or t.single_word or (t.normalized and self.tokenizer.normalizer is not None)]
            if odd:
                raise ValueError(f"added tokens that don't match by their strings alone: {odd}")
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut_added = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if self.added else None
        self.tokenizer.encode_special_tokens = True  # what reaches the library holds none, or takes them for text
        vocabulary = self.tokenizer.get_vocab()
        self.opens = {c: np.zeros(max(vocabulary.values()) + 1, bool) for c in " \n"}
        for before, written in ((" ", BLANK), ("\n", BREAK)):
            self.opens[before][[i for t, i in vocabulary.items() if t.startswith(written)]] = True
        self.marks: dict[str, bytes] = {}
        self.whole: dict[str, bytes] = {}
        self.after_blank: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, known: dict[str, bytes], new: list[str], before: str) -> None:
        """``new`` are chunks that stand behind ``before``, which the ids include."""
        if before:  # it stands before chunks only, so that all can be encoded as one text and told apart
            text = before + before.join(new)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            starts = np.flatnonzero(self.opens[before][ids])
            if len(starts) == len(new):
                data, cuts = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
                known.update(zip(new, map(data.__getitem__, map(slice, cuts, cuts[1:]))))
                return
        known.update(zip(new, self._ids([before + c for c in new])))

    def _learn_all(self, known: dict[str, bytes], new: list[str], before: str) -> None:
        """Chunks that begin with a line break bring what stands before them, others are behind ``before``."""
        if not before:
            self._learn(known, new, "")
            return
        lines = [c[1:] for c in new if c[:1] == "\n"]
        if lines:
            broken: dict[str, bytes] = {}
            self._learn(broken, lines, "\n")
            known.update(("\n" + c, ids) for c, ids in broken.items())
            new = [c for c in new if c[:1] != "\n"]
        if new:
            self._learn(known, new, before)

    def _look_up(self, known: dict[str, bytes], every: list[str], before: str) -> list[bytes]:
        """Ids of each chunk; those that aren't known are learnt together."""
        if len(known) + len(every) > CACHE_CHUNKS:
            kept = {c: known[c] for c in known.keys() & every}
            known.clear()
            known.update(kept)
        found = list(map(known.get, every))
        missing = list(compress(range(len(every)), map(not_, found)))
        new = {every[at] for at in missing}
        if not new:
            return found
        learn, marked = [], []
        for c in new:
            stem = c.rstrip(punctuation)
            # A token ends between a letter and punctuation.
            if stem == c or not stem[-1:].isalpha() or len(c) - len(stem) > CACHE_CHARS:
                learn.append(c)
            else:
                marked.append((c, stem, c[len(stem):]))
        stems = {stem for _, stem, _ in marked}.difference(known, new)
        runs = {run for _, _, run in marked}.difference(self.marks)
        if runs:
            self._learn(self.marks, list(runs), "")
        learn += stems
        if learn:
            self._learn_all(known, learn, before)
        for c, stem, run in marked:
            known[c] = known[stem] + self.marks[run]
        if len(self.marks) > CACHE_CHUNKS:
            self.marks.clear()
        for at in missing:
            found[at] = known[every[at]]
        if max(map(len, new)) > CACHE_CHARS:
            for c in [c for c in chain(new, stems) if len(c) > CACHE_CHARS]:
                del known[c]
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.cut_added is None:
            return self._encode(texts)
        parts = [self.cut_added.split(t) for t in texts]  # text and added token in turn
        between = iter(self._encode([t for part in parts for t in part[::2]]))
        return [b"".join(next(between) if k % 2 == 0 else self.added[t].to_bytes(4, "little") for k, t in enumerate(part))
                for part in parts]

    def _encode(self, texts: list[str]) -> list[bytes]:
        cut = [chunks_by_line(t) for t in texts]
        whole = iter(self._look_up(self.whole, [c for first, _ in cut for c in first], ""))
        first = [b"".join(islice(whole, len(f))) for f, _ in cut]
        rests = pa.array([rest for _, rest in cut], pa.large_string())
        parts = pc.split_pattern(rests, " ")  # no part where there is no rest
        distinct = parts.flatten().dictionary_encode()
        ids = self._look_up(self.after_blank, distinct.dictionary.to_pylist(), " ")
        tokens, sizes = np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts, which, offsets = np.cumsum(sizes) - sizes, distinct.indices.to_numpy(), parts.offsets.to_numpy()
        del cut, rests, parts, distinct, ids
        pa.default_memory_pool().release_unused()
        out = []
        for at in range(0, len(first), GATHERED_TEXTS):
            bounds = offsets[at:at + GATHERED_TEXTS + 1]
            own = which[bounds[0]:bounds[-1]]
            ends = np.concatenate([[0], np.cumsum(sizes[own])])
            places = np.arange(ends[-1]) + np.repeat(starts[own] - ends[:-1], sizes[own])
            data, cuts = tokens[places].tobytes(), (4 * ends[bounds - bounds[0]]).tolist()
            out += [f + data[i:j] for f, i, j in zip(first[at:], cuts, cuts[1:])]
        return out


_encoders: dict[tuple[str, bool], ChunkEncoder] = {}


def encoder(path: str, added_tokens: bool = False) -> ChunkEncoder:
    """One per Python worker, so that its cache outlives a task."""
    key = path, added_tokens
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(*key)
    return _encoders[key]


def together(texts: list[str], chars: int = TOGETHER_CHARS) -> Iterator[list[str]]:
    """Runs of ``texts`` of ``chars`` characters at most, or of one text."""
    start, held = 0, 0
    for at, text in enumerate(texts):
        if at > start and held + len(text) > chars:
            yield texts[start:at]
            start, held = at, 0
        held += len(text)
    yield texts[start:]


def cut_lengths(total: int, length: int = LENGTH) -> list[int]:
    """Lengths of the pieces of a document: all full but the first, which takes what is left over."""
    first = total % length
    return ([first] if first else []) + [length] * (total // length)


def token_pieces(docs: DataFrame, tokenizer: str, added_tokens: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece of every row of ``docs`` (doc_id, text)."""
    def make():
        encode, end = encoder(tokenizer, added_tokens).encode, np.array([END_ID], "<u4").tobytes()

        def work(ids, texts):
            rows, texts = [], [t or "" for t in texts]
            found = chain.from_iterable(map(encode, together(texts)))
            for i, data in zip(ids, found):
                data, start = data + end, 0
                for piece, length in enumerate(cut_lengths(len(data) // 4)):
                    crc = zlib.crc32(data[4 * start:4 * (start + length)])
                    rows.append((i, piece, start, length, crc))
                    start += length
            return rows
        return work

    return map_rows(docs, ["doc_id", "text"], "doc_id long, piece int, start long, length long, ids_crc32 long", make,
                    TOGETHER_ROWS)


def best_fit(sizes: np.ndarray, capacity: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Largest first, each item into the fullest bin that takes it: per item its bin (from 0) and its offset there."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room
    rooms, made = 0, 0  # a bit for each room that a bin has
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            which = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, which = capacity, made
            made += 1
        bins[item], offsets[item] = which, capacity - room
        left = room - size
        if left:
            open_bins[left].append(which)
            rooms |= 1 << left
    return bins, offsets


def pack(items: DataFrame, capacity: int = LENGTH) -> DataFrame:
    """(item, sequence_id, offset) for ``items`` (item: unique long, size: 1 to ``capacity``)."""
    def place(table: pa.Table) -> pa.Table:
        ids, sizes = table.column("item").to_numpy(), table.column("size").to_numpy()
        bins, offsets = best_fit(sizes, capacity)
        fill = np.bincount(bins, weights=sizes).astype(np.int64)
        names = np.zeros(len(fill), np.int64)
        names[bins[offsets == 0]] = ids[offsets == 0]
        return pa.table({"item": ids, "bin": names[bins], "offset": offsets, "fill": fill[bins]})

    def deal(rows: DataFrame, n: int, turn: int) -> DataFrame:
        groups = max(1, -(-n // GROUP_ITEMS))
        dealt = rows.withColumn("grp", F.pmod(F.xxhash64("item", F.lit(turn)), F.lit(groups)))
        return dealt.groupBy("grp").applyInArrow(place, "item long, bin long, offset long, fill long")

    full = items.filter(F.col("size") >= capacity - NEARLY_FULL)
    now, steps = items.filter(F.col("size") < capacity - NEARLY_FULL), []
    n = now.count()
    for turn in range(MAX_ROUNDS):
        if not n:
            break
        step = materialize(deal(now, n, turn), "packing")
        steps.append(step)
        now = step.filter((F.col("offset") == 0) & (F.col("fill") < capacity - NEARLY_FULL)).select(
            F.col("bin").alias("item"), F.col("fill").alias("size"))
        left = now.count()
        if n <= GROUP_ITEMS or (turn and n - left < WORTH * n):
            break
        n = left
    placed = full.select("item", F.col("item").alias("bin"), F.lit(0).cast("long").alias("offset"))
    if steps:
        first = steps[0].select("item", "bin", "offset")
        for later in steps[1:]:
            up = later.select(F.col("item").alias("bin"), F.col("bin").alias("up"), F.col("offset").alias("shift"))
            first = first.join(up, "bin", "left").select(
                "item", F.coalesce("up", "bin").alias("bin"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))
        placed = placed.union(first)
    return placed.withColumnRenamed("bin", "sequence_id")


def pack_documents(docs: DataFrame, tokenizer: str, added_tokens: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of ``docs`` (doc_id, text).

    A document is its ids and the end id. NULL and empty texts are the end id alone; rows that repeat a doc_id
    are packed each, NULL ids like any; an empty table gives an empty result; other columns are ignored.
    ``added_tokens``: strings of added tokens become these tokens, as the tokenizer does it when left at its defaults.
    """
    pieces = materialize(token_pieces(docs, tokenizer, added_tokens).withColumn("item", F.monotonically_increasing_id()), "pieces")
    placed = pack(pieces.select("item", F.col("length").alias("size")))
    return pieces.join(placed, "item").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
