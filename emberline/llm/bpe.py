"""Byte-level BPE by Spark's higher-order functions.

The rank map is a literal: from two adjacent tokens to the rank, which is the id, of the token that they make up. A
word's ids are a fold over the array of its bytes: as often as the word has bytes, the adjacent pair of the lowest rank
is merged. Words are the matches of the pre-tokenizing pattern.

Each distinct word is folded once, however rare. A first pass over the documents numbers the words of each shard (a
part of an input partition with a bounded number of words), and chunks of them, and writes the documents down as
numbers. The shards' words are dealt by a hash into buckets, in which the distinct ones are folded; their ids go back to
the shards, where numbers become ids. Neither texts nor numbered documents are shuffled. Decoding concatenates the bytes of each id.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline.functions.storage import scratch_path
from emberline.llm.common import SLICE_ROWS, arrow_schema
from emberline.llm.text_chunks import chunks

#: A fold's work grows with the square of a word's length: longer words (in bytes) go to the library, whose merges don't.
FOLD_BYTES = 128
#: A shard ends with the slice of rows that takes it beyond so many distinct words, or chunks in all.
SHARD_WORDS = 400_000
SHARD_TOKENS = 2_000_000
#: A shard's words are packed into a row per bucket. There are four buckets for each shuffle partition, within these bounds.
BUCKETS = (256, 65_536)

_BITS = 21
_MASK = (1 << _BITS) - 1
_NOBODY = _MASK << _BITS
_STRETCH = 1024


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


# ---- the rank map

def pair_rows(ranks: dict[bytes, int]) -> tuple[list[int], list[int]]:
    """(starts, slots): the rank of tokens a and b put together stands at slots[starts[a] + b], beside a.

    A sparse table with a row per first token, its rows laid over each other where they leave gaps. Tokens and ranks
    are counted from 1; 0 is the border of a word. A slot holds a * 2^21 + rank, and so tells whose it is.
    """
    rows: dict[int, dict[int, int]] = defaultdict(dict)
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            if token[:i] in ranks and token[i:] in ranks:
                rows[ranks[token[:i]] + 1][ranks[token[i:]] + 1] = rank + 1
    n = max(ranks.values()) + 2
    starts, taken, free = [0] * n, np.zeros(4 * n + 3 * sum(map(len, rows.values())), bool), 0
    ordered = sorted(rows.items(), key=lambda r: -len(r[1]))
    many = [(a, np.array(sorted(row))) for a, row in ordered if len(row) > 1]
    for a, columns in many:
        free += int(np.argmin(taken[free:]))
        at = max(0, free - int(columns[0]))
        while True:  # the first place, of a stretch of them, where all the row's columns are free
            if at + n + 2 * _STRETCH > len(taken):
                taken = np.concatenate([taken, np.zeros(len(taken), bool)])
            fits = ~taken[at + columns[:, None] + np.arange(_STRETCH)].any(axis=0)
            if fits.any():
                break
            at += _STRETCH
        starts[a] = at + int(fits.argmax())
        taken[starts[a] + columns] = True
    # Rows of one column go anywhere.
    alone = [(a, next(iter(row))) for a, row in ordered if len(row) == 1]
    for (a, column), slot in zip(alone, np.flatnonzero(~taken[n:]) + n):
        starts[a] = int(slot) - column
    slots = np.full(max(starts) + n, _NOBODY)
    for a, row in rows.items():
        slots[starts[a] + np.array(list(row))] = (a << _BITS) + np.array(list(row.values()))
    return starts, slots.tolist()


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The literal."""
    starts, slots = pair_rows(ranks)
    return F.from_json(F.lit(json.dumps({"starts": starts, "slots": slots}, separators=(",", ":"))),
                       "struct<starts: array<bigint>, slots: array<bigint>>")


def fold_ids(single: Column, table: Column) -> Column:
    """The ids (array<bigint>, from 1) that the ids of a word's bytes merge to.

    The state has, for each piece, its id and before it the rank of the pair that it begins: the smallest value is the
    pair to merge, and its rank is the new id. A turn replaces the pair and looks up the two pairs of its neighbours.
    Another token's slot leaves a rank beyond all others. There are as many turns as pairs; those after the last merge
    cost little.
    """
    starts, slots = table["starts"], table["slots"]

    def piece(a: Column, b: Column) -> Column:
        rank = slots[starts[a] + b].bitwiseXOR(F.shiftleft(a, _BITS))
        return F.shiftleft(rank, _BITS) + a

    def turn(state: Column, _: Column) -> Column:
        def merged(least: Column) -> Column:
            best = F.shiftright(least, _BITS)

            def at_place(at: Column) -> Column:  # the pair is pieces at and at + 1, counted from 1
                left, right = state[at - 2].bitwiseAND(_MASK), state[at + 1].bitwiseAND(_MASK)
                return F.concat(F.slice(state, F.lit(1), at - 2), F.array(piece(left, best), piece(best, right)),
                                F.slice(state, at + 2, F.size(state)))

            return F.when(least < 1 << 2 * _BITS, let(F.array_position(state, least).cast("int"), at_place)).otherwise(state)

        return let(F.array_min(state), merged)

    border = F.array(F.lit(0).cast("long"))
    bounded = F.concat(border, single, border)
    start = F.zip_with(bounded, F.concat(single, border, border), piece)
    turns = F.sequence(F.lit(1), F.greatest(F.size(single) - 1, F.lit(1)))
    ended = F.aggregate(turns, start, turn)
    return F.transform(F.slice(ended, F.lit(2), F.size(ended) - 2), lambda x: x.bitwiseAND(_MASK))


# ---- numbers as bytes

def pack(values: np.ndarray) -> bytes:
    """Numbers below 2^32: lowest bytes, next bytes, ..., compressed."""
    data = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpacked(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def pack_texts(texts: list[str]) -> tuple[bytes, bytes]:
    """Lengths, and all texts one after another."""
    data = "".join(texts).encode("utf-8")
    return pack(np.fromiter(map(len, texts), np.int64, len(texts))), len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack_texts(lengths: bytes, data: bytes) -> list[str]:
    text, ends = _unpacked(data).decode("utf-8"), np.cumsum(unpack(lengths)).tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def _gathered(lengths: np.ndarray, flat: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of the ``wanted`` ones of the lists that ``flat`` holds one after another."""
    starts = np.cumsum(lengths) - lengths
    own = lengths[wanted]
    ends = np.cumsum(own)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[wanted] - (ends - own), own)
    return own, flat[at]


def _sums(lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The sum of the values of each of the lists that they stand in, one after another."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return upto[ends] - upto[ends - lengths]


def _schema(text: str) -> pa.Schema:
    return arrow_schema(T._parse_datatype_string(text))


# ---- shards of numbered words

#: Documents: sizes and data are the numbers of chunks in each, and these numbers. A shard's chunks: the numbers of words
#: in each, and these numbers. Words of a bucket (from 0): lengths and texts, and their numbers.
_DOCUMENTS, _CHUNKS = -2, -1
_ROWS = "shard long, bucket int, doc_ids array<long>, sizes binary, data binary, numbers binary"


def _splitter() -> Callable[[str], list[str]]:
    import public_tokenizers
    return regex.compile(public_tokenizers.PATTERN).findall


class Shard:
    """Numbers of the words and chunks of some texts, in the order in which they are first met."""

    def __init__(self, split: Callable[[str], list[str]]):
        self.split, self.tokens = split, 0
        self.words: dict[str, int] = {}
        self.whole: dict[str, int] = {}
        self.after_blank: dict[str, int] = {}
        self.chunk_sizes: list[int] = []
        self.chunk_words: list[int] = []

    def _known(self, known: dict[str, int], part: list[str], before: str) -> list[int]:
        found = list(map(known.get, part))
        at = -1
        for _ in range(found.count(None)):
            at = found.index(None, at + 1)
            chunk = part[at]
            if chunk not in known:
                known[chunk] = len(self.chunk_sizes)
                words = self.split(before + chunk)
                self.chunk_sizes.append(len(words))
                for word in words:
                    self.chunk_words.append(self.words.setdefault(word, len(self.words)))
            found[at] = known[chunk]
        return found

    def numbers(self, text: str) -> list[int]:
        first, rest = chunks(text)
        found = self._known(self.whole, first, "") + self._known(self.after_blank, rest, " ")
        self.tokens += len(found)
        return found

    def packed(self, buckets: int) -> Iterator[tuple]:
        """(bucket, sizes, data, numbers)."""
        yield _CHUNKS, pack(np.array(self.chunk_sizes, np.int64)), pack(np.array(self.chunk_words, np.int64)), None
        found: list[list[str]] = [[] for _ in range(buckets)]
        for word in self.words:
            found[zlib.crc32(word.encode("utf-8")) % buckets].append(word)
        for bucket, words in enumerate(found):
            if words:
                yield bucket, *pack_texts(words), pack(np.array(list(map(self.words.get, words)), np.int64))


def number_words(docs: DataFrame, buckets: int, shard_tokens: int) -> DataFrame:
    """The rows of all shards, see ``_ROWS``."""
    schema = _schema(_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, count = _splitter(), 0
        shard = Shard(split)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            name = (TaskContext.get().partitionId() << 20) + count
            columns = zip(*[(name, *row) for row in rows])
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        def dictionary() -> Iterator[pa.RecordBatch]:
            rows = [(bucket, None, *rest) for bucket, *rest in shard.packed(buckets)]
            for start in range(0, len(rows), SLICE_ROWS):
                yield batch_of(rows[start:start + SLICE_ROWS])

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                ids, texts = (c.to_pylist() for c in batch.slice(start, SLICE_ROWS).columns)
                numbers = [shard.numbers(t or "") for t in texts]
                sizes = np.array(list(map(len, numbers)), np.int64)
                yield batch_of([(_DOCUMENTS, ids, pack(sizes), pack(np.array(list(chain.from_iterable(numbers)), np.int64)), None)])
                if len(shard.words) > SHARD_WORDS or shard.tokens > shard_tokens:
                    yield from dictionary()
                    shard, count = Shard(split), count + 1
        yield from dictionary()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _ROWS)


# ---- distinct words and their ids

_DISTINCT = "words array<array<long>>, given array<array<long>>, shards array<long>, sizes array<int>, numbers binary, places binary"
_BACK = "shard long, bucket int, sizes binary, data binary, numbers binary"
_RESULT = "doc_id long, ids array<int>"
_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

_known_ranks: dict[str, dict[bytes, int]] = {}


def _ranks_of(path: str) -> dict[bytes, int]:
    """Read once by a worker."""
    if path not in _known_ranks:
        _known_ranks[path] = read_ranks(path)
    return _known_ranks[path]


def distinct_words(packed: DataFrame, path: str) -> DataFrame:
    """A row per bucket: its distinct words, and for each shard (``sizes``) its numbers and the words' places among them.

    ``words`` are those to be folded, as the ids of their bytes, from 1. Behind them come the words whose ids are
    ``given``: tokens, and words of more than FOLD_BYTES bytes.
    """
    schema = _schema(_DISTINCT)

    def run(table: pa.Table) -> pa.Table:
        import public_tokenizers
        import tiktoken
        ranks, library = _ranks_of(path), None
        byte_id = [ranks[bytes([b])] + 1 for b in range(256)]
        place: dict[str, int] = {}
        rows = []
        for sizes, data in zip(table.column("sizes").to_pylist(), table.column("data").to_pylist()):
            words = unpack_texts(sizes, data)
            for word in words:
                place.setdefault(word, len(place))
            rows.append(list(map(place.__getitem__, words)))
        folded, given, to = [], [], np.zeros(len(place), np.int64)
        for n, word in enumerate(place):
            data = word.encode("utf-8")
            if data in ranks:
                ids = [ranks[data] + 1]
            elif len(data) > FOLD_BYTES:
                library = library or tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
                ids = [i + 1 for i in library.encode_ordinary(word)]
            else:
                to[n] = len(folded)
                folded.append([byte_id[b] for b in data])
                continue
            to[n] = -1 - len(given)
            given.append(ids)
        to = np.where(to < 0, len(folded) - 1 - to, to)
        numbers = np.concatenate([unpack(n) for n in table.column("numbers").to_pylist()])
        values = [folded, given, table.column("shard").to_pylist(), list(map(len, rows)), pack(numbers), pack(to[list(chain.from_iterable(rows))])]
        return pa.table([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    return packed.groupBy("bucket").applyInArrow(run, _DISTINCT)


def shard_ids(packed: DataFrame, path: str, tasks: int) -> DataFrame:
    """The ids (sizes and data) of shards' words (numbers); each distinct word of all documents is folded once."""
    table = rank_map(read_ranks(path))
    distinct = distinct_words(packed.repartition(tasks, "bucket"), path)
    folded = distinct.withColumn("folded", let(table, lambda t: F.transform("words", lambda w: fold_ids(w, t))))
    folded = folded.select("shards", "sizes", "numbers", "places", F.concat(
        F.transform("folded", F.size), F.transform("given", F.size)).alias("lengths"), F.concat(F.flatten("folded"), F.flatten("given")).alias("ids"))
    schema = _schema(_BACK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shards, sizes, lengths, ids = (batch.column(c).slice(row, 1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                                               for c in ("shards", "sizes", "lengths", "ids"))
                numbers, places = (unpack(batch.column(c)[row].as_py()) for c in ("numbers", "places"))
                end = 0
                for shard, n in zip(shards.tolist(), sizes.tolist()):
                    own = slice(end, end + n)
                    counts, values = _gathered(lengths, ids - 1, places[own])
                    end += n
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
                        (shard, 0, pack(counts), pack(values), pack(numbers[own])), schema)], schema=schema)

    return folded.mapInArrow(run, _BACK)


# ---- documents

def _stored_by_shard(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` as a table in the shared folder, bucketed by shard: what is joined by shard then needs no shuffle of it."""
    spark, name = rows.sparkSession, f"bpe_numbers_{uuid.uuid4().hex}"
    rows.write.bucketBy(buckets, "shard").option("path", scratch_path(spark, "bpe-numbers")).format("parquet").saveAsTable(name)
    return spark.table(name)


def encode(docs: DataFrame, path: str, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(doc_id, ids) for every row of ``docs`` (doc_id, text), by the ranks in the file ``path``.

    NULL and empty texts have no ids; repeated rows and NULL ids are encoded like any row; very long texts are encoded
    whole, as one document of their shard; an empty table gives an empty result; other columns are ignored. The ids are
    those that the tiktoken library gives without special tokens.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(max(BUCKETS[0], 4 * partitions), BUCKETS[1])
    rows = _stored_by_shard(number_words(docs, buckets, shard_tokens), partitions)
    tasks = min(buckets, max(partitions, 4 * spark.sparkContext.defaultParallelism))
    words = shard_ids(rows.filter("bucket >= 0").drop("doc_ids"), path, tasks)
    numbered = rows.filter("bucket < 0").select("shard", "bucket", "doc_ids", "sizes", "data")
    schema = _schema(_RESULT)

    def assemble(texts: pa.Table, known: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return schema.empty_table()

        def joined(column: str) -> np.ndarray:
            return np.concatenate([np.zeros(0, np.int64), *map(unpack, known.column(column).to_pylist())])

        # Ids of words, in the order of their numbers, then of chunks, then of documents.
        kinds, sizes, data = (texts.column(c).to_pylist() for c in ("bucket", "sizes", "data"))
        chunk = kinds.index(_CHUNKS)
        lengths, ids = _gathered(joined("sizes"), joined("data"), np.argsort(joined("numbers")))
        lengths, ids = _gathered(lengths, ids.astype(np.int32), unpack(data[chunk]))
        chunk_lengths = _sums(unpack(sizes[chunk]), lengths)
        columns: list[list] = [[], []]
        for row, doc_ids in enumerate(texts.column("doc_ids").to_pylist()):
            if kinds[row] == _DOCUMENTS:
                counts, values = _gathered(chunk_lengths, ids, unpack(data[row]))
                ends = np.concatenate([[0], np.cumsum(_sums(unpack(sizes[row]), counts))])
                columns[0].append(pa.array(doc_ids, pa.int64()))
                columns[1].append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values)))
        return pa.Table.from_arrays([pa.chunked_array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return numbered.groupBy("shard").cogroup(words.groupBy("shard")).applyInArrow(assemble, _RESULT)


class Decoder:
    """The bytes that ids stand for: those of each id, one after another."""

    def __init__(self, ranks: dict[bytes, int]):
        pieces = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        self.lengths = np.array(list(map(len, pieces)), np.int64)
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def decode(self, sizes: np.ndarray, ids: np.ndarray) -> list[bytes]:
        """A text for each of ``sizes``, which are numbers of ids."""
        lengths, data = _gathered(self.lengths, self.flat, ids)
        ends, data = np.cumsum(_sums(sizes, lengths)).tolist(), data.tobytes()
        return [data[a:b] for a, b in zip([0, *ends], ends)]


def _per_document(encoded: DataFrame, path: str, schema: str, make: Callable[[list[bytes], list[bytes]], list]) -> DataFrame:
    """Columns behind doc_id that ``make`` gets from the ids, as little-endian 32-bit integers, and the decoded bytes."""
    out = _schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(_ranks_of(path))
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                lists = part.column(1)
                sizes, ids = lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy()
                ends, data = (4 * np.cumsum(sizes)).tolist(), ids.astype("<u4").tobytes()
                columns = make([data[a:b] for a, b in zip([0, *ends], ends)], decoder.decode(sizes, ids))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(out)[1:]))], schema=out)

    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, data): the decoded bytes of each row's ids."""
    return _per_document(encoded, path, "doc_id long, data binary", lambda _, decoded: [decoded])


def encoded_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids' and of the decoded bytes, of every row of ``docs``; see ``encode``."""
    def sha(values: list[bytes]) -> list[str]:
        return [hashlib.sha256(v).hexdigest() for v in values]

    return _per_document(encode(docs, path), path, _DIGESTS, lambda ids, decoded: [[len(i) // 4 for i in ids], sha(ids), sha(decoded)])
