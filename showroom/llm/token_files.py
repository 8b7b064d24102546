"""Token ids in shard files with a minimal perfect hash index.

Documents are range-partitioned by key and sorted; every partition writes one file. A file holds the
raw ids as little-endian integers of 2 bytes (4 beyond a vocabulary of 65,536), then where each
document begins, the keys, and an index from key to place. The index is a minimal perfect hash: level by
level the keys that alone claim a bit of a bit table are placed, the rank of the bit numbers the key, and
the others go on. It takes a few bits per key and answers in constant expected time; a stored
32-bit fingerprint turns away keys that are not in the file.

Files are written under a name of their own and then moved, and the content depends on the rows only,
so a repeated task does no harm. ``pyarrow.fs`` opens them, so the folder may be on a
shared disk or in a remote store.

Texts are cut at places where the tokenizer's own rule cuts whatever stands around. The different pieces of a
slice go through the tokenizer once each.

``lookup`` finds the files of a key by the first and last key of each, which are stored beside the files, and the
documents in a file through its index. ``read`` takes the documents of all keys through the index as well.

Defined cases: a null or empty text has the end id only; documents of equal key stand next to
each other, ordered by a hash of the text, if need be over several files, and a look-up answers all of them; documents
without key come first and cannot be looked up; an empty table gives files without documents.
"""

from __future__ import annotations

import functools
import itertools
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from showroom.llm.hashing import mix
from showroom.llm.shared import exact, new_folder
from showroom.llm.words import SPACES, buffer_of, separator_table, slices

END = 2
SHARD_BYTES = 64 << 20
#: Bytes of text whose pieces are numbered together; more of them means fewer different pieces in all.
SLICE_BYTES = 8 << 20
#: Pieces remembered by a task from slice to slice.
REMEMBERED = 600_000
#: Plain pieces that go through the tokenizer in one text.
JOINED = 512
MAGIC = b"SHWTOK01"
#: Bits per key on each level of the index.
GAMMA = 2
#: Ids in one batch of rows of a look-up; a longer document has a batch of its own.
BATCH_IDS = 1 << 20
_SHARD = pa.schema([("shard", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("first_key", pa.int64()), ("last_key", pa.int64())])
_SHARD_ROWS = "shard bigint, n_docs bigint, n_ids bigint, first_key bigint, last_key bigint"


# --- cutting and encoding ---------------------------------------------------------------------

#: White space beyond ASCII as UTF-8 bytes (first two, or two and the range of the third).
_WIDE_SPACES_2 = [(0xC2, 0x85), (0xC2, 0xA0)]
_WIDE_SPACES_3 = [
    (0xE1, 0x9A, 0x80, 0x80), (0xE2, 0x80, 0x80, 0x8A), (0xE2, 0x80, 0xA8, 0xA9), (0xE2, 0x80, 0xAF, 0xAF),
    (0xE2, 0x81, 0x9F, 0x9F), (0xE3, 0x80, 0x80, 0x80)]
#: Kinds of bytes: 1 white space, 2 letters and digits, 3 other ASCII, 0 beyond ASCII.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[:128] = 3
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 2
_KIND[list(SPACES)] = 1


def _after_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the places ``at``, all behind a byte beyond ASCII, follow white space beyond ASCII."""
    c, b, a = data[at - 1], data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    blank = np.zeros(len(at), dtype=bool)
    for x, y in _WIDE_SPACES_2:
        blank |= (b == x) & (c == y)
    for x, y, low, high in _WIDE_SPACES_3:
        blank |= (a == x) & (b == y) & (c >= low) & (c <= high)
    return blank


def pieces_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Numbers of the pieces, the different pieces, and the first piece of every text.

    A text is cut before ASCII white space behind anything else, behind a single line break before
    ASCII, and between a letter or digit and ASCII punctuation. The tokenizer cuts there as well, and what
    it does to a piece does not depend on the text around.
    """
    data, offsets = buffer_of(texts)
    if len(data) == 0:
        return np.zeros(0, np.int64), pa.array([], pa.large_string()), np.zeros(len(offsets), np.int64)
    kind = _KIND[data]
    space, word = kind == 1, kind == 2
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[1:-1] = space[1:] & ~space[:-1]
    wide = np.flatnonzero(cut[1:-1] & (kind[:-1] == 0)) + 1
    cut[wide[_after_wide_space(data, wide)]] = False
    breaks = np.flatnonzero(cut[:-2] & space[:-1] & (data[:-1] != 0x20) & ~space[1:] & (kind[1:] != 0)) + 1
    latin = (data[1:] & 0xC0 == 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7) & (data[:-1] == 0xC3)
    word[1:] |= latin
    cut[1:-1] |= word[:-1] & (kind[1:] == 3)
    cut[breaks] = True
    cut[offsets] = True
    borders = np.flatnonzero(cut).astype(np.int64)
    array = pa.Array.from_buffers(
        pa.large_string(), len(borders) - 1, [None, pa.py_buffer(borders), pa.py_buffer(np.ascontiguousarray(data))])
    coded = array.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, np.searchsorted(borders, offsets)


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


class Pieces:
    """Ids of the pieces met so far, behind each other in one array; forgotten when they are too many."""

    def __init__(self, tokenizer, kind: type, end: int):
        self.tokenizer, self.kind, self.end = tokenizer, kind, end
        line = tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None
        self._clear()

    def _clear(self) -> None:
        # Number 0 is the end id.
        self.number: dict[str, int] = {}
        self.flat, self.begin, self.size = np.array([self.end], self.kind), np.zeros(1, np.int64), np.ones(1, np.int64)

    def numbers(self, names: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.number.get, names, itertools.repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(found < 0)
        if len(new) == 0:
            return found
        if len(self.number) and len(self.number) + len(new) > REMEMBERED:
            self._clear()
            return self.numbers(names)
        plain = np.fromiter((_is_plain(names[i]) for i in new), bool, len(new)) if self.line is not None else np.zeros(len(new), bool)
        for part, ids_of in ((new[plain], self._joined), (new[~plain], self._single)):
            if len(part):
                fresh_ = [names[i] for i in part]
                flat, size = ids_of(fresh_)
                found[part] = np.arange(len(part)) + len(self.size)
                self.number.update(zip(fresh_, found[part].tolist(), strict=True))
                self.begin = np.concatenate([self.begin, np.cumsum(size) - size + len(self.flat)])
                self.size = np.concatenate([self.size, size])
                self.flat = np.concatenate([self.flat, flat])
        return found

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(itertools.chain.from_iterable(ids), self.kind, int(size.sum())), size

    def _single(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self._encoded(names)

    def _joined(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain pieces from lines of text: a line break between two is a token of its own."""
        lines = ["\n".join(names[i : i + JOINED]) + "\n" for i in range(0, len(names), JOINED)]
        flat, _ = self._encoded(lines)
        ends = np.flatnonzero(flat == self.line)
        if len(ends) != len(names):
            raise ValueError("the tokenizer doesn't keep line breaks apart")
        return flat[flat != self.line], np.diff(np.concatenate([[-1], ends])) - 1


def _is_plain(piece: str) -> bool:
    """No white space but one leading space: such a piece keeps its ids between line breaks."""
    words = piece.split()
    return len(words) == 1 and (len(words[0]) == len(piece) or (len(words[0]) == len(piece) - 1 and piece[0] == " "))


def encode(texts: pa.Array, known: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts with the end id after each, and the first id of each text."""
    codes, pieces, bounds = pieces_of(texts)
    numbers = known.numbers(pieces.to_pylist())
    n = len(bounds) - 1
    ends = bounds[1:] + np.arange(n)
    order = np.zeros(len(codes) + n, np.int64)  # the end id, except where there is a piece
    inner = np.ones(len(order), dtype=bool)
    inner[ends] = False
    order[inner] = numbers[codes]
    size = known.size[order]
    after = np.cumsum(size)
    source = np.repeat(known.begin[order] - after + size, size)
    source += np.arange(len(source))
    return known.flat[source], np.concatenate([[0], after[ends]])


# --- minimal perfect hash ---------------------------------------------------------------------

def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


@dataclass
class PerfectHash:
    """Bit tables of all levels behind each other; ``levels`` holds the sizes in words of 64 bits."""

    levels: np.ndarray
    bits: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """For different keys."""
        levels, tables, rest = [], [np.zeros(0, np.uint64)], keys
        while len(rest):
            words = -(-GAMMA * len(rest) // 64)
            at = (mix(rest, len(levels)) % np.uint64(words * 64)).astype(np.int64)
            alone = np.bincount(at, minlength=words * 64)[at] == 1
            table = np.zeros(words, np.uint64)
            np.bitwise_or.at(table, at[alone] >> 6, np.uint64(1) << (at[alone] & 63).astype(np.uint64))
            levels.append(words)
            tables.append(table)
            rest = rest[~alone]
        return cls(np.array(levels, np.uint64), np.concatenate(tables))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key from 0 on, or -1 for some of the keys it was not built from."""
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)])
        found, open_, first = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, words in enumerate(self.levels.astype(np.int64)):
            at = (mix(keys[open_], level) % np.uint64(words * 64)).astype(np.int64)
            word, bit = first + (at >> 6), (at & 63).astype(np.uint64)
            set_ = (self.bits[word] >> bit) & np.uint64(1) == 1
            below = self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            found[open_[set_]] = (ranks[word] + np.bitwise_count(below))[set_]
            open_, first = open_[~set_], first + words
        return found


# --- files ------------------------------------------------------------------------------------

def _name(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:08d}.tok"


class ShardWriter:
    """Appends ids, then closes with the tables behind them."""

    def __init__(self, folder: str, shard: int, width: int):
        self.store, self.path = fs.FileSystem.from_uri(_name(folder, shard)) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), _name(folder, shard))
        self.store.create_dir(os.path.dirname(self.path), recursive=True)
        self.draft = f"{self.path}.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.draft)
        self.width, self.starts, self.keys, self.n_ids, self.no_key = width, [], [], 0, 0

    def add(self, keys: pa.Array, ids: np.ndarray, starts: np.ndarray) -> None:
        self.out.write(np.ascontiguousarray(ids.astype(f"<u{self.width}")).tobytes())
        self.starts.append(starts[:-1] + self.n_ids)
        self.no_key += keys.null_count
        self.keys.append(keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        self.n_ids += len(ids)

    def close(self) -> tuple[int, int, int | None, int | None]:
        """Number of documents and of ids, first and last key."""
        starts = np.concatenate([*self.starts, [self.n_ids]]).astype("<u8")
        keys = np.concatenate([*self.keys, np.zeros(0, np.int64)]).astype("<i8")
        named = keys[self.no_key :]
        first = np.flatnonzero(np.concatenate([[True], named[1:] != named[:-1]])) if len(named) else np.zeros(0, np.int64)
        index = PerfectHash.build(named[first])
        slot = index.find(named[first])
        prints, place, copies = np.zeros(len(first), "<u4"), np.zeros(len(first), "<u8"), np.zeros(len(first), "<u8")
        prints[slot] = fingerprint(named[first])
        place[slot] = first + self.no_key
        copies[slot] = np.diff(np.concatenate([first, [len(named)]]))
        tables = [starts, keys, index.levels.astype("<u8"), index.bits.astype("<u8"), prints, place, copies]
        for t in tables:
            self.out.write(t.tobytes())
        head = np.array([self.width, self.n_ids, self.no_key, *[len(t) for t in tables]], "<u8")
        self.out.write(head.tobytes() + MAGIC)
        self.out.close()
        self.store.move(self.draft, self.path)
        return len(keys), self.n_ids, *((int(named[0]), int(named[-1])) if len(named) else (None, None))


class Shard:
    """An open file; ``find`` answers keys, ``ids`` reads the ids of a document."""

    def __init__(self, folder: str, shard: int):
        store, path = fs.FileSystem.from_uri(_name(folder, shard)) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), _name(folder, shard))
        self.file = store.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(88, size - 88)
        if tail[-8:] != MAGIC:
            raise ValueError(f"{path} is no complete token file")
        width, n_ids, no_key, *lengths = np.frombuffer(tail[:-8], "<u8").astype(np.int64).tolist()
        self.width, self.n_ids, self.no_key, at = width, n_ids, no_key, width * n_ids
        tables = []
        for n, kind in zip(lengths, ["<u8", "<i8", "<u8", "<u8", "<u4", "<u8", "<u8"], strict=True):
            step = n * np.dtype(kind).itemsize
            tables.append(np.frombuffer(self.file.read_at(step, at), kind))
            at += step
        self.starts, self.keys, levels, bits, self.prints, self.place, self.copies = tables
        self.starts = self.starts.astype(np.int64)
        self.index = PerfectHash(levels, bits)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document of each key in this file and how many of it there are; -1 and 0 for unknown keys."""
        slot = self.index.find(keys)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == fingerprint(keys[known])
        place, copies = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        place[known], copies[known] = self.place[slot[known]], self.copies[slot[known]]
        return place, copies

    def ids(self, first: int, last: int | None = None) -> np.ndarray:
        """Ids of the documents from ``first`` up to ``last`` (one, if it is left out)."""
        begin, end = self.starts[first], self.starts[first + 1 if last is None else last]
        return np.frombuffer(self.file.read_at(int(end - begin) * self.width, int(begin) * self.width), f"<u{self.width}")


def _table(folder: str) -> str:
    """Where the table of the files is, as Spark names it."""
    return f"{folder if '://' in folder or folder.startswith('file:') else 'file://' + os.path.abspath(folder)}/shards"


def write(
    docs: DataFrame, tokenizer: str, folder: str, key: str = "doc_id", text: str = "text", end: int = END,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write the files and return the rows (shard, n_docs, n_ids), one per file, from a stored table.

    The table stands beside the files and also holds the first and last key of each for ``lookup``.
    ``tokenizer`` names a tokenizer file that all executors can open.
    """
    rows = docs.select(exact(key).cast("bigint").alias("key"), exact(text).cast("string").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-size // shard_bytes))
    order: list[Column] = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    width = 2 if _tokenizer(tokenizer).get_vocab_size() <= 1 << 16 and end < 1 << 16 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        known = Pieces(_tokenizer(tokenizer), np.dtype(f"u{width}").type, end)
        writer = ShardWriter(folder, shard, width)
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                writer.add(batch["key"], *encode(batch["text"], known))
        yield pa.RecordBatch.from_pylist([dict(zip(_SHARD.names, (shard, *writer.close()), strict=True))], _SHARD)

    ordered.mapInArrow(run, _SHARD_ROWS).write.mode("overwrite").parquet(_table(folder))
    return docs.sparkSession.read.schema(_SHARD_ROWS).parquet(_table(folder)).select("shard", "n_docs", "n_ids")


def _offsets(shards: DataFrame) -> DataFrame:
    """Ids in all earlier files. One row per file."""
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("shard", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("offset"))


def lookup(keys: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """Rows (doc_id, start, ids, shard) of all documents whose key is in ``keys``, whatever file they are in.

    Repeated keys count once; keys that no document has give no row. A file is opened only for keys in its range.
    """
    shards = keys.sparkSession.read.schema(_SHARD_ROWS).parquet(_table(folder))
    # One row per file; files are in the order of keys, and several of them may hold one key.
    ranges = shards.where("first_key IS NOT NULL").orderBy("shard").select("shard", "first_key", "last_key").collect()
    number, first, last = (np.array([r[i] for r in ranges], np.int64) for i in range(3))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch["key"].to_numpy(zero_copy_only=False)
            low, high = np.searchsorted(last, wanted, "left"), np.searchsorted(first, wanted, "right")
            count = np.maximum(high - low, 0)
            at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            yield pa.RecordBatch.from_arrays([pa.array(number[at]), pa.array(np.repeat(wanted, count))], names=["shard", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = None
        for batch in batches:
            numbers, wanted = (batch[c].to_numpy(zero_copy_only=False) for c in ("shard", "key"))
            for n in np.unique(numbers).tolist():
                if opened is None or opened[0] != n:
                    opened = n, Shard(folder, n)
                yield from _found(opened[1], n, wanted[numbers == n])

    wanted = keys.select(exact(key).cast("bigint").alias("key")).where("key IS NOT NULL").distinct()
    placed = wanted.mapInArrow(place, "shard bigint, key bigint").repartition(max(1, min(10_000, len(ranges))), "shard")
    found = placed.sortWithinPartitions("shard").mapInArrow(run, "shard bigint, doc_id bigint, local bigint, ids array<bigint>")
    return found.join(_offsets(shards), "shard").select("doc_id", (F.col("offset") + F.col("local")).alias("start"), "ids", "shard")


def _places(shard: Shard, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and places of the documents that the index finds, each key as often as it has documents."""
    place, copies = shard.find(keys)
    at = np.repeat(place - np.cumsum(copies) + copies, copies) + np.arange(copies.sum())
    asked = np.repeat(keys, copies)
    # A strange key passes the fingerprint once in 2^32.
    right = shard.keys[at] == asked
    return asked[right], at[right]


def _found(shard: Shard, number: int, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    asked, at = _places(shard, keys)
    size = shard.starts[at + 1] - shard.starts[at]
    batch = (np.cumsum(size) - size) // BATCH_IDS
    for b in np.unique(batch):
        here = np.flatnonzero(batch == b)
        ids = [shard.ids(x) for x in at[here].tolist()]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size[here])]), pa.int32()), pa.array(np.concatenate(ids), pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(here), number)), pa.array(asked[here]), pa.array(shard.starts[at[here]]), lists],
            names=["shard", "doc_id", "local", "ids"])


def read(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32, shard) of every document in the files.

    Documents with a key are found, and their ids read, at the places that the index of their file gives. ``start`` counts the ids of all earlier
    files, from running sums over the list of files, and of the earlier documents in the file.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch["shard"].to_pylist():
                yield from _documents(Shard(folder, number), number)

    kind = "shard bigint, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint"
    count = max(1, min(10_000, shards.count()))
    found = shards.select("shard").repartition(count, "shard").mapInArrow(run, kind)
    return found.join(_offsets(shards), "shard").select(
        "doc_id", (F.col("offset") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", "shard")


def _documents(shard: Shard, number: int, step: int = 10_000) -> Iterator[pa.RecordBatch]:
    named = shard.keys[shard.no_key :]
    asked, at = _places(shard, named[np.concatenate([[True], named[1:] != named[:-1]])] if len(named) else named)
    if len(asked) != len(named):
        raise ValueError(f"the index of file {number} doesn't lead to its documents")
    keys = np.concatenate([np.zeros(shard.no_key, np.int64), asked])
    at = np.concatenate([np.arange(shard.no_key), at])
    for first in range(0, len(at), step):
        here = at[first : first + step]
        # Places that follow each other are read at once.
        runs = np.split(here, np.flatnonzero(np.diff(here) != 1) + 1)
        sums = [x for run in runs for x in _sums(shard, int(run[0]), int(run[-1]) + 1)]
        missing = np.arange(first, first + len(here)) < shard.no_key
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(here), number)), pa.array(keys[first : first + step], pa.int64(), mask=missing), pa.array(shard.starts[here]),
             pa.array(shard.starts[here + 1] - shard.starts[here]), pa.array(sums, pa.int64())],
            names=["shard", "doc_id", "local", "n_tokens", "ids_crc32"])


def _sums(shard: Shard, first: int, last: int) -> list[int]:
    ids, cuts = shard.ids(first, last), shard.starts[first : last + 1] - shard.starts[first]
    return [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def tokenize(docs: DataFrame, tokenizer: str, folder: str | None = None, **options) -> DataFrame:
    """Write the files below ``folder`` (a new one in the shared folder, if left out) and read them back."""
    folder = folder or new_folder(docs.sparkSession, "tokens")
    return read(docs.sparkSession, folder, write(docs, tokenizer, folder, **options))
