"""Texts as numbers of words, in blocks that know their own words.

What is to be found out about a word is found out once for all texts.  Each block of texts
lists its distinct words; the lists are dealt out by a hash of the word, so that one group
has all that is known of a word; what it finds goes back to the blocks, word by word, and
there to the words' places.  A shuffle so carries a frequent word once a block, not once a
place, no table of words has to fit anywhere, and a word on every line is no hot key.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldweft.llm.common import slices, stage, texts_of

#: Bytes of text that a task numbers at once; a longer text is a block of its own.
BLOCK_BYTES = 12 << 20
#: Bytes of text for each bucket of words: the number of buckets grows with the texts.
BUCKET_BYTES = 16 << 20
#: Numbers of words that are written as one value; a longer text is a value of its own.
RUN_CODES = 1 << 18
#: How hard zstandard tries.
LEVEL = 9


def small(numbers: np.ndarray) -> bytes:
    """Numbers from 0 below 2^35 in one to five bytes each, 7 bits a byte, the low ones first."""
    numbers = np.asarray(numbers, np.int64)
    size = 1 + (numbers >= 1 << 7) + (numbers >= 1 << 14) + (numbers >= 1 << 21) + (numbers >= 1 << 28)
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    first = ends - size
    for i in range(int(size.max(initial=0))):
        has = size > i
        more = (size[has] > i + 1).astype(np.uint8) << 7
        out[first[has] + i] = ((numbers[has] >> 7 * i) & 127).astype(np.uint8) | more
    return out.tobytes()


def large(data: bytes) -> np.ndarray:
    """The numbers that :func:`small` wrote."""
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw < 128)
    first = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    size = ends - first
    numbers = np.zeros(len(ends), np.int64)
    for i in range(int(size.max(initial=-1)) + 1):
        has = size >= i
        numbers[has] |= (raw[first[has] + i] & 127).astype(np.int64) << (7 * i)
    return numbers


def tight(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(LEVEL).compress(data)


def loose(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def buckets_for(docs: DataFrame, text: str) -> int:
    """How many buckets the words of these texts are dealt to."""
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    return max(16, int(size) // BUCKET_BYTES)


def planes(numbers: np.ndarray) -> bytes:
    """64-bit numbers, all their first bytes, then all second ones, ...: packs well."""
    return np.ascontiguousarray(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<i8").ravel()


class _Block:
    def __init__(self):
        self.numbers: dict = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.keys: list = []
        self.codes: list[np.ndarray] = []

    def add(self, key, words: list) -> None:
        self.keys.append(key)
        self.codes.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))

    def _runs(self) -> list[tuple[int, int]]:
        """Texts in a row that are written together."""
        runs, begin, total = [], 0, 0
        for i, codes in enumerate(self.codes):
            if total and total + len(codes) > RUN_CODES:
                runs.append((begin, i))
                begin, total = i, 0
            total += len(codes)
        return [*runs, (begin, len(self.codes))]

    def rows(self, block: int, group: str | None, key_type: pa.DataType, silent, buckets: int, count: bool):
        listed = list(self.numbers)
        uses = np.bincount(np.concatenate(self.codes), minlength=len(listed))
        order = _order(listed, uses)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        runs = self._runs()
        size = len(runs)
        yield _batch(
            [block] * size, [group] * size, pa.array([self.keys[i:j] for i, j in runs], pa.list_(key_type)),
            pa.array([small(np.array([len(c) for c in self.codes[i:j]])) for i, j in runs], pa.binary()),
            pa.array([tight(small(rank[np.concatenate(self.codes[i:j])])) for i, j in runs], pa.binary()),
            pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary()), pa.nulls(size, pa.binary()), pa.nulls(size, pa.binary()),
        )
        self.codes.clear()
        by_bucket: dict[int, list[int]] = defaultdict(list)
        for place, i in enumerate(order.tolist()):
            if (word := listed[i]) not in silent:
                data = word if isinstance(word, bytes) else word.encode()
                by_bucket[zlib.crc32(data) % buckets].append(place)
        size = len(by_bucket)
        if not size:
            return
        join = b"\n".join if isinstance(listed[0], bytes) else (lambda ws: "\n".join(ws).encode())
        places = [np.array(p, np.int64) for p in by_bucket.values()]
        counts = [small(uses[order[p]]) for p in places] if count else [None] * size
        yield _batch(
            [block] * size, [group] * size, pa.nulls(size, pa.list_(key_type)),
            pa.nulls(size, pa.binary()), pa.nulls(size, pa.binary()),
            pa.array(by_bucket, pa.int32()),
            pa.array([tight(small(np.diff(p, prepend=0))) for p in places], pa.binary()),
            pa.array([tight(join([listed[i] for i in order[p].tolist()])) for p in places], pa.binary()),
            pa.array(counts, pa.binary()),
        )


def _order(listed: list, uses: np.ndarray) -> np.ndarray:
    """Words by number: the 2^7 most frequent ones, whose numbers take one byte, the next ones
    up to 2^14, then the others; of each kind in order of their letters, which packs well."""
    by_uses = np.argsort(-uses, kind="stable").tolist()
    kinds = (by_uses[: 1 << 7], by_uses[1 << 7 : 1 << 14], by_uses[1 << 14 :])
    return np.array([i for kind in kinds for i in sorted(kind, key=listed.__getitem__)], np.int64)


_NAMES = ["block", "group", "keys", "sizes", "codes", "bucket", "numbers", "words", "uses"]


def _batch(block, group, *columns) -> pa.RecordBatch:
    arrays = [pa.array(block, pa.int64()), pa.array(group, pa.string()), *columns]
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


def pack(
    docs: DataFrame,
    key: str,
    text: str,
    split: Callable[[bytes], list],
    group: str | None = None,
    silent: frozenset = frozenset(),
    count: bool = False,
) -> DataFrame:
    """The texts of ``docs`` by number, written to the shared folder.

    ``split`` gives the words of a text in UTF-8, none of which may hold U+000A; those in
    ``silent`` get a number, but are not listed.  Texts of a block have the same ``group``.
    Rows of texts: block, group, keys, sizes (words of each text), codes.  Rows of words, one a block and bucket: block,
    group, bucket, numbers, words and, with ``count``, uses.  Block numbers are made of the
    task's and a running one; a repeated task makes them anew, and only one attempt is written.
    """
    buckets = buckets_for(docs, text)
    rows = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        (F.lit("") if group is None else F.col(f"`{group}`").cast("string")).alias("group"),
    )
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        blocks: dict[str, _Block] = defaultdict(_Block)
        pending, key_type = 0, None

        def flush():
            nonlocal block, pending
            for g, b in blocks.items():
                yield from b.rows(block, g, key_type, silent, buckets, count)
                block += 1
            blocks.clear()
            pending = 0

        for batch in slices(batches):
            key_type = batch.column("key").type
            found = zip(batch.column("key").to_pylist(), texts_of(batch.column("text")), batch.column("group").to_pylist())
            for k, t, g in found:
                blocks[g].add(k, split(t))
                pending += len(t) + 16
                if pending >= BLOCK_BYTES:
                    yield from flush()
        yield from flush()

    packed = rows.mapInArrow(
        run, f"block long, group string, keys array<{kind}>, sizes binary, codes binary, bucket int, numbers binary, words binary, uses binary"
    )
    return stage(packed, "word-blocks")


def look_up(packed: DataFrame, find: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``find`` gets the lists of one bucket: block, group, bucket, numbers, words and uses.
    A word is in one bucket only, with all blocks that have it."""
    lists = packed.filter("bucket IS NOT NULL").select("block", "group", "bucket", "numbers", "words", "uses")
    return lists.groupBy("bucket").applyInArrow(find, schema)


def fill(packed: DataFrame, found: DataFrame, fit: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Bring what was found (block, numbers, ...) back to the texts of its block; ``fit``
    gets both as tables, one block at a time."""
    texts = packed.filter("bucket IS NULL").select("block", "group", "keys", "sizes", "codes")
    # A name of its own: both sides come from the same packed table.
    found = found.withColumnRenamed("block", "of_block")
    return texts.groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(fit, schema)


def runs_of(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The codes of a block's texts, some texts at a time, and where each text's begin and end."""
    for sizes, codes in zip(table.column("sizes").to_pylist(), table.column("codes").to_pylist()):
        yield large(loose(codes)), np.concatenate([[0], np.cumsum(large(sizes))])


def keys_of(table: pa.Table) -> pa.Array:
    return table.column("keys").combine_chunks().flatten()


def numbers_of(data: bytes) -> np.ndarray:
    """The numbers of a list of words."""
    return np.cumsum(large(loose(data)))


def words_of(data: bytes) -> list[str]:
    return loose(data).decode().split("\n")
