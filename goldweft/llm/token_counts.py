"""Token counts by byte-pair merging with a heap and a linked list.

Only counts are wanted, so no identifier is ever made: a piece of text starts as its
bytes, every merge removes one symbol, and what is left is counted.
"""

from __future__ import annotations

import heapq
import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldweft.llm.common import slices

#: Fixed value: how the byte-level pre-tokenizer cuts a text.  White space is Unicode's.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    r"| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Pieces whose counts a worker remembers before it starts anew.
REMEMBERED = 400_000


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it prints, else one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


class Counter:
    """Counts tokens as a byte-level ``tokenizer.json`` gives them."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        self.ranks = {tuple(pair): i for i, pair in enumerate(model["model"]["merges"])}
        self.symbols = byte_symbols()
        self.pieces = regex.compile(PIECES)
        special = sorted((t["content"] for t in model["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        self.known: dict[str, int] = {}

    def merged(self, piece: str) -> int:
        """Symbols that are left of one piece when no pair can be merged any more."""
        symbol = [self.symbols[b] for b in piece.encode()]
        n = left = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.ranks
        heap = [
            (ranks[pair], i, pair) for i, pair in enumerate(zip(symbol, symbol[1:])) if pair in ranks
        ]
        heapq.heapify(heap)
        while heap:
            _, i, (a, b) = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != a or j >= n or symbol[j] != b:
                continue  # one of the two has been merged since
            symbol[i], symbol[j] = a + b, ""
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                if (pair := (symbol[i], symbol[k])) in ranks:
                    heapq.heappush(heap, (ranks[pair], i, pair))
            if (h := before[i]) >= 0 and (pair := (symbol[h], symbol[i])) in ranks:
                heapq.heappush(heap, (ranks[pair], h, pair))
        return left

    def plain(self, text: str) -> int:
        known, total = self.known, 0
        for piece in self.pieces.findall(text):
            n = known.get(piece)
            if n is None:
                n = self.merged(piece)
                if len(piece) < 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = n
            total += n
        return total

    def count(self, text: str) -> int:
        """Tokens of a text; a special string is one token."""
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


_counters: dict[int, Counter] = {}


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int = 512, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of
    every row of ``docs``.

    ``vocabulary``: path of a byte-level ``tokenizer.json``, read by the driver.  Texts
    are counted whole; null counts as empty and gives 0.  Repeated rows and null keys
    give a row each, an empty table none; other columns are left out.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(spec)  # the vocabulary: a fixed size
    number = hash(spec)

    def run(batches):
        if number not in _counters:
            _counters.clear()
            _counters[number] = Counter(shared.value)
        counter = _counters[number]
        for part in slices(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key"),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([counter.count(t) for t in texts], pa.int64()),
                ],
                names=["key", "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
