"""Encoding and decoding by a table of distinct words.

A byte-pair tokenizer with word ends treats every word alike, wherever it stands.  So texts
are split into words, each distinct word is encoded once, and its ids are joined back to all
its places; decoding joins the ids with the pieces they stand for.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from goldweft.llm import wordblocks as W
from goldweft.llm.common import slices
from goldweft.llm.token_counts import byte_symbols

#: Fixed value: what the tokenizer takes for a word, after lower-casing; all else is dropped.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
#: Fixed value: the mark of a word's last symbol.
END = "</w>"
_KNOWN_NORMALIZERS = ["NFC", "Replace", "Lowercase"]


@dataclass
class Vocabulary:
    """What a ``tokenizer.json`` with word ends says: pieces by id, merges, special words."""

    ids: dict[str, int]
    ranks: dict[tuple[int, int], tuple[int, int]]  # pair -> (rank, merged id)
    special: dict[str, int]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """Raises ValueError for a file of another kind, whose words would be other ones."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, normalizer = spec["model"], spec.get("normalizer") or {}
        kinds = [n["type"] for n in normalizer.get("normalizers", [])]
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        pattern = split.get("pattern", {}).get("Regex", "")
        if (
            model.get("end_of_word_suffix") != END
            or kinds != _KNOWN_NORMALIZERS
            or pattern.replace("[\\p{L}]", "\\p{L}").replace("[\\p{N}]", "\\p{N}").replace("\\s", "\\p{White_Space}") != WORDS
            or spec.get("decoder") is not None
            or any(t["normalized"] for t in spec["added_tokens"])
        ):
            raise ValueError(f"{path} is not a lower-casing byte-pair tokenizer with word ends")
        ids = model["vocab"]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        ranks = {(ids[a], ids[b]): (i, ids[a + b]) for i, (a, b) in enumerate(pairs)}
        return cls(ids, ranks, {t["content"]: t["id"] for t in spec["added_tokens"]})


class Splitter:
    """Cuts a text into words; special words are found before anything else."""

    def __init__(self, special: dict[str, int]):
        self.special = sorted(special, key=len, reverse=True)
        self.words = None

    def __call__(self, text: bytes) -> list[str]:
        if self.words is None:  # made in the task: patterns do not travel
            self.words = regex.compile(WORDS)
            self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        whole = text.decode("utf-8", "replace")
        if not self.cut or "<" not in whole and not self.cut.search(whole):
            return self._plain(whole)
        found = []
        for i, part in enumerate(self.cut.split(whole)):
            found += [part] if i % 2 else self._plain(part)
        return found

    def _plain(self, text: str) -> list[str]:
        # Every letter is lowered by itself: no other form of sigma at the end of a word.
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def __getstate__(self):
        return {"special": self.special, "words": None}


class Merger:
    """Ids of one word."""

    def __init__(self, vocabulary: Vocabulary):
        self.ranks, self.special = vocabulary.ranks, vocabulary.special
        letters = byte_symbols()
        self.inner = [vocabulary.ids[c] for c in letters]
        self.last = [vocabulary.ids[c + END] for c in letters]

    def ids(self, word: str) -> list[int]:
        """The pair of lowest rank is merged first, of equal ones the leftmost."""
        if word in self.special:
            return [self.special[word]]
        data = word.encode()
        symbol = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        n, ranks = len(symbol), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = []
        for i in range(n - 1):
            merge = ranks.get((symbol[i], symbol[i + 1]))
            if merge:
                waiting.append((merge[0], i, symbol[i], symbol[i + 1], merge[1]))
        heapq.heapify(waiting)
        while waiting:
            _, i, a, b, made = heapq.heappop(waiting)
            j = after[i]
            if j >= n or symbol[i] != a or symbol[j] != b:
                continue  # one of the two is part of another symbol by now
            symbol[i], symbol[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if merge := ranks.get((made, symbol[k])):
                    heapq.heappush(waiting, (merge[0], i, made, symbol[k], merge[1]))
            if (h := before[i]) >= 0 and (merge := ranks.get((symbol[h], made))):
                heapq.heappush(waiting, (merge[0], h, symbol[h], made, merge[1]))
        return [s for s in symbol if s >= 0]


def _encode(merger: Merger, table: pa.Table) -> pa.Table:
    """Ids of the words of one bucket, each distinct word encoded once."""
    known: dict[str, list[int]] = {}
    lengths, ids = [], []
    for words in table.column("words").to_pylist():
        found = []
        for word in W.words_of(words):
            if (one := known.get(word)) is None:
                one = known[word] = merger.ids(word)
            found.append(one)
        lengths.append(W.tight(W.small([len(one) for one in found])))
        ids.append(W.tight(W.small([i for one in found for i in one])))
    return pa.table(
        {
            "block": table.column("block"),
            "numbers": table.column("numbers"),
            "lengths": pa.array(lengths, pa.binary()),
            "ids": pa.array(ids, pa.binary()),
        }
    )


def _fit(texts: pa.Table, found: pa.Table) -> pa.Table:
    """Ids of the texts of a block, from those of its words."""
    lists = [W.numbers_of(n) for n in found.column("numbers").to_pylist()]
    size = 1 + max((int(n[-1]) for n in lists), default=-1)
    begin, length = np.zeros(size, np.int64), np.zeros(size, np.int64)
    parts, before = [np.empty(0, "<u4")], 0
    for numbers, lengths, ids in zip(lists, found.column("lengths").to_pylist(), found.column("ids").to_pylist()):
        lengths = W.large(W.loose(lengths))
        begin[numbers] = before + np.cumsum(lengths) - lengths
        length[numbers] = lengths
        parts.append(W.large(W.loose(ids)).astype("<u4"))
        before += len(parts[-1])
    flat = np.concatenate(parts)
    counts, packed = [], []
    for codes, ends in W.runs_of(texts):
        lengths = length[codes]
        stops = np.concatenate([[0], np.cumsum(lengths)])
        ids = flat[np.arange(stops[-1]) + np.repeat(begin[codes] - stops[:-1], lengths)]
        cuts = stops[ends]
        counts += np.diff(cuts).tolist()
        packed += [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
    return pa.table(
        {"key": W.keys_of(texts), "n_tokens": pa.array(counts, pa.int64()), "ids": pa.array(packed, pa.binary())}
    )


def _words_to_ids(docs: DataFrame, vocabulary: Vocabulary, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The numbered texts, and the ids of their words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the file: a fixed size
    mergers: list[Merger] = []

    def find(table: pa.Table) -> pa.Table:
        if not mergers:
            mergers.append(Merger(shared.value))
        return _encode(mergers[0], table)

    packed = W.pack(docs, key, text, Splitter(vocabulary.special))
    return packed, W.look_up(packed, find, "block long, numbers binary, lengths binary, ids binary")


def encode(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_tokens and ids (32-bit little-endian numbers in one binary) of every row."""
    packed, found = _words_to_ids(docs, vocabulary, key, text)
    kind = packed.schema["keys"].dataType.elementType.simpleString()
    return W.fill(packed, found, _fit, f"key {kind}, n_tokens long, ids binary").withColumnRenamed("key", key)


class Pieces:
    """The table of pieces, ordered by id, with which ids are joined."""

    def __init__(self, vocabulary: Vocabulary):
        rows = [*vocabulary.ids.items(), *vocabulary.special.items()]
        size = 1 + max(i for _, i in rows)
        self.by_id, self.has = np.full(size, b"", object), np.zeros(size, bool)
        for piece, i in rows:
            self.by_id[i], self.has[i] = piece.encode(), True

    def join(self, column: pa.ChunkedArray | pa.Array) -> pa.Array:
        """The decoded texts of a column of ids."""
        texts = []
        for data in column.to_pylist():
            ids = np.frombuffer(data or b"", "<u4")
            ids = ids[ids < len(self.by_id)]
            texts.append(b" ".join(self.by_id[ids[self.has[ids]]]))
        return pa.array(texts, pa.string())


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``encoded`` with ``decoded``: the pieces of its ``ids`` with one space between.

    A join of ids with the table of pieces, which is ordered by id and sent to every task, as
    the vocabulary file bounds it; so places keep their order and nothing is shuffled.  An id
    without a piece leaves no trace, no ids give an empty text.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(Pieces(vocabulary))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", decoded string"

    def run(batches):
        for batch in slices(batches, "ids"):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, shared.value.join(batch.column("ids"))], names=[*batch.schema.names, "decoded"]
            )

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_tokens, ids (32-bit little-endian numbers in one binary) and decoded of
    every row of ``docs``.

    ``vocabulary``: path of a ``tokenizer.json`` with word ends, read by the driver.  Texts
    are encoded whole; null and blank ones have no ids and decode to an empty text.  Special
    strings in a text are one id.  Repeated rows and null keys give a row each, an empty table
    none; other columns are left out.  Words of any length are encoded, one at a time.
    """
    known = Vocabulary.read(vocabulary)
    packed, found = _words_to_ids(docs, known, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(known))

    def fit(texts: pa.Table, found: pa.Table) -> pa.Table:
        coded = _fit(texts, found)  # decoded in the same task as encoded: one hand-over less
        return coded.append_column("decoded", shared.value.join(coded.column("ids")))

    kind = packed.schema["keys"].dataType.elementType.simpleString()
    filled = W.fill(packed, found, fit, f"key {kind}, n_tokens long, ids binary, decoded string")
    return filled.withColumnRenamed("key", key)
