"""Licence scans: an Aho-Corasick automaton over words, and licence expressions.

The automaton finds identifier tags and notice phrases in one pass over a text's words.
The expression behind a tag (``MIT OR (Apache-2.0 AND GPL-2.0 WITH Classpath-exception-2.0)``)
is brought into postfix order by a shunting-yard parser and evaluated.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldweft.llm.common import slices, texts_of

#: The base phrases and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: Further notices, and the words of the tag that comes before a licence expression.
NOTICES = {
    "mit license": "mit",
    "apache license": "apache",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "public domain": "public-domain",
}
TAG = "spdx license identifier"
#: How freely text under a label may be used, from 1 (freely) to 0 (not at all).
FREEDOM = {
    "public-domain": 1.0,
    "mit": 0.95,
    "bsd": 0.95,
    "apache": 0.95,
    "cc-by": 0.9,
    "mpl": 0.7,
    "lgpl": 0.6,
    "cc-by-sa": 0.6,
    "gpl": 0.4,
    "agpl": 0.3,
    "cc-by-nc": 0.2,
    "cc-by-nd": 0.2,
    "reserved": 0.0,
}
#: Of a label that is not in the list, and of a text without any label.
UNKNOWN, UNLABELLED = 0.5, 0.5
#: What an exception (``WITH``) adds to the freedom of a licence.
EXCEPTION = 0.2

#: A-Z to a-z; every other ASCII character that is no digit or letter to a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)
_TAG_AT = re.compile(rb"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:_-]+")
_BINDS = {"OR": 1, "AND": 2, "WITH": 3}


def family(identifier: str) -> str:
    """The label of a licence identifier: ``GPL-2.0-only`` gives ``gpl``."""
    name = identifier.lower().rstrip("+")
    if name in ("cc0-1.0", "unlicense", "0bsd"):
        return "public-domain"
    known = sorted((f for f in FREEDOM if name == f or name.startswith(f + "-")), key=len)
    return known[-1] if known else name


def postfix(expression: str) -> list[str] | None:
    """The expression in postfix order, or None where it is none.

    Reads as far as the text is an expression: a comment's end or other words after a
    whole expression close it.
    """
    out: list[str] = []
    held: list[str] = []
    operand = True  # what is expected next
    for token in _TOKEN.findall(expression):
        word = token.upper()
        if operand:
            if token == "(":
                held.append(token)
            elif token == ")" or word in _BINDS or not re.match(r"[A-Za-z0-9]", token):
                return None
            else:
                out.append(token)
                operand = False
        elif word in _BINDS:
            while held and held[-1] != "(" and _BINDS[held[-1]] >= _BINDS[word]:
                out.append(held.pop())
            held.append(word)
            operand = True
        elif token == ")" and "(" in held:
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        else:
            break
    if operand or "(" in held:
        return None
    return out + held[::-1]


def evaluate(order: list[str]) -> tuple[set[str], float]:
    """Labels and freedom of an expression: ``AND`` binds to the stricter side, ``OR``
    lets one choose the freer one, ``WITH`` loosens its licence."""
    stack: list[tuple[set[str], float]] = []
    for token in order:
        if token == "WITH":
            stack.pop()
            labels, free = stack.pop()
            stack.append((labels, min(1.0, free + EXCEPTION)))
        elif token in ("AND", "OR"):
            (a, x), (b, y) = stack.pop(), stack.pop()
            stack.append((a | b, min(x, y) if token == "AND" else max(x, y)))
        else:
            label = family(token)
            stack.append(({label}, FREEDOM.get(label, UNKNOWN)))
    return stack[0]


def build_automaton() -> ahocorasick.Automaton:
    """Base phrases, notices and the tag, each as words between spaces."""
    automaton = ahocorasick.Automaton()
    for phrase in {**NOTICES, **BASE, TAG: ""}:
        automaton.add_word(f" {phrase} ", phrase)
    automaton.make_automaton()
    return automaton


def scan_text(text: bytes, automaton: ahocorasick.Automaton) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels and score of a text."""
    words = text.translate(_FOLD).split()
    line = f" {b' '.join(words).decode(errors='replace')} "
    starts: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    free: list[float] = []
    tagged = False
    word = read = 0
    for end, phrase in automaton.iter(line):
        start = end - len(phrase) - 1
        if phrase in BASE:
            # Ends come in order, starts nearly so: count on from the last place.
            word += line.count(" ", read, start) if start >= read else -line.count(" ", start, read)
            read = start
            starts.append(word)
            base.add(BASE[phrase])
        elif phrase == TAG:
            tagged = True
        if label := NOTICES.get(phrase):
            labels.add(label)
            free.append(FREEDOM[label])
    if tagged:
        for found in _TAG_AT.finditer(text):
            order = postfix(found[1].decode(errors="replace"))
            if order:
                named, value = evaluate(order)
                labels |= named
                free.append(value)
    free += [FREEDOM[b] for b in base]
    return (
        len(words),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | labels)),
        min(free, default=UNLABELLED),
    )


_automata: list[ahocorasick.Automaton] = []

SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double"
)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the findings (:data:`SCHEMA`) of every row of ``docs``.

    Words are runs of letters, digits and non-ASCII characters, A-Z read as a-z.  n_base
    counts all places of the base phrases, overlapping ones too; first_word and last_word
    are the smallest and greatest of their first words, null without any.  score is the
    freedom of the strictest finding, 0.5 without one.  A null text is empty (no words,
    empty labels).  A tag without a valid expression adds nothing.  Repeated rows and null
    keys give a row each; other columns are left out.
    """

    def run(batches):
        if not _automata:
            _automata.append(build_automaton())
        for part in slices(batches):
            rows = [scan_text(t, _automata[0]) for t in texts_of(part.column("text"))]
            columns = [part.column("key")]
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            columns += [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                columns, names=["key", *(c.split()[0] for c in SCHEMA.split(", "))]
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, {SCHEMA}").withColumnRenamed("key", key)
