"""Repair of the turn structure of conversations, by a grammar over their faults.

What a repair costs depends only on the order of roles and faults, so each conversation is
written as a text of symbols, one a row.  Re-Pair replaces frequent pairs of symbols by new
ones, over the distinct texts of all conversations.  Each symbol has one matrix: for every
state before and after it the least cost, and the audit (the edits) that has it, as a rope.
A rule's matrix is the min-plus product of its two parts, made once, bottom-up, and shared by
all conversations in which the rule occurs; the few symbols left of a text are multiplied.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldweft.llm.common import slices, stage

#: What the edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Roles that are put in, and adjacent initials that are in order.
USER, ASSISTANT = "user", "assistant"
LEGAL = ("su", "ua", "au")

#: Rounds of Re-Pair, and rules a round.  More rules save products, none change the result.
ROUNDS, RULES = 8, 16
#: Rows and bytes of a conversation that are written together; a longer one has more pieces.
PIECE_ROWS, PIECE_BYTES = 4096, 1 << 20

_BLANKS = " \t\n\x0b\f\r"
_CLASSES = "suao"  # the last one: any other initial
_FAULTS = ("blank", "duplicate", "truncated", "none")
#: One symbol for each class of role and fault.
SYMBOLS = [chr(97 + i) for i in range(len(_CLASSES) * len(_FAULTS))]
_FIRST_RULE = 0xE000  # rules are named by private-use characters


# -- rows and faults (DataFrame functions) ---------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of a table with known faults: by the checksum of
    ``conv_id:turn`` rows are dropped, emptied, robbed of their ends, repeated, or said by the
    user.  A null stands for one space; null ids and turns stay null."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    rows = conversations.select(
        "conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind")
    ).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, USER).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _symbol(duplicate: Column) -> Column:
    """The symbol of a row: the class of its role's initial and its first fault."""
    initial = F.substring("role", 1, 1)
    place = F.lit(len(_CLASSES) - 1)
    for i, c in enumerate(_CLASSES[:-1]):
        place = F.when(initial == c, i).otherwise(place)
    cut = F.rtrim(F.col("text"), F.lit(_BLANKS))
    fault = (
        F.when(cut == "", 0)
        .when(duplicate, 1)
        .when(~F.substring(cut, -1, 1).isin(".", "!", "?"), 2)
        .otherwise(3)
    )
    return F.get(F.array(*map(F.lit, SYMBOLS)), place * len(_FAULTS) + fault)


def _pieces(rows: DataFrame) -> DataFrame:
    """conv, part, no (both together give the order), symbols, roles and texts: rows of one
    conversation in order, :data:`PIECE_ROWS` at most in one piece."""
    said = F.sha2(F.concat(F.char_length("role"), F.lit(":"), "role", "text"), 256)
    earlier = Window.partitionBy("conv", "said").orderBy(F.asc_nulls_first("turn"))
    known = (
        rows.withColumn("said", said)
        .withColumn("nth", F.row_number().over(earlier))
        .select("conv", "turn", "role", "text", _symbol(F.col("nth") > 1).alias("symbol"))
    )
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    # By range, so that a conversation with very many rows is cut as well.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = known.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches):
        part, no = TaskContext.get().partitionId(), 0
        conv, held, size, key_type = None, [], 0, None

        def piece():
            nonlocal no
            no += 1
            symbols, roles, texts = zip(*held)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([conv], key_type), pa.array([part], pa.int32()), pa.array([no], pa.int64()),
                    pa.array(["".join(symbols)]), pa.array([roles], pa.list_(pa.string())), pa.array([texts], pa.list_(pa.string())),
                ],
                names=["conv", "part", "no", "symbols", "roles", "texts"],
            )

        for batch in slices(batches):
            key_type = batch.column("conv").type
            for c, symbol, role, text in zip(*[batch.column(n).to_pylist() for n in ("conv", "symbol", "role", "text")]):
                if held and (c != conv or len(held) >= PIECE_ROWS or size + len(text) > PIECE_BYTES):
                    yield piece()
                    held, size = [], 0
                conv = c
                held.append((symbol, role, text))
                size += len(text)
        if held:
            yield piece()

    schema = f"conv {kind}, part int, no long, symbols string, roles array<string>, texts array<string>"
    return stage(ordered.select("conv", "symbol", "role", "text").mapInArrow(run, schema), "chat-pieces")


# -- matrices ------------------------------------------------------------------------------


class Rope:
    """A text made of two texts; short ones are joined, long ones only named."""

    __slots__ = ("text", "left", "right", "size")
    FLAT = 4096

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        self.size = len(text) if text is not None else left.size + right.size

    def __add__(self, other: Rope) -> Rope:
        if not self.size or not other.size:
            return other if not self.size else self
        if self.size + other.size <= self.FLAT:
            return Rope(self.text + other.text)
        return Rope(None, self, other)

    def parts(self):
        """The flat texts in order."""
        open_ = [self]
        while open_:
            rope = open_.pop()
            if rope.text is None:
                open_ += [rope.right, rope.left]
            else:
                yield rope.text

    def __str__(self) -> str:
        return "".join(self.parts())

    def __lt__(self, other: Rope) -> bool:
        if self.text is not None and other.text is not None:
            return self.text < other.text
        mine, theirs, a, b = self.parts(), other.parts(), "", ""
        while True:
            a, b = a or next(mine, ""), b or next(theirs, "")
            n = min(len(a), len(b))
            if not n or a[:n] != b[:n]:
                return a[:n] < b[:n] if n else bool(b)
            a, b = a[n:], b[n:]


#: (cost, audit) for each state before (row) and after (column), None where there is no way.
#: States: nothing yet, after a system turn, after a user's, after an assistant's.
Matrix = list[list[tuple[int, Rope] | None]]
_NEXT_USER, _NEXT_ASSISTANT, _NEXT_SYSTEM = {0: 2, 1: 2, 3: 2}, {2: 3}, {0: 1}


def _better(a, b):
    """The cheaper of two ways, of equal ones the one with the lesser audit."""
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if b[1] < a[1] else a


def product(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus.  Of two equally dear ways between the same states neither audit begins with
    the other (it would go on with insertions, which cost), so the least audit of a whole is
    made of the least audits of its parts."""
    out: Matrix = [[None] * 4 for _ in range(4)]
    for p in range(4):
        for m in range(4):
            if (first := a[p][m]) is None:
                continue
            for q in range(4):
                if (second := b[m][q]) is None:
                    continue
                cost, best = first[0] + second[0], out[p][q]
                if best is None or cost <= best[0]:
                    out[p][q] = _better(best, (cost, first[1] + second[1]))
    return out


def insertions() -> Matrix:
    """Any number of turns put in."""
    ways: Matrix = [[None] * 4 for _ in range(4)]
    for p in range(4):
        state, audit = p, ""
        while ways[p][state] is None:
            ways[p][state] = (INSERT * len(audit), Rope(audit))
            state, audit = _NEXT_ASSISTANT.get(state) or _NEXT_USER[state], audit + "I"
    return ways


def row_matrix(symbol: str) -> Matrix:
    """Turns put in before a row, then the row kept, given another role or deleted."""
    role, fault = divmod(SYMBOLS.index(symbol), len(_FAULTS))
    edits: Matrix = [[None] * 4 for _ in range(4)]
    moves = {"s": _NEXT_SYSTEM, "u": _NEXT_USER, "a": _NEXT_ASSISTANT, "o": {}}[_CLASSES[role]]
    more = TRUNCATED if _FAULTS[fault] == "truncated" else 0
    for p in range(4):
        edits[p][p] = (DELETE, Rope("D"))
        if _FAULTS[fault] in ("blank", "duplicate"):
            continue
        given = _NEXT_ASSISTANT.get(p) or _NEXT_USER[p]
        edits[p][given] = _better(edits[p][given], (REROLE + more, Rope("R")))
        if p in moves:
            edits[p][moves[p]] = _better(edits[p][moves[p]], (more, Rope("K")))
    return product(insertions(), edits)


@dataclass
class Grammar:
    """Rules in the order they were made: each new symbol and the pair it stands for."""

    rules: list[tuple[str, str, str]]

    def matrices(self) -> dict[str, Matrix]:
        """Of all symbols, bottom-up."""
        known = {s: row_matrix(s) for s in SYMBOLS}
        for new, left, right in self.rules:
            known[new] = product(known[left], known[right])
        return known


def cheapest(text: str, matrices: dict[str, Matrix]) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a text of symbols; products are taken in
    neighbouring pairs, so ropes stay shallow."""
    row = [matrices[s] for s in text] or [[[(0, Rope("")) if p == q else None for q in range(4)] for p in range(4)]]
    while len(row) > 1:
        row = [product(*row[i : i + 2]) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)]
    ways = product(row[0], insertions())[0]
    cost, audit = _better(ways[0], ways[3])
    return cost, str(audit)


def re_pair(texts: DataFrame, column: str = "packed") -> tuple[DataFrame, Grammar]:
    """``texts`` with the pairs of ``column`` replaced that occur most often, and the rules.

    A round counts all adjacent pairs and takes the :data:`RULES` most frequent ones that have
    no symbol in common; it ends when no pair occurs twice, or after :data:`ROUNDS`.  Only the
    pairs taken come to the driver.
    """
    rules: list[tuple[str, str, str]] = []
    for _ in range(ROUNDS):
        symbols = F.split(column, "")
        pairs = F.filter(
            F.transform(symbols, lambda s, i: F.struct(s.alias("a"), F.get(symbols, i + 1).alias("b"))), lambda p: p["b"].isNotNull()
        )
        counted = (
            texts.select(F.explode(pairs).alias("p"))
            .groupBy("p.a", "p.b")
            .agg(F.count("*").alias("n"))
            .filter("n > 1")
            .orderBy(F.desc("n"), "a", "b")
            .limit(4 * RULES)
            .collect()
        )
        taken: list[tuple[str, str, str]] = []
        for row in counted:
            used = {s for _, *pair in taken for s in pair}
            if len(taken) < RULES and row.a not in used and row.b not in used:
                taken.append((chr(_FIRST_RULE + len(rules) + len(taken)), row.a, row.b))
        if not taken:
            break
        rules += taken
        packed = F.col(column)
        for new, left, right in taken:
            packed = F.replace(packed, F.lit(left + right), F.lit(new))
        texts = stage(texts.withColumn(column, packed), "re-pair")
    return texts, Grammar(rules)


def _audits(sequences: DataFrame) -> DataFrame:
    """sequence, cost and audit of every distinct sequence."""
    distinct = stage(sequences.select("sequence").distinct().withColumn("packed", F.col("sequence")), "sequences")
    packed, grammar = re_pair(distinct)
    shared = sequences.sparkSession.sparkContext.broadcast(grammar.rules)  # ROUNDS * RULES at most

    def run(batches):
        matrices = Grammar(shared.value).matrices()
        for batch in batches:
            found = [cheapest(t, matrices) for t in batch.column("packed").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence"), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
                names=["sequence", "cost", "audit"],
            )

    return packed.mapInArrow(run, "sequence string, cost long, audit string")


# -- repaired texts ------------------------------------------------------------------------


def _repaired(pieces: DataFrame, audits: DataFrame, texts: bool) -> DataFrame:
    """conv, no, repaired and sha256: the repaired ``role:text`` lines of each piece (null
    unless ``texts``), and in a conversation's last row the hash of all its lines.

    A conversation's pieces pass one task in order, one at a time: a hash needs them so.
    """
    told = audits.select("conv", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("no"), "audit")
    together = told.unionByName(pieces.select("conv", "part", "no", "roles", "texts"), allowMissingColumns=True)
    ordered = together.repartition("conv").sortWithinPartitions("conv", "part", "no")
    kind = pieces.schema["conv"].dataType.simpleString()

    def run(batches):
        conv, audit, at, state, digest, no, any_, key_type = None, None, 0, 0, None, 0, False, None

        def put_in(lines):
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                lines.append((ASSISTANT if state == 2 else USER) + ":")
                state = 3 if state == 2 else 2
                at += 1

        def out(lines, last):
            nonlocal no, any_
            text = "\n".join(lines)
            if lines:
                digest.update((("\n" if any_ else "") + text).encode())
                any_ = True
            no += 1
            if texts or last:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([conv], key_type), pa.array([no], pa.int64()),
                        pa.array([text if texts and lines else None], pa.string()),
                        pa.array([digest.hexdigest() if last else None], pa.string()),
                    ],
                    names=["conv", "no", "repaired", "sha256"],
                )

        def end():
            lines: list[str] = []
            put_in(lines)
            yield from out(lines, True)

        for batch in batches:
            key_type = batch.column("conv").type
            for row in batch.to_pylist():
                if row["audit"] is not None:
                    if audit is not None:
                        yield from end()
                    conv, audit, at, state, digest, no, any_ = row["conv"], row["audit"], 0, 0, hashlib.sha256(), 0, False
                    continue
                lines: list[str] = []
                for role, text in zip(row["roles"], row["texts"]):
                    put_in(lines)
                    edit = audit[at]
                    at += 1
                    if edit == "D":
                        continue
                    if edit == "R":
                        role = ASSISTANT if state == 2 else USER
                    state = {"s": 1, "u": 2, "a": 3}[role[0]]
                    lines.append(f"{role}:{text}")
                yield from out(lines, False)
        if audit is not None:
            yield from end()

    return ordered.mapInArrow(run, f"conv {kind}, no long, repaired string, sha256 string")


def repair(
    rows: DataFrame, ids: DataFrame | None = None, key: str = "conv_id", texts: bool = False
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """One row a conversation: ``key``, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256; with ``texts`` also the repaired lines (``key``, no, repaired).

    ``rows`` has ``key``, turn, role and text; ``ids`` (column ``key``) names conversations
    that may have no rows, which need no repair.  Rows are taken by turn, nulls first, of the
    same turn by role, then text.  A row's first fault counts: blank, duplicate (role and text
    said earlier), truncated (ends without ``.!?``).  Null roles and texts stand for one space;
    a null key is a conversation of its own.  Repeated rows are duplicates.  gaps counts the
    turns missing between the least and the greatest one.  An empty table gives the rows of
    ``ids`` alone.  Other columns are not read.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    plain = rows.select(F.col(f"`{key}`").alias("conv"), F.col("turn").cast("long").alias("turn"), spaced("role"), spaced("text"))
    gaps = plain.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    pieces = _pieces(plain)
    ordered = F.array_sort(F.collect_list(F.struct("part", "no", "symbols")))
    sequences = stage(
        pieces.groupBy("conv").agg(ordered.alias("found")).select("conv", F.array_join(F.col("found.symbols"), "").alias("sequence")),
        "chat-sequences",
    )
    audits = stage(sequences.join(_audits(sequences), "sequence"), "chat-audits")
    lines = _repaired(pieces, audits, texts)
    if texts:
        lines = stage(lines, "chat-repaired")
    count = lambda fault: (
        F.char_length("sequence") - F.char_length(F.translate("sequence", "".join(SYMBOLS[_FAULTS.index(fault) :: len(_FAULTS)]), ""))
    ).cast("long")
    initials = F.translate("sequence", "".join(SYMBOLS), "".join(c * len(_FAULTS) for c in _CLASSES))
    legal = F.regexp_count(initials, F.lit(f"(?={'|'.join(LEGAL)})"))
    judged = audits.select(
        "conv",
        *[count(fault).alias(fault) for fault in _FAULTS[:-1]],
        (F.char_length("sequence") - 1 - legal).cast("long").alias("illegal"),
        "cost",
        "audit",
    )
    last = lines.filter("sha256 IS NOT NULL").select("conv", "sha256")
    named = plain.select("conv") if ids is None else ids.select(F.col(f"`{key}`").alias("conv"))
    whole = named.distinct()
    for part in (gaps, judged, last):
        renamed = part.withColumnRenamed("conv", "same")
        whole = whole.join(renamed, F.col("conv").eqNullSafe(F.col("same")), "left").drop("same")
    empty = hashlib.sha256(b"").hexdigest()
    summary = whole.fillna(0, ["gaps", *_FAULTS[:-1], "illegal", "cost"]).select(
        F.col("conv").alias(key), "gaps", *_FAULTS[:-1], "illegal", "cost",
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(empty)).alias("repaired_sha256"),
    )
    if not texts:
        return summary
    return summary, lines.filter("repaired IS NOT NULL").select(F.col("conv").alias(key), "no", "repaired")
