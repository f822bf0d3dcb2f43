"""Repaired conversations against a search over all edits."""

import hashlib
import heapq
import itertools
import random
import re
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import pytest

pytest.importorskip("public_tokenizers")
sys.path.insert(0, str(Path(__file__).resolve().parent))

from goldweft.llm import chat_repair  # noqa: E402
from goldweft.llm.queries import QUERIES  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string, conv string, symbols int, part int"


def damaged(rows):
    for conv, turn, role, text in rows:
        conv_text, turn_text = (" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{conv_text}:{turn_text}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def search(rows):
    """Cost, audit and lines: the first end that a search by (cost, audit) comes to."""
    initials = {(): None}
    open_ = [(0, "", 0, "", ())]
    done = set()
    while open_:
        cost, audit, at, tail, lines = heapq.heappop(open_)
        if at == len(rows) and tail in ("", "a"):
            return cost, audit, lines
        if (at, tail) in done:
            continue
        # A state may be left only by its least (cost, audit).
        done.add((at, tail))
        wanted = "a" if tail == "u" else "u"
        name = {"u": "user", "a": "assistant"}[wanted]
        heapq.heappush(open_, (cost + 5, audit + "I", at, wanted, (*lines, f"{name}:")))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(open_, (cost + 2, audit + "D", at + 1, tail, lines))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                heapq.heappush(open_, (cost + 1 + more, audit + "R", at + 1, wanted, (*lines, f"{name}:{text}")))
                if role[:1] == wanted or role[:1] == "s" and tail == "":
                    heapq.heappush(open_, (cost + more, audit + "K", at + 1, role[0], (*lines, f"{role}:{text}")))
    raise AssertionError(initials)


def by_hand(rows, ids):
    chats = defaultdict(list)
    for conv, turn, role, text in rows:
        chats[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv in set(ids):
        chat = sorted(chats[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in chat if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, judged = set(), []
        for _, role, text in chat:
            left = re.sub("[ \t-\r]+", "", text)
            fault = "blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else None
            seen.add((role, text))
            judged.append((role, text, fault))
        faults = [f for *_, f in judged]
        heads = [role[:1] for role, *_ in judged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(heads))
        cost, audit, lines = search(judged)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def chats(seed, n, length=9):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(0, length)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "User", None])
            text = rng.choice(["Yes.", "No!", "é?", "cut", " \t\x0b", "", None, f"t{rng.randint(0, 3)}.\n", "end. x", "." * 3])
            rows.append((conv, rng.choice([turn, turn, turn + rng.randint(0, 3), None]), role, text))
    return rows


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_equals_a_search_over_all_edits(spark):
    rows = chats(1, 400) + [(None, 0, "user", "Hi."), (None, 1, "user", "cut"), (500, None, "assistant", "No.")]
    got = result(chat_repair.repair(make(spark, rows)))
    assert got == by_hand(rows, {r[0] for r in rows})


def test_pieces_and_rules_do_not_change_the_result(spark, monkeypatch):
    monkeypatch.setattr(chat_repair, "PIECE_ROWS", 3)
    monkeypatch.setattr(chat_repair, "ROUNDS", 2)
    rng = random.Random(2)
    long = [(7, i, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", f"{i}!"])) for i in range(700)]
    rows = chats(3, 60) + long
    df = make(spark, rows)
    summary, lines = chat_repair.repair(df, texts=True)
    want = by_hand(rows, {r[0] for r in rows})
    assert result(summary) == want
    said = defaultdict(list)
    for conv, _, text in sorted(lines.collect(), key=lambda r: r[1]):
        said[conv].append(text)
    for conv, *_, digest in want:
        assert hashlib.sha256("\n".join(said[conv]).encode()).hexdigest() == digest


def test_damage(spark):
    rows = [(c, t, r, x) for c, t, r, x in chats(4, 120) if (t is None or t >= 0)] + [(None, None, None, None), (None, 3, "user", "Hi.")]
    rows = [(c, t if i % 17 else None, r, x) for i, (c, t, r, x) in enumerate(rows)]
    got = sorted(map(tuple, chat_repair.damage(make(spark, rows)).collect()), key=repr)
    assert got == sorted(damaged(rows), key=repr)


def test_empty_tables_and_conversations_without_rows(spark):
    rows = chats(5, 3)
    df = make(spark, rows)
    nothing = df.filter("1 = 0")
    assert chat_repair.repair(nothing).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    ids = make(spark, [(9, 0, None, None), (None, 0, None, None)])
    assert result(chat_repair.repair(nothing, ids)) == [(9, 0, 0, 0, 0, 0, 0, "", empty), (None, 0, 0, 0, 0, 0, 0, "", empty)]


def test_long_audits_are_compared_as_texts():
    rng = random.Random(6)
    matrices = chat_repair.Grammar([]).matrices()
    ropes = chat_repair.Rope.FLAT
    for _ in range(30):
        text = "".join(rng.choice(chat_repair.SYMBOLS) for _ in range(rng.randint(0, 60)))
        chat_repair.Rope.FLAT = ropes
        want = chat_repair.cheapest(text, matrices)
        chat_repair.Rope.FLAT = 3
        try:
            assert chat_repair.cheapest(text, chat_repair.Grammar([]).matrices()) == want
        finally:
            chat_repair.Rope.FLAT = ropes


def test_query_on_the_smallest_data(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_chat_repair"](spark, sf)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert result(got) == by_hand(list(damaged(rows)), {r[0] for r in rows})
