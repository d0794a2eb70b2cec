"""Conversation repair against a shortest-path search over whole audits, written from the contract."""

import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string, fault string, letters string, digest string"
WORDS = re.compile(r"[^\x20\x09-\x0D]")
MOVES = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def cheapest(rows):
    """(cost, audit) of rows given as (initial, must go, truncated)."""
    @functools.lru_cache(None)
    def go(i, q, inserted):
        found = [(0, "")] if i == len(rows) and q in (0, 3) else []
        def step(cost, letter, rest):
            if rest:
                found.append((cost + rest[0], letter + rest[1]))
        if inserted < 3:
            for r in "ua":
                if r in MOVES[q]:
                    step(2, "I", go(i, MOVES[q][r], inserted + 1))
        if i < len(rows):
            initial, gone, cut = rows[i]
            step(3, "D", go(i + 1, q, 0))
            if not gone:
                if initial in MOVES[q]:
                    step(cut, "K", go(i + 1, MOVES[q][initial], 0))
                for r in "ua":
                    if r in MOVES[q]:
                        step(2 + cut, "R", go(i + 1, MOVES[q][r], 0))
        return min(found) if found else None
    return go(0, 0, 0)


def by_hand(table, damaged=True):
    """Contract rows by conv_id."""
    convs = {}
    for conv, turn, role, text in table:
        out = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        role = "user" if k == 4 else role
        digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
        out += [(turn is not None, turn or 0, role, digest, turn, text)] * (2 if k == 3 else 1)
    want = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: r[:4])
        seen, faults = set(), []
        for _, _, role, _, _, text in rows:
            last = WORDS.findall(text)
            faults.append(1 if not last else 2 if (role, text) in seen else 3 if last[-1] not in ".!?" else 0)
            seen.add((role, text))
        cost, audit = cheapest(tuple((r[2][:1], f in (1, 2), f == 3) for r, f in zip(rows, faults)))
        q, lines, at = 0, [], 0
        for c in audit:
            if c == "I" or c == "R":
                role = "user" if "u" in MOVES[q] else "assistant"
                lines.append(f"{role}:{rows[at][5] if c == 'R' else ''}")
                q = MOVES[q][role[0]]
            elif c == "K":
                lines.append(f"{rows[at][2]}:{rows[at][5]}")
                q = MOVES[q][rows[at][2][0]]
            at += c != "I"
        turns = [r[4] for r in rows if r[4] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        want[conv] = (conv, gaps, *(faults.count(f) for f in (1, 2, 3)), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return want


def sample(rng):
    """Conversations with nulls, ties, repeated rows, other roles, all lengths; one holds a third of the rows."""
    texts = ["", " ", "\t\n", "Yes.", "No", "Why? ", "Well...\n", "x" * 40 + "!", "é", "end ", None, "a.b"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "Übung", "u"]
    table = []
    for conv in [None, *range(60)]:
        n = rng.choice((0, 1, 2, 3, 5, 8, 13))
        for t in range(n):
            table.append((conv, rng.choice((None, t, t, t, t // 2, t + 3)), rng.choice(roles), rng.choice(texts + [f"text {conv} {t}.", f"text {t}"] * 6)))
    hot = [(7000, rng.choice((None, *range(200))), rng.choice(("user", "assistant", "system")), rng.choice(("Same.", f"t{rng.randrange(150)}", f"s{rng.randrange(150)}."))) for _ in range(250)]
    return table + hot + table[:9] + [(1, 5000, "user", "far away.")]


@pytest.mark.parametrize("piece", [4096, 7])
def test_repair_equals_search(spark, monkeypatch, piece):
    import sys
    sys.setrecursionlimit(20000)
    monkeypatch.setattr(C, "PIECE", piece)
    rng = random.Random(4)
    table = sample(rng)
    rng.shuffle(table)
    convs = spark.createDataFrame([(*r, "f", "l", "d") for r in table], SCHEMA).repartition(5)
    got = {r["conv_id"]: tuple(r) for r in C.repaired_conversations(convs).collect()}
    want = by_hand(table)
    assert got == want and any(len(w[7]) > 50 for w in want.values())


def test_repair_rows_over_range_partitions(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE", 16)
    rng = random.Random(5)
    table = [(c, t, r, x) for c, t, r, x in sample(rng) if c is not None]
    rows = C.repair(spark.createDataFrame(table, "conv_id long, turn long, role string, text string")).collect()
    want = by_hand(table, damaged=False)
    for conv in {r["conv_id"] for r in rows}:
        mine = [r for r in rows if r["conv_id"] == conv]
        assert "".join(r["edit"] for r in mine) == want[conv][7]
        text = "\n".join(f"{r['role']}:{r['text']}" for r in mine if r["edit"] != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == want[conv][8]
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][:1] for r in mine if r["edit"] != "D"))


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.repaired_conversations(empty).count() == 0 and C.repair(empty).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    only = spark.createDataFrame([(dropped, 0, "user", "gone.")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in C.repaired_conversations(only).collect()] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_block_tables_compose():
    t = C.tables()
    rng = random.Random(6)
    assert len(t.vectors) < 64 and t.block_to.shape == (len(t.vectors), 9**C.BLOCK)
    for _ in range(300):
        symbols = np.array([rng.randrange(9) for _ in range(rng.randrange(30))], np.int64)
        letters, q = t.trace(symbols, t.end, 0)
        right, before, cost = t.boundaries(symbols, t.end)
        v, rows_cost = t.end, 0
        for s in symbols[::-1]:
            rows_cost += t.row_cost[v, s]
            v = t.row[v, s]
        assert (v, rows_cost) == (before, cost)
        cut = rng.randrange(len(symbols) + 1)
        late = np.frombuffer(t.piece_map(symbols[cut:]), np.int32).reshape(-1, 5)[t.end]
        early = np.frombuffer(t.piece_map(symbols[:cut]), np.int32).reshape(-1, 5)[late[0]]
        assert early[0] == before and late[1 + early[1]] == q
