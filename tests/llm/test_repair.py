import hashlib
import heapq
import random
import re
import zlib

import pytest

from serpscope.llm import repair as R
from serpscope.llm.queries import repaired

BLANKS = " \t\n\v\f\r"


def cheapest(rows, entry=0, exits=(0, 3), last=True):
    """Cost and least edits by Dijkstra's search over (cost, edits)."""
    free = {0: 2, 1: 2, 2: 3, 3: 2}
    heap, done = [(0, "", 0, entry)], set()
    while heap:
        cost, edits, i, q = heapq.heappop(heap)
        if i == len(rows) and q in exits and (last or edits[-1:] != "I"):
            return cost, edits
        if (i, q) in done:
            continue
        done.add((i, q))
        if i < len(rows) or last:
            heapq.heappush(heap, (cost + 3, edits + "I", i, free[q]))
        if i == len(rows):
            continue
        heapq.heappush(heap, (cost + 4, edits + "D", i + 1, q))
        if rows[i] != "-":
            more = 3 if rows[i].isupper() else 0
            to = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(rows[i].lower(), {}).get(q)
            if to is not None:
                heapq.heappush(heap, (cost + more, edits + "K", i + 1, to))
            heapq.heappush(heap, (cost + 3 + more, edits + "R", i + 1, free[q]))
    return None


def brute(rows):
    """By conversation what op11 returns, from rows of (conv_id, turn, role, text)."""
    by = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        own = by.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        codes, seen, faults = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            end = text.rstrip(BLANKS)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else None
            fault = fault or ("truncated" if end[-1] not in ".!?" else None)
            seen.add((role, text))
            code = role[0] if role[:1] and role[0] in "sua" else "x"
            codes.append("-" if fault in ("blank", "duplicate") else code.upper() if fault else code)
            if fault:
                faults[fault] += 1
        turns = {t for t, _, _ in own if t is not None}
        cost, edits = cheapest("".join(codes))
        lines, q, at = [], "", 0
        for e in edits:
            role, text = ("", "") if e == "I" else own[at][1:]
            at += e != "I"
            if e in "IR":
                role = "assistant" if q == "u" else "user"
            if e != "D":
                lines.append(f"{role}:{text}")
                q = role[0]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        out.append(
            (
                conv,
                max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                *faults.values(),
                sum(p not in ("su", "ua", "au") for p in pairs),
                cost,
                edits,
                hashlib.sha256("\n".join(lines).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def test_search_is_cheapest_and_least():
    draw = random.Random(3)
    for _ in range(3000):
        rows = "".join(draw.choice("sua-xSUAXuaua") for _ in range(draw.randint(0, 9)))
        assert R.search(rows) == cheapest(rows)
    for _ in range(1500):
        rows = "".join(draw.choice("sua-xSUAXuaua") for _ in range(draw.randint(1, 7)))
        entry, out, last = draw.randrange(4), draw.randrange(4), draw.random() < 0.5
        if out == 1 and not (entry == 1 or entry == 0 and "s" in rows.lower()) or out == 0 and entry:
            assert R.search(rows, entry, frozenset([out]), last) is None
        elif entry < 2 or out > 1:
            assert R.search(rows, entry, frozenset([out]), last) == cheapest(rows, entry, (out,), last)


SCHEMA = "text string, conv_id long, role string, turn long, kept int, rank long, segment int"


@pytest.fixture(scope="module")
def talks():
    draw = random.Random(11)
    words = ["Yes.", "no", "", " \t\n", "What? ", "So!\n", "é.", "x ", None, "a.b"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "ugly", "System"]
    rows = []
    for conv in [*range(60), None, -7, 1 << 60]:
        n = draw.choice([1, 2, 5, 9, 40 if conv == 3 else 7])
        for k in range(n):
            turn = None if draw.random() < 0.05 else k + draw.randint(0, 1) * (conv or 1)
            role = roles[k % 2] if draw.random() < 0.6 else draw.choice(roles)
            rows.append((conv, turn, role, draw.choice(words)))
    rows += rows[:9]
    rows += [(900 + i, 0, "user", "Alone.") for i in range(60)]
    rows += [(None, None, None, None), (950, None, None, None)]
    return rows


@pytest.mark.parametrize("segment", [128, 6, 1])
def test_damaged_conversations_against_brute_force(spark, talks, segment):
    given = spark.createDataFrame([(x, c, r, t, 1, 2, 3) for c, t, r, x in talks], SCHEMA)
    got = R.repair_damaged(given.repartition(5), segment, keep=True)
    rows = got.collect()
    assert sorted((tuple(r)[:-1] for r in rows), key=str) == brute(talks)
    assert all(hashlib.sha256(r.repaired.encode()).hexdigest() == r.repaired_sha256 for r in rows)
    assert any(r.audit == "" and r.cost == 0 for r in rows)


def test_a_conversation_with_all_rows(spark):
    draw = random.Random(2)
    rows = [(5, k, draw.choice(["user", "assistant"]), f"{k % 97}.") for k in range(400)]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [tuple(r)[:-1] for r in R.repair_damaged(given, 16).collect()]
    assert got == brute(rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert R.repair_damaged(none).count() == 0 and R.repair(none).count() == 0


def test_the_given_conversations(spark, data):
    rows = spark.read.parquet(f"{data}/conversations.parquet").collect()
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in rows]
    assert sorted((tuple(r) for r in repaired(spark, data).collect()), key=str) == brute(rows)
