"""Conversation repair against a search over single edits, whole and in pieces."""

import hashlib
import heapq
import random
import zlib

import pytest

from tallywatch.llm import repair

WHITE = " \t\n\x0b\x0c\r"
DDL = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        held = out.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 1:
            text = ""
        if draw == 2:
            text = "".join(c for c in text if c not in ".!?")
        row = (turn, "user" if draw == 4 else role, text)
        held += [row] * {0: 0, 3: 2}.get(draw, 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in out.items()}


def cheapest(rows, faults):
    """Dijkstra by cost, then by edit list."""
    heap, done = [(0, "", 0, "0", ())], set()
    while heap:
        cost, audit, i, state, turns = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in "0a":
            return cost, audit, turns
        to = "a" if state == "u" else "u"
        role = {"u": "user", "a": "assistant"}[to]
        heapq.heappush(heap, (cost + 2, audit + "I", i, to, (*turns, (role, ""))))
        if i < len(rows):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, turns))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, to, (*turns, (role, rows[i][2]))))
                own = rows[i][1][:1]
                if own and own in {"0": "su", "s": "u", "u": "a", "a": "u"}[state]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, own, (*turns, rows[i][1:])))


def brute(rows):
    out = {}
    for conv, held in damaged(rows).items():
        faults, seen = [], set()
        for _, role, text in held:
            core = text.strip(WHITE)
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
            faults.append(fault)
            seen.add((role, text))
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        cost, audit, kept = cheapest(held, faults)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def found(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{DDL}, conv string, at int")
    return {r[0]: tuple(r)[1:] for r in repair.audited(repair.damaged(frame)).collect()}


def some_rows():
    draw = random.Random(3)
    roles = ["system", "user", "assistant", "tool", None, "", "user", "assistant"]
    texts = ["Hi there.", "Yes!", "what", "", "  ", "No.\n", "ok?", "tail", "\x0b", None, "end. ", "ünï.  "]
    rows = [(c, draw.choice([None, *range(9)]), draw.choice(roles), draw.choice(texts)) for c in range(120) for _ in range(draw.randint(1, 12))]
    rows += [(1000, t, draw.choice(["user", "assistant", "system"]), f"t{draw.randint(0, 200)}" + draw.choice([".", ""])) for t in range(300)]
    rows += [(None, t % 50, draw.choice(["user", "assistant"]), f"t{draw.randint(0, 200)}.") for t in range(200)]
    rows += [(2000, 5, "user", "same.")] * 40 + [(2001, 1, "user", "long word " * 50_000), (-7, None, None, None)]
    return rows


@pytest.mark.parametrize("piece", [4096, 7])
def test_repair_against_single_edits(spark, monkeypatch, piece):
    monkeypatch.setattr(repair, "PIECE", piece)
    rows = some_rows()
    assert found(spark, rows) == brute(rows)


def test_conversation_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(repair, "PIECE", 3)
    monkeypatch.setattr(repair, "FAN_BITS", 1)
    rows = [r for r in some_rows() if r[0] in (None, 1000, 3, 4)]
    adaptive, parts = (spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions"))
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        assert found(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_empty_table_and_dropped_conversation(spark):
    assert repair.audited(repair.damaged(spark.createDataFrame([], DDL))).count() == 0
    turn = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(spark, [(9, turn, "user", "gone.")]) == {9: (0, 0, 0, 0, 0, 0, "", empty)}


def test_repaired_turns_are_returned(spark):
    frame = spark.createDataFrame([(1, 0, "system", "s."), (1, 1, "assistant", "a."), (1, 2, "assistant", "a.")], DDL)
    texts, counts = repair.repair(repair.plain_rows(frame))
    row = texts.collect()[0]
    assert [tuple(t) for t in row["turns"]] == [("system", "s."), ("user", ""), ("assistant", "a.")] and row["audit"] == "KIKD"
    assert counts.collect()[0]["duplicate"] == 1


def test_halving_meets_the_forward_table():
    """Crossings of random items against all ways."""
    draw = random.Random(5)
    for _ in range(200):
        items = [repair.row_item(draw.choice("suax"), draw.randint(0, 3), draw.randint(1, 2)) for _ in range(draw.randint(1, 6))]
        for last in range(4):
            ways = {repair.START: (0, "", [])}
            for item in items:
                new = {}
                for state, (cost, audit, states) in ways.items():
                    for to, more, mark in item[state]:
                        way = (cost + more, audit + mark, [*states, to])
                        new[to] = min(new.get(to, way), way)
                ways = new
            if last in ways:
                assert repair.crossings(items, repair.START, last) == ways[last][2]
