"""The prefix trie against a walk over all prefixes, and list ranking in each of its forms."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tallywatch.llm import tour, trie

DDL = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        whole = tuple(own.get(conv - conv % 5, [])[:h] + turns[h:])
        for depth in range(len(whole) + 1):
            members[whole[:depth]].append(conv)
        ends[whole].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    for node, convs in members.items():
        leaves, saved, stack = 0, 0, [node]
        while stack:
            at = stack.pop()
            leaves += not children[at]
            saved += (len(members[at]) - 1) * len(at[-1][1].encode()) if at else 0
            stack += children[at]
        said = ",".join(map(str, sorted(ends[node])))
        above = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), above, len(convs), len(children[node]), leaves, saved, hashlib.sha256(said.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows):
    frame = spark.createDataFrame([(*r, b"x", 1) for r in rows], f"{DDL}, node binary, part int")
    return sorted((tuple(r) for r in trie.prefix_trie(frame).select(*COLUMNS).collect()), key=str)


def some_rows():
    draw = random.Random(11)
    rows = [(c, draw.choice([None, *range(6)]), draw.choice(["user", "assistant", None]), draw.choice(["a", "bé", "", None, "longer text"])) for c in range(150) for _ in range(draw.randint(1, 9))]
    rows += [(500 + c, t, "user", f"same {t}") for c in range(0, 40) for t in range(5)]
    rows += [(900, t, "user", "x") for t in range(60)] + [(901, 0, "user", "one")] + [(902, 3, "u", "w " * 40_000)]
    rows += [(903, 1, "user", "again")] * 30 + [(None, 1, "user", "no conversation")]
    return rows


def test_trie_against_all_prefixes(spark):
    rows = some_rows()
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


@pytest.mark.parametrize("task", [50, 3])
def test_trie_over_many_partitions(spark, monkeypatch, task):
    """Conversations, siblings, ids and runs that cross partition borders."""
    monkeypatch.setattr(tour, "TASK", task)
    monkeypatch.setattr(tour, "LAST", task)
    monkeypatch.setattr(trie, "IDS", 4)
    rows = [r for r in some_rows() if r[0] is not None and (r[0] >= 900 or r[0] % 7 < 2)][:260]
    adaptive, parts = (spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions"))
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "9")
        assert found(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", parts)


@pytest.mark.parametrize("scattered", [False, True])
def test_sums_before(spark, monkeypatch, scattered):
    monkeypatch.setattr(tour, "TASK", 60)
    monkeypatch.setattr(tour, "LAST", 60)
    draw = random.Random(2)
    places = list(range(400))
    if scattered:
        draw.shuffle(places)
    ids = [f"e{i}".encode() for i in range(400)]
    rows = [(ids[i], ids[i + 1] if i < 399 else None, [1, draw.randint(0, 9)], places[i], 0) for i in range(400)]
    got = {bytes(r["id"]): r["before"] for r in tour.sums_before(spark.createDataFrame(draw.sample(rows, 400), "id binary, next binary, sums array<long>, place long, spot long")).collect()}
    total = 0
    for i, row in enumerate(rows):
        assert got[ids[i]] == [i, total]
        total += row[2][1]
    empty = spark.createDataFrame([], "id binary, next binary, sums array<long>, place long, spot long")
    assert tour.sums_before(empty).count() == 0
