"""The schedule of the mix: balance of its prefixes, and what it gives each document."""

import math

import pytest

from tallywatch.llm import mixing


def plain(rows):
    """First slots by plain Python: shuffled streams cut into blocks, golden-ratio points mapped through the shares."""
    import hashlib

    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    size = {i: len((t or "").split()) for i, t, _ in rows}
    whole = {s: sum(size[i] for i, _, x in rows if x == s) for s in names}
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    left, free, target = mixing.SHARE * sum(whole.values()), list(names), {}
    while True:
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) >= 2 * whole[s]]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * whole[s]
        left, free = left - sum(target[s] for s in over), [s for s in free if s not in over]
    target |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    quota = {s: math.floor(target[s] + 0.5) for s in names}
    slots = -(-sum(quota.values()) // mixing.BLOCK_TOKENS)
    at, high = 0.0, {}
    for s in names:
        at += target[s]
        high[s] = at / sum(target.values())
    owners = [next(s for s in names if (k + 1) * mixing.GOLDEN % 1 < high[s]) for k in range(slots)]
    own = {s: [k for k, x in enumerate(owners) if x == s] for s in names}
    found = {}
    for s in names:
        begin = 0
        for i in sorted((i for i, _, x in rows if x == s), key=lambda i: hashlib.md5(str(i).encode()).hexdigest()):
            block = begin // mixing.BLOCK_TOKENS
            taken = size[i] and begin < quota[s]
            found[i] = (own[s][block] if block < len(own[s]) else slots) if taken else -1
            begin += size[i]
    return found, owners, {s: target[s] / sum(target.values()) for s in names}


@pytest.fixture()
def rows():
    sources = ["a", "b", "b", "c", "c", "c", None]
    return [(i, "w " * (i * 37 % 900), sources[i % 7]) for i in range(400)] + [(900, None, "a"), (901, "", None), (902, "w", "tiny")]


def test_first_slots_against_plain_python(docs, rows):
    got = {r["doc_id"]: r for r in mixing.mix(docs(rows)).collect()}
    expected, _, _ = plain(rows)
    assert {i: r["first_slot"] for i, r in got.items()} == expected
    assert all((r["first_slot"] < 0) == (r["taken"] == 0) for r in got.values())


def test_prefixes_of_the_mix_are_balanced(docs, rows):
    _, owners, share = plain(rows)
    sized = docs(rows).select("source", mixing.word_count(mixing.F.col("text")).alias("size")).groupBy("source").agg(mixing.F.sum("size").alias("source_size"))
    targets = mixing.source_targets(sized).cache()
    names = {r["sid"]: r["source"] for r in targets.collect()}
    scheduled = [(r["slot"], names[r["sid"]]) for r in mixing.schedule(targets, len(owners)).filter(f"slot < {len(owners)}").collect()]
    assert scheduled and all(owners[k] == s for k, s in scheduled)
    met = dict.fromkeys(share, 0)
    for n, s in enumerate(owners, 1):
        met[s] += 1
        assert all(abs(met[x] - n * share[x]) <= 3 for x in share)


def test_tables_without_words_have_no_slots(docs):
    assert [r["first_slot"] for r in mixing.mix(docs([(1, None, "a"), (2, "", None)])).collect()] == [-1, -1]
    assert mixing.mix(docs([(1, "x", "a")]).limit(0)).count() == 0
