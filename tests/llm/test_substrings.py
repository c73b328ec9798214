"""Substring dedup against a table of all windows."""

import random

import numpy as np
import pytest

from tallywatch.llm import substrings


def brute(rows, size):
    """What is left of each row, from all windows in rank order."""
    first, out = {}, {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    keys = {}
    for i in order:
        text = rows[i][1] or ""
        keys.setdefault(text, i)
        words = text.encode().lower().split()
        for p in range(len(words) - size + 1):
            first.setdefault(tuple(words[p : p + size]), (keys[text] if keys[text] == i else i, p))
    for i in order:
        text = rows[i][1]
        words = (text or "").encode().lower().split()
        gone = set()
        for p in range(len(words) - size + 1):
            at, place = first[tuple(words[p : p + size])]
            if at != i or p >= place + size:
                gone.update(range(p, p + size))
        starts = [m.start() for m in substrings.WORD.finditer(text or "")]
        left = (text or "")[: starts[0]] if starts else text or ""
        for n, start in enumerate(starts):
            if n not in gone:
                left += text[start : starts[n + 1] if n + 1 < len(starts) else len(text)]
        out[i] = text if text is None else left
    return [out[i] for i in range(len(rows))]


def running(draw, n):
    """Prose in running text, with few or many sentence ends."""
    ends = draw.choice(["", "", ".", "\n", ". \n"])
    return " ".join(f"{draw.choice('abcdefgh')}{draw.randint(0, 400)}" + (ends if draw.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="module")
def planted():
    draw = random.Random(12)
    passages = {n: running(draw, n) for n in (49, 50, 51, 55, 60, 65, 70, 90, 300)}
    rows = []
    for n, passage in passages.items():
        rows += [(len(rows) + k, f"{running(draw, draw.randint(0, 80))} {passage} {running(draw, draw.randint(0, 80))}") for k in range(4)]
        rows += [(500 + n, passage), (600 + n, f"{passage} {running(draw, 30)}"), (700 + n, f"{running(draw, 30)}\n{passage.upper()}")]
    rows += [(9000, "same word " * 300), (9001, "Ten words are in this line of the song, yes.\n" * 20), (9002, running(draw, 3000)), (9003, None), (9004, ""), (None, rows[0][1] + " more"), (9005, "x " * 50_000)]
    rows += [(9050 + i, rows[3][1]) for i in range(30)] + [(9100, "short copy"), (9101, "short copy")]
    return rows


def test_all_repeated_windows_go_and_nothing_else(spark, planted):
    frame = spark.createDataFrame([(*r, "k", 1, [2]) for r in planted], "doc_id long, text string, key string, rows int, places array<int>")
    got = substrings.cleaned(frame)
    assert got.columns == frame.columns
    ids = [i for i, _ in planted]
    want = dict(zip(ids, brute(planted, 50), strict=True))
    found = {r["doc_id"]: r for r in got.collect()}
    assert {i: r["text"] for i, r in found.items()} == want
    assert all(tuple(r)[2:] == ("k", 1, [2]) for r in found.values())
    for r in substrings.repeats(frame).collect():
        text = dict(planted)[r["doc_id"]]
        pieces, at = [], 0
        for begin, end in r["spans"]:
            pieces.append(text[at:begin])
            at = end
        assert text is None or "".join([*pieces, text[at:]]) == r["text"]
        assert r["n_removed"] == sum(end - begin for begin, end in r["spans"])


def test_rows_that_repeat_id_and_text(spark):
    long = " ".join(f"w{i}" for i in range(60))
    frame = spark.createDataFrame([(3, long), (3, long), (None, long), (4, "few words"), (4, "few words")], "doc_id long, text string")
    assert sorted(r["text"] for r in substrings.repeats(frame).collect()) == ["", "", "few words", "few words", long]
    assert substrings.repeats(frame.limit(0)).count() == 0


def test_digests_and_anchors():
    draw = np.random.default_rng(4)
    words = draw.integers(0, 2**63, 400).astype(np.uint64)
    both = np.concatenate([words, draw.integers(0, 2**63, 37).astype(np.uint64), words])
    runs = substrings.run_digests(both, 12)
    assert (runs[:389] == runs[437 : 437 + 389]).all() and len({tuple(r) for r in runs.tolist()}) == len(runs) - 389
    named = substrings.anchors(runs, len(both) - 49, 39)
    assert all(p <= a <= p + 38 and runs[a, 0] * np.uint64(0x94D049BB133111EB) == min(runs[p : p + 39, 0] * np.uint64(0x94D049BB133111EB)) for p, a in enumerate(named.tolist()))
