"""Packing: every id in one piece, sequences without gaps or padding, and the column generation by itself."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallywatch.llm import cutting, packing

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
DDL = "doc_id long, text string, row string, ids int, length string"


def checked(spark, rows, size):
    pieces, tokens = packing.packed(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DDL), VOCABULARY, size)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = Counter((i, *tokenizer.encode(t or "", add_special_tokens=False).ids, 1) for i, t in rows)
    pieces = pieces.collect()
    filled = defaultdict(list)
    for p in pieces:
        filled[p["sequence_id"]].append((p["offset"], p["length"]))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at == size or at < size and at & (at - 1) == 0
    assert sum(p["length"] for p in pieces) == sum(len(k) - 1 for k in want.elements())
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]))
    for (doc_id, *ids), n in want.items():
        if sum(k[0] == doc_id for k in want) == 1 and n == 1:
            at = 0
            for start, length, crc, total in sorted(by_doc[doc_id]):
                assert (start, total) == (at, len(ids))
                assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
                at += length
            assert at == len(ids)
    return pieces, tokens


def some_rows():
    draw = random.Random(4)
    words = ["one", "Two", "three,", "vier.", "cinq!?", "été", "it's", "I'LL", "x́y", "ΑΣ", "İ", "\x01", "a\x01b", "<|endoftext|>", "<|ENDOFTEXT|>", "日本語", "end.\n", "a\xa0b", "\x1c", "1234", "x\u0301.", "\u2026.", "ab...", "caf\u00e9,", "he's,", "don''", "a<|", "1.", "--b", "\u65e5.", "\u03a3.", "end's!", "q<|endoftext|>.", "\u01c5;", "x\u0338="]
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(0, 90)))) for i in range(300)]
    return rows + [(1000, None), (1001, ""), (None, "no id here"), (1002, "long text. " * 4000), (1003, "twice"), (1003, "twice")] + [(2000 + i, "same length") for i in range(70)]


@pytest.mark.parametrize("size", [64, 2048])
def test_packing_holds_every_id_once(spark, monkeypatch, size):
    monkeypatch.setattr(packing, "BUCKET", 20)
    monkeypatch.setattr(packing, "WORDS", 30)
    pieces, tokens = checked(spark, some_rows(), size)
    if size == 64:
        told = {r["sequence_id"]: r["ids"] for r in packing.sequences(spark.createDataFrame(pieces), tokens).collect()}
        assert set(told) == {p["sequence_id"] for p in pieces}
        for p in pieces:
            ids = told[p["sequence_id"]][p["offset"] : p["offset"] + p["length"]]
            assert zlib.crc32(np.array(ids, "<u4").tobytes()) == p["ids_crc32"]


def test_packing_of_nothing_and_of_one(spark):
    assert packing.packed(spark.createDataFrame([], DDL), VOCABULARY)[0].count() == 0
    checked(spark, [(1, None)], 2048)


def test_patterns_carry_the_packing(spark):
    """Without its patterns the packing would cut a document at nearly every border."""
    rows = [(i, "w " * (24 + i % 16)) for i in range(400)]
    pieces, _ = checked(spark, rows, 64)
    assert len(pieces) - len(rows) < 0.1 * sum(p["length"] for p in pieces) / 64


def test_columns_against_all_fillings():
    """The priced filling is the best of all, and the program reaches a perfect packing that exists."""
    draw = np.random.default_rng(3)
    for _ in range(30):
        lengths = np.sort(draw.choice(np.arange(1, 20), 5, replace=False))[::-1].copy()
        values = draw.random(5)
        best, _ = cutting.fillings(lengths, values, 20)
        reach = {0: 0.0}
        for room in range(1, 21):
            options = [reach[room - n] + v for n, v in zip(lengths.tolist(), values) if reach.get(room - n) is not None]
            reach[room] = max(options) if options else None
            assert best[room] == pytest.approx(reach[room]) if options else best[room] == -np.inf
    patterns, left = cutting.solve({40: 100, 24: 100, 30: 50, 34: 50}, 64)
    assert not left and sum(times for _, times in patterns) == 150
    for column, times in patterns:
        assert sum(n * a for n, a in column.items()) == 64 and times > 0
    # Enough short lengths to fill up every long one.
    counts = {n: int(draw.integers(20, 50)) * (3 if n <= 32 else 1) for n in range(1, 64)}
    patterns, left = cutting.solve(counts, 64)
    used = Counter()
    for column, times in patterns:
        used.update({n: a * times for n, a in column.items()})
    assert all(used[n] + left.get(n, 0) == c for n, c in counts.items())
    assert sum(n * c for n, c in left.items()) < 0.1 * sum(n * c for n, c in counts.items())


def test_plain_words_do_without_normalizer(monkeypatch):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    known, slow = packing.Words(tokenizer), []
    add = known.add
    monkeypatch.setattr(known, "add", lambda words: (slow.extend(words), add(words)))
    draw = random.Random(5)
    letters = ["".join(draw.choices(packing.LETTERS, k=draw.randint(1, 12))) for _ in range(2000)]
    texts = [" ".join([*letters, "Word,", "it's", "x\u0301y", "a1", "\u65e5", "<|endoftext|>", "<|x|> UPPER"]), *letters, "", "one"]
    assert [list(np.frombuffer(raw, "<u4")) for raw in known.ids(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert slow and not any(packing.PLAIN.fullmatch(w) for w in slow)
