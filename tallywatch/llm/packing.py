"""Packing documents into sequences by cutting-stock column generation.

A document's ids are cut into whole sequences and a rest. The histogram of the rests'
lengths (one row per length below ``size``) goes to ``cutting.solve`` on the driver; its
patterns fill sequences exactly. Rests are ranked within their length, in buckets of
about ``BUCKET`` rows, and a rest's rank gives its pattern, sequence and offset by
arithmetic. What no pattern takes is laid end to end in the order of length and rank and
cut at every ``size``; the end of that row is cut into powers of two. So there is no
padding, and only the pooled documents at a border are cut.

Defined results: a null or empty text is the end id alone; rows that repeat an id are packed
each for itself, and a null ``doc_id`` stays null; an empty table gives an empty result.
Texts of any length are tokenized whole, white-space separated words once for each task;
strings of special tokens in a text are special tokens, as the library has it. Other
columns are ignored, whatever their names. Sequence ids are unique, but not gapless.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.llm import cutting
from tallywatch.session import written

SIZE = 2048
END = 1
#: Rests ranked by one task at a time.
BUCKET = 100_000
#: Distinct words whose ids a task keeps.
WORDS = 800_000
#: Characters tokenized at a time.
CHARS = 2_000_000
#: A word of its own, by which new words are told apart in one call.
MARK = "\x01"
#: ASCII marks that may end a word; after a letter the tokenizer cuts before them. An apostrophe may begin a
#: contraction, and angle brackets and bars a special token.
TAIL = rb"""!"#$%&()*+,-./:;=?@[\]^_`{}~"""


#: Lower-case letters of Latin-1. Normalizers leave them, and a word of them alone is tokenized as one.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


def words_of(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "replace")
    return (raw if b"|>" in raw else raw.lower()).split()  # special tokens are written in lower case


def plain_tokenizer(tokenizer):
    """The same model on words between spaces, and which ids end a word; none where letters are not one word as they stand.

    Normalizing and splitting by pattern are most of the time of a call, and such words don't need them.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    pieces = [text for text, _ in tokenizer.pre_tokenizer.pre_tokenize_str(LETTERS)] if tokenizer.pre_tokenizer else []
    as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    same = tokenizer.normalizer is None or tokenizer.normalizer.normalize_str(LETTERS) == LETTERS
    if not suffix or not same or pieces != [text for text, _ in as_bytes.pre_tokenize_str(LETTERS)]:
        return None, None
    plain = Tokenizer(tokenizer.model)
    plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), as_bytes])
    vocabulary = tokenizer.get_vocab()
    ending = np.zeros(max(vocabulary.values()) + 1, bool)
    ending[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return plain, ending


class Words(dict):
    """Ids of words as unsigned 32-bit numbers; equal to tokenizing the whole text, for tokenizers that drop white space."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        (self.mark,) = tokenizer.encode(MARK, add_special_tokens=False).ids
        self.plain, self.ending = plain_tokenizer(tokenizer)

    def learn(self, words: set[bytes]) -> None:
        if len(self) > WORDS:
            self.clear()
        new = words.difference(self)
        plain = {w for w in new if w.isalpha() and w.islower()}
        whole, ended = set(), []
        for word in new.difference(plain):
            stem = word.rstrip(TAIL)
            if stem and stem != word and 97 <= stem[-1] <= 122:
                ended.append((word, stem, word[len(stem) :]))
                whole.add(stem)
                whole.add(ended[-1][2])
            else:
                whole.add(word)
        whole.difference_update(self)
        plain.update(filter(PLAIN.fullmatch, whole))
        whole.update(plain)
        self.add(list(whole.difference(self.add_plain(list(plain)))))
        for word, stem, tail in ended:
            self[word] = self[stem] + self[tail]

    def add_plain(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of ``LETTERS`` from one call, told apart by the suffix of each word's last token; returns the words added."""
        if not words or self.plain is None:
            return []
        ids = np.array(self.plain.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ending[ids])
        if len(ends) != len(words):
            return []
        raw, stops = ids.tobytes(), (4 * ends + 4).tolist()
        self.update(zip(words, [raw[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)], strict=True))
        return words

    def add(self, words: list[bytes]) -> None:
        """Ids of new words from one call, told apart by the mark between them."""
        if not words:
            return
        ids = np.array(self.tokenizer.encode_batch_fast([f" {MARK} ".encode().join(words).decode()], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(ids == self.mark)
        if len(ends) != len(words) - 1:  # a word holds the mark
            for word in words:
                self[word] = np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, "<u4").tobytes()
            return
        raw = ids.tobytes()
        stops = [*(4 * ends).tolist(), len(raw)]
        self.update(zip(words, [raw[a:b] for a, b in zip([0, *(4 * ends + 4).tolist()], stops, strict=True)], strict=True))

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        split = [words_of(t) for t in texts]
        self.learn(set().union(*split))
        for words in split:
            yield b"".join(itemgetter(*words)(self)) if len(words) > 1 else b"".join(map(self.__getitem__, words))


TOKENS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
TOKENS_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def tokenized(documents: DataFrame, vocabulary: str, size: int) -> DataFrame:
    """Whole sequences and rests: ``row`` and ``TOKENS``; ``ids`` are unsigned 16-bit numbers where the vocabulary allows."""

    def groups(texts: list[str]) -> Iterator[tuple[int, int]]:
        first, held = 0, 0
        for i, text in enumerate(texts):
            held += len(text)
            if held > CHARS:
                yield first, i + 1
                first, held = i + 1, 0
        if first < len(texts):
            yield first, len(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        small = tokenizer.get_vocab_size() <= 1 << 16
        known, end = Words(tokenizer), np.array([END], "<u4").tobytes()
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for first, last in groups(texts):
                out = []
                for doc_id, raw in zip(doc_ids[first:last], known.ids(texts[first:last]), strict=True):
                    raw += end
                    n = len(raw) // 4
                    stored = np.frombuffer(raw, "<u4").astype("<u2").tobytes() if small else raw
                    wide = 2 if small else 4
                    for start in range(0, n, size):
                        stop = min(start + size, n)
                        out.append((doc_id, start, stop - start, zlib.crc32(raw[4 * start : 4 * stop]), n, stored[wide * start : wide * stop]))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, TOKENS, strict=True)], schema=TOKENS)

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(texts.mapInArrow(run, TOKENS_DDL).withColumn("row", F.monotonically_increasing_id()), "pack-tokens")


def ranked(rests: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``rank`` of each rest among those of its length, from 0."""
    spark = rests.sparkSession
    parts = [(n, c // BUCKET + 1) for n, c in counts.items()]  # one row per length
    dealt = rests.join(F.broadcast(spark.createDataFrame(parts, "length long, parts long")), "length")
    dealt = written(dealt.withColumn("bucket", F.pmod(F.xxhash64("row"), F.col("parts"))).drop("parts"), "pack-dealt")
    own = dealt.withColumn("nth", F.row_number().over(Window.partitionBy("length", "bucket").orderBy(F.col("doc_id").asc_nulls_last(), "row")) - 1)
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    offsets = sizes.withColumn("offset", F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).drop("n")
    return own.join(offsets, ["length", "bucket"]).withColumn("rank", F.col("nth") + F.col("offset")).drop("bucket", "nth", "offset")


class Plan:
    """Where the rest of a length and rank goes; its size depends on the sequence length alone."""

    def __init__(self, counts: dict[int, int], size: int) -> None:
        self.size = size
        patterns, pooled = cutting.solve(counts, size)
        by_length: dict[int, list[tuple]] = {n: [] for n in counts}
        taken = dict.fromkeys(counts, 0)
        sequence = 0
        for column, times in patterns:
            offset = 0
            for n, a in sorted(column.items(), reverse=True):
                by_length[n].append((taken[n], a, sequence, offset))
                taken[n] += a * times
                offset += n * a
            sequence += times
        at = 0
        for n in sorted(pooled):
            by_length[n].append((taken[n], 0, at, 0))
            at += n * pooled[n]
        rows = [(n, *slot) for n in sorted(by_length) for slot in by_length[n]]
        self.length, self.base, self.items, self.first, self.offset = np.array(rows, np.int64).reshape(-1, 5).T
        self.key = self.length << 44 | self.base
        self.pool, self.pool_tokens = sequence, at
        self.borders, end = [at // size * size], at // size * size
        for bit in reversed(range(size.bit_length())):
            if (at - at // size * size) >> bit & 1:
                end += 1 << bit
                self.borders.append(end)
        #: The first id after those of patterns and pool.
        self.after = sequence + at // size + len(self.borders) - 1

    def slots(self, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.key, length.astype(np.int64) << 44 | rank, side="right") - 1

    def pieces(self, position: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """Start, length, sequence and offset of the pieces of a pooled rest."""
        start = 0
        while start < length:
            at = position + start
            if at < self.borders[0]:
                sequence, low, high = at // self.size, at // self.size * self.size, (at // self.size + 1) * self.size
            else:
                nth = next(i for i, border in enumerate(self.borders[1:]) if at < border)
                sequence, low, high = self.borders[0] // self.size + nth, self.borders[nth], self.borders[nth + 1]
            stop = min(length, start + high - at)
            yield start, stop - start, self.pool + sequence, at - low
            start = stop


PIECE = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("skip", pa.int64())])
PIECE_DDL = "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, skip long"


def placed(rests: DataFrame, plan: Plan) -> DataFrame:
    """Pieces of ranked rests; ``ids_crc32`` is null where a rest is cut, ``skip`` counts its ids before the piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            out = []
            for values in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank")), plan.slots(length, rank).tolist(), strict=True):
                row, doc_id, start, n, crc, tokens, nth, slot = values
                items, first = int(plan.items[slot]), int(plan.first[slot])
                nth -= int(plan.base[slot])
                if items:
                    out.append((row, doc_id, start, n, crc, tokens, first + nth // items, int(plan.offset[slot]) + nth % items * n, 0))
                    continue
                found = list(plan.pieces(first + nth * n, n))
                out += [(row, doc_id, start + skip, size, crc if len(found) == 1 else None, tokens, sequence, at, skip) for skip, size, sequence, at in found]
            columns = list(zip(*out, strict=True)) or [()] * len(PIECE)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECE, strict=True)], schema=PIECE)

    return rests.select("row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(run, PIECE_DDL)


def with_crc(cut: DataFrame, tokens: DataFrame) -> DataFrame:
    """Checksums of the pieces of cut rests, from their stored ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for raw, rest, skip, length in zip(*(batch.column(c).to_pylist() for c in ("ids", "rest", "skip", "length")), strict=True):
                wide = len(raw) // rest
                ids = np.frombuffer(raw, f"<u{wide}")[skip : skip + length].astype("<u4")
                sums.append(zlib.crc32(ids.tobytes()))
            batch = batch.select(PIECE.names)
            yield batch.set_column(PIECE.get_field_index("ids_crc32"), "ids_crc32", pa.array(sums, pa.int64()))

    stored = tokens.select("row", F.col("length").alias("rest"), "ids")
    return cut.join(stored, "row").select(*PIECE.names, "ids", "rest").mapInArrow(run, PIECE_DDL)


def packed(documents: DataFrame, vocabulary: str, size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """Pieces with their place (``PIECE``), and the stored tokens by ``row`` from which ``sequences`` reads."""
    tokens = tokenized(documents, vocabulary, size)
    whole, rests = tokens.filter(F.col("length") == size), tokens.filter(F.col("length") < size)
    counts = {r["length"]: r["count"] for r in rests.groupBy("length").count().collect()}  # fewer rows than size
    plan = Plan(counts, size)
    pieces = written(placed(ranked(rests.drop("ids"), counts), plan), "pack-pieces")
    settled = pieces.filter("ids_crc32 is not null")
    cut = written(pieces.filter("ids_crc32 is null"), "pack-cut")  # few: with its size known, a join that leaves the ids in place
    full = whole.select("row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("row") + plan.after).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(0).cast("long").alias("skip"))
    return full.unionByName(settled).unionByName(with_crc(cut, tokens)), tokens


def sequences(pieces: DataFrame, tokens: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of every sequence; no sequence has more than ``SIZE`` ids."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("offset", "skip", "length", "rest", "ids")), strict=True))
        ids = [np.frombuffer(raw, f"<u{len(raw) // rest}")[skip : skip + n].astype(np.int64) for _, skip, n, rest, raw in rows]
        return pa.table({"sequence_id": table.column("sequence_id").slice(0, 1), "ids": pa.array([np.concatenate(ids).tolist()], pa.list_(pa.int64()))})

    stored = tokens.select("row", F.col("length").alias("rest"), "ids")
    parts = pieces.select("row", "sequence_id", "offset", "skip", "length").join(stored, "row")
    return parts.groupBy("sequence_id").applyInArrow(run, "sequence_id long, ids array<long>")
