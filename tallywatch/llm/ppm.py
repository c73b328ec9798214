"""LM scoring by prediction by partial matching over a byte-context trie.

A text is coded word by word; a word as its bytes and a word end, each predicted
from up to ``ORDER`` bytes before it in the word (the start of a word is a context of
its own), and the text's end as a symbol at the start of a word. Escapes follow
method C: a context that saw ``d`` different symbols in ``n`` has the share
``d / (n + d)`` for all others. Symbols of a longer context are excluded in the shorter
ones, and what no context knows is uniform over the rest of the alphabet.

Longer, deterministic contexts are kept for whole lines: where a line of the training
texts occurs again, it may be coded as one symbol in proportion to its count, and the
shorter of the two codes is taken. A training document's own line does not count.

Since other contexts stay within words, a word's code length depends on the word alone.
The trie is counted over the distinct words of the training texts, weighted by their
counts, and each distinct word is coded once. Its tables are Spark tables that are
joined by context; blocks of documents ask for the words they hold, blocks of words
for the strings of ``ORDER + 1`` bytes they hold, so no table is broadcast and no
text is spread over more rows than it has different words.

Defined results: a null text is empty and consists of the end alone; a null id is
never held out (its remainder is taken as 0); repeated rows count each; without
training rows counts are 0 and every symbol is uniform; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.session import written

ORDER = 5
FOLDS, HELD_OUT = 5, 1
BLOCK_CHARS = 32_000_000
WORD_BLOCK = 100_000
SPACE, END = b" ", b"\n"
#: Bytes that are not white space, the word end and the text's end.
ALPHABET = 256 - 6 + 2
#: Lines of at least so many words are symbols of their own; their keys start with a byte that no word holds.
LINE_WORDS = 4
LINE = b"\n\n"


def lines_of(text: str | None) -> list[list[bytes]]:
    return [words for line in (text or "").encode().lower().split(b"\n") if (words := line.split())]


def line_key(words: list[bytes]) -> bytes:
    return LINE + hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def symbols_of(text: str | None) -> list[bytes]:
    """Words, keys of the lines that are symbols, and the end."""
    lines = lines_of(text)
    return [*(w for words in lines for w in words), *(line_key(words) for words in lines if len(words) >= LINE_WORDS), END]


def strings(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each symbol of each word the integer of its context and itself, and the word's place.

    Integers are big-endian, so the string without its first byte is the lower bytes.
    """
    ends = [w if w == END else w + SPACE for w in words]
    flat = np.frombuffer(SPACE * ORDER + (SPACE * ORDER).join(ends), np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, ends), np.int64, len(ends))
    value = np.zeros(max(len(flat) - ORDER, 0), np.int64)
    for k in range(ORDER + 1):
        value = value << 8 | flat[k : k + len(value)]
    starts = np.cumsum(lengths + ORDER) - lengths - ORDER
    places = np.repeat(np.arange(len(words)), lengths)
    within = np.arange(len(places)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return value[starts[places] + within], places


def blocks(documents: DataFrame) -> DataFrame:
    """``block, doc_id, train, text``: documents dealt by hash to blocks of about ``BLOCK_CHARS`` characters."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    count = max(1, (documents.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARS)
    return documents.select(
        F.pmod(F.xxhash64("doc_id", F.crc32(F.coalesce("text", F.lit("")))), F.lit(count)).cast("int").alias("block"),
        "doc_id",
        (~held_out).alias("train"),
        "text",
    )


def block_words(docs: DataFrame) -> DataFrame:
    """``block, place, word, n``: the different symbols of each block in order, and their training count."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, trained = set(), Counter()
        for batch in batches:
            for text, train in zip(batch.column("text").to_pylist(), batch.column("train").to_pylist(), strict=True):
                symbols = symbols_of(text)
                seen.update(symbols)
                if train:
                    trained.update(symbols)
        words = sorted(seen)
        for at in range(0, len(words), WORD_BLOCK):
            part = words[at : at + WORD_BLOCK]
            columns = [[key[0].as_py()] * len(part), range(at, at + len(part)), part, [trained[w] for w in part]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    schema = pa.schema([("block", pa.int32()), ("place", pa.int32()), ("word", pa.binary()), ("n", pa.int64())])
    return docs.groupBy("block").applyInArrow(run, "block int, place int, word binary, n long")


def trie(words: DataFrame) -> list[DataFrame]:
    """Tables ``string, n`` by order, from 0 to ``ORDER``; a string is a context and the symbol after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, places = strings(batch.column("word").to_pylist())
            keys, at = np.unique(values, return_inverse=True)
            n = np.bincount(at, batch.column("n").to_numpy()[places], len(keys)).astype(np.int64) if len(keys) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["string", "n"])

    longest = words.filter("n > 0").select("word", "n").mapInArrow(run, "string long, n long")
    tables = [written(longest.groupBy("string").agg(F.sum("n").alias("n")), "ppm-trie")]
    for order in range(ORDER - 1, -1, -1):
        shorter = tables[-1].groupBy(F.col("string").bitwiseAND((1 << 8 * (order + 1)) - 1).alias("string")).agg(F.sum("n").alias("n"))
        tables.append(written(shorter, "ppm-trie"))
    return tables[::-1]


def contexts(tables: list[DataFrame], order: int) -> DataFrame:
    """``context, total, kinds`` of one order, and ``known``: how often its symbols follow the next shorter context."""
    own = tables[order].withColumn("context", F.shiftright("string", 8))
    if order:
        shorter = tables[order - 1].select(F.col("string").alias("end"), F.col("n").alias("shorter"))
        own = own.withColumn("end", F.col("string").bitwiseAND((1 << 8 * order) - 1)).join(shorter, "end")
    else:
        own = own.withColumn("shorter", F.lit(0))
    return own.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("shorter").alias("known"))


def string_lengths(asked: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """``string, log10p`` of every asked string: escapes from the longest context down to one that knows the symbol."""
    rows = asked.select("string", F.lit(0.0).alias("log10p"), F.lit(False).alias("done"), F.lit(0).alias("kinds_above"), F.lit(0).cast("long").alias("known_above"))
    for order in range(ORDER, -1, -1):
        end = F.col("string").bitwiseAND((1 << 8 * (order + 1)) - 1)
        known = tables[order].select(F.col("string").alias("end"), "n")
        table = contexts(tables, order)
        joined = rows.withColumn("end", end).withColumn("context", F.shiftright("end", 8)).join(table, "context", "left").join(known, "end", "left")
        # What the longer context knows is excluded here.
        mass, kinds = F.col("total") - F.col("known_above"), F.col("kinds") - F.col("kinds_above")
        reached = ~F.col("done") & F.col("total").isNotNull() & (kinds > 0)
        here = F.coalesce(F.col("n"), F.lit(0)) > 0
        step = F.when(reached, F.log10(F.when(here, F.col("n")).otherwise(kinds) / (mass + kinds))).otherwise(0.0)
        rows = joined.select(
            "string",
            (F.col("log10p") + step).alias("log10p"),
            (F.col("done") | reached & here).alias("done"),
            F.coalesce("kinds", "kinds_above").alias("kinds_above"),
            F.coalesce("known", F.lit(0)).alias("known_above"),
        )
    rest = F.when(F.col("done"), 0.0).otherwise(-F.log10(F.lit(ALPHABET) - F.col("kinds_above")))
    return rows.select("string", (F.col("log10p") + rest).alias("log10p"))


def word_lengths(words: DataFrame) -> DataFrame:
    """``word, n, log10p`` of every word; blocks of words look up each of their strings once."""
    tables = trie(words)
    count = max(1, words.count() // WORD_BLOCK)
    dealt = written(words.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(count)).cast("int")), "ppm-words")

    def needed(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = np.unique(np.concatenate([strings(b.column("word").to_pylist())[0] for b in batches]))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), key[0].as_py()), pa.int32()), pa.array(keys)], ["part", "string"])

    asked = written(dealt.groupBy("part").applyInArrow(needed, "part int, string long"), "ppm-strings")
    known = written(string_lengths(asked.select("string").distinct(), tables), "ppm-strings-coded")

    def run(key: tuple, held: pa.Table, table: pa.Table) -> pa.Table:
        values, places = strings(held["word"].to_pylist())
        order = np.argsort(table["string"].to_numpy())
        lengths = table["log10p"].to_numpy()[order]
        found = lengths[np.searchsorted(table["string"].to_numpy()[order], values)]
        coded = np.bincount(places, found, held.num_rows)
        return pa.table({"word": held["word"], "n": held["n"], "log10p": pa.array(coded)})

    joined = asked.join(known, "string").groupBy("part")
    return dealt.groupBy("part").cogroup(joined).applyInArrow(run, "word binary, n long, log10p double")


def scores(documents: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every document."""
    docs = blocks(documents)
    held = written(block_words(docs), "ppm-block-words")
    counts = written(held.groupBy("word").agg(F.sum("n").alias("n")), "ppm-counts")
    line = F.substring("word", 1, len(LINE)) == F.lit(LINE)
    lines = counts.filter(line)
    coded = written(word_lengths(counts.filter(~line)).unionByName(lines.withColumn("log10p", F.lit(0.0))), "ppm-coded")
    total, distinct = coded.filter(~line).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    all_lines, again = lines.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))).first()
    # How often a whole line comes instead of a word.
    share = (again + 0.5) / (again + total + 1)
    asked = held.select("block", "place", "word").join(coded, "word").select("block", "place", "n", "log10p")
    kind = dict(documents.dtypes)["doc_id"]

    def run(key: tuple, texts: pa.Table, words: pa.Table) -> pa.Table:
        place = words["place"].to_numpy()
        counts, lengths = np.zeros(len(place), np.int64), np.zeros(len(place))
        counts[place], lengths[place] = words["n"].to_numpy(), words["log10p"].to_numpy()
        base = np.log10((counts + 0.5) / (total + 0.5 * (distinct + 1)))
        at = {w: k for k, w in enumerate(sorted({s for t in texts["text"] for s in symbols_of(t.as_py())}))}
        spelled = lengths + np.log10(1 - share)
        out = []
        for text, train in zip(texts["text"], texts["train"].to_pylist(), strict=True):
            n, known, base_score, score = 1, int(counts[at[END]] > 0), float(base[at[END]]), float(spelled[at[END]])
            for own in lines_of(text.as_py()):
                places = np.fromiter(map(at.__getitem__, own), np.int64, len(own))
                n, known, base_score = n + len(own), known + int((counts[places] > 0).sum()), base_score + float(base[places].sum())
                code = float(spelled[places].sum())
                if len(own) >= LINE_WORDS and (others := int(counts[at[line_key(own)]]) - train) > 0:
                    code = max(code, float(np.log10(share * others / all_lines)))
                score += code
            out.append((n, known, base_score, score))
        columns = list(zip(*out, strict=True))
        names = ["n_tokens", "n_known", "base_score", "score"]
        return pa.table({"doc_id": texts["doc_id"], "held_out": pa.array([not t for t in texts["train"].to_pylist()])} | dict(zip(names, map(pa.array, columns), strict=True)))

    scored = docs.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.withColumn("train_tokens", F.lit(total).cast("long"))
