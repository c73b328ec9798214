"""Toxicity by class-conditional Kneser-Ney models.

For each class, toxic and ordinary, an interpolated Kneser-Ney model of words: the
number of different words that a word follows, backed off to the same number for its
first six and first four bytes, so inflected forms help each other, and last to
counts shared by both classes. The shares left to the backoff are shared as well: an
expression that is rare in both classes tells neither from the other. Discounts grow
with the square root of a count, its standard error. Copies of a text add nothing, as
they repeat the same neighbours; a higher order was tried and told the classes apart
less well (figures in the README).

A toxic text is ordinary text with a share ``TOXIC_SHARE`` of toxic expressions, so
its likelihood is that mixture's. A text's score is the difference of the two
log-likelihoods a word, mapped to 0..1 by a logistic curve fitted on labelled
documents that the counts do not include.

The models are fitted on at most ``CLASS_DOCS`` labelled documents of each class, as
many of one as of the other, and the curve on at most ``CURVE_DOCS``; both are bounded samples by hash, so the tables
that go to the executors are bounded. Rows of the held-out fold are used for neither.

Defined results: a null or empty text gets the curve's value at 0; a null id is not
held out; labels with null or contradicting values are left out; without labels of
both classes every score is 0.5 less a hair and nothing is predicted. Every row of
the input gives one row, repeats included; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.quality import clear_labels
from tallywatch.session import written

FOLDS, HELD_OUT = 5, 0
CLASS_DOCS = 4000
CURVE_DOCS = 4000
DISCOUNT = 1.0
TOXIC_SHARE = 0.001
STEMS = (6, 4)
LEVELS = {"stem4": "stem4", "stem6": "stem6", "word": "words"}
CACHED_WORDS = 1 << 19
NOT_WORD = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))
START = 1


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters and digits."""
    return (text or "").encode().lower().translate(NOT_WORD).split()


def stem_id(word: bytes, length: int) -> int:
    return zlib.crc32(word[:length], length)


def bigrams(ids: np.ndarray) -> np.ndarray:
    before = np.concatenate([np.array([START], np.uint64), ids[:-1]])
    return before << np.uint64(32) | ids


#: ``words``, ``stem6`` and ``stem4`` (sorted ids), each with ``..._odds`` (2, ids: probability by class).
Model = dict[str, np.ndarray]


def found(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys in a sorted, non-empty array, and which are there."""
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


class WordRatios(dict):
    """Log-likelihood ratio of each word met so far."""

    def __init__(self, model: Model):
        self.model = model

    def meet(self, words: list[bytes]) -> None:
        new = [w for w in dict.fromkeys(words) if w not in self]
        keys = {"words": np.fromiter(map(zlib.crc32, new), np.uint64, len(new))}
        keys |= {f"stem{n}": np.array([stem_id(w, n) for w in new], np.uint64) for n in STEMS}
        # What is unknown at a level has the same share of the next level in both classes.
        odds = np.ones((2, len(new)))
        for name in LEVELS.values():
            at, known = found(self.model[name], keys[name])
            odds = np.where(known, self.model[f"{name}_odds"][:, at], odds)
        self.update(zip(new, np.log(1 - TOXIC_SHARE + TOXIC_SHARE * odds[1] / odds[0]).tolist(), strict=True))

    def ratio(self, text: str | None) -> float:
        """Log-likelihood ratio a word; 0 for a text without words."""
        words, total = words_of(text), 0.0
        for at in range(0, len(words), CACHED_WORDS // 4):
            piece = words[at : at + CACHED_WORDS // 4]
            if len(self) > CACHED_WORDS // 2:
                self.clear()
            self.meet(piece)
            total += sum(map(self.__getitem__, piece))
        return total / max(len(words), 1)


def pair_counts(sample: DataFrame) -> DataFrame:
    """``pair, label, n`` over the sample's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label in (0, 1):
                pairs = zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True)
                parts = [bigrams(np.fromiter(map(zlib.crc32, w), np.uint64, len(w))) for t, y in pairs if y == label and (w := words_of(t))]
                if parts:
                    keys, n = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), label)), pa.array(n)], ["pair", "label", "n"])

    return sample.select("text", F.col("label").cast("long").alias("label")).mapInArrow(run, "pair long, label long, n long").groupBy("pair", "label").agg(F.sum("n").alias("n"))


def vocabulary(sample: DataFrame) -> DataFrame:
    """``word, stem6, stem4``: ids of the sample's words and of their stems."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = sorted({w for t in batch.column("text").to_pylist() for w in words_of(t)})
            columns = [[zlib.crc32(w) for w in some], *([stem_id(w, n) for w in some] for n in STEMS)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["word", *(f"stem{n}" for n in STEMS)])

    return sample.select("text").mapInArrow(run, "word long, " + ", ".join(f"stem{n} long" for n in STEMS)).groupBy("word").agg(
        *(F.min(f"stem{n}").alias(f"stem{n}") for n in STEMS)
    )


def discounted(counts: np.ndarray) -> np.ndarray:
    return np.maximum(counts - DISCOUNT * np.sqrt(counts.sum(0)), 0)


def model_of(counts: DataFrame, stems: DataFrame) -> Model:
    """Gathers the bounded sample's continuation counts by word and class."""
    follows = counts.groupBy(F.col("pair").bitwiseAND(0xFFFFFFFF).alias("word")).pivot("label", [0, 1]).agg(F.count("pair")).fillna(0)
    frame = follows.join(stems, "word").orderBy("word").toPandas()
    model: Model = {}
    totals = np.maximum(frame[["0", "1"]].sum().to_numpy(float), 1)[:, None]
    below, below_all, below_key = None, None, None
    for name in (f"stem{STEMS[1]}", f"stem{STEMS[0]}", "word"):
        keyed = frame if below_key is None else frame.assign(below=frame[below_key])
        rows = keyed.groupby(name).agg({"0": "sum", "1": "sum"} | ({} if below_key is None else {"below": "min"}))
        ids, own = rows.index.to_numpy(np.uint64), rows[["0", "1"]].to_numpy(float).T
        both = own.sum(0)
        left = 1 - (discounted(own) / totals).sum(1).mean()
        if below_key is None:
            shared = np.stack([both / both.sum()] * 2)
        else:
            at = np.searchsorted(model[LEVELS[below_key]], rows["below"].to_numpy(np.uint64))
            shared = below[:, at] * both / below_all[at]
        below, below_all, below_key = discounted(own) / totals + left * shared, both, name
        model[LEVELS[name]], model[f"{LEVELS[name]}_odds"] = ids, below
    return model


def curve(ratios: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton's method with a small penalty on the slope."""
    scale = max(float(np.std(ratios)), 1e-9)
    x, w = np.stack([ratios / scale, np.ones(len(ratios))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
        gradient = x @ (p - labels) + np.array([1e-2, 0]) * w
        hessian = (x * (p * (1 - p) + 1e-9)) @ x.T + np.diag([1e-2, 1e-9])
        w = w - np.linalg.solve(hessian, gradient)
    return float(w[0] / scale), float(w[1])


def fit(documents: DataFrame, labels: DataFrame) -> tuple[Model | None, float, float]:
    turn = F.crc32(F.col("doc_id").cast("string"))
    labelled = clear_labels(labels, "toxic").withColumn("turn", turn).filter(F.col("turn") % FOLDS != HELD_OUT)
    part = F.floor(F.col("turn") / FOLDS) % 4
    chosen = labelled.filter("1 = 0").withColumn("use", F.lit(0))
    for_counts = labelled.filter(part > 0)
    least = min([CLASS_DOCS, *(r["count"] for r in for_counts.groupBy("label").count().collect())])
    for label in (0, 1):
        chosen = chosen.unionByName(for_counts.filter(F.col("label") == label).orderBy("turn", "doc_id").limit(least).withColumn("use", F.lit(0)))
    chosen = chosen.unionByName(labelled.filter(part == 0).orderBy("turn", "doc_id").limit(CURVE_DOCS).withColumn("use", F.lit(1)))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # at most 2 * CLASS_DOCS + CURVE_DOCS rows of four numbers
    few = F.broadcast(written(chosen, "toxic-labels"))
    sample = written(texts.join(few, "doc_id").select("text", "label", "use"), "toxic-sample")
    kinds = {tuple(r) for r in sample.select("use", "label").distinct().collect()}
    if len(kinds) < 4:
        return None, 0.0, -1e-6
    counts = written(pair_counts(sample.filter("use = 0")), "toxic-pairs")
    model = model_of(counts, vocabulary(sample.filter("use = 0")))
    if not len(model["words"]):
        return None, 0.0, -1e-6
    held = ratios(sample.filter("use = 1"), model).select("ratio", "label").toPandas()
    return model, *curve(held["ratio"].to_numpy(float), held["label"].to_numpy(float))


def ratios(docs: DataFrame, model: Model) -> DataFrame:
    """Replaces ``text`` by ``ratio``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordRatios(shared.value)
        for batch in batches:
            values = pa.array([known.ratio(t.as_py()) for t in batch.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), values], [*others, "ratio"])

    others = [c for c in docs.columns if c != "text"]
    return docs.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in docs.dtypes if c != "text") + ", ratio double")


def scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, ratio`` for every document."""
    model, slope, intercept = fit(documents, labels)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = docs.select("doc_id", F.lit(0.0).alias("ratio")) if model is None else ratios(docs, model)
    score = 1 / (1 + F.exp(-(F.col("ratio") * slope + intercept)))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), "ratio")
