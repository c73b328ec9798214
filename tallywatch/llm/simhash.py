"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are reduced to the distinct ones first, so copies of a text meet
nowhere again. Correlated bits go to the same partition; a dynamic program gives
each partition a threshold so that the thresholds sum to
``distance - partitions + 1`` (then some partition of every link is within its
own), at the least estimated cost of probes and candidates. Buckets are probed and
candidates verified by the number of differing bits.

Buckets of more than ``CROWD`` fingerprints are not paired. Their members emit
every value one bit away and every value two bits away; two fingerprints within
three bits meet in a value that is one bit from one and two from the other, and
each such value needs only a star of links. That is exact and linear in the crowd.

With ``jaccard`` given, texts whose sets of five-word shingles agree to that share are
linked too: min-hash bands propose pairs, each member of a bucket with three others
chosen by hash, so a bucket costs links in proportion to its members, and each pair is
verified on the whole shingle sets.

Defined results: a null or empty text has fingerprint zero; a null ``doc_id`` never
is a component's id while it has another; repeated rows share a component; an empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import row_key
from tallywatch.session import written

BITS = 64
DISTANCE = 3
SHINGLE = 3
CROWD = 256
SEED = 42
PARTITIONS = (2, 3, 4)
HASHES_AT_ONCE = 65_536
WIDE_SHINGLE = 5
BANDS, BAND_ROWS, CENTRES = 20, 6, 3
MIXERS = np.random.default_rng(SEED).integers(1, 2**63, (2, BANDS * BAND_ROWS)).astype(np.uint64) | np.uint64(1)


def fingerprint(text: str | None) -> int:
    """Majority of the bits of all shingle hashes; a bit set in just half of them is 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    count, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    total = len(words) - SHINGLE + 1
    for at in range(0, total, HASHES_AT_ONCE):
        part = words[at : at + HASHES_AT_ONCE + SHINGLE - 1]
        hashes = np.array([digest(b" ".join(x), SEED) for x in zip(*(part[k:] for k in range(SHINGLE)))], "<u8")
        count += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(count * 2 > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` to ``doc_id, key, fp``; ``key`` names rows with the same id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(values)], ["doc_id", "key", "fp"])

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    return keyed.mapInArrow(run, "doc_id long, key string, fp long")


def bit_products(values: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how many have both bits of each pair set: a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((BITS, BITS)), 0
        for batch in batches:
            raw = np.ascontiguousarray(batch.column("fp").to_numpy(zero_copy_only=False)).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float64)
            total, rows = total + bits.T @ bits, rows + len(bits)
        yield pa.RecordBatch.from_pydict({"row": list(range(BITS)), "n": [rows] * BITS, "both": [list(x) for x in total]}, schema=schema)

    schema = pa.schema([("row", pa.int32()), ("n", pa.int64()), ("both", pa.list_(pa.float64()))])
    sums = (
        values.select("fp").mapInArrow(run, "row int, n long, both array<double>")
        .select("row", "n", F.posexplode("both").alias("column", "both"))
        .groupBy("row", "column").agg(F.sum("n").alias("n"), F.sum("both").alias("both")).collect()
    )
    products = np.zeros((BITS, BITS))
    for row in sums:
        products[row["row"], row["column"]] = row["both"]
    return max((row["n"] for row in sums), default=0), products


def grouped_bits(rows: int, products: np.ndarray, parts: int) -> list[list[int]]:
    """Bits by partition, filled one after another with the bit most correlated with those it has."""
    share = products / max(rows, 1)
    mean = np.diag(share)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    related = np.abs(share - np.outer(mean, mean)) / np.outer(spread, spread)
    left, groups = set(range(BITS)), []
    for part in range(parts):
        size = len(left) // (parts - part)
        group = [min(left)]
        left.remove(group[0])
        while len(group) < size:
            best = max(sorted(left), key=lambda b: related[b, group].max())
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def within(rows: int, products: np.ndarray, group: list[int]) -> np.ndarray:
    """Estimated chance that two fingerprints differ in at most t bits of the group, t from 0 to ``DISTANCE``."""
    mean = np.diag(products)[group] / max(rows, 1)
    exact = np.zeros(DISTANCE + 1)
    exact[0] = 1
    for p in mean:
        differ = 2 * p * (1 - p)
        exact = exact * (1 - differ) + np.concatenate([[0], exact[:-1]]) * differ
    return exact.cumsum()


def plan(rows: int, products: np.ndarray) -> list[tuple[list[int], int]]:
    """Partitions and thresholds (-1: not probed) of the least estimated cost."""
    best: tuple[float, list[tuple[list[int], int]]] = (float("inf"), [])
    for parts in PARTITIONS:
        groups, budget = grouped_bits(rows, products, parts), DISTANCE - parts + 1
        states: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for group in groups:
            chance, grown = within(rows, products, group), {}
            for spent, (cost, chosen) in states.items():
                for threshold in range(-1, min(DISTANCE, 2) + 1):
                    probes = sum(_combinations(len(group), k) for k in range(threshold + 1))
                    candidates = rows * rows / 2 * chance[threshold] if threshold >= 0 else 0
                    state = (cost + rows * probes + candidates, [*chosen, threshold])
                    if spent + threshold not in grown or state < grown[spent + threshold]:
                        grown[spent + threshold] = state
            states = grown
        if budget in states and states[budget][0] < best[0]:
            best = (states[budget][0], list(zip(groups, states[budget][1], strict=True)))
    return best[1]


def _combinations(n: int, k: int) -> int:
    return (1, n, n * (n - 1) // 2)[k]


def _masks(bits: list[int], most: int) -> Column:
    """Masks of none, one, or up to two of the bits, in this order."""
    one = f"array({', '.join(f'shiftleft(1L, {b})' for b in bits)})"
    two = f"flatten(transform({one}, (x, i) -> transform(slice({one}, 1, i), y -> x | y)))"
    return F.expr(f"concat({', '.join(['array(0L)', one, two][: most + 1])})")


def _mask(bits: list[int]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def links(values: DataFrame) -> DataFrame:
    """``a, b``: links between distinct fingerprints that connect all those within ``DISTANCE`` bits."""
    found = None
    rows, products = bit_products(values)
    chosen = [(k, bits, t) for k, (bits, t) in enumerate(plan(rows, products)) if t >= 0]
    stored = None
    for k, bits, _ in chosen:
        part = values.select(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(_mask(bits)).cast("long")).alias("bucket"), "fp")
        stored = part if stored is None else stored.unionByName(part)
    if stored is None:
        return values.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    sizes = stored.groupBy("part", "bucket").agg(F.count("*").alias("members"))
    crowds = written(sizes.filter(F.col("members") > CROWD).select("part", "bucket"), "simhash-crowds")
    calm = stored.join(crowds, ["part", "bucket"], "left_anti")
    for k, bits, threshold in chosen:
        own = calm.filter(F.col("part") == k).select("bucket", "fp")
        probes = values.select(
            F.col("fp").alias("probe"),
            F.explode(F.transform(_masks(bits, threshold), lambda m: F.col("fp").bitwiseXOR(m).bitwiseAND(F.lit(_mask(bits)).cast("long")))).alias("bucket"),
        )
        close = F.bit_count(F.col("fp").bitwiseXOR(F.col("probe"))) <= DISTANCE
        # Rows that an array is spread to are not in the planner's estimate, so it must not broadcast them.
        pairs = probes.hint("merge").join(own, "bucket").filter((F.col("fp") < F.col("probe")) & close).select(F.col("fp").alias("a"), F.col("probe").alias("b"))
        found = pairs if found is None else found.unionByName(pairs)
    return found.unionByName(crowd_links(values, stored, crowds, chosen)).distinct()


def crowd_links(values: DataFrame, stored: DataFrame, crowds: DataFrame, chosen: list[tuple[int, list[int], int]]) -> DataFrame:
    """Stars over the values between two members of a crowd.

    Members are those of a crowded bucket and all whose probes reach one.
    """
    reaching = None
    for k, bits, threshold in chosen:
        near = values.select(
            "fp",
            F.lit(k).alias("part"),
            F.explode(F.transform(_masks(bits, threshold), lambda m: F.col("fp").bitwiseXOR(m).bitwiseAND(F.lit(_mask(bits)).cast("long")))).alias("bucket"),
        )
        near = near.hint("merge").join(crowds, ["part", "bucket"], "left_semi").select("fp")
        reaching = near if reaching is None else reaching.unionByName(near)
    members = written(reaching.distinct(), "simhash-members")
    everything = list(range(BITS))
    between = members.select(
        "fp", F.posexplode(_masks(everything, 2)).alias("nth", "flip")
    ).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"), (F.col("nth") <= BITS).alias("near"))
    stars = between.groupBy("value").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("centre"), F.count("*").alias("n")).filter("centre is not null and n > 1")
    return (
        between.hint("merge").join(stars, "value")
        .filter("fp != centre")
        .select(F.least("fp", "centre").alias("a"), F.greatest("fp", "centre").alias("b"))
    )


def components(pairs: DataFrame) -> DataFrame:
    """``fp, root``: the smallest fingerprint reachable over links, by alternating large and small stars.

    Every round is written, so lineage stays short and a lost executor costs one round.
    """
    edges = written(pairs.select("a", "b").filter("a != b"), "simhash-links")
    while True:
        large = _star(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), smaller=False)
        small = _star(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), smaller=True)
        grown = written(small.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "simhash-links")
        mark = [F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.coalesce(F.sum(F.hash("a", "b").cast("long")), F.lit(0))]
        if grown.agg(*mark).first() == edges.agg(*mark).first():
            return grown.select(F.col("b").alias("fp"), F.col("a").alias("root"))
        edges = grown


def _star(edges: DataFrame, smaller: bool) -> DataFrame:
    """Links each node's neighbours (the larger ones, or all smaller ones and itself) with its smallest neighbour."""
    smallest = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    joined = edges.join(smallest, "a")
    if smaller:
        kept = joined.select(F.col("b").alias("a"), F.col("low").alias("b"))
        return kept.unionByName(smallest.select("a", F.col("low").alias("b")))
    return joined.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles; a shorter text is one shingle."""
    words = (text or "").encode().lower().split()
    parts = zip(*(words[k:] for k in range(WIDE_SHINGLE))) if len(words) >= WIDE_SHINGLE else [words] if words else []
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(x), SEED) for x in parts), np.uint64))


def bands(values: np.ndarray) -> np.ndarray:
    """One number for each band of the min-hashes."""
    lows = np.full(BANDS * BAND_ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(values), 1024):
        mixed = (values[at : at + 1024, None] ^ MIXERS[0]) * MIXERS[1]
        np.minimum(lows, (mixed ^ mixed >> np.uint64(32)).min(0), out=lows)
    return np.array([xxhash.xxh64_intdigest(x.tobytes(), k) for k, x in enumerate(lows.reshape(BANDS, -1))], np.uint64).view(np.int64)


def similar_links(docs: DataFrame, printed: DataFrame, jaccard: float) -> DataFrame:
    """``a, b``: links between fingerprints of texts that agree to ``jaccard``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([xxhash.xxh128_digest(x.tobytes()) for x in sets]), pa.array([bands(x) if len(x) else None for x in sets], pa.list_(pa.int64()))],
                ["key", "digest", "bands"],
            )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array([shingles(t.as_py()).tobytes() for t in batch.column("text")], pa.binary())], ["key", "members"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("one").to_pylist(), batch.column("two").to_pylist(), strict=True):
                x, y = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True)) if min(len(x), len(y)) >= jaccard * max(len(x), len(y)) else 0
                keep.append(both >= jaccard * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    texts = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    signed = texts.mapInArrow(sign, "key string, digest binary, bands array<long>").filter("bands is not null")
    # One row stands for all texts of one shingle set and fingerprint.
    one_each = signed.join(printed.select("key", "fp"), "key").groupBy("fp", "digest").agg(F.min(F.struct("key", "bands")).alias("low"))
    signs = written(one_each.select("fp", "low.key", "low.bands"), "simhash-signs")
    spread = signs.select("fp", "key", F.posexplode("bands").alias("band", "value"))
    pick = [F.min(F.struct(F.xxhash64("key", F.lit(k)).alias("h"), "key", "fp")).alias(f"c{k}") for k in range(CENTRES)]
    centres = spread.groupBy("band", "value").agg(F.count("*").alias("n"), *pick).filter("n > 1").drop("n")
    met = spread.hint("merge").join(centres, ["band", "value"]).select("fp", "key", F.explode(F.array(*(f"c{k}" for k in range(CENTRES)))).alias("c"))
    pairs = written(met.filter("fp != c.fp").select(
        F.least("key", "c.key").alias("k"), F.greatest("key", "c.key").alias("l"), F.least("fp", "c.fp").alias("a"), F.greatest("fp", "c.fp").alias("b")
    ).distinct(), "simhash-pairs")
    involved = pairs.select(F.col("k").alias("key")).unionByName(pairs.select(F.col("l").alias("key"))).distinct()
    sets = written(texts.join(involved, "key", "left_semi").dropDuplicates(["key"]).mapInArrow(fill, "key string, members binary"), "simhash-sets")
    first = pairs.join(sets.select(F.col("key").alias("k"), F.col("members").alias("one")), "k")
    return first.join(sets.select(F.col("key").alias("l"), F.col("members").alias("two")), "l").select("a", "b", "one", "two").mapInArrow(verify, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, jaccard: float | None = None) -> DataFrame:
    """One row per document: ``doc_id, key, fp, root, component_id``."""
    printed = written(fingerprints(docs), "simhash-prints")
    values = written(printed.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-values")
    linked = links(values.select("fp"))
    if jaccard is not None:
        linked = linked.unionByName(similar_links(docs, printed.dropDuplicates(["key"]), jaccard)).distinct()
    roots = components(linked)
    rooted = values.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "low")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = written(rooted.join(lowest, "root").select("fp", "root", "component_id"), "simhash-roots")
    return printed.join(named, "fp").select("doc_id", "key", "fp", "root", "component_id")


def one_of_each(documents: DataFrame, jaccard: float | None = None) -> DataFrame:
    """One document of each component, that of the smallest id, with its own columns."""
    grouped = near_duplicates(documents, jaccard)
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    kept = written(grouped.groupBy("root").agg(F.min(place).alias("place")).select("place.key"), "simhash-kept")
    own = documents.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), F.struct("*").alias("row"))
    # Rows that agree in id and text share a key; few do, so any of them may stay.
    repeated = written(grouped.groupBy("key").count().filter("count > 1").select("key").join(kept, "key", "left_semi"), "simhash-repeated")
    chosen = own.join(kept, "key", "left_semi")
    single = chosen.join(repeated, "key", "left_anti").select("row")
    one = chosen.join(repeated, "key", "left_semi").groupBy("key").agg(F.first("row").alias("row")).select("row")
    return single.unionByName(one).select("row.*")
