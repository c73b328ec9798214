"""Conversation structure repair by Hirschberg's divide and conquer.

The repaired role initials must match ``(s?(ua)+)?``: four states, nothing yet, after a
system turn, after a user turn, after an assistant turn. Each row is kept, given the role
that comes next, or deleted, and turns with empty text may be inserted before it. Of all
cheapest edit lists the one whose initials (D, I, K, R) are ASCII-least is wanted.

A run of rows is solved by halves: a forward vector (the cost of each state after the
first half, and the rank of its least edit list among the four) meets a backward vector
(the cost from each state to the end). The crossing with the least sum, ties by rank, is
on the answer, and both halves are solved between fixed states. Two lists with equally
many rows that end in a row's edit are never prefixes of each other, so the ranks alone
decide ties. An insert never stands right before a deletion: after it, it is as cheap and
the list is less.

A conversation of any size is cut into pieces of at most ``PIECE`` rows after a global
sort. Pieces have 4 x 4 matrices of costs and ranks, which are combined up a tree of
partitions; the crossings are then chosen down the tree by the same function that
chooses them between rows. No task holds more than one piece, or the matrices of a
partition or of 64 subtrees.

Defined results: nulls of role and text count as one space; a null ``conv_id`` is a
conversation of its own; rows of one turn are ordered by role and text (by the first 64
characters of each, then by digest); equal rows are adjacent; conversations whose rows
are all dropped give zeros and empty results; an empty table gives an empty result. Texts
of any length are taken whole. Other columns are ignored, whatever their names. SHA-256 is
sequential: the texts of one conversation in several pieces pass through one task, as a
stream that holds one batch of pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.session import written

#: Rows and characters of a piece, after which it is closed.
PIECE, PIECE_CHARS = 4096, 8_000_000
#: Subtrees combined at a time, as a power of two.
FAN_BITS = 6

START, SYSTEM, USER, ASSISTANT = range(4)
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Inserts that lead from a state to an accepted end.
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
INSERT_COST, REROLE_COST, DELETE_COST, TRUNCATED_COST = 2, 2, 3, 1
LEGAL = ("su", "ua", "au")

#: For each state the reachable ``(state, cost, mark)``; marks order the edit lists from one state.
Item = tuple[tuple[tuple[int, int, object], ...], ...]
Vector = list[tuple[int, int] | None]


#: Items of single rows by initial and fault: at most four faults of the initials that occur.
KNOWN: dict[tuple[str, int], Item] = {}


def row_item(initial: str, fault: int, copies: int) -> Item:
    """Edits of a row and of its further adjacent copies, which are deleted."""
    kind = (initial if initial in ("s", "u", "a") else "", fault)
    if kind not in KNOWN:
        KNOWN[kind] = single_item(*kind)
    rest = DELETE_COST * (copies - 1)
    return tuple(tuple((to, cost + rest, mark) for to, cost, mark in reached) for reached in KNOWN[kind]) if rest else KNOWN[kind]


def single_item(initial: str, fault: int) -> Item:
    out = []
    for state in range(4):
        found: dict[int, tuple[int, str]] = {state: (DELETE_COST, "D")}

        def offer(to: int, cost: int, mark: str, found=found) -> None:
            found[to] = min(found.get(to, (cost, mark)), (cost, mark))

        if fault not in (BLANK, DUPLICATE):
            at, extra = state, TRUNCATED_COST * (fault == TRUNCATED)
            for inserts in range(3):
                spent = inserts * INSERT_COST + extra
                if (at, initial) in KEEP:
                    offer(KEEP[at, initial], spent, "I" * inserts + "K")
                offer(NEXT[at], spent + REROLE_COST, "I" * inserts + "R")
                at = NEXT[at]
        out.append(tuple((to, cost, mark) for to, (cost, mark) in sorted(found.items())))
    return tuple(out)


def advance(vector: Vector, item: Item) -> Vector:
    """The forward vector after one more item."""
    best: list[tuple | None] = [None] * 4
    for state, reached in enumerate(vector):
        if reached is not None:
            for to, cost, mark in item[state]:
                new = (reached[0] + cost, reached[1], mark)
                if best[to] is None or new < best[to]:
                    best[to] = new
    order = {key: rank for rank, key in enumerate(sorted(b[1:] for b in best if b is not None))}
    return [None if b is None else (b[0], order[b[1:]]) for b in best]


def retreat(costs: list[float], item: Item) -> list[float]:
    """The backward vector before one more item."""
    return [min((cost + costs[to] for to, cost, _ in item[state]), default=float("inf")) for state in range(4)]


def from_state(state: int) -> Vector:
    return [(0, 0) if s == state else None for s in range(4)]


def product(items: list[Item]) -> Item:
    """All items as one."""
    out = []
    for state in range(4):
        vector = from_state(state)
        for item in items:
            vector = advance(vector, item)
        out.append(tuple((to, *reached) for to, reached in enumerate(vector) if reached is not None))
    return tuple(out)


def crossings(items: list[Item], first: int, last: int) -> list[int]:
    """The state after each item on the audit-least cheapest way from ``first`` to ``last``."""
    states = [last] * len(items)

    def between(low: int, high: int, begin: int, end: int) -> None:
        if high - low < 2:
            if high > low:
                states[low] = end
            return
        middle = (low + high) // 2
        forward = from_state(begin)
        for item in items[low:middle]:
            forward = advance(forward, item)
        backward = [0.0 if s == end else float("inf") for s in range(4)]
        for item in reversed(items[middle:high]):
            backward = retreat(backward, item)
        crossing = min((f[0] + backward[s], f[1], s) for s, f in enumerate(forward) if f is not None)[2]
        between(low, middle, begin, crossing)
        between(middle, high, crossing, end)

    between(0, len(items), first, last)
    return states


def closed(whole: Item) -> tuple[int, int]:
    """Cost of a whole conversation, and its state before the closing inserts."""
    cost, _, state = min((cost + INSERT_COST * CLOSING[to], mark, to) for to, cost, mark in whole[START])
    return cost, state


Row = tuple[str, int, int, str, str]  # initial, fault, copies, role, text


def solved(rows: list[Row], first: int, last: int, ends: bool) -> tuple[str, list[tuple[str, str]]]:
    """Edit initials and repaired turns of a piece between two states; ``ends``: the closing inserts too."""
    items = [row_item(*row[:3]) for row in rows]
    audit, turns, state = [], [], first
    for (_, _, copies, role, text), item, to in zip(rows, items, crossings(items, first, last), strict=True):
        mark = next(mark for reached, _, mark in item[state] if reached == to)
        for edit in mark:
            if edit == "I":
                state = NEXT[state]
                turns.append((ROLE[state], ""))
            elif edit == "K":
                turns.append((role, text))
            elif edit == "R":
                turns.append((ROLE[NEXT[state]], text))
        state = to
        audit.append(mark + "D" * (copies - 1))
    for _ in range(CLOSING[state] if ends else 0):
        state = NEXT[state]
        turns.append((ROLE[state], ""))
        audit.append("I")
    return "".join(audit), turns


#: Counts of a run of rows; they join with those of the run after it.
COUNTS = ("first_turn", "last_turn", "n_turns", "first_initial", "last_initial", "illegal", "blank", "duplicate", "truncated")
COUNTS_DDL = "first_turn long, last_turn long, n_turns long, first_initial string, last_initial string, illegal long, blank long, duplicate long, truncated long"
NOTHING = (None, None, 0, None, None, 0, 0, 0, 0)


def row_counts(turn: int | None, row: Row) -> tuple:
    initial, fault, copies = row[:3]
    blank = copies if fault == BLANK else 0
    again = 0 if fault == BLANK else copies - 1 + (fault == DUPLICATE)
    side_by_side = 0 if initial + initial in LEGAL else copies - 1
    return (turn, turn, int(turn is not None), initial, initial, side_by_side, blank, again, int(fault == TRUNCATED))


def joined(a: tuple, b: tuple) -> tuple:
    seam = a[4] is not None and b[3] is not None and a[4] + b[3] not in LEGAL
    same_turn = a[1] is not None and a[1] == b[0]
    return (
        b[0] if a[0] is None else a[0], a[1] if b[1] is None else b[1], a[2] + b[2] - same_turn,
        b[3] if a[3] is None else a[3], a[4] if b[4] is None else b[4], a[5] + b[5] + seam, *(x + y for x, y in zip(a[6:], b[6:], strict=True)),
    )


def packed(item: Item) -> list[int]:
    """A matrix as 32 numbers: cost and rank by state and state reached, -1 where none is."""
    out = [-1] * 32
    for state, reached in enumerate(item):
        for to, cost, mark in reached:
            out[8 * state + 2 * to : 8 * state + 2 * to + 2] = cost, mark
    return out


def unpacked(numbers: list[int]) -> Item:
    return tuple(tuple((to, *numbers[8 * s + 2 * to : 8 * s + 2 * to + 2]) for to in range(4) if numbers[8 * s + 2 * to] >= 0) for s in range(4))


TURNS_DDL = "array<struct<role:string,text:string>>"
TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
ROWS_DDL = "array<struct<initial:string,fault:int,copies:long,role:string,text:string>>"
ROWS = pa.list_(pa.struct([("initial", pa.string()), ("fault", pa.int32()), ("copies", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
COUNTS_ARROW = [(name, pa.string() if "initial" in name else pa.int64()) for name in COUNTS]
MATRIX = pa.list_(pa.int64())


def columns_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def faults(rows: DataFrame) -> DataFrame:
    """Equal rows as one with ``copies``; ``initial`` and ``fault`` of each. Rows with no copies mark their conversation."""
    merged = written(rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "repair-rows")
    merged = merged.withColumn("said", F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text")))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = merged.filter("copies > 0").groupBy("conv", "said").agg(F.min(place).alias("first"), F.count("*").alias("places"))
    again = again.filter("places > 1").select("conv", "said", "first")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    fault = (
        F.when(blank, BLANK)
        .when(F.col("first").isNotNull() & (place > F.col("first")), DUPLICATE)
        .when(~last.isin(".", "!", "?"), TRUNCATED)
        .otherwise(FINE)
    )
    return merged.join(again, ["conv", "said"], "left").select("conv", "turn", "role", "text", "copies", "said", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"))


PIECE_DDL = f"conv string, at long, alone boolean, {COUNTS_DDL}, matrix array<long>, cost long, audit string, turns {TURNS_DDL}, rows {ROWS_DDL}"


def pieces(rows: DataFrame) -> DataFrame:
    """Runs of rows of one conversation in order. Conversations inside one partition are solved at once."""
    schema = pa.schema([("conv", pa.string()), ("at", pa.int64()), ("alone", pa.bool_()), *COUNTS_ARROW, ("matrix", MATRIX), ("cost", pa.int64()), ("audit", pa.string()), ("turns", TURNS), ("rows", ROWS)])

    def piece(conv: str, at: int, alone: bool, held: list[tuple[int | None, Row]]) -> tuple:
        own = [row for _, row in held if row[2]]
        counts = NOTHING
        for turn, row in held:
            if row[2]:
                counts = joined(counts, row_counts(turn, row))
        whole = product([row_item(*row[:3]) for row in own])
        if not alone:
            return (conv, at, False, *counts, packed(whole), None, None, None, own)
        cost, state = closed(whole)
        return (conv, at, True, *counts, None, cost, *solved(own, START, state, True), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held, chars, nth, starts_here, part, seen, out = None, [], 0, 0, False, 0, False, []
        for batch in batches:
            for key, turn, role, text, copies, initial, fault, part in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "copies", "initial", "fault", "part")), strict=True):
                if key != conv or len(held) >= PIECE or chars >= PIECE_CHARS:
                    if seen:
                        out.append(piece(conv, part << 32 | nth, key != conv and starts_here, held))
                    # The first conversation of a partition may have begun in the one before.
                    starts_here = seen and key != conv
                    nth = 0 if key != conv else nth + 1
                    conv, held, chars, seen = key, [], 0, True
                held.append((turn, (initial, fault, copies, role, text)))
                chars += len(text)
            if out:
                yield columns_of(out, schema)
                out = []
        if seen:  # and the last may go on in the next
            yield columns_of([piece(conv, part << 32 | nth, False, held)], schema)

    # Bounded keys: the range boundaries are sampled to the driver.
    keyed = rows.withColumns({"role_key": F.left("role", F.lit(64)), "text_key": F.left("text", F.lit(64))})
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role_key"), F.col("text_key"), F.col("said")]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    return ordered.select("conv", "turn", "role", "text", F.col("copies").cast("long"), "initial", "fault", "part").mapInArrow(run, PIECE_DDL)


NODE_DDL = f"conv string, at long, {COUNTS_DDL}, matrix array<long>"
NODE = pa.schema([("conv", pa.string()), ("at", pa.int64()), *COUNTS_ARROW, ("matrix", MATRIX)])
BOUND_DDL = "conv string, at long, begin int, end int, last boolean"
BOUND = pa.schema([("conv", pa.string()), ("at", pa.int64()), ("begin", pa.int32()), ("end", pa.int32()), ("last", pa.bool_())])


def combined(nodes: DataFrame, shift: int) -> DataFrame:
    """One level up the tree: the nodes below one parent as one node."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in NODE.names), strict=True), key=lambda r: r[1])
        counts = NOTHING
        for row in rows:
            counts = joined(counts, row[2:-1])
        whole = product([unpacked(row[-1]) for row in rows])
        return pa.Table.from_batches([columns_of([(rows[0][0], rows[0][1] >> shift, *counts, packed(whole))], NODE)])

    return nodes.groupBy("conv", F.expr(f"at >> {shift}").alias("parent")).applyInArrow(run, NODE_DDL)


def descended(nodes: DataFrame, bounds: DataFrame, shift: int) -> DataFrame:
    """One level down: the states at both ends of each node, from those of its parent."""

    def run(children: pa.Table, parents: pa.Table) -> pa.Table:
        if not parents.num_rows:
            return BOUND.empty_table()
        rows = sorted(zip(*(children.column(c).to_pylist() for c in ("conv", "at", "matrix")), strict=True), key=lambda r: r[1])
        first, end, last = (parents.column(c)[0].as_py() for c in ("begin", "end", "last"))
        states = crossings([unpacked(m) for _, _, m in rows], first, end)
        begins = [first, *states[:-1]]
        found = [(conv, at, begin, to, last and i == len(rows) - 1) for i, ((conv, at, _), begin, to) in enumerate(zip(rows, begins, states, strict=True))]
        return pa.Table.from_batches([columns_of(found, BOUND)])

    left = nodes.groupBy("conv", F.expr(f"at >> {shift}").alias("parent"))
    return left.cogroup(bounds.groupBy("conv", "at")).applyInArrow(run, BOUND_DDL)


def rooted(nodes: DataFrame) -> DataFrame:
    """``cost`` of each root and the states at its ends."""
    schema = pa.schema([*BOUND, ("cost", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for conv, at, matrix in zip(*(batch.column(c).to_pylist() for c in ("conv", "at", "matrix")), strict=True):
                cost, state = closed(unpacked(matrix))
                found.append((conv, at, START, state, True, cost))
            yield columns_of(found, schema)

    return nodes.select("conv", "at", "matrix").mapInArrow(run, f"{BOUND_DDL}, cost long")


def solve_open(open_pieces: DataFrame, bounds: DataFrame) -> DataFrame:
    schema = pa.schema([("conv", pa.string()), ("at", pa.int64()), ("alone", pa.bool_()), ("audit", pa.string()), ("turns", TURNS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for conv, at, rows, begin, end, last in zip(*(batch.column(c).to_pylist() for c in ("conv", "at", "rows", "begin", "end", "last")), strict=True):
                own = [(r["initial"], r["fault"], r["copies"], r["role"], r["text"]) for r in rows]
                found.append((conv, at, False, *solved(own, begin, end, last)))
            yield columns_of(found, schema)

    return open_pieces.select("conv", "at", "rows").join(bounds, ["conv", "at"]).select("conv", "at", "rows", "begin", "end", "last").mapInArrow(
        run, f"conv string, at long, alone boolean, audit string, turns {TURNS_DDL}"
    )


def conv_id() -> Column:
    return F.when(F.col("conv") != " ", F.col("conv")).cast("long").alias("conv_id")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired conversations and their counts, from ``conv, turn, role, text, copies``.

    The first has one row per piece: ``conv, at`` (its place), ``alone`` (the only piece), ``audit`` and the
    repaired ``turns``. The second has one row per conversation: ``conv, gaps, blank, duplicate, truncated,
    illegal, cost``.
    """
    cut = written(pieces(faults(rows)), "repair-pieces")
    open_pieces = cut.filter("not alone")
    parts = cut.agg(F.max(F.expr("at >> 32"))).first()[0] or 0
    shifts = [32]
    while parts:
        shifts.append(FAN_BITS)
        parts >>= FAN_BITS
    levels = [open_pieces.select(*NODE.names)]
    for shift in shifts:
        levels.append(written(combined(levels[-1], shift), "repair-level"))
    roots = written(rooted(levels[-1]), "repair-roots")
    bounds = roots.drop("cost")
    for nodes, shift in zip(levels[-2::-1], reversed(shifts), strict=True):
        bounds = written(descended(nodes, bounds, shift), "repair-bounds")
    texts = cut.filter("alone").select("conv", "at", "alone", "audit", "turns").unionByName(solve_open(open_pieces, bounds))
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0)).alias("gaps")
    counts = ["conv", gaps, "blank", "duplicate", "truncated", "illegal", "cost"]
    whole = cut.filter("alone").select(*counts)
    return texts, whole.unionByName(levels[-1].join(roots.select("conv", "cost"), "conv").select(*counts))


def digests(texts: DataFrame) -> DataFrame:
    """``conv, audit, repaired_sha256`` of each conversation; several pieces pass as a stream in their order."""
    said = F.concat_ws("\n", F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])))
    whole = texts.filter("alone").select("conv", "audit", F.sha2(said, 256).alias("repaired_sha256"))
    schema = pa.schema([("conv", pa.string()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, digest, any_turn, out = None, [], hashlib.sha256(), False, []
        for batch in batches:
            for key, edits, n, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "n", "said")), strict=True):
                if key != conv:
                    if conv is not None:
                        out.append((conv, "".join(audit), digest.hexdigest()))
                    conv, audit, digest, any_turn = key, [], hashlib.sha256(), False
                audit.append(edits)
                if n:
                    digest.update((b"\n" if any_turn else b"") + text.encode())
                    any_turn = True
            if out:
                yield columns_of(out, schema)
                out = []
        if conv is not None:
            yield columns_of([(conv, "".join(audit), digest.hexdigest())], schema)

    several = texts.filter("not alone").select("conv", "at", "audit", F.size("turns").alias("n"), said.alias("said"))
    several = several.repartition("conv").sortWithinPartitions("conv", "at").drop("at")
    return whole.unionByName(several.mapInArrow(run, "conv string, audit string, repaired_sha256 string"))


def plain_rows(conversations: DataFrame) -> DataFrame:
    """Rows as ``repair`` takes them, undamaged."""
    space = F.lit(" ")
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("long").cast("string"), space).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        F.lit(1).alias("copies"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage by row; a dropped row stays with no copies, empty, so its conversation is known."""
    rows = plain_rows(conversations)
    draw = F.pmod(F.crc32(F.concat("conv", F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))), F.lit(20))
    text = F.when(draw < 2, "").when(draw == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(draw == 0, "").when(draw == 4, "user").otherwise(F.col("role"))
    copies = F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1)
    return rows.select("conv", F.when(draw != 0, F.col("turn")).alias("turn"), role.alias("role"), text.alias("text"), copies.alias("copies"))


def audited(rows: DataFrame) -> DataFrame:
    """The contract's columns for each conversation."""
    texts, counts = repair(rows)
    stored = written(texts, "repair-texts")
    found = counts.join(digests(stored), "conv")
    return found.select(conv_id(), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
