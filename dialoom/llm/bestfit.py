"""Packing documents into token sequences: linear grouping, configurations, then best fit.

The lengths lie between 1 and the capacity, so the histogram of lengths, at most ``capacity`` numbers,
says all that a packing needs to know; documents of one length are interchangeable. The driver packs
the histogram and never sees documents:

1. Large lengths (over ``capacity // SMALL_PART``) are sorted and cut into groups of equal cardinality;
   each is rounded up to the largest of its group, which leaves few distinct sizes.
2. A linear program over configurations (sets of rounded sizes that fit together), solved by column
   generation, says how often to use which configuration; counts are rounded down, what remains is
   packed with the others in step 4.
3. Actual lengths, the longest first, take the places of their group's size; each fits, being shorter.
4. What is left of the large and all small lengths go, the longest first, where they fit best.

Sequences that hold the same lengths form one run ``(lengths, how many)``; every step works on runs, so
its cost follows the number of runs, not of documents. The plan maps each length's ranks to runs. In
Spark documents only get their rank within their length: numbers inside hash parts of a length, plus the
count of the parts before. No window holds a whole length, so one very common length does no harm.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .common import arrow_schema, map_arrow, materialise, struct_of, table, texts

#: A length is large if it is over this part of the capacity.
SMALL_PART = 8
#: Groups of equal cardinality among the large lengths.
GROUPS = 48
#: A sequence made from a configuration stays if actual lengths fill this part of it; else its documents
#: join the best fit. Each is tried, and the plan with the fewest sequences counts.
LEAST_FILL = (0.0, 0.98, 0.99, 0.995, 0.998, 0.999, 1.0)
#: Documents in a hash part of one length, and parts of a length at most (then parts grow, sorts spill).
PART_ROWS = 512
MAX_PARTS = 4096


class Plan:
    """Runs of equal sequences: ``rows[k] = (count, [(length, copies), ...])``; places by length."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rows: list[tuple[int, list[tuple[int, int]]]] = []
        self.places: dict[int, list[tuple[int, int, int, int]]] = {}
        self.sequences = 0

    def close(self) -> Plan:
        """Number the sequences and deal each length's ranks out: (first rank, first sequence, copies, offset)."""
        taken: Counter = Counter()
        places = defaultdict(list)
        for count, content in self.rows:
            offset = 0
            for length, copies in content:
                places[length].append((taken[length], self.sequences, copies, offset))
                taken[length] += copies * count
                offset += length * copies
            self.sequences += count
        self.places = dict(places)
        return self

    def place(self, length: int, rank: int) -> tuple[int, int]:
        """The sequence and the offset of the ``rank``-th piece (from 0) of this length."""
        rows = self.places[length]
        first, sequence, copies, offset = rows[bisect.bisect_right(rows, (rank, float("inf"))) - 1]
        return sequence + (rank - first) // copies, offset + (rank - first) % copies * length


def _groups(histogram: dict[int, int], k: int) -> list[list[tuple[int, int]]]:
    """The multiset of lengths, the longest first, in at most ``k`` groups of equal cardinality."""
    total = sum(histogram.values())
    each = max(1, -(-total // k))
    groups, room = [[]], each
    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            if not room:
                groups.append([])
                room = each
            m = min(n, room)
            groups[-1].append((length, m))
            n, room = n - m, room - m
    return [g for g in groups if g]


def _best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within the capacity that is worth most (unbounded knapsack)."""
    worth = np.zeros(capacity + 1)
    by = np.full(capacity + 1, -1)
    for i in np.argsort(-sizes):
        size, value = int(sizes[i]), float(values[i])
        if value <= 1e-12:
            continue
        for _ in range(capacity // size):
            with_one = worth[:-size] + value
            better = with_one > worth[size:] + 1e-12
            if not better.any():
                break
            worth[size:][better] = with_one[better]
            by[size:][better] = i
        # later sizes may build on any of these entries, so choices are read back from worth itself
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        fit = [(worth[room - int(s)] + v, i) for i, (s, v) in enumerate(zip(sizes, values, strict=True)) if s <= room and v > 1e-12]
        best = max(fit, default=(0.0, -1))
        if best[1] < 0 or best[0] < worth[room] - 1e-9:
            if worth[room] <= 1e-12:
                break
            room -= 1
            continue
        pattern[best[1]] += 1
        room -= int(sizes[best[1]])
    return float(worth[capacity]), pattern


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, float]]:
    """Fractional use of configurations that covers the demand with the fewest sequences.

    Column generation: the simplex basis starts with one configuration for each size; dual prices of
    the sizes ask a knapsack for a better configuration, which takes the place of the column that the
    ratio test names, until none is better.
    """
    s, d = np.array(sizes), np.array(demand, dtype=float)
    basis = np.diag([float(capacity // x) for x in sizes])
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        amounts = inverse @ d
        prices = np.ones(len(s)) @ inverse
        value, pattern = _best_pattern(s, prices, capacity)
        if value <= 1 + 1e-7:
            break
        direction = inverse @ pattern
        ratio = np.where(direction > 1e-9, amounts / np.maximum(direction, 1e-9), np.inf)
        leave = int(np.argmin(ratio))
        if not np.isfinite(ratio[leave]):
            break
        kept = basis[:, leave].copy()
        basis[:, leave] = pattern
        if abs(np.linalg.det(basis / np.maximum(basis.max(axis=0), 1))) < 1e-200 and np.linalg.matrix_rank(basis) < len(s):
            basis[:, leave] = kept
            break
    amounts = np.linalg.inv(basis) @ d
    return [(basis[:, j], float(a)) for j, a in enumerate(amounts) if a > 1e-9]


def pack_histogram(histogram: dict[int, int], capacity: int, groups: int = GROUPS) -> Plan:
    """Pack ``histogram[length] = how many`` into sequences of the capacity.

    Of the runs that hold actual lengths, those filled to one of LEAST_FILL stay; the plan with the
    fewest sequences counts.
    """
    if any(not 0 < x <= capacity for x in histogram):
        raise ValueError("lengths must lie between 1 and the capacity")
    full = histogram.get(capacity, 0)
    stock = {k: v for k, v in histogram.items() if v > 0 and k < capacity}
    runs = _configured({k: v for k, v in stock.items() if k > capacity // SMALL_PART}, capacity, groups)
    best = None
    for least in LEAST_FILL:
        kept = [r for r in runs if capacity - r[0] >= least * capacity]
        left = Counter(stock)
        for _, count, content in kept:
            left.subtract({k: v * count for k, v in content})
        plan = Plan(capacity)
        if full:
            plan.rows.append((full, [(capacity, 1)]))
        _best_fit(plan, kept, +left, capacity)
        if best is None or sum(c for c, _ in plan.rows) < sum(c for c, _ in best.rows):
            best = plan
    return best.close()


def _configured(large: dict[int, int], capacity: int, groups: int) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Runs ``(free room, count, content)`` of actual large lengths in the places of the configurations."""
    runs: list[tuple[int, int, list[tuple[int, int]]]] = []  # free room, count, content
    if large:
        queues = _groups(large, groups)
        rounded: dict[int, list] = {}
        for g in queues:  # groups of one size are one
            rounded.setdefault(g[0][0], []).extend(g)
        sizes = list(rounded)
        stock = [list(reversed(rounded[x])) for x in sizes]  # the longest at the end
        demand = [sum(n for _, n in rounded[x]) for x in sizes]
        for pattern, amount in configurations(sizes, demand, capacity):
            todo = int(amount + 1e-6)
            slots = [i for i in range(len(sizes)) for _ in range(int(round(pattern[i])))]
            have = {i: sum(n for _, n in stock[i]) for i in set(slots)}
            need = Counter(slots)
            todo = min([todo, *(have[i] // need[i] for i in need)])
            while todo > 0 and slots:
                # one run: as many sequences as hold the same actual lengths in every slot
                heads = {i: stock[i][-1] for i in need}
                count = max(1, min([todo, *(heads[i][1] // need[i] for i in need)]))
                content: Counter = Counter()
                for i in need:
                    for _ in range(need[i] if count == 1 else 1):
                        length, n = stock[i][-1]
                        take = 1 if count == 1 else count * need[i]
                        content[length] += 1 if count == 1 else need[i]
                        if n == take:
                            stock[i].pop()
                        else:
                            stock[i][-1] = (length, n - take)
                rows = sorted(content.items(), reverse=True)
                runs.append((capacity - sum(k * v for k, v in rows), count, rows))
                todo -= count
    return runs


def _best_fit(plan: Plan, runs: list, left: Counter, capacity: int) -> None:
    """Put the lengths in, the longest first, each into the fullest sequences that still take it."""
    by_room: dict[int, list] = defaultdict(list)
    rooms: list[int] = []

    def add(room: int, count: int, content: list) -> None:
        if not room:
            plan.rows.append((count, content))
            return
        if room not in by_room or not by_room[room]:
            bisect.insort(rooms, room)
        by_room[room].append((count, content))

    for room, count, content in runs:
        add(room, count, content)
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            k = bisect.bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                count, content = by_room[room].pop()
                if not by_room[room]:
                    rooms.pop(k)
            else:
                room, count, content = capacity, n, []
            copies = room // length  # best fit stays with a sequence until it takes no more
            whole = min(count, n // copies)
            if whole:
                add(room - copies * length, whole, [*content, (length, copies)])
                n -= whole * copies
            if whole < count and n and n < copies:
                add(room - n * length, 1, [*content, (length, n)])
                n, whole = 0, whole + 1
            if whole < count and content:
                add(room, count - whole, content)
    for room in rooms:
        plan.rows += by_room[room]


PIECES = struct_of("doc_id long, row long, piece int, start long, length long, ids_crc32 long")


def token_pieces(docs: DataFrame, capacity: int, keep_ids: bool = False) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids; the first piece takes the odd length.

    ``row`` tells apart rows that share a doc_id. With ``keep_ids`` the little-endian ids come along.
    """
    schema = struct_of("doc_id long, row long, piece int, start long, length long, ids_crc32 long, ids binary") if keep_ids else PIECES
    out = arrow_schema(schema)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in schema]
        for doc, row, text in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), texts(batch), strict=True):
            ids = np.append(bpe.encode(text), 0).astype("<u4").tobytes()
            total = len(ids) // 4
            start, length = 0, total % capacity or min(total, capacity)
            piece = 0
            while start < total:
                raw = ids[4 * start : 4 * (start + length)]
                values = (doc, row, piece, start, length, zlib.crc32(raw), raw)
                for c, v in zip(cols, values, strict=False):
                    c.append(v)
                start, length, piece = start + length, capacity, piece + 1
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, out, strict=True)], schema=out)

    # rows of one doc_id get different numbers, so that repeated rows are packed each
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col("text").cast("string").alias("text"),
    )
    return map_arrow(rows, run, schema)


PLACED = struct_of("doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = 2048) -> DataFrame:
    """Return ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece.

    A document is its text's ids (null or empty: none) followed by id 0; only documents over the
    capacity are cut. Null ids and repeated rows are packed like others, pieces of one length are
    interchangeable; an empty table gives no rows; columns other than doc_id and text are not read, so
    names that clash do no harm. Texts may be of any length, white space and single words too.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    pieces = materialise(token_pieces(docs, capacity), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    plan = pack_histogram(histogram, capacity)
    parts = max(1, min(MAX_PARTS, -(-sum(histogram.values()) // (4 * PART_ROWS))))
    part = F.pmod(F.xxhash64("doc_id", "row", "piece"), F.lit(parts)).cast("int")
    rows = pieces.withColumn("part", part)
    counts = rows.groupBy("length", "part").agg(F.count("*").alias("n"))
    firsts = counts.select(
        F.col("length").alias("_length"),
        F.col("part").alias("_part"),
        (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"),
    )
    inside = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "row")) - 1
    ranked = rows.withColumn("inside", inside).join(firsts, (F.col("length") == F.col("_length")) & (F.col("part") == F.col("_part")))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("inside")).alias("rank"))
    # the plan's size is bounded by the capacity and the number of groups, not by the documents
    places = {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v, strict=True)) for k, v in plan.places.items()}
    shared = docs.sparkSession.sparkContext.broadcast(places)
    out = arrow_schema(PLACED)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths, ranks = (np.asarray(batch.column(c)) for c in ("length", "rank"))
        sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            first, start, copies, base = shared.value[int(length)]
            k = np.searchsorted(first, ranks[at], side="right") - 1
            inner = ranks[at] - first[k]
            sequence[at] = start[k] + inner // copies[k]
            offset[at] = base[k] + inner % copies[k] * length
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in PLACED.names[:5]), pa.array(sequence), pa.array(offset)], schema=out)

    return map_arrow(ranked, run, PLACED)


def op3_bestfit_packing(spark, sf_dir: str) -> DataFrame:
    """``pack_documents`` of ``documents`` into 2,048 tokens; cases as stated there."""
    return pack_documents(table(spark, sf_dir, "documents"))
