"""Removing long repeated byte strings, exactly, by sparse suffix sorting.

A byte goes if a string of ``length`` bytes covers it that also starts anywhere else. All suffixes are
too many to shuffle, so they are sorted from anchors only:

1. Anchors are minimizers: of the ``length - GRAM + 1`` grams in every window of ``length`` bytes the one
   with the least hash. Equal windows have their anchor at the same place, so only anchors with equal
   grams can belong to equal windows, and all windows of an anchor lie in its context (``length - GRAM``
   bytes before it, ``length`` from it on).
2. Anchors whose gram occurs once go. Equal contexts are one context with a count; if that is over one,
   all its windows are repeated.
3. Contexts of one gram are sorted from the anchor to the right and, reversed, to the left by deep-shallow
   sorting. Of two contexts ``l`` bytes agree to the left and ``r`` to the right (least common prefixes
   between their places in either order); they share a window exactly if ``l + r >= length``. Each
   context keeps the largest such ``l`` and ``r``.
4. A gram with more than ``BLOCK`` different contexts is cut into blocks, every pair of which is one task; with
   more than ``MOST_BLOCKS`` blocks, as in a passage that very many documents hold, each window of its contexts
   becomes a hash instead, and windows that occur in two places are found by an aggregate. So the cost of a
   gram grows with its contexts, not with their square.
5. Every anchor thus covers one interval; the union in a document is what goes.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, discard, map_arrow, map_groups, materialise, struct_of, table, texts
from .suffixsort import deep_shallow_sort

LENGTH = 200
GRAM = 64
#: Different contexts of one gram in a block (a task holds two of them, some 20 MB), and blocks of a gram that meet
#: in pairs at most; from there on 137 windows of 20 bytes are less than the copies of a context of 336.
BLOCK = 1 << 15
MOST_BLOCKS = 8


@functools.cache
def _bytes_table() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64)


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _sliding(x: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """``op`` over every ``width`` neighbours."""
    have, out = 1, x
    while 2 * have <= width:
        out = op(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return op(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions and gram hashes of the minimizers of a byte string."""
    n = len(raw)
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    up, down = _powers(1 << max(12, (n - 1).bit_length()))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_bytes_table()[np.frombuffer(raw, np.uint8)] * up[:n], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[: n - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    width = length - gram + 1
    least = _sliding(h, width, np.minimum)
    padded = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    padded[width - 1 : width - 1 + len(least)] = least
    at = np.flatnonzero(_sliding(padded, width, np.maximum) == h)
    return at, h[at]


ANCHOR = struct_of("h long, c long, doc_id long, t long, pos int")
CONTEXT = struct_of("h long, c long, n long, blocks int, own int, left binary, right binary")
WINDOW = struct_of("w long, h long, c long, l int")
FOUND = struct_of("h long, c long, l int, r int")


def _columns(rows: list[tuple], schema) -> pa.RecordBatch:
    out = arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(out)], schema=out)


def _raw(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _anchor_rows(length: int, gram: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        hs, cs, rows, poss = [], [], [], []
        for k, text in enumerate(texts(batch)):
            raw = _raw(text)
            at, h = anchors(raw, length, gram)
            if not len(at):
                continue
            lows = np.maximum(at - (length - gram), 0)
            # a context is its bytes and where the anchor is in them
            cs += [digest(raw[a : p + length], p - a) for a, p in zip(lows.tolist(), at.tolist(), strict=True)]
            hs.append(h)
            poss.append(at)
            rows.append(np.full(len(at), k))
        if not hs:
            return None
        at = pa.array(np.concatenate(rows))
        cols = [
            pa.array(np.concatenate(hs).view(np.int64)),
            pa.array(np.array(cs, np.uint64).view(np.int64)),
            batch.column("doc_id").take(at),
            batch.column("t").take(at),
            pa.array(np.concatenate(poss).astype(np.int32)),
        ]
        return pa.RecordBatch.from_arrays(cols, schema=arrow_schema(ANCHOR))

    return run


def _each_once(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple[bytes, list]]]:
    """The bytes and wanted places of each batch's documents; of repeated rows, which the join puts side by side, one."""
    last = None
    for batch in batches:
        out = []
        for doc, t, text, wanted in zip(batch.column("doc_id").to_pylist(), batch.column("t").to_pylist(), texts(batch), batch.column("wanted").to_pylist(), strict=True):
            if (doc, t) != last:
                out.append((_raw(text), wanted))
            last = doc, t
        yield out


def _context_rows(length: int, gram: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for documents in _each_once(batches):
            rows = []
            for raw, wanted in documents:
                for w in wanted:
                    p = w["pos"]
                    left, right = raw[max(0, p - (length - gram)) : p], raw[p : p + length]
                    rows.append((w["h"], w["c"], w["n"], w["blocks"], w["c"] % w["blocks"], left, right))
            if rows:
                yield _columns(rows, CONTEXT)

    return run


def _window_rows(length: int, gram: int):
    """The hash of every window of the wanted contexts, and how many of its bytes lie left of the anchor.

    Equal windows have their anchor at the same place, while one window may hold the gram twice, at two places:
    the place is part of what is hashed.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        schema = arrow_schema(WINDOW)
        for documents in _each_once(batches):
            held: list[list] = [[], [], [], []]

            def rows(held=held) -> pa.RecordBatch:
                w, h, c, l = held
                w = np.array(w, np.uint64).view(np.int64)
                return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((w, h, c, l), schema, strict=True)], schema=schema)

            for raw, wanted in documents:
                for x in wanted:
                    p = x["pos"]
                    starts = range(max(0, p - (length - gram)), min(p, len(raw) - length) + 1)
                    held[0] += [digest(raw[a : a + length], p - a) for a in starts]
                    held[1] += [x["h"]] * len(starts)
                    held[2] += [x["c"]] * len(starts)
                    held[3] += [p - a for a in starts]
                    if len(held[0]) > 200_000:
                        yield rows()
                        for column in held:
                            column.clear()
            if held[0]:
                yield rows()

    return run


class _Prefixes:
    """Common prefixes of any two members of one group, from a sorted order: range minima of neighbours."""

    def __init__(self, order: np.ndarray, common: np.ndarray):
        self.order, self.place = order, np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.common = common.astype(np.int16)
        self.levels = [self.common]
        while 2 << (len(self.levels) - 1) <= len(order):
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.place[i], self.place[j]
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b)  # minima over common[lo..hi]
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int16)
        for k in np.unique(level):
            at = level == k
            x = self.levels[k]
            out[at] = np.minimum(x[lo[at]], x[hi[at] - (1 << int(k)) + 1])
        return out

    def near(self, i: int, least: int) -> np.ndarray:
        """The members, but ``i``, that agree with it in ``least`` bytes: they surround it in the order."""
        p, n = int(self.place[i]), len(self.order)
        ends = []
        for there in (self.common[p + 1 :], self.common[p:0:-1]):
            size = 16
            while True:
                low = np.flatnonzero(there[:size] < least)
                if len(low) or size >= len(there):
                    break
                size *= 4
            ends.append(int(low[0]) if len(low) else len(there))
        return np.r_[self.order[max(0, p - ends[1]) : p], self.order[p + 1 : min(n, p + 1 + ends[0])]]

    def most(self) -> np.ndarray:
        """Each member's longest common prefix with any other of its group (-1 if it is alone)."""
        after = np.r_[self.common[1:], np.int16(-1)] if len(self.common) else self.common
        before = self.common.copy()
        before[:1] = -1
        out = np.empty(len(self.order), np.int16)
        out[self.order] = np.maximum(before, after)
        return out


#: Neighbours on either side, in both orders, that are tried before a member meets all that could still matter.
NEIGHBOURS = 3


def match_contexts(group: np.ndarray, counts: np.ndarray, lefts: list[bytes], rights: list[bytes], length: int, same: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """For each context the most bytes left and right of its anchor that windows shared with others cover.

    ``group`` is sorted; the rights of a group agree in their first ``same`` bytes. Contexts with a count
    over one need no answer and get -1, as do those that share no window. A member is done when what it
    found meets the bounds that its neighbours in the two orders set; else it meets all that agree with it
    further than what was found, which lie around it in either order.
    """
    n = len(group)
    order, common = deep_shallow_sort([x[same:] for x in rights], group)
    right = _Prefixes(order, np.where(common >= 0, common + same, -1))
    left = _Prefixes(*deep_shallow_sort([x[::-1] for x in lefts], group))
    best_l, best_r = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    most_l, most_r = left.most(), right.most()
    open_ = np.flatnonzero((counts <= 1) & (most_l >= 0) & (most_l.astype(np.int64) + most_r >= length))

    def meet(i: np.ndarray, j: np.ndarray) -> None:
        l, r = left.of(i, j).astype(np.int64), right.of(i, j).astype(np.int64)
        hit = l + r >= length
        i, l, r = i[hit], l[hit], r[hit]
        best_l[i] = np.maximum(best_l[i], l)
        best_r[i] = np.maximum(best_r[i], r)

    def meet_one(i: int, j: np.ndarray) -> None:
        l, r = left.of(np.full(len(j), i), j).astype(np.int64), right.of(np.full(len(j), i), j).astype(np.int64)
        hit = l + r >= length
        if hit.any():
            best_l[i] = max(best_l[i], int(l[hit].max()))
            best_r[i] = max(best_r[i], int(r[hit].max()))

    for step in range(1, NEIGHBOURS + 1):
        for side in (left, right):
            for sign in (step, -step):
                at = side.place[open_] + sign
                ok = (at >= 0) & (at < n)
                i, j = open_[ok], side.order[at[ok]]
                ok = group[i] == group[j]
                meet(i[ok], j[ok])
        open_ = open_[(best_l[open_] < most_l[open_]) | (best_r[open_] < most_r[open_])]
        if not len(open_):
            return best_l, best_r
    for i in open_.tolist():
        # only members that agree further than what was found, and far enough for a window, can still matter
        for side, best, other in ((left, best_l, most_r), (right, best_r, most_l)):
            j = side.near(i, max(int(best[i]) + 1, length - int(other[i])))
            if len(j):
                meet_one(i, j)
    return best_l, best_r


def _found_rows(length: int, gram: int):
    def run(part: pa.Table) -> pa.RecordBatch | None:
        keys = np.stack([part.column(k).to_numpy().astype(np.int64) for k in ("h", "lo", "hi")])
        group = np.r_[0, np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))]
        counts = part.column("n").to_numpy()
        l, r = match_contexts(group, counts, part.column("left").to_pylist(), part.column("right").to_pylist(), length, gram)
        at = np.flatnonzero(l >= 0)
        if not len(at):
            return None
        cols = [pa.array(part.column(k).to_numpy()[at]) for k in ("h", "c")] + [pa.array(x[at].astype(np.int32)) for x in (l, r)]
        return pa.RecordBatch.from_arrays(cols, schema=arrow_schema(FOUND))

    return run


def merge(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of intervals as maximal runs."""
    out: list[list[int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, t, spans``: for each document with repeated strings the intervals of its bytes that go.

    ``docs`` has ``doc_id, text, t`` where ``t`` is xxhash64 of the text. Rows equal in both are copies
    of each other and share one row here.
    """
    if not 0 < gram <= length:
        raise ValueError("the gram must fit into the length")
    found = materialise(map_arrow(docs, _anchor_rows(length, gram), ANCHOR), "suffix-anchors")
    again = found.groupBy("h").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("h").alias("_h"))
    # written before the join, which adaptive execution can then split where a gram is very common
    again = materialise(again, "suffix-again")
    kept = materialise(found.join(again.hint("merge"), F.col("h") == F.col("_h")).drop("_h"), "suffix-repeated")
    discard(found)
    contexts = kept.groupBy("h", "c").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "t", "pos")).alias("one"))
    contexts = materialise(contexts, "suffix-contexts")
    several = contexts.groupBy("h").agg(F.count("*").alias("_m"), F.min("n").alias("_least"))
    several = several.where("_m > 1 and _least = 1").select(F.col("h").alias("_h"), F.expr(f"cast(ceil(_m / {BLOCK}) as int)").alias("blocks"))
    several = materialise(several, "suffix-several")

    def texts_with(grams: DataFrame) -> DataFrame:
        """``doc_id, t, text, wanted``: one document for each context of these grams, with its places."""
        wanted = contexts.join(grams, F.col("h") == F.col("_h"))
        wanted = wanted.groupBy(F.col("one.doc_id").alias("_doc"), F.col("one.t").alias("_t")).agg(
            F.collect_list(F.struct(F.col("one.pos").alias("pos"), "h", "c", "n", "blocks")).alias("wanted")
        )  # a document's own anchors: as many as its bytes allow
        same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("t") == F.col("_t"))
        # texts are always dealt by id: broadcasts would do for small tables only
        return docs.join(wanted.hint("merge"), same).select("doc_id", "t", "text", "wanted")

    cut = texts_with(several.where(F.col("blocks") <= MOST_BLOCKS)).mapInArrow(_context_rows(length, gram), CONTEXT)
    cut = cut.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    cut = cut.select("h", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "c", "n", "left", "right")
    matched = map_groups(cut, ["h", "lo", "hi"], _found_rows(length, gram), FOUND)
    frequent = several.where(F.col("blocks") > MOST_BLOCKS)
    windows = None
    if not frequent.isEmpty():
        windows = materialise(texts_with(frequent).mapInArrow(_window_rows(length, gram), WINDOW), "suffix-windows")
        twice = windows.groupBy("w").agg(F.min("c").alias("_a"), F.max("c").alias("_b")).where("_a <> _b")
        # written before the join, which adaptive execution can then split where a window is very common
        twice = materialise(twice.select(F.col("w").alias("_w")), "suffix-twice")
        shared = windows.join(twice.hint("merge"), F.col("w") == F.col("_w"))
        matched = matched.unionByName(shared.select("h", "c", "l", (F.lit(length) - F.col("l")).alias("r")))
    matched = matched.groupBy("h", "c").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    whole = contexts.where("n > 1").select("h", "c", F.lit(length - gram).alias("l"), F.lit(length).alias("r"))
    cover = materialise(whole.unionByName(matched).select(F.col("h").alias("_h"), F.col("c").alias("_c"), "l", "r"), "suffix-cover")
    spans = kept.join(cover.hint("merge"), (F.col("h") == F.col("_h")) & (F.col("c") == F.col("_c")))
    spans = spans.select("doc_id", "t", F.greatest(F.lit(0), F.col("pos") - F.col("l")).alias("a"), (F.col("pos") + F.col("r")).alias("b"))
    spans = materialise(spans.groupBy("doc_id", "t").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "suffix-spans")
    for stored in (kept, contexts, several, cover, *([windows, twice] if windows is not None else ())):
        discard(stored)
    return spans


DEDUPED = struct_of("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")


def cut_text(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The bytes without the spans, how many went, in how many maximal runs."""
    runs = merge([(a, min(b, len(raw))) for a, b in spans])
    kept, at = [], 0
    for a, b in runs:
        kept.append(raw[at:a])
        at = b
    kept.append(raw[at:])
    return b"".join(kept), sum(b - a for a, b in runs), len(runs)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row; the kept text too, if asked.

    Texts are UTF-8 bytes, null as empty; matches never cross documents; a text shorter than ``length``
    loses nothing; of copies every one loses the whole, as there is no first among ties. Repeated rows are
    copies of each other; null ids are no special case; an empty table gives no rows; texts of any length are
    read whole. The kept text drops what cutting left of a character. ``carry`` names string columns of
    ``docs`` to pass on; other columns are not read, so names that clash do no harm.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(F.col(c).cast("string").alias(c) for c in carry))
    rows = rows.withColumn("t", F.xxhash64("text"))
    spans = repeated_spans(rows.select("doc_id", "text", "t"), length, gram)
    spans = spans.select(F.col("doc_id").alias("_doc"), F.col("t").alias("_t"), "spans")
    joined = rows.join(spans.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("t") == F.col("_t")), "left")
    base = DEDUPED.fields if with_text else DEDUPED.fields[:5]
    schema = type(DEDUPED)([*base, *(f for f in rows.schema if f.name in carry)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, found in zip(texts(batch), batch.column("spans").to_pylist(), strict=True):
            raw = _raw(text)
            kept, removed, n = cut_text(raw, [(s["a"], s["b"]) for s in found or ()])
            out.append((len(raw), removed, n, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
        out_schema = arrow_schema(schema)
        made = [pa.array([o[k] for o in out], out_schema.field(k + 1).type) for k in range(len(base) - 1)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *made, *(batch.column(c) for c in carry)], schema=out_schema)

    return map_arrow(joined.select("doc_id", "text", "spans", *carry), run, schema)


def op7_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """``remove_repeats`` of ``documents`` for 200 bytes; cases as stated there."""
    return remove_repeats(table(spark, sf_dir, "documents"))
