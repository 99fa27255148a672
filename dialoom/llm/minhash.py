"""Near-duplicate documents: MinHash bands, signatures, exact sets, connected components.

1. Each document's set of word shingles gives ``BANDS * ROWS`` minima of universal hashes. Documents
   with equal sets are one class from here on, so copies cost one row each and no pair.
2. In every bucket (equal minima of one band) each class meets the bucket's head, its least class: a star,
   as many rows as members. Signatures pass over hopeless pairs; for the others the exact intersection of
   the full sets decides. Heads travel once to each chunk of their members, so a cluster of near copies,
   however large, costs its size. Large-star and small-star turn the confirmed links into labels.
3. Only buckets whose other members still have different labels need more. There signatures are compared
   pair by pair, inside bounded blocks, and a spanning forest of the pairs that could be links makes tight
   families; in these, products of 0/1 matrices give exact intersections, again block by block, for pairs
   of different labels only. Rows out stay below rows in.
4. Components of all confirmed links name the groups.

A link at similarity 0.85 is missed if the two share no bucket, probability (1 - 0.85**5)**26 < 3e-7, or if
the signatures disagree by more than SLACK, below 1e-8; at 0.80 the two are 4e-5 and below 1e-6.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, discard, map_arrow, map_groups, materialise, struct_of, table, texts
from .components import components

SHINGLE_WORDS = 5
BANDS, ROWS = 26, 5
#: Classes of a family in one block; a task compares two blocks.
BLOCK = 256
#: Set items of a family in one block, on average, and in one step of a task.
BLOCK_ITEMS = 1 << 20
PART_ITEMS = 1 << 19
#: Members of a head in one chunk.
CHUNK = 128
#: Signatures that agree in less than the threshold minus this share are taken for no link: over five
#: standard deviations of the estimate over 130 minima.
SLACK = 0.20
_M1, _M2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def _mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64, on a copy."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_M1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_M2)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words of the text with A-Z lower-cased.

    A text with fewer words is one shingle; one without words has none.
    """
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six white-space bytes only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(size, len(h))
    odd = np.uint64(0x9E3779B97F4A7C15)
    total = np.full(len(h) - n + 1, np.uint64(n))
    for k in range(n):
        total = _mix(total * odd + h[k : len(h) - n + 1 + k])
    return np.unique(total)


@functools.cache
def _universal(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    a, b = rng.integers(0, 2**63, (2, count), dtype=np.uint64)
    return a * np.uint64(2) + np.uint64(1), b * np.uint64(2) + np.uint64(1)


def minima(items: np.ndarray, count: int = BANDS * ROWS) -> np.ndarray:
    """The least value of each of ``count`` multiply-add hashes over a non-empty set."""
    a, b = _universal(count)
    least = np.full(count, np.uint64(2**64 - 1))
    for k in range(0, len(items), 512):
        values = np.multiply.outer(a, items[k : k + 512])
        values += b[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band; keys of different bands differ."""
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + least[k : bands * rows : rows])
    return key.view(np.int64)


def fingerprint(items: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(items.tobytes())


SKETCH = struct_of("row long, doc_id long, n_shingles long, fp binary, bands array<long>, signature binary")
MEMBER = struct_of("k long, items binary")
PAIR = struct_of("u long, v long")


def _table_of(rows: list[tuple], schema) -> pa.RecordBatch:
    out = arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(out)], schema=out)


def _sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for row, doc, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), texts(batch), strict=True):
        s = shingles(text)
        if len(s):
            least = minima(s)
            rows.append((row, doc, len(s), fingerprint(s), band_keys(least), signature_of(least)))
        else:
            rows.append((row, doc, 0, None, None, None))
    return _table_of(rows, SKETCH)


def signature_of(least: np.ndarray) -> bytes:
    """A byte of each minimum: equal minima have equal bytes, others by chance in one of 256."""
    return (least >> np.uint64(32)).astype(np.uint8).tobytes()


def _member(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for k, fp, text in zip(*(batch.column(c).to_pylist() for c in ("k", "fp", "text")), strict=True):
        s = shingles(text or "")
        if fingerprint(s) == fp:  # of rows that share an id, those that stand for the class
            rows.append((k, s.tobytes()))
    return _table_of(rows, MEMBER)


def _least_agreement(percent: int, places: int) -> float:
    return (percent / 100 - SLACK) * places


def _signatures(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)


def _alike(percent: int):
    """Pairs whose signatures leave a link possible."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = _signatures(batch.column("sa")), _signatures(batch.column("sb"))
        keep = pa.array((a == b).sum(axis=1) >= _least_agreement(percent, a.shape[1]))
        return pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("u", "v")], schema=arrow_schema(PAIR))

    return run


def is_link(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar enough: ``100 * intersection >= percent * union``."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    shared = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _confirm(percent: int):
    """Rows sorted so that a head's set goes before its members': one set is held at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held = None, np.empty(0, np.uint64)
        for batch in batches:
            found = []
            for v, u, items in zip(*(batch.column(c).to_pylist() for c in ("head", "k", "items")), strict=True):
                s = np.frombuffer(items, np.uint64)
                if u == v:
                    head, held = v, s
                elif head == v and is_link(s, held, percent):
                    found.append((u, v))
            if found:
                yield _table_of(found, PAIR)

    return run


class _Forest:
    """Union-find over the places of one task's rows."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = self.parent[self.parent[k]]
            k = self.parent[k]
        return k

    def join(self, i: int, j: int) -> bool:
        """Whether the two were apart."""
        a, b = self.find(i), self.find(j)
        self.parent[a] = b
        return a != b


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)), np.int16)
    for k in range(a.shape[1]):
        out += a[:, k][:, None] == b[:, k]
    return out


def _possible(percent: int):
    """For groups ``bucket, lo, hi`` a forest of the pairs of different labels that could be links."""

    def run(part: pa.Table) -> pa.RecordBatch | None:
        keys = np.stack([part.column(c).to_numpy().astype(np.int64) for c in ("bucket", "lo", "hi")])
        starts = np.r_[0, 1 + np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)), part.num_rows]
        ids, labels, sizes, own = (part.column(c).to_numpy() for c in ("k", "label", "n", "own"))
        signatures = _signatures(part.column("signature"))
        least = _least_agreement(percent, signatures.shape[1])
        out = []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            lo, hi = keys[1, a], keys[2, a]
            left = np.arange(a, b) if lo == hi else a + np.flatnonzero(own[a:b] == lo)
            right = left if lo == hi else a + np.flatnonzero(own[a:b] == hi)
            if not len(left) or not len(right) or (labels[a:b] == labels[a]).all():
                continue
            x, y = sizes[left][:, None], sizes[right]
            able = (labels[left][:, None] != labels[right]) & (100 * np.minimum(x, y) >= percent * np.maximum(x, y))
            able &= _agreement(signatures[left], signatures[right]) >= least
            forest = _Forest(b - a)
            for i, j in np.argwhere(able):
                if forest.join(int(left[i]) - a, int(right[j]) - a):
                    out.append((int(ids[left[i]]), int(ids[right[j]])))
        return _table_of(out, PAIR) if out else None

    return run


def block_links(
    ids: list[int], signatures: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None, percent: int, labels: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """A spanning forest of the links between the members of side 0 and those of side 1 (or all, if one block).

    ``side`` is None for a block with itself. A link: ``100 * intersection >= percent * union``. Signatures
    only choose the rows and columns of the product. Members of one label need no link.
    """
    left = np.arange(len(ids)) if side is None else np.flatnonzero(side == 0)
    right = left if side is None else np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return []
    wanted = np.ones((len(left), len(right)), bool) if side is not None else np.tri(len(left), dtype=bool).T ^ np.eye(len(left), dtype=bool)
    if labels is not None:
        wanted &= labels[left][:, None] != labels[right]
    able = wanted & (_agreement(signatures[left], signatures[right]) >= _least_agreement(percent, signatures.shape[1]))
    left_on, right_on = able.any(axis=1), able.any(axis=0)
    wanted, left, right = wanted[left_on][:, right_on], left[left_on], right[right_on]
    if not len(left):
        return []
    used = np.unique(np.concatenate([left, right]))
    lengths = np.array([len(x) for x in sets])
    row_l, row_r = np.full(len(ids), -1), np.full(len(ids), -1)
    row_l[left], row_r[right] = np.arange(len(left)), np.arange(len(right))
    shared = np.zeros((len(left), len(right)), np.float32)
    # sets are sorted and hashes uniform: equal ranges of the hash space hold about equal parts of all sets
    parts = 1 + int(lengths[used].sum()) // PART_ITEMS
    bounds = [np.uint64(k * 2**64 // parts) for k in range(1, parts)]
    cuts = {k: np.r_[0, np.searchsorted(sets[k], np.array(bounds, np.uint64)), lengths[k]] for k in used}
    for p in range(parts):
        slices = [sets[k][cuts[k][p] : cuts[k][p + 1]] for k in used]
        owner = np.repeat(used, [len(x) for x in slices])
        items = np.concatenate(slices)
        order = np.argsort(items, kind="stable")
        items, owner = items[order], owner[order]
        new = np.r_[True, items[1:] != items[:-1]] if len(items) else np.empty(0, bool)
        uses = np.diff(np.r_[np.flatnonzero(new), len(items)])
        keep = np.repeat(uses > 1, uses)  # an item of one member is in no intersection
        column = np.repeat(np.cumsum(uses > 1) - 1, uses)[keep]
        owner = owner[keep]
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            at = slice(*np.searchsorted(column, (first, first + 4096)))
            o, c = owner[at], column[at] - first
            x, y = np.zeros((len(left), 4096), np.float32), np.zeros((len(right), 4096), np.float32)
            on = row_l[o] >= 0
            x[row_l[o[on]], c[on]] = 1
            on = row_r[o] >= 0
            y[row_r[o[on]], c[on]] = 1
            shared += x @ y.T
    shared = np.rint(shared).astype(np.int64)
    union = lengths[left][:, None] + lengths[right] - shared
    forest = _Forest(len(ids))
    links = ((int(left[i]), int(right[j])) for i, j in np.argwhere(wanted & (100 * shared >= percent * union)))
    return [(ids[i], ids[j]) for i, j in links if forest.join(i, j)]


def _grid(rows: DataFrame, group: str) -> DataFrame:
    """Rows of a group with ``blocks``, once for each block that theirs meets: ``lo, hi, own``."""
    own = F.pmod(F.xxhash64("k", F.lit(5)), F.col("blocks")).cast("int")
    met = rows.withColumn("own", own).withColumn("_other", F.explode(F.expr("sequence(0, blocks - 1)")))
    return met.withColumn("lo", F.least("own", "_other")).withColumn("hi", F.greatest("own", "_other")).drop("_other", "blocks")


def _sets(rows: DataFrame, classes: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """``k, items`` of the classes in ``nodes`` (node): their full sets, made from the texts again."""
    wanted = nodes.join(classes, F.col("node") == F.col("k")).select("k", "owner", F.col("_fp").alias("fp"))
    # always dealt by id: a broadcast of the classes would do for small tables only
    chosen = rows.join(wanted.hint("merge"), F.col("doc_id") == F.col("owner")).select("k", "fp", "text")
    return materialise(map_arrow(chosen, _member, MEMBER), name)


def _star_links(stars: DataFrame, sketches: DataFrame, classes: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Confirmed links ``u, v`` between members of buckets and their heads."""
    marks = sketches.select("row", "n_shingles", "signature")
    of_u, of_v = (marks.select(F.col("row").alias(f"_{c}"), F.col("n_shingles").alias(f"n{c}"), F.col("signature").alias(f"s{c}")) for c in "ab")
    pairs = stars.select(F.col("k").alias("u"), F.col("head").alias("v")).distinct()
    pairs = pairs.join(of_u, F.col("u") == F.col("_a")).join(of_v, F.col("v") == F.col("_b"))
    pairs = pairs.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("u", "v", "sa", "sb")
    pairs = materialise(map_arrow(pairs, _alike(percent), PAIR), "minhash-pairs")
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    members = _sets(rows, classes, nodes, "minhash-members")
    heads = materialise(pairs.groupBy(F.col("v").alias("head")).agg(F.expr(f"cast(ceil(count(*) / {CHUNK}) as int) as chunks")), "minhash-heads")
    dealt = pairs.join(heads, F.col("v") == F.col("head")).select("head", F.pmod(F.xxhash64("u"), F.col("chunks")).cast("int").alias("chunk"), F.col("u").alias("_k"))
    leads = heads.select("head", F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk"), F.col("head").alias("_k"))
    dealt = dealt.unionByName(leads).join(members, F.col("_k") == F.col("k")).select("head", "chunk", "k", "items")
    first = (F.col("k") != F.col("head")).alias("_first")
    ordered = dealt.repartition("head", "chunk").sortWithinPartitions("head", "chunk", first)
    links = materialise(ordered.mapInArrow(_confirm(percent), PAIR), "minhash-star-links")
    discard(members)
    return links


def _other_links(stars: DataFrame, labels: DataFrame, sketches: DataFrame, classes: DataFrame, rows: DataFrame, percent: int) -> DataFrame | None:
    """Confirmed links between members of one bucket, none its head, that have different labels so far."""
    several = stars.where("members > 2").join(labels.withColumnRenamed("node", "_node"), F.col("k") == F.col("_node"), "left")
    several = several.select("bucket", "k", F.coalesce("component", "k").alias("label"))
    mixed = several.groupBy("bucket").agg(F.min("label").alias("_low"), F.max("label").alias("_high"), F.expr(f"cast(ceil(count(*) / {BLOCK}) as int) as blocks"))
    mixed = materialise(mixed.where("_low < _high").select(F.col("bucket").alias("_bucket"), "blocks"), "minhash-mixed")
    marks = sketches.select("row", F.col("n_shingles").alias("n"), "signature")
    open_ = several.join(mixed, F.col("bucket") == F.col("_bucket")).join(marks, F.col("k") == F.col("row"))
    open_ = _grid(open_.select("bucket", "blocks", "k", "label", "n", "signature"), "bucket")
    possible = materialise(map_groups(open_, ["bucket", "lo", "hi"], _possible(percent), PAIR), "minhash-possible")
    if possible.isEmpty():
        return None
    families = materialise(components(possible).select("node", F.col("component").alias("family")), "minhash-families")
    members = _sets(rows, classes, families.select("node"), "minhash-family-members")
    named = families.withColumnRenamed("node", "_k").join(labels.select(F.col("node").alias("_n"), F.col("component").alias("_c")), F.col("_k") == F.col("_n"), "left")
    named = named.select("_k", "family", F.coalesce("_c", "_k").alias("label")).join(marks, F.col("_k") == F.col("row"))
    full = members.join(named, F.col("k") == F.col("_k")).select("k", "family", "label", "signature", "items")
    sizes = full.groupBy("family").agg(F.count("*").alias("_n"), F.sum(F.octet_length("items")).alias("_b"))
    sizes = sizes.select(F.col("family").alias("_family"), F.expr(f"cast(ceil(greatest(_n / {BLOCK}, _b / {8 * BLOCK_ITEMS})) as int)").alias("blocks"))
    grid = _grid(full.join(sizes, F.col("family") == F.col("_family")).drop("_family"), "family")

    def link(group: pa.Table) -> pa.Table:
        ids = group.column("k").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in group.column("items").to_pylist()]
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        side = None if lo == hi else (group.column("own").to_numpy() == hi).astype(int)
        found = block_links(ids, _signatures(group.column("signature")), sets, side, percent, group.column("label").to_numpy())
        return pa.Table.from_batches([_table_of(found, PAIR)])

    # dealt by pair of blocks: the joins above leave whole families together
    links = materialise(grid.repartition("family", "lo", "hi").groupBy("family", "lo", "hi").applyInArrow(link, PAIR), "minhash-other-links")
    discard(members)
    return links


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the least id that links reach; a document without words (null and empty texts too) is
    linked with nothing. Rows are compared each by its own text: repeated rows are copies, and rows that share
    an id but no text are not linked by it. Rows without an id belong to the component of their text, which is
    null if no row with an id has the same set of shingles. An empty table gives no rows. Other columns are
    not read, so names that clash do no harm; whole texts are read, however long.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketches = materialise(map_arrow(rows.withColumn("row", F.monotonically_increasing_id()), _sketch, SKETCH), "minhash-sketches")
    one = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    classes = sketches.where("fp is not null").groupBy("fp").agg(one.alias("one"))
    classes = materialise(classes.select(F.col("fp").alias("_fp"), F.col("one.row").alias("k"), F.col("one.doc_id").alias("owner")), "minhash-classes")
    owned = classes.where("owner is not null").select("_fp", "k")
    heads = sketches.join(owned, (F.col("fp") == F.col("_fp")) & (F.col("row") == F.col("k"))).select("k", F.explode("bands").alias("bucket"))
    least = heads.groupBy("bucket").agg(F.min("k").alias("head"), F.count("*").alias("members"))
    # written before the join, which adaptive execution can then split where a bucket is very full
    least = materialise(least.where("members > 1").withColumnRenamed("bucket", "_bucket"), "minhash-buckets")
    stars = heads.join(least, F.col("bucket") == F.col("_bucket")).where("k <> head").drop("_bucket")
    stars = materialise(stars, "minhash-stars")
    links = _star_links(stars, sketches, classes, rows, percent)
    groups = components(links)
    others = _other_links(stars, groups, sketches, classes, rows, percent)
    if others is not None and not others.isEmpty():
        groups = components(links.unionByName(others))
    discard(stars)
    member = classes.join(groups, F.col("k") == F.col("node"), "left").select("_fp", "owner", F.coalesce("component", "k").alias("group"))
    member = materialise(member, "minhash-groups")
    names = materialise(member.groupBy("group").agg(F.min("owner").alias("name")).withColumnRenamed("group", "_group"), "minhash-names")
    named = member.join(names, F.col("group") == F.col("_group")).select("_fp", "name")
    out = sketches.select("doc_id", "n_shingles", "fp").join(named, F.col("fp") == F.col("_fp"), "left")
    component = F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("name"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op10_minhash_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """``near_duplicates`` of ``documents`` at 0.85; cases as stated there."""
    return near_duplicates(table(spark, sf_dir, "documents"))
