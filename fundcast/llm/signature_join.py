"""Exact Jaccard self-join of documents on word n-grams with signature trees.

Two documents link when the Jaccard similarity of their sets of ``N``-word
shingles is at least 3/4.

1. Every text becomes a set of 64-bit shingle hashes; documents with equal sets
   are one class from here on (told apart by a 64-bit fingerprint of the set, so
   copies cost one row each).
2. Shingles have an order, by hash, those known as frequent from one bounded
   table last. Of the first three eighths of its shingles a class shares at least
   a quarter with every class that it links with, so a class that shares fewer
   of them with others has no links and is done. Those left file themselves under
   the first quarter: linked classes share one of them (prefix principle).
3. Classes filed under the same shingle share a leader, the smallest of them; all
   classes with one leader form a cell, so that a group of near copies, which
   shares many shingles, is few cells. In every cell all members
   are first compared with one leader, exactly. A group of near copies is thus
   joined by as many comparisons as it has members. The leader, being compared
   with all, then leaves the cell. Cells that stay open draw a new leader once more.
4. Cells whose members are not all connected by then are cut into blocks that are
   joined by signature trees: nodes hold the OR of their members' shingle bitmaps, at
   1/NARROW of their width, and the range of their sizes; two trees are descended
   together, and a pair of nodes is dropped when the overlap that bitmaps and sizes
   allow is too small, or when all its members are connected already. Pairs that
   remain are verified exactly on the spot, and a task returns only links that
   connect what was apart: fewer than its members. First every block is joined with
   itself, its members taken in random order, so that a group of near copies becomes
   connected in as many comparisons as its blocks give; pairs of blocks follow for
   the cells that are still open.
5. Components of all links, smallest document first.

Cells of any size are cut into blocks, so no task holds a whole cell. No pair is
lost: bounds are upper bounds, and nothing is capped or sampled.

Edge cases: null and empty texts have no shingles and link with nothing; texts
of fewer words have one shingle, the whole sequence; repeated rows link with
each other; a null doc_id counts as larger than any other; very long texts are
read whole; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundcast.llm import hashing
from fundcast.llm.components import components
from fundcast.llm.packed import bits_of, bucket_bits, bucket_of, pack, slices, unpack
from fundcast.session import cut_lineage

N = 5
#: Shingles seen this often within PART_BYTES of text are reported as frequent.
LOCAL_HOT = 2
#: At most this many frequent shingles are broadcast: those above the share 1/FREQUENT
#: of all reported occurrences, of which there can be no more.
FREQUENT = 1 << 20
#: Filed shingles that one bucket holds on average (12 bytes each).
BUCKET_ROWS = 1 << 20
#: Text that a task shingles at once.
PART_BYTES = 8 << 20
#: Members of a block, members of a leaf.
BLOCK, LEAF = 512, 8
#: Bitmap bits of a block's members; sets of shingles take about twice as many bytes at most.
BLOCK_BITS = 1 << 23
#: Further rounds with new leaders before the trees.
ROUNDS = 1
#: Slices (as bits) of the bit table of classes that file themselves.
CHOSEN_BITS = 8
#: Whole bitmaps are this many times as wide as those that the trees are made of.
NARROW = 2

_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, n: int = N) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    words, bounds = hashing.words(texts)
    full = hashing.runs(words, n)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= n:
            x = np.sort(full[a : b - n + 1])
            new = x[1:] != x[:-1]
            out.append(x if new.all() else np.concatenate([x[:1], x[1:][new]]))
        else:
            out.append(hashing.runs(words[a:b], b - a) if b > a else full[:0])
    return out


def fingerprints(sets: list[np.ndarray]) -> np.ndarray:
    """Order-free 64-bit fingerprints of sets, as signed numbers; 0 for empty ones."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.zeros(len(sets), np.int64)
    some = sizes > 0
    if some.any():
        mixed = hashing.mix(np.concatenate(sets) ^ _MIX)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])[some]
        total = np.add.reduceat(mixed, starts) + sizes[some].astype(np.uint64)
        out[some] = (hashing.mix(total) | np.uint64(1)).view(np.int64)
    return out


def _distinct(sets: list[np.ndarray]) -> dict[int, np.ndarray]:
    """Fingerprint -> set of the non-empty ones."""
    return {fp: s for fp, s in zip(fingerprints(sets).tolist(), sets, strict=True) if len(s)}


def needed(a, b):
    """Smallest overlap of linked sets of these sizes: 3/7 of their sum, rounded up."""
    return (3 * (a + b) + 6) // 7


def prefix_length(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1


def long_prefix(n: int) -> int:
    return min(n, prefix_length(n) + n // 8)


def least_shared(n):
    """So many shingles of its long prefix a set of ``n`` shares with that of any set it
    links with: the first 1 + m // 8 common ones, m being the size of the smaller set,
    are in both long prefixes, and m is at least 3/4 of ``n``."""
    return 1 + (3 * n + 3) // 4 // 8


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every document (doc_id, its hash ``text``, fp, n, bits) and one for every
    shingle that is frequent within the batch (shingle in fp, its count in hot)."""
    for batch in _parts(batches):
        sets = shingle_sets(batch.column("text"))
        fps = [fp or None for fp in fingerprints(sets).tolist()]
        distinct = list({fp: s for fp, s in zip(fps, sets, strict=True) if fp is not None}.values())
        hot, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(distinct) >= LOCAL_HOT:
            hot, counts = np.unique(np.concatenate(distinct), return_counts=True)
            hot, counts = hot[counts >= LOCAL_HOT], counts[counts >= LOCAL_HOT]
        docs, k = batch.num_rows, len(hot)
        yield pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([batch.column("doc_id").cast(pa.int64()), pa.nulls(k, pa.int64())]),
                pa.concat_arrays([batch.column("text_hash"), pa.nulls(k, pa.int64())]),
                pa.concat_arrays([pa.array(fps, pa.int64()), pa.array(hot.view(np.int64))]),
                pa.array([len(s) for s in sets] + [0] * k, pa.int64()),
                pa.concat_arrays([pa.nulls(docs, pa.int64()), pa.array(counts.astype(np.int64))]),
                *(pa.array(x + [None] * k, pa.binary()) for x in _bitmaps(sets)),
            ],
            names=["doc_id", "text_hash", "fp", "n", "hot", "bits", "narrow"],
        )


def _frequent(seen: DataFrame) -> np.ndarray:
    """Frequent shingles, rarest first. Every one has more than 1/FREQUENT of the
    reported occurrences, so there are fewer than FREQUENT of them."""
    counts = cut_lineage(seen.where("hot is not null").groupBy("fp").agg(F.sum("hot").alias("n")), "hot-shingles")
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where(F.col("n") > total / FREQUENT).toArrow()
    fp, n = rows.column("fp").to_numpy().astype(np.int64), rows.column("n").to_numpy()
    return fp[np.lexsort((fp, n))].view(np.uint64)


def _file(docs: DataFrame, held, bits: int, length, chosen=None) -> DataFrame:
    """(bucket, shingles, fps, sizes): every class under the first ``length(n)`` of its
    shingles, packed by bucket of the shingle hash; with ``chosen`` only the classes
    that this bit table does not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            found = _distinct(shingle_sets(batch.column("text")))
            if chosen is not None:
                key = np.fromiter(found, np.int64, len(found)).view(np.uint64)
                keep = chosen.value.has(bucket_of(hashing.mix(key), CHOSEN_BITS), key)
                found = {fp: s for (fp, s), k in zip(found.items(), keep.tolist(), strict=True) if k}
            keys = [_prefix(s, length(len(s)), *held.value) for s in found.values()]
            times = [len(k) for k in keys]
            owner = np.repeat(np.fromiter(found, np.int64, len(found)), times)
            sizes = np.repeat(np.array([len(s) for s in found.values()], np.uint32), times)
            yield _packed(np.concatenate([np.zeros(0, np.uint64), *keys]), owner, sizes, bits)

    return docs.select("text").mapInArrow(run, "bucket long, shingles binary, fps binary, sizes binary")


def _filed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, fp, size) of a bucket, sorted, each once."""
    key, fp, n = (unpack(table, c, t) for c, t in (("shingles", np.uint32), ("fps", np.int64), ("sizes", np.uint32)))
    order = np.lexsort((fp, key))
    key, fp, n = key[order], fp[order], n[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (fp[1:] != fp[:-1])
    return key[new], fp[new], n[new]


def _shared(table: pa.Table, bits: int) -> pa.RecordBatch:
    """How many of the shingles that a class has in a bucket others have too, with its
    size, packed by bucket of the class."""
    key, fp, n = _filed(table)
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.concatenate([start, [len(key)]]))
    rows = np.repeat(size > 1, size)
    fp, first, shared = np.unique(fp[rows], return_index=True, return_counts=True)
    return pack(
        bucket_of(hashing.mix(fp.view(np.uint64)), bits),
        {"fps": fp, "sizes": n[rows][first], "shared": shared.astype(np.uint32)},
    )


def _enough(table: pa.Table) -> pa.Table:
    """(fp) of the classes that share enough shingles, over all buckets."""
    fp, n, shared = (unpack(table, c, t) for c, t in (("fps", np.int64), ("sizes", np.uint32), ("shared", np.uint32)))
    order = np.argsort(fp, kind="stable")
    fp, n, shared = fp[order], n[order].astype(np.int64), shared[order].astype(np.int64)
    start = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]])) if len(fp) else np.zeros(0, np.int64)
    total = np.add.reduceat(shared, start) if len(fp) else shared
    return pa.table({"fp": fp[start][total >= least_shared(n[start])]})


def _with_company(docs: DataFrame, held, bits: int) -> DataFrame:
    """(fp) of the classes that share enough shingles with others to have links."""
    shared = _file(docs, held, bits, long_prefix).groupBy("bucket").applyInArrow(
        lambda table: pa.Table.from_batches([_shared(table, bits)]), "bucket long, fps binary, sizes binary, shared binary"
    )
    return cut_lineage(shared.groupBy("bucket").applyInArrow(_enough, "fp long"), "company")


def _prefix(s: np.ndarray, length: int, known: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first ``length`` shingles of a set in filing order: by hash, frequent ones last."""
    if len(known):
        at = np.searchsorted(known, s)
        at[at == len(known)] = 0
        is_hot = known[at] == s
        if is_hot.any():
            hot = s[is_hot][np.argsort(rank[at[is_hot]], kind="stable")]
            s = np.concatenate([s[~is_hot], hot])
    return s[:length]


def _packed(key: np.ndarray, owner: np.ndarray, sizes: np.ndarray, bits: int) -> pa.RecordBatch:
    rest = (key >> np.uint64(32 - bits)).astype(np.uint32)  # the 32 bits after the bucket's; a tie costs a comparison
    return pack(bucket_of(key, bits), {"shingles": rest, "fps": owner, "sizes": sizes})


def _cells(table: pa.Table) -> pa.Table:
    """(cell, fp): the classes of a bucket that share a shingle, by the smallest of
    them; each once."""
    key, fp, _ = _filed(table)
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.concatenate([start, [len(key)]]))
    leader, rows = np.repeat(fp[start], size), np.repeat(size > 1, size)
    leader, fp = leader[rows], fp[rows]
    order = np.lexsort((fp, leader))
    leader, fp = leader[order], fp[order]
    new = np.ones(len(fp), bool)
    new[1:] = (leader[1:] != leader[:-1]) | (fp[1:] != fp[:-1])
    return pa.table({"cell": leader[new], "fp": fp[new]})


def _bitmap(shingles: np.ndarray) -> bytes:
    """Bits of a set: a power of two of them, at least four for each shingle."""
    width = max(64, 1 << int(4 * len(shingles) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(shingles & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _bitmaps(sets: list[np.ndarray]) -> tuple[list, list]:
    """The bitmaps of the sets, whole and narrow; null for empty ones."""
    whole = [_bitmap(s) if len(s) else None for s in sets]
    words = [np.frombuffer(x, np.uint64)[None] if x else None for x in whole]
    return whole, [None if x is None else _fold(x, max(1, x.shape[1] // NARROW)).tobytes() for x in words]


def _sets(docs: DataFrame, wanted: DataFrame, classes: DataFrame) -> DataFrame:
    """(fp, shingles) of the ``wanted`` classes, from one document of each. Texts are
    not shuffled: a bit table of a fixed size tells which documents to look at."""
    wanted = cut_lineage(wanted.distinct(), "wanted")
    chosen = classes.join(wanted, "fp", "left_semi").groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    buckets = 8
    held = docs.sparkSession.sparkContext.broadcast(bits_of(chosen.where("doc_id is not null"), "doc_id", buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            key = ids.fill_null(0).to_numpy().view(np.uint64)
            keep = held.value.has(bucket_of(hashing.mix(key), buckets), key) | ids.is_null().to_numpy(zero_copy_only=False)
            for part in _parts([batch.filter(pa.array(keep))]):
                found = _distinct(shingle_sets(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.keys(), pa.int64()), pa.array([x.tobytes() for x in found.values()], pa.binary())],
                    names=["fp", "shingles"],
                )

    made = docs.select("doc_id", "text").mapInArrow(run, "fp long, shingles binary").join(wanted, "fp", "left_semi")
    made = cut_lineage(made.groupBy("fp").agg(F.first("shingles").alias("shingles")), "sets")
    held.destroy()
    return made


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, "text", PART_BYTES)


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that sizes and bitmaps do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column("xa")[i].as_buffer(), np.uint64)[None]
                y = np.frombuffer(batch.column("xb")[i].as_buffer(), np.uint64)[None]
                w = min(x.shape[1], y.shape[1])
                x, y = _fold(x, w), _fold(y, w)
                most = min(n[i] - np.bitwise_count(x & ~y).sum(), m[i] - np.bitwise_count(y & ~x).sum())
                keep[i] = most >= needed(n[i], m[i])
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    sizes = classes.select("fp", "n")
    near = pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b").where("4 * na >= 3 * nb and 4 * nb >= 3 * na")
    near = cut_lineage(near, "near-pairs")  # bitmaps go with these only
    bits = classes.select("fp", "bits")
    joined = near.join(bits.toDF("b", "xb"), "b").join(bits.toDF("a", "xa"), "a")
    return cut_lineage(joined.select("a", "b", "na", "nb", "xa", "xb").mapInArrow(run, "a long, b long"), "possible")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets link, by their exact overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                keep.append(_linked_sets(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    return cut_lineage(joined.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long"), "links")


class Tree:
    """Signature tree over members in the given order; level 0 holds the leaves."""

    def __init__(self, sizes: np.ndarray, labels: np.ndarray, bits: np.ndarray):
        self.sizes, self.labels, self.bits = sizes, labels, bits
        cuts = np.arange(0, len(sizes), LEAF)
        slack = sizes - np.bitwise_count(bits).sum(1, dtype=np.int64)
        self.levels = [
            (
                np.bitwise_or.reduceat(bits, cuts, axis=0), np.minimum.reduceat(sizes, cuts), np.maximum.reduceat(sizes, cuts),
                np.maximum.reduceat(slack, cuts), np.minimum.reduceat(labels, cuts), np.maximum.reduceat(labels, cuts),
            )
        ]
        while len(self.levels[-1][0]) > 1:
            o, lo, hi, sl, l0, l1 = self.levels[-1]
            cuts = np.arange(0, len(o), 2)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(o, cuts, axis=0), np.minimum.reduceat(lo, cuts), np.maximum.reduceat(hi, cuts),
                    np.maximum.reduceat(sl, cuts), np.minimum.reduceat(l0, cuts), np.maximum.reduceat(l1, cuts),
                )
            )

    def node(self, level: int, i: int):
        return tuple(x[i] for x in self.levels[level])


def _may_link(p, q) -> bool:
    """Whether members of two nodes could link without being connected already."""
    o1, lo1, hi1, slack1, first1, last1 = p
    o2, lo2, hi2, slack2, first2, last2 = q
    if first1 == last1 == first2 == last2:
        return False
    if 4 * hi1 < 3 * lo2 or 4 * hi2 < 3 * lo1:
        return False
    most = int(np.bitwise_count(o1 & o2).sum()) + int(min(slack1, slack2))
    return min(most, int(hi1), int(hi2)) >= needed(int(lo1), int(lo2))


def dual_traversal(one: Tree, two: Tree, same: bool) -> Iterator[tuple[int, int]]:
    """Index pairs (i, j) of members that may link; i < j if the trees are the same."""
    stack = [(len(one.levels) - 1, 0, len(two.levels) - 1, 0)]
    while stack:
        a, i, b, j = stack.pop()
        if same and a == b and i > j or not _may_link(one.node(a, i), two.node(b, j)):
            continue
        if a or b:
            if a >= b:  # descend the taller side
                below = [(a - 1, k, b, j) for k in (2 * i, 2 * i + 1) if k < len(one.levels[a - 1][0])]
                if same and a == b:
                    below = [
                        (a - 1, k, b - 1, m) for _, k, _, _ in below for m in (2 * j, 2 * j + 1)
                        if m < len(two.levels[b - 1][0])
                    ]
                stack += below
            else:
                stack += [(a, i, b - 1, k) for k in (2 * j, 2 * j + 1) if k < len(two.levels[b - 1][0])]
            continue
        p, q = slice(i * LEAF, (i + 1) * LEAF), slice(j * LEAF, (j + 1) * LEAF)
        x, y = one.bits[p][:, None], two.bits[q][None]
        n, m = one.sizes[p][:, None], two.sizes[q][None]
        most = np.minimum(
            n - np.bitwise_count(x & ~y).sum(2, dtype=np.int64), m - np.bitwise_count(y & ~x).sum(2, dtype=np.int64)
        )
        good = (most >= needed(n, m)) & (one.labels[p][:, None] != two.labels[q][None])
        for u, v in zip(*np.nonzero(good), strict=True):
            u, v = int(u) + i * LEAF, int(v) + j * LEAF
            if not same or u < v:
                yield u, v


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps of half the width: both halves OR-combined (hashes modulo the width)."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def _linked_sets(s: np.ndarray, t: np.ndarray) -> bool:
    """Whether two sets of shingles link, by their exact overlap."""
    both = np.concatenate([s, t])
    both.sort()
    overlap = int((both[1:] == both[:-1]).sum())
    return 100 * overlap >= 75 * (len(both) - overlap)


def _join_blocks(table: pa.Table) -> pa.Table:
    """Links between two blocks of a cell (side 0 and 1), or within one, that connect
    all which link and are not connected by their labels: a link that joins members
    connected by those before it is left out."""

    def tree(side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
        t = table.filter(pa.compute.equal(table.column("side"), side))
        fp, n, label = (t.column(c).to_numpy() for c in ("fp", "n", "label"))
        order = np.lexsort((fp, n, label))
        raw = t.column("narrow").to_pylist()
        bits = np.stack([np.frombuffer(raw[i], np.uint64) for i in order]) if len(raw) else np.zeros((0, 1), np.uint64)
        sets = t.column("shingles").to_pylist()
        return fp[order], n[order], label[order], bits, [np.frombuffer(sets[i], np.uint64) for i in order]

    import pyarrow.compute  # noqa: F401

    one, two = tree(0), tree(1)
    same = not len(two[0])
    if same:
        two = one
    words = min(one[3].shape[1], two[3].shape[1])
    left = Tree(one[1], one[2], _fold(one[3], words))
    right = left if same else Tree(two[1], two[2], _fold(two[3], words))
    above = {x: x for x in np.concatenate([one[2], two[2]]).tolist()}  # label -> one that it is connected with

    def root(x: int) -> int:
        while above[x] != x:
            above[x] = x = above[above[x]]
        return x

    apart, pairs = len(above), []
    for i, j in dual_traversal(left, right, same):
        p, q = root(int(one[2][i])), root(int(two[2][j]))
        if p != q and _linked_sets(one[4][i], two[4][j]):
            above[p] = q
            pairs.append((int(one[0][i]), int(two[0][j])))
            apart -= 1
            if apart == 1:
                break
    a = np.array([min(p) for p in pairs], np.int64)
    b = np.array([max(p) for p in pairs], np.int64)
    return pa.table({"a": a, "b": b})


def _open(cells: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """(cell, fp, label, n) of the cells whose members are not all connected yet,
    without members that no other member of their cell comes near in size."""
    known = labels.select(F.col("node").alias("fp"), F.col("component").alias("label"))
    in_cell, by_size = Window.partitionBy("cell"), Window.partitionBy("cell").orderBy("n", "fp")
    return cut_lineage(
        cells.select("cell", "fp").join(classes.select("fp", "n"), "fp").join(known, "fp", "left")
        .withColumn("label", F.coalesce("label", "fp"))
        .withColumn("_p", F.lag("n").over(by_size)).withColumn("_q", F.lead("n").over(by_size))
        .withColumn("_0", F.min("label").over(in_cell)).withColumn("_1", F.max("label").over(in_cell))
        .where("_0 <> _1 and (4 * _p >= 3 * n or 4 * n >= 3 * _q)").drop("_p", "_q", "_0", "_1"),
        "open-cells",
    )


def _stars(opened: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, rest): pairs of every open cell's member with a leader drawn anew, in other
    words as many pairs as members: cells of one group of near copies draw different
    leaders; and the cells (cell, fp) without their leaders, which are then done."""
    lead = opened.groupBy("cell").agg(
        F.min(F.struct(F.xxhash64("cell", "fp", F.lit(turn)).alias("h"), "fp", "label")).alias("_l")
    )
    led = opened.join(lead, "cell")
    pairs = led.where(F.col("label") != F.col("_l.label")).select(
        F.least("fp", "_l.fp").alias("a"), F.greatest("fp", "_l.fp").alias("b")
    ).distinct()
    return pairs, led.where(F.col("fp") != F.col("_l.fp")).select("cell", "fp")


def _blocks(marked: DataFrame, classes: DataFrame, *order) -> DataFrame:
    """The members of open cells (``marked``) with their block, cut in this order."""
    members = marked.join(classes.select("fp", "width"), "fp")
    size = F.greatest(F.lit(LEAF), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_BITS) / F.col("width"))))
    place = F.row_number().over(Window.partitionBy("cell", "width").orderBy(*order)) - 1
    return cut_lineage(members.withColumn("block", F.floor(place / size)), "cell-members")


def _traversed(dealt: DataFrame, classes: DataFrame) -> DataFrame:
    """Links of the members dealt to pairs of blocks; bitmaps and sets join them now, not before."""
    return (
        dealt.select("pair", "side", "fp", "n", "label").join(classes.select("fp", "narrow", "shingles"), "fp")
        .groupBy("pair").applyInArrow(_join_blocks, "a long, b long").distinct()
    )


def _block_links(marked: DataFrame, classes: DataFrame) -> DataFrame:
    """Links of open cells by signature trees, of every block with itself: each member
    goes to one task, and blocks of random members connect most of what is connected."""
    members = _blocks(marked, classes, "fp")
    return _traversed(members.select(
        F.concat_ws(":", "cell", "width", "block").alias("pair"), F.lit(0).alias("side"), "fp", "n", "label"
    ), classes)


def _tree_pairs(marked: DataFrame, classes: DataFrame) -> DataFrame:
    """Links of open cells by signature trees, of all pairs of blocks."""
    members = _blocks(marked, classes, "label", "n", "fp")
    blocks = members.groupBy("cell", "width", "block").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("label").alias("l0"), F.max("label").alias("l1")
    )
    other = blocks.select(*[F.col(c).alias(f"{c}2") for c in blocks.columns])
    # blocks of one cell that sizes and labels do not rule out; a bitmap is at most
    # twice as wide as that of a set it may link with
    pairs = blocks.join(
        other,
        (F.col("cell") == F.col("cell2"))
        & ((F.col("width") < F.col("width2")) & (F.col("width2") <= 2 * F.col("width"))
           | (F.col("width") == F.col("width2")) & (F.col("block") <= F.col("block2")))
        & (4 * F.col("hi") >= 3 * F.col("lo2")) & (4 * F.col("hi2") >= 3 * F.col("lo"))
        & ~((F.col("l0") == F.col("l1")) & (F.col("l0") == F.col("l02")) & (F.col("l0") == F.col("l12"))),
    )
    itself = (F.col("width") == F.col("width2")) & (F.col("block") == F.col("block2"))
    sides = F.when(itself, F.array(F.struct(F.lit(0).alias("side"), F.col("width").alias("w"), F.col("block").alias("k")))).otherwise(
        F.array(
            F.struct(F.lit(0).alias("side"), F.col("width").alias("w"), F.col("block").alias("k")),
            F.struct(F.lit(1).alias("side"), F.col("width2").alias("w"), F.col("block2").alias("k")),
        )
    )
    wanted = pairs.select(
        F.col("cell"), F.concat_ws(":", "cell", "width", "block", "width2", "block2").alias("pair"), F.explode(sides).alias("s")
    ).select("cell", "pair", F.col("s.side").alias("side"), F.col("s.w").alias("width"), F.col("s.k").alias("block"))
    return _traversed(wanted.join(members, ["cell", "width", "block"]), classes)


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes, links): doc_id, text_hash, fp and n of every document (fp null without
    words), and verified links (a, b) between classes that connect all that link."""
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hashed = thin.withColumn("text_hash", text_hash(F.col("text")))
    seen = cut_lineage(
        hashed.mapInArrow(_classes, "doc_id long, text_hash long, fp long, n long, hot long, bits binary, narrow binary"), "classes"
    )
    classes = seen.where("hot is null").select("doc_id", "text_hash", "fp", "n")
    total = classes.agg(F.sum(F.floor(3 * F.col("n") / 8) + 1).alias("filed")).first()
    frequent = _frequent(seen)
    order = np.argsort(frequent, kind="stable")
    held = thin.sparkSession.sparkContext.broadcast((frequent[order], order))
    filed_bits = bucket_bits(total.filed or 0, BUCKET_ROWS)
    company = _with_company(thin, held, filed_bits)
    chosen = thin.sparkSession.sparkContext.broadcast(bits_of(company, "fp", CHOSEN_BITS))
    filed = _file(thin, held, filed_bits, prefix_length, chosen)
    cells = cut_lineage(filed.groupBy("bucket").applyInArrow(_cells, "cell long, fp long").distinct(), "cells")
    held.destroy()
    chosen.destroy()
    known = cut_lineage(
        seen.where("fp is not null and hot is null").join(cells.select("fp").distinct(), "fp", "left_semi")
        .groupBy("fp").agg(*[F.first(c).alias(c) for c in ("n", "bits", "narrow")], F.first(F.length("bits")).alias("width")),
        "cell-classes",
    )
    stars = cells.where("cell <> fp").select(F.col("cell").alias("a"), F.col("fp").alias("b"))
    found = _linked(_possible(stars, known), thin, classes)
    rest = cells.where("cell <> fp")  # a cell's leader is done
    for turn in range(ROUNDS):
        pairs, rest = _stars(_open(rest, components(found), known), turn)
        found = found.unionAll(_linked(_possible(pairs, known), thin, classes))
    opened = _open(rest, components(found), known)
    known_sets = known.join(_sets(thin, opened.select("fp"), classes), "fp")
    found = found.unionAll(cut_lineage(_block_links(opened, known_sets), "block-links"))
    opened = _open(opened.select("cell", "fp"), components(found), known)
    return classes, found.unionAll(cut_lineage(_tree_pairs(opened, known_sets), "tree-pairs"))


def _linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The links among ``pairs``, by exact overlaps."""
    wanted = pairs.select(F.col("a").alias("fp")).unionAll(pairs.select(F.col("b").alias("fp")))
    return _verified(pairs, _sets(docs, wanted, classes))


def text_hash(text: Column) -> Column:
    """Tells rows with one doc_id (or none) apart by their text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, class (of equal sets, null without shingles) and
    component_id: the smallest doc_id reachable by links, its own included."""
    classes, found = links(docs)
    label = components(found)
    placed = classes.join(
        label.select(F.col("node").alias("fp"), "component"), "fp", "left"
    ).withColumn("component", F.coalesce("component", "fp"))
    least = placed.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("_least"))
    return placed.join(least, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("_least")).alias("component_id"),
        F.col("fp").alias("class"), "component", "text_hash",
    )
