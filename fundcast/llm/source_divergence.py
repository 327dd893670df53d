"""Which terms and which other sources set a (lang, source) group apart.

Terms are letter runs. Every lang keeps the terms of at least ``MIN_DOCS`` of its
documents, V of them. A group, and a lang as a whole, gives a kept term the share
p = 1 + floor(10**9 * (count + 2) / (N + 2 V)), N being its occurrences of kept
terms. Two shares differ by f = floor((p - q)**2 / (p + q)); all of it is exact
integer arithmetic.

Sources (``pairs``): f summed over the kept terms, for every two sources of a lang.
Shares are packed by (lang, part of the terms, block of sources); a pair of blocks
adds what the terms with occurrences contribute beyond two groups without any, so
no term is spread over all sources of its lang.

Terms (``terms``): f grows with the group's count and falls with the lang's, so a
term that ``top`` others beat in higher group count, lower lang count and earlier
UTF-8 is not among the first ``top``. Every partition retains its skyband (the
terms that fewer than ``top`` others dominate), the skybands of a group are merged
in a stream, and only what is left is ranked, exactly.

Edge cases: null texts, langs and sources are ''; a text without terms still makes
its group; repeated rows count as documents of their own; ties go by UTF-8; with no
kept term every two sources of the lang have the value 0; an empty table gives an
empty result; other columns are ignored; texts are read whole, very long ones too.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundcast.llm import hashing, packed
from fundcast.session import cut_lineage

MIN_DOCS = 10
TOP = 10
#: Bytes of text that are counted at a time.
SLICE = 16 << 20
#: About as many kept terms and sources meet in one block.
PART_TERMS = 4096
BLOCK_SOURCES = 32
#: Rows that a skyband task holds beside its skybands.
HELD_ROWS = 400_000
_LETTER = np.zeros(256, np.uint8)  # what a byte becomes; 0 ends a term
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def _terms(column: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The terms of all texts in order, dictionary-encoded, and how many each text has."""
    raw, offsets = hashing._utf8(column)
    low = _LETTER[raw]
    inside = np.concatenate([[False], low > 0, [False]])
    begins, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    touch = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(raw))]
    touch = touch[inside[touch] & inside[touch + 1]]  # texts that touch without a break
    begins[touch] = ends[touch] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    at = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    data = low[low > 0]
    found = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(data)])
    return found.dictionary_encode(), np.diff(np.searchsorted(start, offsets, "left"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in packed.slices(batch, "text", SLICE):
            langs, sources = (part.column(c).fill_null("").dictionary_encode() for c in ("lang", "source"))
            wide = len(sources.dictionary) or 1
            group = langs.indices.to_numpy().astype(np.int64) * wide + sources.indices.to_numpy()
            terms, n = _terms(part.column("text"))
            size = len(terms.dictionary) or 1
            key = np.repeat(np.arange(part.num_rows, dtype=np.int64), n) * size + terms.indices.to_numpy()
            key, count = np.unique(key, return_counts=True)  # one entry for a document and term
            key, back = np.unique(group[key // size] * size + key % size, return_inverse=True)
            every = np.unique(group)  # a row without a term for each group, with or without terms
            of = np.concatenate([key // size, every])
            term = terms.dictionary.cast(pa.binary()).cast(pa.string()).take(pa.array(key % size))
            zeros = np.zeros(len(every), np.int64)
            out = pa.table({
                "lang": langs.dictionary.take(pa.array(of // wide)),
                "source": sources.dictionary.take(pa.array(of % wide)),
                "term": pa.chunked_array([term, pa.nulls(len(every), pa.string())]),
                "count": np.concatenate([np.bincount(back, count, len(key)).astype(np.int64), zeros]),
                "docs": np.concatenate([np.bincount(back, minlength=len(key)).astype(np.int64), zeros]),
            })
            yield from out.to_batches(max_chunksize=50_000)


def counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs): occurrences, and documents that hold the term;
    a null term for every group."""
    found = docs.select("lang", "source", "text").mapInArrow(
        _count, "lang string, source string, term string, count long, docs long"
    )
    return found.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: str, n: str, v: str) -> Column:
    """p of a count among n occurrences of v kept terms; 1 without kept terms."""
    return F.expr(f"if({v} = 0, 1L, 1 + (cast(1000000000 as decimal(18,0)) * ({count} + 2)) div ({n} + 2 * {v}))")


def difference(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


class Counted:
    """The counts of a table of documents, written once: ``groups`` (lang, source, n, v,
    p0: the share of a term without occurrences) and ``rows`` (lang, source, term, id,
    count, total, p, q: the shares in the group and in its lang) of the kept terms."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        with packed.small_batches(docs.sparkSession, 4000):
            found = cut_lineage(counts(docs), "term-counts")
        kept = found.where("term IS NOT NULL").groupBy("lang", "term").agg(
            F.sum("count").alias("total"), F.sum("docs").alias("docs")
        ).where(F.col("docs") >= min_docs).drop("docs")
        kept = cut_lineage(kept.withColumn("id", F.monotonically_increasing_id()), "kept-terms")
        langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
        rows = cut_lineage(found.drop("docs").join(kept, ["lang", "term"]), "group-terms")
        sizes = rows.groupBy("lang", "source").agg(F.sum("count").alias("n"))
        groups = found.where("term IS NULL").select("lang", "source").join(sizes, ["lang", "source"], "left")
        groups = groups.join(langs, "lang", "left").na.fill(0, ["n", "v", "lang_n"])
        sources = groups.groupBy("lang").agg(F.count("*").alias("n_sources"))
        self.groups = cut_lineage(groups.join(sources, "lang").withColumn("p0", share("0", "n", "v")), "groups")
        self.rows = rows.join(self.groups, ["lang", "source"]).withColumns(
            {"p": share("count", "n", "v"), "q": share("total", "lang_n", "v")}
        )


def _block(column: pa.ChunkedArray, row: int):
    """(ids, sources, code of each, p, p0 by code) of one packed block."""
    x = column[row].values
    name, key, p, p0 = (x.field(c) for c in ("source", "id", "p", "p0"))
    coded = name.dictionary_encode()
    code = coded.indices.to_numpy()
    zero = np.zeros(len(coded.dictionary), np.int64)
    zero[code] = p0.to_numpy()
    return key.to_numpy(), coded.dictionary.to_pylist(), code, p.to_numpy(), zero


def _matrix(ids: np.ndarray, block) -> np.ndarray:
    key, _, code, p, zero = block
    out = np.repeat(zero[None, :], len(ids), axis=0)
    out[np.searchsorted(ids, key), code] = p
    return out


def _beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every two sources of two blocks, f summed over the terms of either block,
    less what as many terms without occurrences would give."""
    for batch in batches:
        for row in range(batch.num_rows):
            a, b = _block(batch.column("xs"), row), _block(batch.column("ys"), row)
            ids = np.union1d(a[0], b[0])
            left, right = _matrix(ids, a), _matrix(ids, b)
            same = batch.column("same")[row].as_py()
            source, item, value = [], [], []
            for i, s in enumerate(a[1]):
                p = left[:, i : i + 1]
                f = ((p - right) * (p - right) // (p + right)).sum(axis=0)
                p0 = a[4][i]
                f -= len(ids) * ((p0 - b[4]) * (p0 - b[4]) // (p0 + b[4]))
                for t, x in zip(b[1], f.tolist()):
                    if s != t:
                        source.append(s)
                        item.append(t)
                        value.append(x)
            if not same:
                source, item, value = source + item, item + source, value + value
            lang = pa.array([batch.column("lang")[row].as_py()] * len(source), pa.string())
            yield pa.RecordBatch.from_arrays(
                [lang, pa.array(source, pa.string()), pa.array(item, pa.string()), pa.array(value, pa.int64())],
                names=["lang", "source", "item", "beyond"],
            )


def pairs(counted: Counted) -> DataFrame:
    """(lang, source, item, value): f summed over all kept terms, for every ordered
    pair of sources of a lang."""
    block = F.expr(f"pmod(xxhash64(source), cast(ceil(n_sources / {BLOCK_SOURCES}) as bigint))")
    part = F.expr(f"pmod(xxhash64(term), cast(ceil(v / {PART_TERMS}) as bigint))")
    blocks = counted.rows.withColumns({"block": block, "part": part}).groupBy("lang", "part", "block").agg(
        F.collect_list(F.struct("source", "id", "p", "p0")).alias("xs")
    )
    blocks = cut_lineage(blocks, "share-blocks")
    other = blocks.select("lang", "part", F.col("block").alias("block_b"), F.col("xs").alias("ys"))
    met = blocks.join(other, ["lang", "part"]).where("block <= block_b").select(
        "lang", "xs", "ys", (F.col("block") == F.col("block_b")).alias("same")
    )
    with packed.small_batches(blocks.sparkSession, 4):
        beyond = met.mapInArrow(_beyond, "lang string, source string, item string, beyond long")
        beyond = cut_lineage(
            beyond.groupBy("lang", "source", "item").agg(F.sum("beyond").alias("beyond")), "pair-sums"
        )
    g = counted.groups
    both = g.select("lang", "source", "v", "p0").join(
        g.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0")), "lang"
    ).where("source <> item")
    return both.join(beyond, ["lang", "source", "item"], "left").select(
        "lang", "source", "item",
        (F.col("v") * difference("p0", "q0") + F.coalesce("beyond", F.lit(0))).alias("value"),
    )


def skyband(count: np.ndarray, total: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Positions of the rows that fewer than ``k`` others dominate (count not lower,
    total not higher, term earlier). Rows come in falling count and rising total; a
    Fenwick tree over the totals holds the ``k`` earliest terms of every span. What
    is dominated is left out of it: its own dominators dominate whatever it would."""
    order = np.lexsort((term, total, -count))
    c, t = count[order], total[order]
    # of rows alike in both counts only the first k can stay
    new = np.concatenate([[True], (c[1:] != c[:-1]) | (t[1:] != t[:-1])]) if len(order) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    order = order[place < k]
    levels, level = np.unique(total[order], return_inverse=True)
    tree: list[list[int]] = [[] for _ in range(len(levels) + 1)]
    kept = []
    for row, at, x in zip(order.tolist(), (level + 1).tolist(), term[order].tolist()):
        beaten, i = 0, at
        while i and beaten < k:
            beaten += bisect_left(tree[i], x)
            i &= i - 1
        if beaten >= k:
            continue
        kept.append(row)
        i = at
        while i < len(tree):
            span = tree[i]
            if len(span) < k or x < span[-1]:
                insort(span, x)
                del span[k:]
            i += i & -i
    return np.array(kept, np.int64)


def _retain(table: pa.Table, k: int) -> pa.Table:
    """The rows of every (lang, source) group's skyband."""
    if not table.num_rows:
        return table
    table = table.combine_chunks()
    term = table.column("term").combine_chunks().dictionary_encode()
    rank = np.empty(len(term.dictionary), np.int64)
    rank[pc.array_sort_indices(term.dictionary).to_numpy()] = np.arange(len(rank))  # by UTF-8 bytes
    rank = rank[term.indices.to_numpy()]
    langs, sources = (table.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source"))
    group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
    order = np.argsort(group, kind="stable")
    count, total = table.column("count").to_numpy(), table.column("total").to_numpy()
    keep = [
        at[skyband(count[at], total[at], rank[at], k)]
        for at in np.split(order, np.flatnonzero(np.diff(group[order])) + 1)
    ]
    return table.take(pa.array(np.sort(np.concatenate(keep))))


def _bands(k: int):
    def retain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, new = [], 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            new += batch.num_rows
            if new >= HELD_ROWS:
                held, new = [_retain(pa.concat_tables(held), k)], 0
        if held:
            yield from _retain(pa.concat_tables(held), k).to_batches(max_chunksize=20_000)

    return retain


_BAND = "lang string, source string, term string, count long, total long, p long, q long"


def terms(counted: Counted, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): of every group, its first ``top`` terms whose
    share is above the lang's."""
    above = counted.rows.where((F.col("count") > 0) & (F.col("p") > F.col("q"))).select(
        "lang", "source", "term", "count", "total", "p", "q"
    )
    bands = above.mapInArrow(_bands(top), _BAND)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _bands(top)(batches)

    merged = bands.groupBy("lang", "source").applyInArrow(merge, _BAND)
    valued = merged.select("lang", "source", F.col("term").alias("item"), difference("p", "q").alias("value"))
    return ranked(valued).where(F.col("rank") <= top)


def ranked(valued: DataFrame) -> DataFrame:
    """``rank`` from 1 in each group by falling value, then by the item's UTF-8 bytes."""
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return valued.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` and ``term``."""
    counted = Counted(docs, min_docs)
    return ranked(pairs(counted)).withColumn("part", F.lit("pair")).unionByName(
        terms(counted, top).withColumn("part", F.lit("term"))
    ).select("lang", "source", "part", "item", "value", "rank")
