"""Benchmark decontamination by pigeonhole edit matching.

Every test item is split into one piece more than its error budget. If a
document contains the item with at most that many word errors, one piece is
intact, so exact piece hits find every candidate. A hit is verified with Myers'
bit-parallel edit distance over the words around it.

Texts are compared as lower-cased runs of letters and digits (any character
beyond ASCII counts as a letter), so spacing, case and punctuation do not
matter. Piece hits are found by rolling hashes over whole texts, one Arrow
batch at a time; documents are never shuffled. The test items are a stated
query set: they are read in blocks of at most ``BLOCK_ITEMS`` items and
``BLOCK_BYTES`` bytes, each block broadcast on its own.

Edge cases: null or empty texts, and items without a word, match nothing;
repeated documents or items each match on their own; of several places in one
document the one with the smallest distance (then the first) is reported; very
long texts are scanned whole; other columns, clashing names included, are left
out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundcast.llm import hashing

#: Word errors allowed per word of the item.
ERROR_RATE = 0.15
#: Words of a piece that are hashed; longer pieces are filed under their first ones.
KEY_WORDS = 8
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 64 << 20

SCHEMA = "doc_id long, item_id long, distance int, budget int, item_words int, first_word int, last_word int"


def budget_of(n_words: int, rate: float = ERROR_RATE) -> int:
    return int(n_words * rate)


def pieces(words: list, errors: int) -> list[tuple[int, int]]:
    """[start, end) of ``errors + 1`` pieces of nearly equal length."""
    cuts = [len(words) * i // (errors + 1) for i in range(errors + 2)]
    return list(zip(cuts, cuts[1:], strict=False))


def myers(pattern: list, text: list, errors: int) -> tuple[int, int]:
    """(distance, end) of the best approximate occurrence of ``pattern`` inside
    ``text`` with at most ``errors`` edits; (errors + 1, -1) if there is none.
    Bit-parallel: one column of the edit matrix per word, in two bit vectors."""
    m = len(pattern)
    where: dict = {}
    for i, w in enumerate(pattern):
        where[w] = where.get(w, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = errors + 1, -1
    for j, w in enumerate(text):
        eq = where.get(w, 0)
        cross = eq | down
        flat = (((eq & up) + up) ^ up) | eq
        right_up = down | ~(flat | up) & full
        right_down = up & flat
        if right_up & high:
            score += 1
        elif right_down & high:
            score -= 1
        # row 0 is free, so a match may begin anywhere in the text
        right_up <<= 1
        right_down <<= 1
        up = (right_down | ~(cross | right_up)) & full
        down = right_up & cross & full
        if score < best:
            best, end = score, j
    return best, end


class _Index:
    """Pieces of one block of items, filed by the hash of their first words."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items: list[tuple[int, list[int], int]] = []
        by_length: dict[int, list[tuple[int, int, int]]] = {}
        texts = pa.array([t or "" for _, t in items], pa.string())
        words, bounds = hashing.words(texts, hashing.ALNUM)
        for k, (item, _) in enumerate(items):
            own = words[bounds[k] : bounds[k + 1]]
            if not len(own):
                continue
            errors = budget_of(len(own), rate)
            self.items.append((item, own.tolist(), errors))
            for a, b in pieces(own, errors):
                n = min(b - a, KEY_WORDS)
                key = int(hashing.runs(own[a : a + n], n)[0])
                by_length.setdefault(n, []).append((key, len(self.items) - 1, a))
        self.by_length = {}
        for n, rows in by_length.items():
            rows.sort()
            keys = np.array([r[0] for r in rows], np.uint64)
            self.by_length[n] = (keys, hashing.Filter(keys), [r[1:] for r in rows])

    def hits(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(position in words, item, word offset of the piece in the item)."""
        for n, (keys, some, rows) in self.by_length.items():
            if len(words) < n:
                continue
            h = hashing.runs(words, n)
            for at in some.positions(h):
                lo = np.searchsorted(keys, h[at], "left")
                while lo < len(keys) and keys[lo] == h[at]:
                    yield int(at), *rows[lo]
                    lo += 1


def _scan(batches: Iterator[pa.RecordBatch], index: _Index) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        words, bounds = hashing.words(batch.column("text"), hashing.ALNUM)
        ids, hashes = batch.column("doc_id"), batch.column("text_hash")
        best: dict[tuple[int, int], tuple] = {}
        done: set = set()
        hits = sorted(index.hits(words))
        rows = np.searchsorted(bounds, [h[0] for h in hits], "right") - 1 if hits else []
        for (at, k, offset), row in zip(hits, rows, strict=True):
            lo, hi = int(bounds[row]), int(bounds[row + 1])
            item, pattern, errors = index.items[k]
            begin = at - offset
            # neighbouring pieces of one occurrence point to about the same window
            if (row, k, begin) in done:
                continue
            done.add((row, k, begin))
            a, b = max(lo, begin - errors), min(hi, begin + len(pattern) + errors)
            distance, end = myers(pattern, words[a:b].tolist(), errors)
            if distance <= errors:
                last = a + end - lo
                found = (distance, max(0, last - len(pattern) + 1), last)
                if (row, k) not in best or found < best[row, k]:
                    best[row, k] = found
        for (row, k), (distance, first, last) in best.items():
            item, pattern, errors = index.items[k]
            out.append((ids[int(row)].as_py(), item, distance, errors, len(pattern), first, last, hashes[int(row)].as_py()))
        columns = list(zip(*out, strict=True)) or [[]] * 8
        kinds = [pa.int64(), pa.int64()] + [pa.int32()] * 5 + [pa.int64()]
        names = [*(x.split()[0] for x in SCHEMA.split(", ")), "text_hash"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
        )


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for row in items.select("item_id", "text").where("text is not null").orderBy("item_id").toLocalIterator():
        block.append((row.item_id, row.text))
        size += len(row.text)
        if len(block) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def matches(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """One row per (document, item) that occurs in it within the error budget:
    doc_id, item_id, distance, budget, item_words, first_word, last_word."""
    return _found(docs.withColumn("text_hash", F.lit(0).cast("long")), items, rate).drop("text_hash")


def _found(docs: DataFrame, items: DataFrame, rate: float) -> DataFrame:
    """``matches`` with the column text_hash of ``docs``."""
    spark = docs.sparkSession
    thin = docs.select("doc_id", "text", "text_hash").where("text is not null")
    schema = SCHEMA + ", text_hash long"
    found = spark.createDataFrame([], schema)
    for block in _blocks(items):
        held = spark.sparkContext.broadcast((block, rate))

        def scan(batches, held=held):
            yield from _scan(batches, _Index(*held.value))

        found = found.unionAll(thin.mapInArrow(scan, schema))
    return found


def remove(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """``docs`` without the documents that contain a test item. Rows are told apart by
    id and text, so null and repeated ids are judged on their own texts."""
    text_hash = F.xxhash64("text")
    dirty = _found(docs.withColumn("text_hash", text_hash), items, rate).select(
        F.col("doc_id").alias("_dirty"), F.col("text_hash").alias("_hash")
    ).distinct()
    return docs.join(dirty, F.col("doc_id").eqNullSafe(F.col("_dirty")) & (text_hash == F.col("_hash")), "left_anti")
