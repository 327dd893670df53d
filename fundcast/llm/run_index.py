"""A run-compressed positional Burrows-Wheeler transform and matching statistics.

The strings of a collection have one width and are aligned (here: on an anchor, so
equal windows stand in equal columns). Before column j the strings are ordered by
their prefixes read backwards; the transform of the column is the characters in that
order. Strings that agree over a long stretch stand together, so repetitive
collections give few runs. A column keeps its runs with the strings at both ends of
every run (the samples), from which a search continues when a character differs.

Patterns are streamed through all columns at once. A pattern holds a row and the
length of its match, that is of the longest stretch ending here that some string has
in the same columns. In a run of its character the row maps on; else it moves to the
nearer end of a run of that character above or below, whichever string agrees longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

NONE = np.iinfo(np.int64).max


@dataclass
class Column:
    """The runs of one column, and what follows it."""

    run: np.ndarray  # of every row
    starts: np.ndarray  # row at which each run begins
    heads: np.ndarray  # its character
    base: np.ndarray  # row of its first string in the next column's order
    first: np.ndarray  # samples: strings at the ends of each run
    last: np.ndarray
    after: np.ndarray  # the next column's order of the strings
    common: np.ndarray  # columns in which a string agrees with the one before it there

    def classes(self, length: int) -> np.ndarray:
        """The group of every row, of those that agree in the last ``length`` columns."""
        return np.cumsum(self.common < length) - 1


def columns(strings: np.ndarray) -> Iterator[Column]:
    """The transform of ``strings`` (one per row), column by column."""
    n, width = strings.shape
    order, common = np.arange(n), np.zeros(n, np.int32)
    for j in range(width):
        chars = strings[order, j]
        begins = np.concatenate([[True], chars[1:] != chars[:-1]])
        starts = np.flatnonzero(begins)
        heads = chars[starts]
        to = np.argsort(chars, kind="stable")
        row = np.empty(n, np.int64)
        row[to] = np.arange(n)
        ends = np.append(starts[1:], n) - 1
        after = order[to]
        agree = common[to] + 1
        # the first string of a run meets the last one of the run of its character before:
        # they agree as far as everything between them does
        by_char = np.argsort(heads, kind="stable")
        head = heads[by_char]
        again = np.flatnonzero(head[1:] == head[:-1])
        fresh = by_char[np.concatenate([[0], np.flatnonzero(head[1:] != head[:-1]) + 1])]
        agree[row[starts[fresh]]] = 0
        if len(again):
            before, run = by_char[again], by_char[again + 1]
            least = np.minimum.reduceat(common, starts)
            spans = np.empty(2 * len(run), np.int64)
            spans[::2], spans[1::2] = before + 1, run
            between = np.minimum(np.minimum.reduceat(least, spans)[::2], common[starts[run]])
            agree[row[starts[run]]] = between + 1
        yield Column(np.cumsum(begins) - 1, starts, heads, row[starts], order[starts], order[ends], after, agree)
        order, common = after, agree


def _agreeing(patterns: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """Columns in which two rows agree, counted back from the last."""
    differ = patterns != strings
    width = differ.shape[1]
    if not width:
        return np.zeros(len(patterns), np.int64)
    return np.where(differ.any(axis=1), differ[:, ::-1].argmax(axis=1), width)


def stream(column: Column, j: int, strings: np.ndarray, patterns: np.ndarray, row: np.ndarray, length: np.ndarray) -> None:
    """Takes ``row`` and ``length`` of every pattern over column ``j``, in place."""
    char = patterns[:, j]
    run = column.run[row]
    off = np.flatnonzero(column.heads[run] != char)
    runs = len(column.starts)
    by_char = np.argsort(column.heads, kind="stable")
    key = column.heads[by_char].astype(np.int64) * runs + by_char  # rising
    at = np.searchsorted(key, char[off].astype(np.int64) * runs + run[off])
    size = np.diff(np.append(column.starts, len(strings)))
    best, to = np.zeros(len(off), np.int64), np.zeros(len(off), np.int64)
    for side, sample in ((at - 1, column.last), (at, column.first)):
        there = np.flatnonzero((side >= 0) & (side < runs))
        near = by_char[side[there]]
        there, near = there[ok := column.heads[near] == char[off[there]]], near[ok]
        agree = _agreeing(patterns[off[there], :j], strings[sample[near], :j]) + 1
        better = agree > best[there]
        last = size[near] - 1 if sample is column.last else 0
        best[there] = np.where(better, agree, best[there])
        to[there] = np.where(better, column.base[near] + last, to[there])
    row += column.base[run] - column.starts[run]
    length += 1
    row[off], length[off] = to, best


def earlier(strings, docs, inside, patterns, pattern_docs, pattern_inside, length: int) -> np.ndarray:
    """Which windows of ``length`` columns each pattern shares with a string of a
    smaller document, as bits by the window's first column. ``inside`` (first and end
    column of what belongs to a row's document) says which windows a row really has."""
    row, matched = np.zeros(len(patterns), np.int64), np.zeros(len(patterns), np.int64)
    marks = np.zeros(len(patterns), np.int64)
    for j, column in enumerate(columns(strings)):
        stream(column, j, strings, patterns, row, matched)
        window = j + 1 - length
        if window < 0:
            continue
        of = np.where((inside[0] <= window) & (inside[1] > j), docs, NONE)
        classes = column.classes(length)
        least = np.minimum.reduceat(of[column.after], np.flatnonzero(np.diff(classes, prepend=-1)))
        found = least[classes[row]] < pattern_docs
        found &= (matched >= length) & (pattern_inside[0] <= window) & (pattern_inside[1] > j)
        marks |= found.astype(np.int64) << window
    return marks
