"""Connected components of a link table, by alternating star contractions.

Links are packed by bucket of a node, and a task contracts all links of a bucket at
once; a round costs two shuffles of a few packed rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundcast.llm import hashing
from fundcast.llm.packed import bucket_bits, bucket_of, gathered, pack, unpack
from fundcast.session import cut_lineage

MAX_ROUNDS = 60
#: Links that one bucket holds on average (16 bytes each, filed under both nodes).
BUCKET_LINKS = 1 << 18

_PACKED = "bucket long, nodes binary, others binary"


def contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node reachable by these links), no more than were given;
    nodes that are the smallest have none."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[u], root[v]
        apart = x != y
        if not apart.any():
            break
        u, v, x, y = u[apart], v[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    below = root != np.arange(len(nodes))
    return nodes[below], nodes[root[below]]


def _by_node(node: np.ndarray, other: np.ndarray, bits: int) -> pa.RecordBatch:
    bucket = bucket_of(hashing.mix(node.view(np.uint64)), bits)
    return pack(bucket, {"nodes": node, "others": other})


def _both_ways(a: np.ndarray, b: np.ndarray, bits: int) -> pa.RecordBatch:
    return _by_node(np.concatenate([a, b]), np.concatenate([b, a]), bits)


def _links(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return unpack(table, "nodes", np.int64), unpack(table, "others", np.int64)


def _small_stars(table: pa.Table, bits: int) -> pa.Table:
    """Links of the larger nodes of a bucket, contracted, filed under both nodes."""
    return pa.Table.from_batches([_both_ways(*contracted(*_links(table)), bits)])


def _gathered(table: pa.Table) -> pa.Table:
    """The links of a bucket's nodes, sorted, each once, and how many of its nodes are
    neither the smallest nor linked with one node alone."""
    node, other = _links(table)
    order = np.lexsort((other, node))
    node, other = node[order], other[order]
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (other[1:] != other[:-1])
    node, other = node[new], other[new]
    start = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    size = np.diff(np.concatenate([start, [len(node)]]))
    unsettled = int(((other[start] < node[start]) & (size > 1)).sum())
    return pa.table({
        "nodes": pa.array([node.tobytes()], pa.binary()), "others": pa.array([other.tobytes()], pa.binary()),
        "unsettled": [unsettled],
    })


def _large_stars(node: np.ndarray, other: np.ndarray, bits: int) -> pa.RecordBatch:
    """The larger neighbours of every node, linked with the smallest of it and its
    neighbours instead; ``node`` and ``other`` are sorted."""
    start = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    size = np.diff(np.concatenate([start, [len(node)]]))
    least = np.repeat(np.minimum(other[start], node[start]), size)
    larger = other > node
    return _by_node(other[larger], least[larger], bits)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b): component is the smallest
    node reachable. Every round hangs each node's larger neighbours below its smallest
    one, then contracts what the larger nodes of a bucket link; the table never grows
    beyond the links. It ends when every node but the smallest has one link.
    """
    links = cut_lineage(links.where("a <> b").select("a", "b"), "edges")
    bits = bucket_bits(2 * links.count(), BUCKET_LINKS)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            a, b = contracted(batch.column("a").to_numpy(), batch.column("b").to_numpy())
            yield _by_node(a, b, bits)

    def large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _large_stars(*_links(pa.Table.from_batches([batch.slice(i, 1)])), bits)

    stars = links.mapInArrow(first, _PACKED)
    for _ in range(MAX_ROUNDS):
        small = stars.groupBy("bucket").applyInArrow(lambda table: _small_stars(table, bits), _PACKED)
        held = cut_lineage(
            small.groupBy("bucket").applyInArrow(_gathered, "nodes binary, others binary, unsettled long"), "edges"
        )
        if not held.agg(F.sum("unsettled")).first()[0]:
            break
        stars = held.select("nodes", "others").mapInArrow(large, _PACKED)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")

    def labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, other = _links(pa.Table.from_batches([batch]))
            below = other < node
            smallest = np.unique(node[~below])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([node[below], smallest])), pa.array(np.concatenate([other[below], smallest]))],
                names=["node", "component"],
            )

    return held.select("nodes", "others").mapInArrow(labels, "node long, component long")
