"""Cover trees over vectors, for inner products.

All vectors get one more component that lifts them to the norm of the longest, so
they lie on a sphere and an inner product tells an angle. A node stands on one of its
points, and every level covers a node's points by a net: centres drawn farthest
first, the node's own centre among them, until half the node's radius or ``FAN``
centres (fewer for few points) are reached; each point goes to its nearest centre. Every node keeps
its covering radius, the largest angle from its centre to a point below it, so by the
triangle inequality an inner product with any of them has an upper and a lower bound.

Searches run best first for many queries at once: each step opens every query's most
promising nodes, twice as many as the step before (so at most about twice as many as
one at a time would), and queries that open the same node share the work. A query ends
when no node left can reach its worst kept score; leaves are verified exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FAN = 16
LEAF = 256
LOW = -(1 << 62)
#: Angles are this much too wide, beyond what rounding can take.
_SLACK = 1e-6


@dataclass
class Tree:
    """Points in the order of the leaves, and the nodes, the root first: centre, norm
    of the sphere, covering angle, children and points (from, to)."""

    order: np.ndarray
    centers: np.ndarray
    radius: np.ndarray
    children: np.ndarray
    points: np.ndarray
    norm: float


def build(vectors: np.ndarray, leaf: int = LEAF, fan: int = FAN) -> Tree:
    x = vectors.astype(np.float64)
    square = (x * x).sum(axis=1)
    norm = float(np.sqrt(square.max(initial=0.0))) or 1.0
    u = np.concatenate([x / norm, np.sqrt(np.maximum(1 - square / norm**2, 0))[:, None]], axis=1)

    def angles(of: np.ndarray, center: int) -> np.ndarray:
        return np.arccos(np.clip(u[of] @ u[center], -1, 1))

    order, centers, radius, children, points = [], [0], [0.0], [(0, 0)], [(0, 0)]
    waiting = [(0, np.arange(len(x)), angles(np.arange(len(x)), 0))] if len(x) else []
    while waiting:
        node, rows, far = waiting.pop()
        radius[node] = float(far.max())
        if len(rows) <= leaf:
            points[node] = (len(order), len(order) + len(rows))
            order.extend(rows.tolist())
            continue
        net, owner, distance = [centers[node]], np.zeros(len(rows), np.int64), far.copy()
        most = min(fan, max(2, 2 * len(rows) // leaf))  # no more than the points are worth
        while len(net) < most and distance.max() > max(radius[node] / 2, 1e-7):
            net.append(int(rows[distance.argmax()]))
            to = angles(rows, net[-1])
            owner[to < distance] = len(net) - 1
            distance = np.minimum(distance, to)
        if len(net) == 1:  # as good as equal points: parts of them
            owner = np.arange(len(rows)) * most // len(rows)
            net = net * most
        first = len(centers)
        children[node] = (first, first + len(net))
        for i, center in enumerate(net):
            centers.append(center)
            radius.append(0.0)
            children.append((0, 0))
            points.append((0, 0))
            mine = owner == i
            waiting.append((first + i, rows[mine], distance[mine]))
    kept = np.array(centers)
    return Tree(
        np.array(order, np.int64), x[kept] if len(x) else x[:0], np.array(radius) + _SLACK,
        np.array(children, np.int64), np.array(points, np.int64), norm,
    )


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors (norms below 2**31): in floating point
    where no sum can reach 2**53."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Best:
    """The ``k`` best (score, id) of every query so far: higher scores first, then smaller ids."""

    def __init__(self, queries: int, k: int):
        self.score = np.full((queries, k), LOW, np.int64)
        self.id = np.zeros((queries, k), np.int64)

    def add(self, queries: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """``score`` has a row for each of ``queries``; LOW stands for none."""
        k = self.score.shape[1]
        worst = np.maximum(self.score[queries, -1], LOW + 1)
        if score.shape[1] > k:  # ties with the last of the best may count
            worst = np.maximum(worst, np.partition(score, -k, axis=1)[:, -k])
        row, column = np.nonzero(score >= worst[:, None])
        some = np.unique(row)
        if not len(some):
            return
        # the best so far and what may join them, in order, row by row
        who = np.concatenate([np.repeat(some, k), row])
        what = np.concatenate([self.score[queries[some]].ravel(), score[row, column]])
        name = np.concatenate([self.id[queries[some]].ravel(), ids[column]])
        order = np.lexsort((name, -what, who))
        who, what, name = who[order], what[order], name[order]
        first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
        kept = (first[:, None] + np.arange(k)).ravel()
        q = queries[some]
        self.score[q], self.id[q] = what[kept].reshape(-1, k), name[kept].reshape(-1, k)


def search(tree: Tree, vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, least, most, fits, best: Best, at) -> int:
    """Adds to ``best``, at the rows ``at``, the best of ``vectors`` (in the tree's
    order) with a score from ``least`` to ``most`` for which ``fits(queries, points)``
    (a matrix) holds. Returns how many points were verified, over all queries."""
    if not len(vectors) or not len(queries):
        return 0
    q = queries.astype(np.float64)
    length = np.sqrt((q * q).sum(axis=1))
    reach = length * tree.norm
    upper = np.full((len(q), len(tree.centers)), -np.inf)
    verified = 0

    def bound(rows: np.ndarray, nodes: slice) -> None:
        cosine = (q[rows] @ tree.centers[nodes].T) / np.maximum(reach[rows], 1e-300)[:, None]
        angle = np.arccos(np.clip(cosine, -1, 1))
        wide, slack = tree.radius[nodes], reach[rows][:, None] * 1e-9 + 1e-3
        high = reach[rows][:, None] * np.cos(np.maximum(angle - wide, 0)) + slack
        low = reach[rows][:, None] * np.cos(np.minimum(angle + wide, np.pi)) - slack
        outside = (high < least[rows][:, None]) | (low > most[rows][:, None])
        upper[rows, nodes] = np.where(outside, -np.inf, high) 

    bound(np.arange(len(q)), slice(0, 1))
    count = 1
    while True:
        row, node = np.nonzero((upper > -np.inf) & (upper >= best.score[at, -1][:, None]))
        if not len(row):
            return verified
        if count < upper.shape[1]:  # the most promising ones of each query
            order = np.lexsort((-upper[row, node], row))
            row, node = row[order], node[order]
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            place = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
            row, node = row[place < count], node[place < count]
        upper[row, node] = -np.inf
        count *= 2
        order = np.argsort(node, kind="stable")
        row, node = row[order], node[order]
        for rows in np.split(np.arange(len(row)), np.flatnonzero(np.diff(node)) + 1):
            n, rows = node[rows[0]], row[rows]
            if tree.children[n, 1]:
                bound(rows, slice(*tree.children[n]))
                continue
            leaf = slice(*tree.points[n])
            score = products(queries[rows], vectors[leaf])
            verified += score.size
            inside = (score >= least[rows][:, None]) & (score <= most[rows][:, None]) & fits(rows, leaf)
            best.add(at[rows], np.where(inside, score, LOW), ids[leaf])
