"""Hierarchical navigable small-world graphs in numpy.

Every layer is a graph over the nodes drawn for it (each layer holds about
1/16 of the one below).  Layers are built from the top down; a node enters a
layer by a beam search from the nearest node of the layer above and gets
diverse neighbours: a candidate is taken if it is nearer to the node than to
any neighbour taken before.  Searches run for a block of queries at once, one
numpy step expanding the best open nodes of every beam.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np

DEGREE = 32
_WIDTH = 2 * DEGREE  # a list is pruned to DEGREE when it would grow past this
_SHRINK = 16
_BUILD_BEAM = 64
_BLOCK = 256
_OPEN = 4


def _top(ids: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row, best first."""
    if sims.shape[1] > k:
        at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        ids, sims = np.take_along_axis(ids, at, 1), np.take_along_axis(sims, at, 1)
    at = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, at, 1), np.take_along_axis(sims, at, 1)


def beam_search(vectors: np.ndarray, lists: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """Ids (-1 where there are fewer) and similarities of the ``beam`` best found, best first.

    ``entries`` (queries, m) are distinct start nodes of each query, -1 for none.
    """
    q, n = len(queries), len(vectors)
    rows = np.arange(q)[:, None]
    seen = np.zeros((q, n + 1), dtype=bool)  # the last column takes the -1 entries
    seen[rows, entries] = True
    sims = np.where(entries >= 0, np.einsum("qmd,qd->qm", vectors[entries], queries), -np.inf).astype(np.float32)
    ids, sims = _top(entries, sims, beam)
    open_ = ids >= 0
    live = np.flatnonzero(open_.any(axis=1))
    best_ids, best_sims = np.full((q, beam), -1, dtype=np.int32), np.full((q, beam), -np.inf, dtype=np.float32)
    best_ids[:, :ids.shape[1]], best_sims[:, :ids.shape[1]] = ids, sims
    closed = np.ones((q, beam), dtype=bool)
    closed[:, :ids.shape[1]] = ~open_
    while len(live):
        # rows are sorted, so the first open nodes are the best
        order = np.argsort(closed[live], axis=1, kind="stable")[:, :_OPEN]
        chosen = np.take_along_axis(best_ids[live], order, 1)
        chosen = np.where(np.take_along_axis(closed[live], order, 1), -1, chosen)
        marks = closed[live]
        np.put_along_axis(marks, order, True, 1)
        closed[live] = marks
        fresh = []
        for k in range(chosen.shape[1]):
            near = np.where(chosen[:, k:k + 1] >= 0, lists[chosen[:, k]], -1)
            new = (near >= 0) & ~seen[live[:, None], near]
            seen[live[:, None], np.where(new, near, n)] = True
            fresh.append(np.where(new, near, -1))
        near = np.concatenate(fresh, axis=1)
        near = near[:, (near >= 0).any(axis=0)]
        if near.shape[1]:
            sim = np.einsum("qmd,qd->qm", vectors[near], queries[live])
            sim = np.where(near >= 0, sim, -np.inf).astype(np.float32)
            all_ids = np.concatenate([best_ids[live], near.astype(np.int32)], axis=1)
            all_sims = np.concatenate([best_sims[live], sim], axis=1)
            all_closed = np.concatenate([closed[live], near < 0], axis=1)
            if all_sims.shape[1] > beam:
                at = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
                all_ids, all_sims, all_closed = (np.take_along_axis(x, at, 1) for x in (all_ids, all_sims, all_closed))
            at = np.argsort(-all_sims, axis=1, kind="stable")
            best_ids[live], best_sims[live], closed[live] = (np.take_along_axis(x, at, 1) for x in (all_ids, all_sims, all_closed))
        live = live[~closed[live].all(axis=1)]
    return best_ids, best_sims


def _diverse(vectors: np.ndarray, ids: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
    """Up to ``degree`` neighbours of each row from candidates sorted best first;
    places that diverse ones leave are filled with the nearest others."""
    found = vectors[ids]
    between = np.einsum("qid,qjd->qij", found, found)
    blocked = ids < 0
    taken = np.zeros_like(blocked)
    count = np.zeros(len(ids), dtype=int)
    for j in range(ids.shape[1]):
        near = np.where(taken, between[:, j, :], -np.inf).max(axis=1)
        take = ~blocked[:, j] & (count < degree) & (sims[:, j] > near)
        taken[:, j] = take
        count += take
    rank = np.where(taken, 0, np.where(blocked, 2, 1)) * ids.shape[1] + np.arange(ids.shape[1])
    at = np.argsort(rank, axis=1, kind="stable")[:, :degree]
    out = np.where(np.take_along_axis(blocked, at, 1), -1, np.take_along_axis(ids, at, 1))
    if out.shape[1] < degree:
        out = np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)
    return out


@dataclass
class Graph:
    """Unit vectors (float32) and, per layer from the top, neighbour lists by node."""

    vectors: np.ndarray
    layers: list[np.ndarray]
    tops: list[np.ndarray]  # per layer, its nodes
    start: int

    def descend(self, queries: np.ndarray, layers: int) -> np.ndarray:
        """The nearest node found in each of the first ``layers`` layers, one after the other."""
        at = np.full((len(queries), 1), self.start, dtype=np.int32)
        for lists in self.layers[:layers]:
            at = beam_search(self.vectors, lists, queries, at, 1)[0]
        return at

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        ids, sims = [], []
        for at in range(0, len(queries), _BLOCK):
            block = queries[at:at + _BLOCK]
            found = beam_search(self.vectors, self.layers[-1], block, self.descend(block, len(self.layers) - 1), beam)
            ids.append(found[0])
            sims.append(found[1])
        return np.concatenate(ids), np.concatenate(sims)

    def dumps(self) -> bytes:
        out = io.BytesIO()
        rows = {f"l{i}": lists[nodes] for i, (lists, nodes) in enumerate(zip(self.layers, self.tops))}
        nodes = {f"n{i}": nodes for i, nodes in enumerate(self.tops)}
        np.savez(out, vectors=self.vectors, start=self.start, layers=len(self.layers), **rows, **nodes)
        return out.getvalue()

    @classmethod
    def loads(cls, data: bytes) -> "Graph":
        with np.load(io.BytesIO(data)) as f:
            vectors, tops, layers = f["vectors"], [], []
            for i in range(int(f["layers"])):
                lists = np.full((len(vectors), _WIDTH), -1, dtype=np.int32)
                lists[f[f"n{i}"]] = f[f"l{i}"]
                tops.append(f[f"n{i}"])
                layers.append(lists)
            return cls(vectors, layers, tops, int(f["start"]))


def build(vectors: np.ndarray, seed: int = 1) -> Graph:
    """A graph over the rows of ``vectors`` (unit length, float32)."""
    n, rng = len(vectors), np.random.default_rng(seed)
    level = np.minimum((-np.log(1 - rng.random(n)) / np.log(_SHRINK)).astype(int), 12)
    top = int(level.max())
    order = np.lexsort((rng.random(n), -level))  # nodes of upper layers come first in every layer
    graph = Graph(vectors, [], [], int(order[0]))
    for layer in range(top, -1, -1):
        nodes = order[level[order] >= layer].astype(np.int32)
        lists = np.full((n, _WIDTH), -1, dtype=np.int32)
        degrees = np.zeros(n, dtype=np.int32)
        above = int((level[nodes] > layer).sum())
        done = 1
        while done < len(nodes):
            # up to as many as are in the layer, so that every search meets most of the graph
            size = min(done, _BLOCK, *( [above - done] if done < above else []))
            batch = nodes[done:done + size]
            size = len(batch)
            entries = (np.full((size, 1), graph.start, dtype=np.int32) if done < above or not graph.layers
                       else graph.descend(vectors[batch], len(graph.layers)))
            ids, sims = beam_search(vectors, lists, vectors[batch], entries, _BUILD_BEAM)
            # nodes of one batch meet by comparing them all
            inside = vectors[batch] @ vectors[batch].T
            np.fill_diagonal(inside, -np.inf)
            near = np.argsort(-inside, axis=1)[:, :min(_SHRINK, size - 1)]
            ids = np.concatenate([ids, batch[near]], axis=1)
            sims = np.concatenate([sims, np.take_along_axis(inside, near, 1).astype(np.float32)], axis=1)
            ids, sims = _top(ids, np.where(ids < 0, -np.inf, sims), _BUILD_BEAM)
            chosen = _diverse(vectors, ids, sims, DEGREE)
            lists[batch, :DEGREE] = chosen
            degrees[batch] = (chosen >= 0).sum(axis=1)
            _link_back(vectors, lists, degrees, batch, chosen)
            done += size
        graph.layers.append(lists)
        graph.tops.append(nodes)
    return graph


def _link_back(vectors: np.ndarray, lists: np.ndarray, degrees: np.ndarray, batch: np.ndarray, chosen: np.ndarray) -> None:
    """Adds each new node to the lists of its neighbours; full lists are pruned to diverse ones."""
    to, new = chosen.ravel(), np.repeat(batch, chosen.shape[1])
    keep = to >= 0
    to, new = to[keep], new[keep]
    # those that list each other already need no second entry
    known = (lists[to] == new[:, None]).any(axis=1)
    to, new = to[~known], new[~known]
    while len(to):
        by = np.argsort(to, kind="stable")
        to, new = to[by], new[by]
        first = np.r_[True, to[1:] != to[:-1]]
        rank = np.arange(len(to)) - np.maximum.accumulate(np.where(first, np.arange(len(to)), 0))
        place = degrees[to] + rank
        fits = place < _WIDTH
        lists[to[fits], place[fits]] = new[fits]
        np.add.at(degrees, to[fits], 1)
        to, new = to[~fits], new[~fits]
        full = np.unique(to)
        for at in range(0, len(full), _BLOCK):
            nodes = full[at:at + _BLOCK]
            ids = lists[nodes]
            sims = np.einsum("qmd,qd->qm", vectors[ids], vectors[nodes]).astype(np.float32)
            ids, sims = _top(ids, sims, _WIDTH)
            kept = _diverse(vectors, ids, sims, DEGREE)
            lists[nodes] = -1
            lists[nodes, :DEGREE] = kept
            degrees[nodes] = (kept >= 0).sum(axis=1)
