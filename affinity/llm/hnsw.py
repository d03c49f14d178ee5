"""Hierarchical navigable small-world graph over unit vectors, on arrays.

Nodes enter in falling order of their random top layer, in batches that at most double the graph.
All vectors of a batch (or of a query block) walk the graph in step: one numpy operation
expands the best open candidate of every walk.
"""

from __future__ import annotations

import numpy as np

LINKS = 12
BATCH = 512


def search_layer(vectors, links, row, queries, start, beam: int):
    """(ids, similarities), each queries x beam, best first; missing places have id -1.

    ``links``: neighbours by row; ``row``: node -> row of ``links``; ``start``: nodes to begin
    from, queries x s.
    """
    q = np.arange(len(queries))
    seen = np.zeros((len(queries), len(vectors)), dtype=bool)
    ids = np.full((len(queries), beam), -1, dtype=np.int64)
    sims = np.full((len(queries), beam), -np.inf, dtype=np.float32)
    s = min(start.shape[1], beam)
    ids[:, :s] = start[:, :s]
    seen[q[:, None], ids[:, :s]] = True
    sims[:, :s] = np.einsum("qd,qsd->qs", queries, vectors[ids[:, :s]])
    open_ = sims > -np.inf
    live = q
    while len(live):
        best = np.where(open_[live], sims[live], -np.inf).argmax(axis=1)
        going = open_[live, best]
        live, best = live[going], best[going]
        if not len(live):
            break
        open_[live, best] = False
        near = links[row[ids[live, best]]]
        fresh = (near >= 0) & ~seen[live[:, None], near]
        near = np.where(fresh, near, 0)
        found = np.where(fresh, np.einsum("qd,qsd->qs", queries[live], vectors[near]), -np.inf).astype(np.float32)
        seen[np.repeat(live, near.shape[1])[fresh.ravel()], near[fresh]] = True
        all_ids = np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1)
        all_sims = np.concatenate([sims[live], found], axis=1)
        all_open = np.concatenate([open_[live], fresh], axis=1)
        top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        ids[live], sims[live] = np.take_along_axis(all_ids, top, 1), np.take_along_axis(all_sims, top, 1)
        open_[live] = np.take_along_axis(all_open, top, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def spread_choice(vectors, ids, sims, count: int) -> np.ndarray:
    """``count`` neighbours of each row of candidates (best first): first those nearer to the query than
    to any chosen one, then the nearest of the rest."""
    gram = np.einsum("qcd,qed->qce", vectors[ids], vectors[ids])
    valid = (ids >= 0) & (sims > -np.inf)
    chosen = np.zeros(ids.shape, dtype=bool)
    for c in range(ids.shape[1]):
        rival = np.where(chosen, gram[:, c, :], -np.inf).max(axis=1)
        chosen[:, c] = valid[:, c] & (sims[:, c] > rival) & (chosen.sum(axis=1) < count)
    rank = np.where(chosen, 0, np.where(valid, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
    pick = np.argsort(rank, axis=1)[:, :count]
    return np.where(np.take_along_axis(valid, pick, 1), np.take_along_axis(ids, pick, 1), -1)


class Graph:
    def __init__(self, vectors: np.ndarray, beam: int, seed: int = 7, links: int = LINKS):
        """``vectors``: unit rows, float32."""
        n = len(vectors)
        rng = np.random.default_rng(seed)
        level = np.minimum((-np.log(1 - rng.random(n)) / np.log(links)).astype(int), 8)
        self.order = np.argsort(-level, kind="stable")
        self.vectors, self.level = vectors[self.order], level[self.order]
        self.layers = [
            np.full((int((self.level >= k).sum()), links * (2 if k == 0 else 1)), -1, dtype=np.int64)
            for k in range((int(self.level[0]) if n else 0) + 1)
        ]
        self.row = np.arange(n)  # nodes are numbered by falling layer: a node's row is the same in all its layers
        done = 0
        while done < n:
            size = min(n - done, BATCH if done >= BATCH else max(1, done) if done else min(n, 64))
            self._insert(np.arange(done, done + size), done, beam, links)
            done += size

    def _insert(self, new: np.ndarray, done: int, beam: int, links: int) -> None:
        queries = self.vectors[new]
        within = queries @ queries.T
        np.fill_diagonal(within, -np.inf)
        start = np.zeros((len(new), 1), dtype=np.int64)
        for k in range(len(self.layers) - 1, -1, -1):
            layer = self.layers[k]
            here = self.level[new] >= k  # a prefix, as nodes come by falling layer
            before = min(done, len(layer))
            ids = np.full((len(new), 0), -1, dtype=np.int64)
            sims = np.full((len(new), 0), -np.inf, dtype=np.float32)
            if before:
                ids, sims = search_layer(self.vectors[:done], layer[:before], self.row, queries, start, beam if here.any() else 1)
                start = np.where(ids[:, :4] >= 0, ids[:, :4], ids[:, :1])
            m = int(here.sum())
            if not m:
                continue
            peers = np.argsort(-within[:m, :m], axis=1)[:, :beam]
            ids_all = np.concatenate([ids[:m], new[peers]], axis=1)
            sims_all = np.concatenate([sims[:m], np.take_along_axis(within[:m, :m], peers, 1)], axis=1)
            best = np.argsort(-sims_all, axis=1)[:, :beam]
            ids_all, sims_all = np.take_along_axis(ids_all, best, 1), np.take_along_axis(sims_all, best, 1)
            chosen = spread_choice(self.vectors, ids_all, sims_all, links)
            layer[new[:m], :chosen.shape[1]] = chosen
            self._link_back(layer, new[:m], chosen)

    def _link_back(self, layer: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> None:
        """Add the reverse links. A full row keeps its two oldest links (the long ones) and the nearest others."""
        target = chosen.ravel()
        source = np.repeat(new, chosen.shape[1])[target >= 0]
        target = target[target >= 0]
        touched = np.unique(target)
        old = layer[touched]
        t = np.concatenate([np.repeat(touched, old.shape[1])[old.ravel() >= 0], target])
        s = np.concatenate([old.ravel()[old.ravel() >= 0], source])
        pair = np.unique(np.stack([t, s]), axis=1)  # by target, then by node number: the oldest first
        t, s = pair
        first = np.concatenate([[True], t[1:] != t[:-1]])
        begin = np.flatnonzero(first)
        rank_old = np.arange(len(t)) - np.repeat(begin, np.diff(np.append(begin, len(t))))
        sim = np.einsum("id,id->i", self.vectors[t], self.vectors[s])
        sim[rank_old < 2] = np.inf
        order = np.lexsort((-sim, t))
        rank = rank_old  # ranks run alike in any order within a target
        keep = rank < layer.shape[1]
        layer[touched] = -1
        layer[t[order][keep], rank[keep]] = s[order][keep]

    def search(self, queries: np.ndarray, beam: int):
        """(node numbers in the order given to the constructor, similarities) of the best ``beam`` found."""
        n = len(self.vectors)
        start = np.zeros((len(queries), 1), dtype=np.int64)
        for k in range(len(self.layers) - 1, -1, -1):
            ids, sims = search_layer(self.vectors, self.layers[k], self.row, queries, start, min(n, beam) if k == 0 else 1)
            start = ids[:, :1]
        return np.where(ids >= 0, self.order[ids], -1), sims
