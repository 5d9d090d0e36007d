"""A hierarchical navigable small-world graph over unit vectors, in numpy.

Insertion and search run many vectors at once: each keeps its own beam, and
a round expands the best open nodes of every beam. Layers are built from the
top; a batch entering a layer is searched in what the layer holds so far,
linked to a diverse choice of what it finds (and of its own batch), and
linked back, where lists over the limit are chosen anew.
"""

from __future__ import annotations

import numpy as np

WIDTH = 4  # nodes a beam expands in one round


def _diverse(query: np.ndarray, vectors: np.ndarray, found: np.ndarray, keep: int) -> np.ndarray:
    """Of each row of ``found`` (node numbers, -1 for none) at most ``keep``:
    nearest first, skipping nodes nearer to one already taken than to the
    query; room that is left goes to the nearest skipped ones."""
    x = vectors[np.maximum(found, 0)]
    near = np.where(found < 0, -np.inf, np.einsum("bcd,bd->bc", x, query))
    order = np.argsort(-near, axis=1, kind="stable")
    found, near = np.take_along_axis(found, order, 1), np.take_along_axis(near, order, 1)
    x = np.take_along_axis(x, order[:, :, None], 1)
    among = np.matmul(x, x.transpose(0, 2, 1))
    taken = np.zeros(found.shape, bool)
    for c in range(found.shape[1]):
        shadow = np.where(taken, among[:, c, :], -np.inf).max(axis=1)
        taken[:, c] = (near[:, c] > shadow) & (found[:, c] >= 0) & (taken.sum(axis=1) < keep)
    rank = np.where(taken, 0, np.where(found >= 0, 1, 2))
    order = np.argsort(rank, axis=1, kind="stable")[:, :keep]
    return np.take_along_axis(found, order, 1)


def _search(vectors: np.ndarray, links: np.ndarray, query: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Node numbers (-1 for none) and similarities of the ``beam`` nearest nodes found for every query."""
    n, each = len(query), np.arange(len(query))
    nodes = np.full((n, beam), -1, np.int64)
    near = np.full((n, beam), -np.inf, np.float32)
    open_ = np.zeros((n, beam), bool)
    seen = np.zeros((n, len(vectors)), bool)
    new = entry
    live = each
    while True:
        fresh = np.zeros(new.shape, bool)
        step = links.shape[1] if new.shape[1] > entry.shape[1] else new.shape[1]
        for a in range(0, new.shape[1], max(1, step)):  # nodes are distinct inside one list
            part = new[:, a:a + step]
            ok = (part >= 0) & ~seen[live[:, None], np.maximum(part, 0)]
            r, c = np.nonzero(ok)
            seen[live[r], part[r, c]] = True
            fresh[:, a:a + step] = ok
        sims = np.full(new.shape, -np.inf, np.float32)
        r, c = np.nonzero(fresh)
        sims[r, c] = np.einsum("kd,kd->k", vectors[new[r, c]], query[live[r]])
        both = np.concatenate([near[live], sims], axis=1)
        top = np.argpartition(-both, beam - 1, axis=1)[:, :beam] if both.shape[1] > beam else np.broadcast_to(np.arange(both.shape[1]), both.shape)
        pad = ((0, 0), (0, beam - top.shape[1]))
        near[live] = np.pad(np.take_along_axis(both, top, 1), pad, constant_values=-np.inf)
        nodes[live] = np.pad(np.take_along_axis(np.concatenate([nodes[live], np.where(fresh, new, -1)], axis=1), top, 1), pad, constant_values=-1)
        open_[live] = np.pad(np.take_along_axis(np.concatenate([open_[live], fresh], axis=1), top, 1), pad)
        live = live[open_[live].any(axis=1)]
        if not len(live):
            return nodes, near
        width = min(WIDTH, beam)
        score = np.where(open_[live], near[live], -np.inf)
        pick = np.argpartition(-score, width - 1, axis=1)[:, :width]
        on = np.take_along_axis(open_[live], pick, 1)
        chosen = np.where(on, np.take_along_axis(nodes[live], pick, 1), -1)
        rows = np.broadcast_to(live[:, None], pick.shape)
        open_[rows[on], pick[on]] = False
        new = np.where(chosen[:, :, None] < 0, -1, links[np.maximum(chosen, 0)]).reshape(len(live), -1)


class Graph:
    """``vectors``: float32 rows of length one. ``degree``: links of a node on the base layer; half of it above."""

    def __init__(self, vectors: np.ndarray, degree: int = 24, beam: int = 48, batch: int = 256, seed: int = 11):
        self.vectors = vectors
        level = np.floor(-np.log(np.random.default_rng(seed).random(len(vectors))) / np.log(degree / 2)).astype(int)
        top = int(level.max(initial=0))
        #: per layer from the base: node numbers on it and links among them
        self.layers: list[tuple[np.ndarray, np.ndarray]] = []
        upper: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(top, -1, -1):
            above = upper[0][0] if upper else np.zeros(0, np.int64)
            rest = np.flatnonzero(level == k)
            nodes = np.concatenate([above, rest]).astype(np.int64)
            self.layers = upper
            upper = [(nodes, self._layer(nodes, len(above), degree if k == 0 else max(4, degree // 2), beam, batch)), *upper]
        self.layers = upper

    def _layer(self, nodes: np.ndarray, above: int, degree: int, beam: int, batch: int) -> np.ndarray:
        x = self.vectors[nodes]
        links = np.full((len(nodes), degree), -1, np.int64)
        place = np.full(len(self.vectors), -1, np.int64)
        place[nodes] = np.arange(len(nodes))
        done = 0
        while done < len(nodes):
            new = np.arange(done, min(len(nodes), done + min(batch, max(32, done))))
            own = x[new] @ x[new].T
            np.fill_diagonal(own, -np.inf)
            k = min(degree, len(new) - 1)
            mates = np.where(np.ones((len(new), k), bool), done + np.argpartition(-own, max(0, k - 1), axis=1)[:, :k], -1)
            if done:
                entry = place[self.descend(x[new])] if above and done >= above else np.zeros((len(new), 1), np.int64)
                found, _ = _search(x[:done], links[:done], x[new], entry, beam)
                mates = np.concatenate([found, mates], axis=1)
            if mates.shape[1]:
                mine = _diverse(x[new], x, mates, max(1, degree * 2 // 3))
                links[new, :mine.shape[1]] = mine
                self._back(x, links, np.repeat(new, mine.shape[1]), mine.ravel(), degree)
            done = int(new[-1]) + 1
        return links

    @staticmethod
    def _back(x: np.ndarray, links: np.ndarray, source: np.ndarray, target: np.ndarray, degree: int) -> None:
        ok = target >= 0
        source, target = source[ok], target[ok]
        near = np.einsum("kd,kd->k", x[source], x[target])
        order = np.lexsort((-near, target))
        source, target = source[order], target[order]
        names, first, count = np.unique(target, return_index=True, return_counts=True)
        rank = np.arange(len(target)) - np.repeat(first, count)
        few = rank < 2 * degree
        added = np.full((len(names), int(min(count.max(initial=0), 2 * degree))), -1, np.int64)
        added[np.repeat(np.arange(len(names)), count)[few], rank[few]] = source[few]
        for i in range(0, len(names), 256):
            t, more = names[i:i + 256], added[i:i + 256]
            more = np.where((more[:, :, None] == links[t][:, None, :]).any(axis=2), -1, more)
            links[t] = _diverse(x[t], x, np.concatenate([links[t], more], axis=1), degree)

    def descend(self, query: np.ndarray, beam: int = 8) -> np.ndarray:
        """Entry nodes for the layer below the lowest one there is."""
        entry = None
        for nodes, links in reversed(self.layers):
            if entry is None:
                at = np.zeros((len(query), 1), np.int64)
            else:
                place = np.full(len(self.vectors), -1, np.int64)
                place[nodes] = np.arange(len(nodes))
                at = np.where(entry < 0, -1, place[np.maximum(entry, 0)])
            found, near = _search(self.vectors[nodes], links, query, at, beam)
            best = np.take_along_axis(found, np.argsort(-near, axis=1)[:, :2], 1)
            entry = np.where(best < 0, -1, nodes[np.maximum(best, 0)])
        return entry

    def nearest(self, query: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest nodes found for every query and their similarities."""
        nodes, links = self.layers[0]
        place = np.empty(len(nodes), np.int64)
        place[nodes] = np.arange(len(nodes))
        if len(self.layers) > 1:
            own, self.layers = self.layers, self.layers[1:]
            entry = self.descend(query)
            self.layers = own
            entry = np.where(entry < 0, -1, place[np.maximum(entry, 0)])
        else:
            entry = np.zeros((len(query), 1), np.int64)
        found, near = _search(self.vectors[nodes], links, query, entry, min(beam, len(nodes)))
        return np.where(found < 0, -1, nodes[np.maximum(found, 0)]), near

    def within(self, query: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs of similarity at least ``least``: beams whose
        worst entry still is are widened until they end below it."""
        pairs = [np.zeros((0, 2), np.int64)]
        for i in range(0, len(query), 256):
            rows = np.arange(i, min(i + 256, len(query)))
            width = beam
            while len(rows):
                found, near = self.nearest(query[rows], width)
                full = (near.min(axis=1) >= least) & (width < len(self.vectors))
                r, c = np.nonzero((near >= least) & ~full[:, None])
                pairs.append(np.stack([rows[r], found[r, c]], axis=1))
                rows, width = rows[full], 2 * width
        out = np.concatenate(pairs)
        return out[:, 0], out[:, 1]
