"""A navigable small-world graph with levels, built and searched for many vectors at a time.

Malkov and Yashunin, "Efficient and robust approximate nearest neighbor search
using hierarchical navigable small world graphs". Nodes are inserted in batches
of at most as many as there are already; queries walk the graph side by side, so
the work is in matrix products.
"""

from __future__ import annotations

import numpy as np

NEIGHBOURS = 16
BUILD_BEAM = 48
BATCH = 1024
EXPAND = 4
VISITED_BYTES = 16 << 20
GATHERED = 8 << 20  # numbers of vectors gathered at a time


def _top(ids: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best columns of each row, best first."""
    if sims.shape[1] > k:
        at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        ids, sims = np.take_along_axis(ids, at, 1), np.take_along_axis(sims, at, 1)
    at = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, at, 1), np.take_along_axis(sims, at, 1)


class Graph:
    """Nodes are numbered from the highest level down, so that those of a level are the first rows of its links.

    Beside its vectors and its lowest links a graph so takes next to nothing.
    """

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray]):
        self.vectors, self.links = vectors, links

    @staticmethod
    def numbered(n: int, seed: int = 0, m: int = NEIGHBOURS) -> tuple[np.ndarray, list[int]]:
        """The order in which ``n`` vectors become nodes, and how many nodes each level has."""
        levels = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(m)).astype(np.int64)
        order = np.argsort(-levels, kind="stable")  # the highest nodes first: every level is there when it is needed
        return order, [int((levels >= l).sum()) for l in range(int(levels.max()) + 1 if n else 1)]

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 0, m: int = NEIGHBOURS, beam: int = BUILD_BEAM) -> Graph:
        """From unit vectors in any order; the result depends on the vectors and the seed only."""
        order, sizes = cls.numbered(len(vectors), seed, m)
        return cls.grown(vectors[order].astype(np.float32), sizes, m, beam)

    @classmethod
    def grown(cls, vectors: np.ndarray, sizes: list[int], m: int = NEIGHBOURS, beam: int = BUILD_BEAM) -> Graph:
        """From unit vectors in single precision that are ``numbered`` already."""
        g = cls(vectors, [np.full((size, 2 * m if l == 0 else m), -1, np.int32) for l, size in enumerate(sizes)])
        done, n = 0, len(vectors)
        while done < n:
            new = min(n - done, BATCH, max(64, done))
            g._insert(np.arange(done, done + new), done, m, beam)
            done += new
        return g

    def _insert(self, new: np.ndarray, old: int, m: int, beam: int) -> None:
        q = self.vectors[new]
        among = q @ q.T
        np.fill_diagonal(among, -2)
        start = np.full((len(new), 1), 0 if old else -1)
        for level in range(len(self.links) - 1, -1, -1):
            rows = np.flatnonzero(new < len(self.links[level]))
            if old:
                found, sims = self.search(q, start, beam if len(rows) else 1, level, old)
                start = found[:, : max(1, beam // 8)]
            else:
                found, sims = np.full((len(new), 1), -1), np.full((len(new), 1), -2, np.float32)
            if not len(rows):
                continue
            ids = np.hstack([found[rows], np.broadcast_to(new[rows], (len(rows), len(rows)))])
            near = np.hstack([sims[rows], among[np.ix_(rows, rows)]])
            ids, near = _top(ids, near, beam)
            ids = np.where(near > -2, ids, -1)
            chosen = self._select(ids, near, m)
            self.links[level][new[rows], :m] = chosen
            self._link_back(new[rows], chosen, level)

    def _select(self, ids: np.ndarray, sims: np.ndarray, m: int) -> np.ndarray:
        """Up to ``m`` of each row's candidates (best first): those nearer to the row than to one chosen before, then others."""
        step = max(1, GATHERED // (ids.shape[1] * self.vectors.shape[1]))
        if len(ids) > step:
            return np.vstack([self._select(ids[i : i + step], sims[i : i + step], m) for i in range(0, len(ids), step)])
        v = self.vectors[ids]
        mutual = v @ v.transpose(0, 2, 1)
        taken = np.zeros(ids.shape, bool)
        for k in range(ids.shape[1]):
            covered = ((mutual[:, k] > sims[:, k, None]) & taken).any(axis=1)
            taken[:, k] = (ids[:, k] >= 0) & (taken.sum(axis=1) < m) & ~covered
        rank = np.where(taken, 0, np.where(ids >= 0, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
        at = np.argsort(rank, axis=1)[:, :m]
        out = np.full((len(ids), m), -1, np.int32)
        out[:, : at.shape[1]] = np.take_along_axis(ids, at, 1)
        return out

    def _link_back(self, new: np.ndarray, chosen: np.ndarray, level: int) -> None:
        links = self.links[level]
        of, to = np.repeat(new, chosen.shape[1]), chosen.ravel()
        of, to = of[to >= 0], to[to >= 0]
        if not len(to):
            return
        order = np.argsort(to, kind="stable")
        of, to = of[order], to[order]
        nodes, first, n = np.unique(to, return_index=True, return_counts=True)
        width = links.shape[1]
        many = np.argsort(n, kind="stable")  # nodes that many link to are not laid beside those with few
        nodes, first, n = nodes[many], first[many], n[many]
        at = 0
        while at < len(nodes):
            end = min(at + BATCH, len(nodes))
            end = min(end, at + max(1, GATHERED // ((width + int(n[end - 1])) * self.vectors.shape[1])))
            node, count = nodes[at:end], n[at:end]
            part = np.full((end - at, width + int(count[-1])), -1, np.int64)
            part[:, :width] = links[node]
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            part[np.repeat(np.arange(end - at), count), width + place] = of[np.repeat(first[at:end], count) + place]
            part = np.sort(part, axis=1)[:, ::-1].copy()
            part[:, 1:][part[:, 1:] == part[:, :-1]] = -1  # linked both ways already
            sims = np.einsum("bkd,bd->bk", self.vectors[part], self.vectors[node])
            sims[part < 0] = -2
            part, sims = _top(part, sims, 2 * width)
            part = np.where(sims > -2, part, -1)
            links[node] = self._select(part, sims, width)
            at = end

    def search(self, q: np.ndarray, start: np.ndarray, beam: int, level: int, nodes: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Nodes (-1: none) and similarities, best first, of a beam search on one level from the nodes ``start``.

        ``nodes``: so many are linked yet (default: all).
        """
        links = self.links[level]
        n, expand = min(len(links), nodes or len(links)), max(EXPAND, beam // 16)
        rows = max(1, min(max(16, VISITED_BYTES // max(1, n)), GATHERED // (expand * links.shape[1] * self.vectors.shape[1])))
        if len(q) > rows:
            parts = [self.search(q[i : i + rows], start[i : i + rows], beam, level, nodes) for i in range(0, len(q), rows)]
            return np.vstack([p[0] for p in parts]), np.vstack([p[1] for p in parts])
        b = len(q)
        visited = np.zeros((b, n + 1), bool)
        visited[:, n] = True  # stands for no node
        row = np.arange(b)[:, None]
        ids = np.full((b, beam), -1, np.int64)
        sims = np.full((b, beam), -2, np.float32)
        opened = np.ones((b, beam), bool)
        fresh = np.where(start >= 0, start, n)
        live = np.arange(b)
        while len(live):
            r = row[: len(live)]
            new = fresh
            seen = visited[live[:, None], new]
            order = np.argsort(new, axis=1, kind="stable")
            again = np.zeros(new.shape, bool)
            ranked = np.take_along_axis(new, order, 1)
            again[r, order[:, 1:]] = ranked[:, 1:] == ranked[:, :-1]
            usable = ~seen & ~again
            visited[live[:, None], new] = True
            near = np.einsum("bkd,bd->bk", self.vectors[np.minimum(new, n - 1)], q[live])
            near = np.where(usable, near, np.float32(-2))
            all_ids = np.hstack([ids[live], np.where(usable, new, -1)])
            all_sims = np.hstack([sims[live], near])
            all_open = np.hstack([opened[live], ~usable])
            at = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[live] = np.take_along_axis(all_ids, at, 1)
            sims[live] = np.take_along_axis(all_sims, at, 1)
            opened[live] = np.take_along_axis(all_open, at, 1)
            live = live[~opened[live].all(axis=1)]
            if not len(live):
                break
            pick = np.argsort(opened[live], axis=1, kind="stable")[:, :expand]  # the best that were not expanded yet
            todo = np.where(np.take_along_axis(opened[live], pick, 1), -1, np.take_along_axis(ids[live], pick, 1))
            opened[live[:, None], pick] = True
            around = np.where(todo[:, :, None] >= 0, links[todo], -1).reshape(len(live), -1)
            fresh = np.where(around >= 0, around, n)
        return ids, sims

    def nearest(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search from the top level down."""
        start = np.zeros((len(q), 1), np.int64)
        for level in range(len(self.links) - 1, 0, -1):
            start = self.search(q, start, 4, level)[0]
        return self.search(q, start, min(beam, len(self.vectors)), 0)

    def dump(self) -> dict[str, np.ndarray]:
        return {"vectors": self.vectors} | {f"links{l}": a for l, a in enumerate(self.links)}

    @classmethod
    def load(cls, arrays: dict[str, np.ndarray]) -> Graph:
        return cls(arrays["vectors"], [arrays[f"links{l}"] for l in range(sum(name.startswith("links") for name in arrays))])
