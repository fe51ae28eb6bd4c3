"""Nearest-entry search in small codebooks by Orchard's walk, many queries in step (numpy)."""

from __future__ import annotations

import numpy as np


class Orchard:
    """Codebooks of ``parts`` positions with ``size`` integer entries each.

    Every entry keeps the list of the other entries of its codebook, nearest first. A search
    starts at an entry and goes down its list. An entry that is nearer to the query than the
    current one becomes current, and the search goes on at the top of the new one's list;
    entries that were visited are passed by. The search ends where the list's distance is
    more than twice the current distance: by the triangle inequality nothing behind can be
    as near. Distances are exact squared integers, ties go to the lower index.
    """

    def __init__(self, entries: np.ndarray):
        self.entries = entries  # parts x size x width
        parts, size, _ = entries.shape
        apart = ((entries[:, :, None, :] - entries[:, None, :, :]) ** 2).sum(axis=3)
        order = np.argsort(apart, axis=2, kind="stable")
        other = order != np.arange(size)[None, :, None]
        self.near = order[other].reshape(parts, size, size - 1)
        self.apart = np.take_along_axis(apart, self.near, axis=2)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry, for rows x parts x width."""
        rows, parts, width = vectors.shape
        size = self.entries.shape[1]
        part = np.tile(np.arange(parts), rows)
        query = vectors.reshape(rows * parts, width)
        best = np.zeros(len(part), np.int64)
        least = ((query - self.entries[part, 0]) ** 2).sum(axis=1)
        visited = np.zeros((len(part), size), bool)
        visited[:, 0] = True
        live, place = np.arange(len(part)), np.zeros(len(part), np.int64)
        while size > 1 and len(live):
            own, now = part[live], best[live]
            going = (place < size - 1)
            # sqrt(apart) <= 2 sqrt(least), in integers
            going &= self.apart[own, now, np.minimum(place, size - 2)] <= 4 * least[live]
            live, place, own, now = live[going], place[going], own[going], now[going]
            entry = self.near[own, now, place]
            fresh = ~visited[live, entry]
            visited[live, entry] = True
            far = ((query[live] - self.entries[own, entry]) ** 2).sum(axis=1)
            better = fresh & ((far < least[live]) | ((far == least[live]) & (entry < now)))
            best[live[better]], least[live[better]] = entry[better], far[better]
            place = np.where(better, 0, place + 1)
        return best.reshape(rows, parts), least.reshape(rows, parts)
