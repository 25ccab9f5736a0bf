"""Closest-first matching inside one block of sites, as far as the block decides it.

Numpy helper of ``match``: a block is a tile of the globe with the tiles around it, of bounded size.
Candidate pairs come one by one in their order. By place, they come from a queue of pairs of tree
nodes with lower bounds of their distance: a pair of boxes is opened only when nothing closer is
left, and boxes without open sites are dropped, so far groups do not list all their pairs. By name,
they come from an index of cells and of the rarest grams that similar names cannot both miss.

A site whose partners may lie beyond the block is *unsure*: a pair with an unsure site can be
neither taken nor refused, and makes its other site unsure for all later pairs. Everything else is
exactly what the matching of all sites would do.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np

from hexmosaic.functions.geo import EARTH_R, RAD

LEAF = 16
#: Metres by which bounds stay below distances.
SLACK = 1e-6


def distance(lat1, lng1, lat2, lng2) -> np.ndarray:
    """Great-circle distance in metres, as ``geo.haversine_m``."""
    dlat, dlng = np.sin((lat2 - lat1) * RAD / 2), np.sin((lng2 - lng1) * RAD / 2)
    h = dlat * dlat + np.cos(lat1 * RAD) * np.cos(lat2 * RAD) * dlng * dlng
    return np.arcsin(np.minimum(np.sqrt(h), 1.0)) * (2.0 * EARTH_R)


class Side:
    """Sites of one side, their state, and a tree of boxes over them."""

    def __init__(self, ids: list, lat: np.ndarray, lng: np.ndarray, cap: np.ndarray, grams: list, sure: np.ndarray):
        self.ids, self.lat, self.lng, self.cap, self.sure = ids, lat, lng, cap.copy(), sure.copy()
        self.grams = [frozenset(g) for g in grams]
        c = np.cos(lat * RAD)
        self.xyz = np.stack([c * np.cos(lng * RAD), c * np.sin(lng * RAD), np.sin(lat * RAD)], 1)
        self.box, self.kids, self.members, self.parent = [], [], [], []
        self.leaf_of = np.zeros(len(ids), int)
        if len(ids):
            self._grow(np.arange(len(ids)), -1)
        self.open, self.free = [0] * len(self.box), [0] * len(self.box)
        for k in range(len(ids)):
            self._count(k, self.open, 1)
            if sure[k]:
                self._count(k, self.free, 1)

    def _grow(self, at: np.ndarray, parent: int) -> int:
        node, xyz = len(self.box), self.xyz[at]
        low, high = xyz.min(0), xyz.max(0)
        self.box.append((*low.tolist(), *high.tolist()))
        self.parent.append(parent)
        self.kids.append(None)
        self.members.append(at)
        if len(at) > LEAF:
            axis, half = int(np.argmax(high - low)), len(at) // 2
            at = at[np.argpartition(xyz[:, axis], half)]
            self.kids[node] = (self._grow(at[:half], node), self._grow(at[half:], node))
        else:
            self.leaf_of[at] = node
        return node

    def _count(self, k: int, of: list[int], by: int) -> None:
        node = self.leaf_of[k]
        while node >= 0:
            of[node] += by
            node = self.parent[node]

    def doubt(self, k: int) -> None:
        if self.sure[k]:
            self.sure[k] = False
            self._count(k, self.free, -1)

    def take(self, k: int, n: int) -> None:
        self.cap[k] -= n
        if not self.cap[k]:
            self._count(k, self.open, -1)
            if self.sure[k]:
                self._count(k, self.free, -1)


def similarity(a: frozenset, b: frozenset) -> float:
    shared = len(a & b)
    total = len(a) + len(b) - shared
    return shared / total if total else 0.0


class Tally:
    """Distances measured, for tests of the cost."""

    measured = 0


def near(a: Side, b: Side, radius: float) -> Iterator[tuple]:
    """Pairs (d, -s, id, id, i, j) within the radius, in that order, between sites open when they come."""

    def bound(x: int, y: int) -> float:
        p, q = a.box[x], b.box[y]
        gap = 0.0
        for k in range(3):
            g = max(p[k] - q[k + 3], q[k] - p[k + 3])
            gap += g * g if g > 0 else 0.0
        return 2 * EARTH_R * math.asin(min(1.0, math.sqrt(gap) / 2)) - SLACK

    def push(x: int, y: int) -> None:
        low = bound(x, y)
        if low <= radius:
            heappush(heap, (low, -2.0, 0, 0, x, y))

    heap: list[tuple] = []
    if a.ids and b.ids:
        push(0, 0)
    while heap:
        pair = heappop(heap)
        if pair[1] > -2.0:
            yield pair
            continue
        x, y = pair[4:]
        if not a.open[x] or not b.open[y] or not (a.free[x] or b.free[y]):
            continue
        if a.kids[x] and (not b.kids[y] or len(a.members[x]) >= len(b.members[y])):
            for k in a.kids[x]:
                push(k, y)
        elif b.kids[y]:
            for k in b.kids[y]:
                push(x, k)
        else:
            i, j = (s.members[n][s.cap[s.members[n]] > 0] for s, n in ((a, x), (b, y)))
            d = distance(a.lat[i][:, None], a.lng[i][:, None], b.lat[j][None], b.lng[j][None])
            Tally.measured += d.size
            for u, v in zip(*np.nonzero(d <= radius)):
                p, q = int(i[u]), int(j[v])
                heappush(heap, (float(d[u, v]), -similarity(a.grams[p], b.grams[q]), a.ids[p], b.ids[q], p, q))


def alike(a: Side, b: Side, radius: float, least: float) -> Iterator[tuple]:
    """The same for pairs with a similarity of ``least`` or more, by cells of the radius and their rarest grams."""
    counts = Counter(g for s in (a, b) for x in s.grams for g in x)

    def prefix(x: frozenset) -> list[str]:
        return sorted(x, key=lambda g: (counts[g], g))[: len(x) - math.ceil(len(x) * (least - 1e-9)) + 1]

    side = 2 * math.sin(radius / (2 * EARTH_R)) * 1.000001
    cells: list[list[tuple]] = [[*map(tuple, np.floor(s.xyz / side).astype(int).tolist())] for s in (a, b)]
    steps = [(x, y, z) for x in (-1, 0, 1) for y in (-1, 0, 1) for z in (-1, 0, 1)]
    used, held = {(c[0] + x, c[1] + y, c[2] + z) for c in {*cells[0]} for x, y, z in steps}, {}
    for j, x in enumerate(b.grams):
        if cells[1][j] in used:
            at = held.setdefault(cells[1][j], defaultdict(list))
            for g in prefix(x):
                at[g].append(j)
    found = []
    for i, x in enumerate(a.grams):
        c = cells[0][i]
        near_by = [at for s in steps if (at := held.get((c[0] + s[0], c[1] + s[1], c[2] + s[2])))]
        if not near_by:
            continue
        first = prefix(x)
        some = {j for at in near_by for g in first for j in at.get(g, ())}
        # sets too different in size cannot be similar
        j = np.array([k for k in some if len(x) * (least - 1e-9) <= len(b.grams[k]) <= len(x) / (least - 1e-9)], int)
        if len(j):
            d = distance(a.lat[i], a.lng[i], b.lat[j], b.lng[j])
            Tally.measured += len(j)
            for k in np.flatnonzero(d <= radius):
                s = similarity(x, b.grams[j[k]])
                if s >= least and (a.sure[i] or b.sure[j[k]]):
                    found.append((float(d[k]), -s, a.ids[i], b.ids[j[k]], i, int(j[k])))
    heapify(found)
    while found:
        yield heappop(found)


def decide(a: Side, b: Side, radius: float, least: float | None) -> list[tuple]:
    """(i, j, d, s, n) of pairs that are matched for certain; undecided sites are left open and unsure."""
    taken = []
    for d, s, _, _, i, j in alike(a, b, radius, least) if least else near(a, b, radius):
        if not a.cap[i] or not b.cap[j]:
            continue
        if not a.sure[i] or not b.sure[j]:
            a.doubt(i)
            b.doubt(j)
            continue
        n = int(min(a.cap[i], b.cap[j]))
        taken.append((i, j, d, -s, n))
        a.take(i, n)
        b.take(j, n)
    return taken
