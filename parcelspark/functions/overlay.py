"""Areas of intersections and unions by slabs: between two neighbouring vertex or crossing heights every
edge is straight and edges do not cross, so areas are sums of trapezoids. No new geometry is built."""

from __future__ import annotations

import numpy as np

from parcelspark.functions.wkb import Polygons, bounds


def _edges(polygons: Polygons, owner: int) -> np.ndarray:
    rows = [np.column_stack([r[:-1], r[1:], np.full(len(r) - 1, owner)]) for p in polygons for r in p if len(r) > 1]
    edges = np.concatenate(rows) if rows else np.zeros((0, 5))
    edges = edges[edges[:, 1] != edges[:, 3]]
    down = edges[:, 1] > edges[:, 3]
    edges[down] = edges[down][:, [2, 3, 0, 1, 4]]
    return edges


def _heights(edges: np.ndarray) -> np.ndarray:
    """Heights of all vertices and crossings."""
    ys = [edges[:, 1], edges[:, 3]]
    x0, y0, x1, y1 = edges[:, 0], edges[:, 1], edges[:, 2], edges[:, 3]
    dx, dy = x1 - x0, y1 - y0
    for low in range(0, len(edges), 512):
        s = slice(low, low + 512)
        cross = dx[s, None] * dy[None] - dy[s, None] * dx[None]
        with np.errstate(divide="ignore", invalid="ignore"):
            ox, oy = x0[None] - x0[s, None], y0[None] - y0[s, None]
            t, u = (ox * dy[None] - oy * dx[None]) / cross, (ox * dy[s, None] - oy * dx[s, None]) / cross
        meet = (cross != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
        ys.append((y0[s, None] + t * dy[s, None])[meet])
    return np.unique(np.concatenate(ys))


def _measure(groups: list[Polygons], counted) -> float:
    """Area where `counted` holds, given for each group whether a point is inside it."""
    edges = np.concatenate([_edges(g, i) for i, g in enumerate(groups)])
    if not len(edges):
        return 0.0
    edges = edges - np.array([*(o := edges[0, :2]), *o, 0])
    heights, total = _heights(edges), 0.0
    slope = (edges[:, 2] - edges[:, 0]) / (edges[:, 3] - edges[:, 1])
    for a, b in zip(heights[:-1], heights[1:], strict=True):
        live = (edges[:, 1] <= a) & (edges[:, 3] >= b)
        if not live.any() or b <= a:
            continue
        e, k = edges[live], slope[live]
        low, high = e[:, 0] + (a - e[:, 1]) * k, e[:, 0] + (b - e[:, 1]) * k
        order = np.argsort(low + high, kind="stable")
        inside = [False] * len(groups)
        width_from, held = None, False
        for i in order:
            g = int(e[i, 4])
            inside[g] = not inside[g]
            now = counted(inside)
            if now != held:
                if held:
                    total += ((low[i] - width_from[0]) + (high[i] - width_from[1])) / 2 * (b - a)
                width_from, held = (low[i], high[i]), now
    return float(total)


def boxes_apart(a: Polygons, b: Polygons) -> bool:
    p, q = bounds(a), bounds(b)
    return p is None or q is None or p[0] > q[2] or q[0] > p[2] or p[1] > q[3] or q[1] > p[3]


def intersection_area(a: Polygons, b: Polygons) -> float:
    return 0.0 if boxes_apart(a, b) else _measure([a, b], all)


def union_area(polygons: list[Polygons]) -> float:
    """Area covered by at least one."""
    return _measure(polygons, any)


def covered_area(a: Polygons, pieces: list[Polygons]) -> float:
    """Area of `a` that lies in at least one of the pieces, which may overlap."""
    near = [p for p in pieces if not boxes_apart(a, p)]
    return _measure([a, *near], lambda inside: inside[0] and any(inside[1:])) if near else 0.0


def land_fraction(a: Polygons, pieces: list[Polygons]) -> float | None:
    """Share of `a` on land; None without area."""
    own = _measure([a], all)
    return None if own <= 0 else min(1.0, covered_area(a, pieces) / own)


def is_seam_pair(overlap: float, area_a: float, area_b: float, same_tile: bool, share: float = 0.1, least: float = 100.0) -> bool:
    """Are two parcels pieces of one? They overlap by a share of the smaller; from two tiles also by an
    area. A shared edge is no overlap."""
    return overlap >= share * min(area_a, area_b) and overlap > 0 and (same_tile or overlap >= least)


#: Pairs of edges that are compared at a time, and polygons that a large union takes at a time.
PAIRS, FAN = 1 << 20, 16
#: Edges of a row from which on those near a level are looked up.
WIDE = 64


def _spans(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts n: which one each of sum(n) places belongs to, and its place there."""
    of = np.repeat(np.arange(len(n)), n)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)


def _chunks(n: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Slices of counts whose sums stay near `most`, one place at least."""
    marks = np.flatnonzero(np.diff(np.cumsum(n) // most)) + 1
    ends = [0, *marks.tolist(), len(n)]
    return [(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True) if b > a]


def meeting(row: np.ndarray, low: np.ndarray, high: np.ndarray, most: int = PAIRS):
    """Pairs (i, j) of boxes of one row that meet or touch, each pair once, in portions. `low` and `high` are corners;
    a sweep along x finds the candidates."""
    n = len(row)
    if not n:
        return
    order = np.lexsort((low[:, 0], row))
    row, low, high = row[order], low[order], high[order]
    after = np.maximum(_ranks(row, low[:, 0], row, high[:, 0]) - np.arange(n) - 1, 0)
    for a, b in _chunks(after, most):
        i, k = _spans(after[a:b])
        i += a
        j = i + 1 + k
        m = (low[i, 1] <= high[j, 1]) & (high[i, 1] >= low[j, 1])
        yield order[i[m]], order[j[m]]


def _ranks(row: np.ndarray, values: np.ndarray, of: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each place (of, at): how many of the values, by row, come at or before it."""
    order = np.lexsort((np.repeat([0, 1], [len(row), len(of)]), np.concatenate([values, at]), np.concatenate([row, of])))
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(order < len(row))
    return out[len(row) :]


class Arrangement:
    """Edges of many rows at once, each row some groups of polygons: cut where they cross or touch, with ends that
    agree to 1e-9 of a row's extent made one, and only those left that `held` ('any' or 'all' of the row's groups,
    each by the even-odd rule) holds on one side of. They are turned so that the region is on the left."""

    def __init__(self, rows: list[list[Polygons]], held: str):
        rings = [(r, i, g) for i, groups in enumerate(rows) for g, polygons in enumerate(groups) for p in polygons for r in p if len(r) > 1]
        self.n = len(rows)
        self.a = self.b = np.zeros((0, 2))
        self.row = np.zeros(0, np.int64)
        self.tail = self.head = np.zeros(0, np.int64)
        if not rings:
            return
        sizes = np.array([len(r) for r, _, _ in rings])
        points = np.concatenate([r for r, _, _ in rings])
        step = np.ones(len(points), bool)
        step[np.cumsum(sizes) - 1] = False
        at = np.flatnonzero(step)
        a, b = points[at], points[at + 1]
        row = np.repeat([i for _, i, _ in rings], sizes)[at]
        group = np.repeat([g for _, _, g in rings], sizes)[at]
        real = (a != b).any(1)
        a, b, row, group = a[real], b[real], row[real], group[real]
        if not len(a):
            return
        self.low = np.full((self.n, 2), np.inf)
        top = np.full((self.n, 2), -np.inf)
        for k in (a, b):
            np.minimum.at(self.low, row, k)
            np.maximum.at(top, row, k)
        self.scale = np.maximum((top - self.low).max(1), 1e-12) * 1e-9
        self._sides(group, *self._cut(a, b, row), np.array([len(g) for g in rows]), held)

    def _cut(self, a, b, row):
        """The edge of each piece, its ends as numbers of nodes, the nodes and their rows."""
        eps = self.scale[row][:, None]
        d, size = b - a, ((b - a) ** 2).sum(1)
        edges, places, points, made = [np.arange(len(a))] * 2, [np.zeros(len(a)), np.ones(len(a))], [a, b], [np.zeros(2 * len(a), np.int8)]
        for i, j in meeting(row, np.minimum(a, b) - eps, np.maximum(a, b) + eps):
            cross = d[i, 0] * d[j, 1] - d[i, 1] * d[j, 0]
            o = a[j] - a[i]
            with np.errstate(divide="ignore", invalid="ignore"):
                t, u = (o[:, 0] * d[j, 1] - o[:, 1] * d[j, 0]) / cross, (o[:, 0] * d[i, 1] - o[:, 1] * d[i, 0]) / cross
            meet = (cross != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
            for x, y in ((i, j), (j, i)):  # ends of y that lie on x, which collinear edges meet at
                for end in (a, b):
                    v = end[y] - a[x]
                    along = (v * d[x]).sum(1) / size[x]
                    off = np.abs(v[:, 0] * d[x, 1] - v[:, 1] * d[x, 0]) / np.sqrt(size[x])
                    on = off <= self.scale[row[x]]
                    near = on & (along > -1e-9) & (along < 1 + 1e-9)
                    meet &= ~near
                    on &= (along > 0) & (along < 1)
                    edges.append(x[on])
                    places.append(along[on])
                    points.append(end[y][on])
                    made.append(np.zeros(on.sum(), np.int8))
            i, j, t, u = i[meet], j[meet], t[meet], u[meet]
            p = a[i] + t[:, None] * d[i]
            edges += [i, j]
            places += [t, u]
            points += [p, p]
            made.append(np.ones(2 * len(i), np.int8))
        edge, place, point, made = (np.concatenate(x) for x in (edges, places, points, made))
        order = np.lexsort((place, edge))
        edge, point, made = edge[order], point[order], made[order]
        of = row[edge]
        key = np.rint((point - self.low[of]) / self.scale[of][:, None]).astype(np.int64)
        # points of one key are one node, at a corner of the input where there is one
        by = np.lexsort((made, key[:, 1], key[:, 0], of))
        new = np.ones(len(by), bool)
        new[1:] = (of[by[1:]] != of[by[:-1]]) | (key[by[1:]] != key[by[:-1]]).any(1)
        node = np.empty(len(by), np.int64)
        node[by] = np.cumsum(new) - 1
        first = by[new]
        m = (edge[1:] == edge[:-1]) & (node[1:] != node[:-1])
        return edge[:-1][m], node[:-1][m], node[1:][m], point[first], of[first]

    def _sides(self, group, edge, tail, head, nodes, of, n_groups, held):
        # pieces that lie on one another are one, with the groups that have an odd number of them
        tail, head, wide = np.minimum(tail, head), np.maximum(tail, head), int(n_groups.max())
        found, which = np.unique(tail * len(nodes) + head, return_inverse=True)
        tail, head = found // len(nodes), found % len(nodes)
        own = (np.bincount(which * wide + group[edge], minlength=len(found) * wide) % 2).reshape(-1, wide)
        piece = of[tail]
        p, q = nodes[tail] - self.low[piece], nodes[head] - self.low[piece]
        at = (p + q) / 2
        # of the pieces that rise or fall those whose lower ends lie near a level may cross it; no piece is asked about itself
        up = np.flatnonzero((p[:, 1] != q[:, 1]) & own.any(1))
        bottom = np.minimum(p[up, 1], q[up, 1])
        order = np.lexsort((bottom, piece[up]))
        up, bottom = up[order], bottom[order]
        row = piece[up]
        first, last = np.searchsorted(row, piece), np.searchsorted(row, piece, "right")
        if len(row) and (last - first).max() > WIDE:
            reach = np.zeros(self.n)
            np.maximum.at(reach, row, np.abs(p[up, 1] - q[up, 1]))
            # one place earlier, for a piece as high as any may begin where the search does
            first = np.maximum(_ranks(row, bottom, piece, at[:, 1] - reach[piece] * (1 + 1e-9)) - 1, first)
            last = _ranks(row, bottom, piece, at[:, 1])
        n_near = np.maximum(last - first, 0)
        odd = np.zeros((len(tail), wide), np.int64)
        for low, high in _chunks(n_near, PAIRS):
            s, k = _spans(n_near[low:high])
            e = up[first[low:high][s] + k]
            s += low
            y, y0, y1 = at[s, 1], p[e, 1], q[e, 1]
            c = np.flatnonzero(((y0 > y) != (y1 > y)) & (e != s))
            s, e, y, y0, y1 = s[c], e[c], y[c], y0[c], y1[c]
            m = at[s, 0] < p[e, 0] + (y - y0) * (q[e, 0] - p[e, 0]) / (y1 - y0)
            s, e = s[m], e[m]
            for g in range(wide):
                odd[low:high, g] = np.bincount((s - low)[own[e, g] == 1], minlength=high - low) % 2
        # a ray to the right leaves a piece on its right side; from a level one it starts above
        rising = (q[:, 1] > p[:, 1])[:, None]
        sides = np.where(rising, odd ^ own, odd), np.where(rising, odd, odd ^ own)
        inside = [x.sum(1) > 0 if held == "any" else x.sum(1) == n_groups[piece] for x in sides]
        keep = inside[0] != inside[1]
        left = inside[0][keep]
        tail, head = tail[keep], head[keep]
        self.tail, self.head = np.where(left, tail, head), np.where(left, head, tail)
        self.nodes, self.row = nodes, piece[keep]
        self.a, self.b = nodes[self.tail], nodes[self.head]

    def areas(self) -> np.ndarray:
        if not len(self.row):
            return np.zeros(self.n)
        o = self.low[self.row]
        p, q = self.a - o, self.b - o
        return np.bincount(self.row, weights=p[:, 0] * q[:, 1] - p[:, 1] * q[:, 0], minlength=self.n) / 2

    def _rings(self) -> list[list[int]]:
        """Nodes of closed walks, the first one again at the end."""
        ways: dict[int, list[int]] = {}
        for p, q in zip(self.tail.tolist(), self.head.tolist(), strict=True):
            ways.setdefault(p, []).append(q)
        rings, nodes = [], self.nodes
        while ways:
            start = at = next(iter(ways))
            ring, last = [at], None
            while options := ways.get(at):
                if last is None or len(options) == 1:
                    to = options[0]
                else:  # several ways on: the first one clockwise from where the walk came keeps each ring by itself
                    angle = lambda o, c=nodes[at]: np.arctan2(nodes[o][1] - c[1], nodes[o][0] - c[0])
                    back = angle(last)
                    to = min(options, key=lambda o: (back - angle(o)) % (2 * np.pi))
                options.remove(to)
                if not options:
                    del ways[at]
                last, at = at, to
                ring.append(at)
                if at == start:
                    break
            if len(ring) >= 4 and ring[0] == ring[-1]:
                rings.append(ring)
        return rings

    def polygons(self) -> list[Polygons]:
        """The region of each row."""
        from parcelspark.functions.wkb import contains, ring_area

        out: list[Polygons] = [[] for _ in range(self.n)]
        if not len(self.row) or not (walks := self._rings()):
            return out
        of = {}
        for node, row in zip(self.tail.tolist(), self.row.tolist(), strict=True):
            of[node] = row
        # corners where a ring bends, of all rings at once
        n = np.array([len(w) - 1 for w in walks])
        points = self.nodes[np.concatenate([w[:-1] for w in walks])]
        begin = np.cumsum(n) - n
        after = np.arange(len(points)) + 1
        after[begin + n - 1] = begin
        before = np.empty_like(after)
        before[after] = np.arange(len(points))
        d = points[after] - points
        turn = np.abs(d[before, 0] * d[:, 1] - d[before, 1] * d[:, 0])
        bend = turn > np.repeat(1e-12 * (np.maximum.reduceat(np.abs(d).max(1), begin) ** 2 + 1e-300), n)
        left = np.add.reduceat(bend.astype(np.int64), begin)
        corners = np.split(points[bend], np.cumsum(left)[:-1])
        holes = []
        for walk, p in zip(walks, corners, strict=True):
            if len(p) < 3:
                continue
            ring = np.concatenate([p, p[:1]])
            size = ring_area(ring)
            if size > 0:
                out[of[walk[0]]].append([ring])
            elif size < 0:
                holes.append((of[walk[0]], ring))
        for parts in out:
            if len(parts) > 1:
                parts.sort(key=lambda p: (p[0][:, 0].min(), p[0][:, 1].min()))
        for row, hole in holes:
            d = hole[1] - hole[0]
            at = (hole[0] + hole[1]) / 2 + np.array([-d[1], d[0]]) * 1e-6
            around = [p for p in out[row] if contains([[p[0]]], at[:1], at[1:])[0]]
            if around:
                min(around, key=lambda p: ring_area(p[0])).append(hole)
        return out


def unions(rows: list[list[Polygons]]) -> list[Polygons]:
    """Of each row the region that at least one of its geometries covers. Many geometries are united with their
    neighbours first, so that what lies inside the outlines is not compared again."""
    rows = [[p for p in polygons if p] for polygons in rows]
    while large := [i for i, r in enumerate(rows) if len(r) > FAN]:
        parts, sizes = [], []
        for i in large:
            boxes = np.array([bounds(p) for p in rows[i]])
            x, y = (boxes[:, 0] + boxes[:, 2]) / 2, (boxes[:, 1] + boxes[:, 3]) / 2
            columns = max(1, round(float(np.sqrt(len(x) / FAN))))
            column = np.argsort(np.argsort(x, kind="stable"), kind="stable") * columns // len(x)
            order = np.lexsort((y, column)).tolist()
            parts += [[rows[i][k] for k in order[a : a + FAN]] for a in range(0, len(order), FAN)]
            sizes.append(-(-len(order) // FAN))
        done = iter(Arrangement(parts, "any").polygons())
        for i, size in zip(large, sizes, strict=True):
            rows[i] = [next(done) for _ in range(size)]
    return Arrangement(rows, "any").polygons()


def intersections(pairs: list[tuple[Polygons, Polygons]]) -> list[Polygons]:
    return Arrangement([list(p) for p in pairs], "all").polygons()


def intersection_areas(pairs: list[tuple[Polygons, Polygons]]) -> np.ndarray:
    return Arrangement([list(p) for p in pairs], "all").areas()


def union(polygons: list[Polygons]) -> Polygons:
    return unions([polygons])[0]


def intersection(a: Polygons, b: Polygons) -> Polygons:
    return [] if boxes_apart(a, b) else intersections([(a, b)])[0]


def repaired(polygons: Polygons) -> Polygons:
    """The same region with valid rings: crossings become corners, slivers without area go."""
    return Arrangement([[polygons]], "all").polygons()[0] if polygons else []
