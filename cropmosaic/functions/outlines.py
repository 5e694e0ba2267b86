"""Outlines from signed edges, inside a task: unions of overlapping polygons and rings walked back together.

Edges are those of `functions.geometry`: from left to right, s = +1 for a top and -1 for a
bottom, vertical ones left out. Over every x the signs add up to zero.
"""

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from cropmosaic.functions.geometry import EDGE_TYPE

#: Points of one vertical line, and lines, nearer than this are one (metres; rounding is some 1e-9).
SNAP = 1e-7
_ROWS = 512
#: Outlines with more segments are not tested here.
MOST_SEGMENTS = 1000
#: Pairs of edges compared at a time, so few that they stay in the cache.
EDGE_PAIRS = 1 << 14

Edges = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _at(x1, y1, x2, y2, x):
    """y of an edge at x; its own ends give exactly their y."""
    with np.errstate(invalid="ignore", divide="ignore"):
        inner = y1 + (x - x1) / (x2 - x1) * (y2 - y1)
    return np.where(x == x1, y1, np.where(x == x2, y2, inner))


def _runs_of(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers first[i] ... last[i] - 1 in turn, and the i of each."""
    n = last - first
    owner = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - first, n), owner


def self_meetings(rings: pa.ListArray) -> pa.Array:
    """For each feature what `geometry.self_crossing` tells, all features of a batch side by side.

    NULL where that is left to the expression: outlines of more than MOST_SEGMENTS segments, and
    those with a coordinate that is missing or not finite. The comparisons are those of the expression.
    """
    lists = rings.values
    points = lists.values
    xs, ys = (points.field(c).to_numpy(zero_copy_only=False) for c in "xy")
    ring_at, point_at = rings.offsets.to_numpy().astype(np.int64), lists.offsets.to_numpy().astype(np.int64)
    absent = rings.is_null().to_numpy(zero_copy_only=False)
    ring, feature = _runs_of(ring_at[:-1], np.where(absent, ring_at[:-1], ring_at[1:]))
    start, which = _runs_of(point_at[ring], point_at[ring + 1])
    of = feature[which]
    end = start + 1
    final = end == point_at[ring[which] + 1]
    end[final] = point_at[ring[which[final]]]
    x1, y1, x2, y2 = xs[start], ys[start], xs[end], ys[end]
    n = len(rings)
    unknown = np.bincount(of, weights=~(np.isfinite(x1) & np.isfinite(y1)), minlength=n) > 0
    if lists.null_count or points.null_count:
        unknown |= True
    drawn = ((x1 != x2) | (y1 != y2)) & ~unknown[of]
    unknown |= np.bincount(of[drawn], minlength=n) > MOST_SEGMENTS
    drawn &= ~unknown[of]
    of, x1, y1, x2, y2 = of[drawn], x1[drawn], y1[drawn], x2[drawn], y2[drawn]
    meets = np.zeros(n, bool)
    order = np.lexsort((y1, x1, of))
    a, b = order[:-1], order[1:]
    meets[of[a][(of[a] == of[b]) & (x1[a] == x1[b]) & (y1[a] == y1[b])]] = True  # a corner returned to
    back = (x1 > x2) | ((x1 == x2) & (y1 > y2))
    x1, y1, x2, y2 = np.where(back, x2, x1), np.where(back, y2, y1), np.where(back, x1, x2), np.where(back, y1, y2)
    order = np.lexsort((x1, of))
    of, x1, y1, x2, y2 = of[order], x1[order], y1[order], x2[order], y2[order]
    low, high = np.minimum(y1, y2), np.maximum(y1, y2)
    dx, dy = x2 - x1, y2 - y1
    last = np.searchsorted(of, of, side="right")

    def side(e, x, y):
        return np.sign(dx[e] * (y - y1[e]) - dy[e] * (x - x1[e]))

    def inside(e, x, y, turn):
        on = (turn == 0) & (x >= x1[e]) & (x <= x2[e]) & (y >= low[e]) & (y <= high[e])
        return on & ((x != x1[e]) | (y != y1[e])) & ((x != x2[e]) | (y != y2[e]))

    e, step = np.flatnonzero(~meets[of]), 0
    while len(e):  # each segment against the next one by its left end, then the one after that, while they reach so far
        step += 1
        e = e[e + step < last[e]]
        f = e + step
        near = (x1[f] <= x2[e]) & ~meets[of[e]]
        e, f = e[near], f[near]
        close = (high[e] >= low[f]) & (high[f] >= low[e])
        p, q = e[close], f[close]
        p1, p2, q1, q2 = side(q, x1[p], y1[p]), side(q, x2[p], y2[p]), side(p, x1[q], y1[q]), side(p, x2[q], y2[q])
        hit = (q1 * q2 < 0) & (p1 * p2 < 0)
        hit |= inside(p, x1[q], y1[q], q1) | inside(p, x2[q], y2[q], q2)
        hit |= inside(q, x1[p], y1[p], p1) | inside(q, x2[p], y2[p], p2)
        meets[of[p[hit]]] = True
    return pa.array(meets, mask=unknown)


def meets_itself(rings: str) -> Column:
    """self_meetings() of a column of rings."""

    def run(column: pa.Array) -> pa.Array:
        return self_meetings(column)

    return F.arrow_udf(run, "boolean")(rings)


def plain_outlines(rings: pa.ListArray) -> pa.StructArray:
    """meets (see self_meetings), edges and box of each feature; the last two NULL but for outlines of one ring that does not meet itself.

    Edges are those of `geometry.oriented_edges`, in its order, and the box is that of `geometry.bbox`.
    """
    n, lists = len(rings), rings.values
    points = lists.values
    meets = self_meetings(rings)
    xs, ys = (points.field(c).to_numpy(zero_copy_only=False) for c in "xy")
    ring_at, point_at = rings.offsets.to_numpy().astype(np.int64), lists.offsets.to_numpy().astype(np.int64)
    plain = ~meets.fill_null(True).to_numpy(zero_copy_only=False) & (np.diff(ring_at) == 1) & rings.is_valid().to_numpy(zero_copy_only=False)
    which = np.flatnonzero(plain)
    ring = ring_at[:-1][which]
    drawn = point_at[ring + 1] > point_at[ring]
    plain[which[~drawn]] = False
    which, ring = which[drawn], ring[drawn]
    start, of = _runs_of(point_at[ring], point_at[ring + 1])
    first = np.cumsum(point_at[ring + 1] - point_at[ring]) - (point_at[ring + 1] - point_at[ring])
    end = start + 1
    end[np.append(first[1:], len(start))[: len(first)] - 1] = start[first]
    box = [np.zeros(n) for _ in range(4)]
    if len(which):
        for side, (values, least) in zip(box, ((xs, np.minimum), (ys, np.minimum), (xs, np.maximum), (ys, np.maximum))):
            side[which] = least.reduceat(values[start], first)
    x1, y1, x2, y2 = xs[start], ys[start], xs[end], ys[end]
    upright = x1 == x2
    of, x1, y1, x2, y2 = of[~upright], x1[~upright], y1[~upright], x2[~upright], y2[~upright]
    back = x2 < x1
    x1, y1, x2, y2 = np.where(back, x2, x1), np.where(back, y2, y1), np.where(back, x1, x2), np.where(back, y1, y2)
    s = np.where(back, 1, -1)
    count = np.bincount(of, minlength=len(which))
    base = np.repeat(y1[np.minimum(np.cumsum(count) - count, max(len(y1) - 1, 0))] if len(y1) else np.zeros(len(which)), count)
    area = np.bincount(of, weights=s * (x2 - x1) * ((y1 - base) + (y2 - base)) / 2, minlength=len(which))
    s = np.where(area[of] < 0, -s, s).astype(np.int32)
    sizes = np.zeros(n, np.int64)
    sizes[which] = count
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    edges = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(c) for c in (x1, y1, x2, y2, s)], ["x1", "y1", "x2", "y2", "s"]), mask=pa.array(~plain))
    boxes = pa.StructArray.from_arrays([pa.array(c) for c in box], ["xmin", "ymin", "xmax", "ymax"], mask=pa.array(~plain))
    return pa.StructArray.from_arrays([meets, edges, boxes], ["meets", "edges", "box"])


def outline_parts(rings: str) -> Column:
    """plain_outlines() of a column of rings."""

    def run(column: pa.Array) -> pa.Array:
        return plain_outlines(column)

    box = "struct<xmin:double,ymin:double,xmax:double,ymax:double>"
    return F.arrow_udf(run, f"struct<meets:boolean,edges:array<{EDGE_TYPE}>,box:{box}>")(rings)


def overlap_areas(a: pa.ListArray, b: pa.ListArray) -> pa.Array:
    """For each row what `geometry.overlap_area` tells of two lists of signed edges, all rows of a batch side by side.

    NULL where a list is, and where that is left to the expression: rows with a coordinate that is missing
    or not finite. Terms and the order in which they are added are those of the expression.
    """
    n = len(a)
    unknown = (a.is_null().to_numpy(zero_copy_only=False)) | (b.is_null().to_numpy(zero_copy_only=False))
    sides = []
    for lists in (a, b):
        x1, y1, x2, y2, s = (lists.values.field(c).to_numpy(zero_copy_only=False) for c in ("x1", "y1", "x2", "y2", "s"))
        at = lists.offsets.to_numpy().astype(np.int64)
        odd = np.concatenate(([0], np.cumsum(~np.isfinite(x1 + y1 + x2 + y2))))
        unknown |= (odd[at[1:]] > odd[at[:-1]]) | (lists.values.null_count > 0)
        sides.append((at, x1, y1, x2, y2, s))
    (a_at, ax1, ay1, ax2, ay2, a_s), (b_at, bx1, by1, bx2, by2, b_s) = sides
    edge, row = _runs_of(a_at[:-1], np.where(unknown, a_at[:-1], a_at[1:]))
    share = np.zeros(len(edge))
    pairs = np.cumsum(b_at[row + 1] - b_at[row])
    lo = 0
    while lo < len(edge):
        before = pairs[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(pairs, before + EDGE_PAIRS, side="right")))
        q, of = _runs_of(b_at[row[lo:hi]], b_at[row[lo:hi] + 1])
        p = edge[lo:hi][of]
        left, right = np.maximum(ax1[p], bx1[q]), np.minimum(ax2[p], bx2[q])
        meet = left < right
        p, q, of, left, right = p[meet], q[meet], of[meet], left[meet], right[meet]
        px1, py1, qx1, qy1 = ax1[p], ay1[p], bx1[q], by1[q]
        p_run, p_rise, q_run, q_rise = ax2[p] - px1, ay2[p] - py1, bx2[q] - qx1, by2[q] - qy1
        first, last = (
            (py1 + (x - px1) / p_run * p_rise) - (qy1 + (x - qx1) / q_run * q_rise) for x in (left, right)
        )  # how far one edge lies above the other at both ends
        with np.errstate(invalid="ignore", divide="ignore"):
            crossed = (first * first + last * last) / np.abs(first - last)
        distance = np.where(first * last >= 0, np.abs(first + last), crossed)
        share[lo:hi] = np.bincount(of, weights=distance * (right - left) * -(a_s[p] * b_s[q]) / 4, minlength=hi - lo)
        lo = hi
    return pa.array(np.bincount(row, weights=share, minlength=n), mask=unknown)


def overlap_of_edges(a: Column, b: Column) -> Column:
    """overlap_areas() of two columns of signed edges."""

    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        return overlap_areas(a, b)

    return F.arrow_udf(run, "double")(a, b)


def crossings(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> np.ndarray:
    """x of every point at which two edges cross inside both; some rows against all later ones at a time."""
    order = np.argsort(x1, kind="stable")
    x1, y1, x2, y2 = x1[order], y1[order], x2[order], y2[order]
    found = []
    for k in range(0, len(x1), _ROWS):
        a = slice(k, k + _ROWS)
        stop = int(np.searchsorted(x1, x2[a].max(initial=-np.inf)))
        b = slice(k, max(k, stop))
        lo = np.maximum(x1[a, None], x1[None, b])
        hi = np.minimum(x2[a, None], x2[None, b])
        i, j = np.nonzero(lo < hi)
        later = j > i
        i, j = i[later] + k, j[later] + k
        lo, hi = np.maximum(x1[i], x1[j]), np.minimum(x2[i], x2[j])
        at_lo = _at(x1[i], y1[i], x2[i], y2[i], lo) - _at(x1[j], y1[j], x2[j], y2[j], lo)
        at_hi = _at(x1[i], y1[i], x2[i], y2[i], hi) - _at(x1[j], y1[j], x2[j], y2[j], hi)
        cross = at_lo * at_hi < 0
        lo, hi, at_lo, at_hi = lo[cross], hi[cross], at_lo[cross], at_hi[cross]
        found.append(lo + (hi - lo) * at_lo / (at_lo - at_hi))
    return np.concatenate(found) if found else np.zeros(0)


def crossings_of_groups(of: np.ndarray, x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group and x of every point at which two edges of a group cross inside both; `of` is the group of each edge.

    Edges are sorted by group and left end; each is compared with the next one, then with the one
    after that, while they begin before it ends, all edges of all groups at a time.
    """
    order = np.lexsort((x1, of))
    of, x1, y1, x2, y2 = of[order], x1[order], y1[order], x2[order], y2[order]
    last = np.searchsorted(of, of, side="right")
    groups, found = [np.zeros(0, of.dtype)], [np.zeros(0)]
    i, step = np.arange(len(x1)), 0
    while len(i):
        step += 1
        i = i[i + step < last[i]]
        i = i[x1[i + step] < x2[i]]
        j = i + step
        lo, hi = x1[j], np.minimum(x2[i], x2[j])
        at_lo = _at(x1[i], y1[i], x2[i], y2[i], lo) - _at(x1[j], y1[j], x2[j], y2[j], lo)
        at_hi = _at(x1[i], y1[i], x2[i], y2[i], hi) - _at(x1[j], y1[j], x2[j], y2[j], hi)
        cross = at_lo * at_hi < 0
        lo, hi, at_lo, at_hi = lo[cross], hi[cross], at_lo[cross], at_hi[cross]
        groups.append(of[i[cross]])
        found.append(lo + (hi - lo) * at_lo / (at_lo - at_hi))
    return np.concatenate(groups), np.concatenate(found)


def union(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, s: np.ndarray) -> Edges:
    """Signed edges of what at least one polygon covers, from the edges of all of them put together."""
    return union_of_groups(np.zeros(len(x1), np.int64), x1, y1, x2, y2, s)[1:]


def union_of_groups(of: np.ndarray, x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, ...]:
    """Group and signed edges of what at least one polygon of the group covers; `of`, ascending, is the group of each edge.

    The plane is cut into strips at all ends and crossings. In a strip edges do not cross, and
    the running sum of their signs from below is the number of polygons that cover the gap above
    each; edges stay where that number leaves or reaches zero. Neighbouring pieces of one edge
    are one piece again.
    """
    if len(of) and of[0] == of[-1]:
        cut = crossings(x1, y1, x2, y2)
        where = np.full(len(cut), of[0])
    else:
        where, cut = crossings_of_groups(of, x1, y1, x2, y2)
    where, cut = np.concatenate([of, of, where]), np.concatenate([x1, x2, cut])
    order = np.lexsort((cut, where))
    where, cut = where[order], cut[order]
    fresh = np.ones(len(cut), bool)
    fresh[1:] = (where[1:] != where[:-1]) | (cut[1:] != cut[:-1])
    xs, place = cut[fresh], np.empty(len(cut), np.int64)
    place[order] = np.cumsum(fresh) - 1
    first, last = place[: len(x1)], place[len(x1) : 2 * len(x1)]
    parts = last - first
    edge = np.repeat(np.arange(len(x1)), parts)
    strip = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts) + first[edge]
    line = x1[edge], y1[edge], x2[edge], y2[edge]
    middle = _at(*line, xs[strip]) + _at(*line, xs[strip + 1])
    order = np.lexsort((s[edge], middle, strip))  # bottoms before tops of the same height
    above = np.cumsum(-s[edge][order])
    below = above + s[edge][order]
    stays = (above > 0) != (below > 0)
    order, sign = order[stays], np.where(below[stays] > 0, 1, -1)
    edge, strip = edge[order], strip[order]
    order = np.lexsort((strip, edge))
    edge, strip, sign = edge[order], strip[order], sign[order]
    goes_on = (edge[1:] == edge[:-1]) & (strip[1:] == strip[:-1] + 1) & (sign[1:] == sign[:-1])
    head = np.flatnonzero(np.r_[True, ~goes_on]) if len(edge) else np.zeros(0, np.int64)
    tail = np.r_[head[1:], len(edge)] - 1 if len(edge) else head
    e, a, b = edge[head], xs[strip[head]], xs[strip[tail] + 1]
    line = x1[e], y1[e], x2[e], y2[e]
    return of[e], a, _at(*line, a), b, _at(*line, b), sign[head]


def _snapped(values: np.ndarray) -> dict[float, float]:
    """Each value -> the first of the run of values it lies in, neighbours of a run being at most SNAP apart."""
    out, last, name = {}, -math.inf, 0.0
    for v in np.unique(values).tolist():
        if v - last > SNAP:
            name = v
        out[v] = name
        last = v
    return out


def _directed(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, s: np.ndarray) -> dict[tuple, list[tuple]]:
    """Point -> the points that boundary steps lead to, the inside on the left; vertical steps are put back.

    Of pieces lying on each other tops and bottoms cancel. On a vertical line every point must be
    left as often as it is reached; what the edges leave open flows along the line.
    """
    line_of = _snapped(np.concatenate([x1, x2]))
    heights = defaultdict(list)
    for x, y in zip(np.concatenate([x1, x2]).tolist(), np.concatenate([y1, y2]).tolist()):
        heights[line_of[x]].append(y)
    level_of = {x: _snapped(np.array(ys)) for x, ys in heights.items()}

    def point(x: float, y: float) -> tuple[float, float]:
        x = line_of[x]
        return x, level_of[x][y]

    total: dict[tuple, int] = defaultdict(int)
    flat: dict[float, dict[float, int]] = defaultdict(lambda: defaultdict(int))
    corners: dict[float, set[float]] = defaultdict(set)
    for xa, ya, xb, yb, sign in zip(x1.tolist(), y1.tolist(), x2.tolist(), y2.tolist(), s.tolist()):
        a, b = point(xa, ya), point(xb, yb)
        if a[0] == b[0]:
            continue
        if a[1] == b[1]:
            flat[a[1]][a[0]] += sign
            flat[a[1]][b[0]] -= sign
        else:
            total[a, b] += sign
            corners[a[1]].add(a[0])
            corners[b[1]].add(b[0])
    for y, steps in flat.items():
        level, since = 0, 0.0
        for x in sorted({*steps, *corners[y]}):  # a corner on a flat edge stays a corner
            if level and since < x:
                total[(since, y), (x, y)] += level
            level, since = level + steps.get(x, 0), x
    next_, open_ = defaultdict(list), defaultdict(lambda: defaultdict(int))
    for (a, b), sign in total.items():
        here, there = (b, a) if sign > 0 else (a, b)
        for _ in range(abs(sign)):
            next_[here].append(there)
        open_[here[0]][here[1]] += abs(sign)
        open_[there[0]][there[1]] -= abs(sign)
    for x, levels in open_.items():
        up, since = 0, 0.0
        for y in sorted(levels):
            low, high = ((x, since), (x, y)) if up > 0 else ((x, y), (x, since))
            for _ in range(abs(up)):
                next_[low].append(high)
            up, since = up - levels[y], y
    return next_


def _turn(before: tuple, here: tuple, there: tuple) -> float:
    """Angle from the way back, clockwise, in (0, 2 pi]: the smallest is the sharpest turn to the left."""
    back = math.atan2(before[1] - here[1], before[0] - here[0])
    on = math.atan2(there[1] - here[1], there[0] - here[0])
    angle = (back - on) % (2 * math.pi)
    return angle or 2 * math.pi


def _straightened(ring: list[tuple]) -> list[tuple]:
    """The ring without corners that lie on the line of their neighbours (to SNAP)."""
    kept = True
    while kept and len(ring) > 2:
        out = []
        for i, (x, y) in enumerate(ring):
            (ax, ay), (bx, by) = out[-1] if out else ring[-1], ring[(i + 1) % len(ring)]
            off = abs((bx - ax) * (y - ay) - (by - ay) * (x - ax))
            if off > SNAP * max(math.hypot(bx - ax, by - ay), SNAP):
                out.append((x, y))
        kept, ring = len(out) < len(ring), out
    return ring


def walk(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, s: np.ndarray) -> list[list[tuple[float, float]]]:
    """Signed edges -> closed rings: shells counter-clockwise, holes clockwise, none meeting itself.

    Where several ways leave a corner the sharpest left turn is taken, and a walk that comes back
    to a corner leaves what lies between as a ring of its own, so rings touch in points only.
    Rings come in the order of their lowest leftmost corner, which they also begin with.
    """
    next_ = _directed(np.asarray(x1), np.asarray(y1), np.asarray(x2), np.asarray(y2), np.asarray(s))
    rings = []
    for start in sorted(next_):
        while next_[start]:
            path, at = [start], {start: 0}
            here, before = start, (start[0], start[1] + 1.0)
            while True:
                ways = next_[here]
                if not ways:
                    break  # back at the start, nothing leaves it any more
                there = min(ways, key=lambda p: _turn(before, here, p))
                ways.remove(there)
                before, here = here, there
                if here in at:
                    loop = path[at[here] :]
                    for p in loop[1:]:
                        del at[p]
                    del path[at[here] + 1 :]
                    ring = _straightened(loop)
                    if len(ring) > 2:
                        first = ring.index(min(ring))
                        rings.append([*ring[first:], *ring[:first], ring[first]])
                    before = path[-2] if len(path) > 1 else before
                else:
                    at[here] = len(path)
                    path.append(here)
    return sorted(rings)
