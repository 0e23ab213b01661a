"""Which polygons of two blocks share a point: numpy over the rows of one grid cell.

The same predicate as geometry.polygons_intersect, by the same cross products. Boxes are compared first. A polygon that
is one axis-parallel rectangle is its box, so two of them need no more, and against another polygon an edge is tested
with the box. Only pairs of two other polygons are tested edge by edge.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Cells of a matrix of boxes that is held at once; pairs of edges that are held at once.
BOXES, EDGES = 1 << 18, 1 << 16
#: Members of polygons that stand in a batch of lists at once.
LISTED = 1 << 18


class Side:
    """Polygons of one side: ids, boxes (minx, miny, maxx, maxy), edges (x1, y1, x2, y2) in one array with the place of each polygon's first."""

    def __init__(self, table: pa.Table, edges: str = "_edges"):
        table = table.combine_chunks()
        self.n = table.num_rows
        self.box = np.stack([_floats(table[c]) for c in ("_minx", "_miny", "_maxx", "_maxy")]) if self.n else np.empty((4, 0))
        lists = _chunk(table[edges], pa.list_(pa.float64()))
        flat = _floats(lists.flatten())
        self.count = np.diff(lists.offsets.to_numpy()) // 4
        self.first = np.r_[0, np.cumsum(self.count)][:-1].astype(np.int64)
        self.edges = flat.reshape(-1, 4).T
        self.is_box = self._boxes()

    def _boxes(self) -> np.ndarray:
        """Whether each polygon has four edges of some length that go around its box."""
        four = np.flatnonzero(self.count == 4)
        e = self.edges[:, self.first[four][:, None] + np.arange(4)]  # (4, n, 4)
        x0, y0, x1, y1 = (b[four][:, None] for b in self.box)
        upright, flat = e[0] == e[2], e[1] == e[3]
        on = (upright & ((e[0] == x0) | (e[0] == x1))) | (flat & ((e[1] == y0) | (e[1] == y1)))
        whole = (upright & (abs(e[1] - e[3]) == y1 - y0)) | (flat & (abs(e[0] - e[2]) == x1 - x0))
        sides = upright.sum(1) == 2
        apart = np.where(upright, e[0], -np.inf).max(1) > np.where(upright, e[0], np.inf).min(1)
        above = np.where(flat, e[1], -np.inf).max(1) > np.where(flat, e[1], np.inf).min(1)
        out = np.zeros(self.n, bool)
        out[four] = (on & whole & (upright != flat)).all(1) & sides & apart & above
        return out


def _chunk(column, kind: pa.DataType):
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], kind)
    return column.cast(kind)


def _floats(column) -> np.ndarray:
    return np.asarray(_chunk(column, pa.float64()).to_numpy(zero_copy_only=False), float)


def near_pairs(a: Side, b: Side, once):
    """(i, j) arrays, in pieces, of polygons whose boxes meet and whose boxes' common lower left corner passes ``once``(x, y)."""
    step = max(1, BOXES // max(1, b.n))
    for at in range(0, a.n, step):
        x0, y0, x1, y1 = (v[at : at + step, None] for v in a.box)
        u0, v0, u1, v1 = b.box
        i, j = np.nonzero((x0 <= u1) & (u0 <= x1) & (y0 <= v1) & (v0 <= y1))
        keep = once(np.maximum(a.box[0, at + i], u0[j]), np.maximum(a.box[1, at + i], v0[j]))
        yield at + i[keep], j[keep]


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places first, first + 1, ... of count each, and which of them each belongs to."""
    of = np.repeat(np.arange(len(count)), count)
    return first[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count), of


def _cross(e, x, y):
    return (e[2] - e[0]) * (y - e[1]) - (e[3] - e[1]) * (x - e[0])


def _odd(e, of, n, x, y) -> np.ndarray:
    """Even-odd rule: whether the edges e of each of n polygons fill its point (x, y, one for an edge)."""
    c = _cross(e, x, y)
    hit = ((e[1] > y) != (e[3] > y)) & np.where(e[3] > e[1], c > 0, c < 0)
    return np.bincount(of, hit, n) % 2 == 1


def _with_boxes(a: Side, i: np.ndarray, box: np.ndarray) -> np.ndarray:
    """Whether polygon i of a meets its box: an edge reaches into the box, or the box lies in the fill."""
    at, of = _spread(a.first[i], a.count[i])
    e, (x0, y0, x1, y1) = a.edges[:, at], box[:, of]
    meets = (np.minimum(e[0], e[2]) <= x1) & (np.maximum(e[0], e[2]) >= x0) & (np.minimum(e[1], e[3]) <= y1) & (np.maximum(e[1], e[3]) >= y0)
    # an axis-parallel edge is its box; of others the corners tell, where the boxes meet
    slope = np.flatnonzero(meets & (e[0] != e[2]) & (e[1] != e[3]))
    corners = [_cross(e[:, slope], x[slope], y[slope]) for x in (x0, x1) for y in (y0, y1)]
    meets[slope] = (np.minimum.reduce(corners) <= 0) & (np.maximum.reduce(corners) >= 0)
    out = np.bincount(of, meets, len(i)) > 0
    rest = np.flatnonzero(~out[of])
    return out | _odd(e[:, rest], of[rest], len(i), x0[rest], y0[rest])


def _on(e, x, y):
    return (_cross(e, x, y) == 0) & (x >= np.minimum(e[0], e[2])) & (x <= np.maximum(e[0], e[2])) & (y >= np.minimum(e[1], e[3])) & (y <= np.maximum(e[1], e[3]))


def _edges_meet(a, b):
    proper = (np.sign(_cross(a, b[0], b[1])) * np.sign(_cross(a, b[2], b[3])) < 0) & (np.sign(_cross(b, a[0], a[1])) * np.sign(_cross(b, a[2], a[3])) < 0)
    return proper | _on(a, b[0], b[1]) | _on(a, b[2], b[3]) | _on(b, a[0], a[1]) | _on(b, a[2], a[3])


def _holds(es: np.ndarray, of: np.ndarray) -> bool:
    """Whether the fill of edges es holds a corner of edges ``of``."""
    step = max(1, EDGES // max(1, es.shape[1]))
    for at in range(0, of.shape[1], step):
        x, y = of[0, at : at + step, None], of[1, at : at + step, None]
        c = _cross(es[:, None, :], x, y)
        hit = ((es[1] > y) != (es[3] > y)) & np.where(es[3] > es[1], c > 0, c < 0)
        if (hit.sum(1) % 2 == 1).any():
            return True
    return False


def _any_pair(a: Side, b: Side, i: int, j: int) -> bool:
    """One pair of polygons, edge by edge; edges of many corners in pieces."""
    one, two = (s.edges[:, s.first[k] : s.first[k] + s.count[k]] for s, k in ((a, i), (b, j)))
    step = max(1, EDGES // max(1, two.shape[1]))
    for at in range(0, one.shape[1], step):
        part = one[:, at : at + step]
        if _edges_meet(part[:, :, None], two[:, None, :]).any():
            return True
    return _holds(one, two) or _holds(two, one)


def meet(a: Side, b: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether each pair (i, j), whose boxes meet, shares a point."""
    out = a.is_box[i] & b.is_box[j]
    for one, two, p, q in ((a, b, i, j), (b, a, j, i)):
        rest = np.flatnonzero(~one.is_box[p] & two.is_box[q])
        # no piece holds more than EDGES edges, but for one polygon's
        for piece in _pieces(rest, one.count[p[rest]]):
            out[piece] = _with_boxes(one, p[piece], two.box[:, q[piece]])
    for k in np.flatnonzero(~a.is_box[i] & ~b.is_box[j]):
        out[k] = _any_pair(a, b, i[k], j[k])
    return out


def _pieces(rows: np.ndarray, size: np.ndarray, most: int | None = None):
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // (most or EDGES))) + 1
    return [p for p in np.split(rows, cuts) if len(p)]


def _strictly(s: Side, j: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether polygon j of each pair holds the point (x, y) and not on its boundary."""
    at, of = _spread(s.first[j], s.count[j])
    e, x, y = s.edges[:, at], x[of], y[of]
    return _odd(e, of, len(j), x, y) & (np.bincount(of, _on(e, x, y), len(j)) == 0)


def _holds_some(one: Side, p: np.ndarray, two: Side, q: np.ndarray) -> np.ndarray:
    """Whether polygon p of ``one`` holds a corner or an edge's middle of polygon q of ``two`` inside."""
    at, of = _spread(two.first[q], two.count[q])
    e, of = two.edges[:, at], np.r_[of, of]
    x, y = np.r_[e[0], (e[0] + e[2]) / 2], np.r_[e[1], (e[1] + e[3]) / 2]
    hit = np.zeros(len(of), bool)
    for piece in _pieces(np.arange(len(of)), one.count[p[of]]):
        hit[piece] = _strictly(one, p[of[piece]], x[piece], y[piece])
    return np.bincount(of, hit, len(p)) > 0


def _edges_cross(a: Side, i: np.ndarray, b: Side, j: np.ndarray) -> np.ndarray:
    """Whether an edge of each polygon i crosses one of polygon j at an inner point of both."""
    out = np.zeros(len(i), bool)
    at, of = _spread(a.first[i], a.count[i])
    for piece in _pieces(np.arange(len(at)), b.count[j[of]]):
        other, row = _spread(b.first[j[of[piece]]], b.count[j[of[piece]]])
        e, f = a.edges[:, at[piece][row]], b.edges[:, other]
        hit = (np.sign(_cross(e, f[0], f[1])) * np.sign(_cross(e, f[2], f[3])) < 0) & (np.sign(_cross(f, e[0], e[1])) * np.sign(_cross(f, e[2], e[3])) < 0)
        out[of[piece][row[hit]]] = True
    return out


def _same(a: Side, i: int, b: Side, j: int) -> bool:
    """Whether two polygons have the same edges, in any order."""
    one, two = (s.edges[:, s.first[k] : s.first[k] + s.count[k]] for s, k in ((a, i), (b, j)))
    return one.shape == two.shape and np.array_equal(one[:, np.lexsort(one)], two[:, np.lexsort(two)])


def overlap(a: Side, b: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether each pair (i, j) shares more than boundary, as geometry.interiors_overlap tells it; two rectangles by their boxes."""
    out = (a.box[0, i] < b.box[2, j]) & (b.box[0, j] < a.box[2, i]) & (a.box[1, i] < b.box[3, j]) & (b.box[1, j] < a.box[3, i])
    for k in np.flatnonzero((a.box[0, i] == a.box[2, i]) | (a.box[1, i] == a.box[3, i])):  # of no area
        out[k] = out[k] or _same(a, i[k], b, j[k])
    rest = np.flatnonzero(out & ~(a.is_box[i] & b.is_box[j]))
    for piece in _pieces(rest, a.count[i[rest]] * b.count[j[rest]]):
        hit = _edges_cross(a, i[piece], b, j[piece])
        for one, two, p, q in ((a, b, i, j), (b, a, j, i)):
            free = np.flatnonzero(~hit)
            hit[free] = _holds_some(one, p[piece[free]], two, q[piece[free]])
        for k in np.flatnonzero(~hit & (a.box[:, i[piece]] == b.box[:, j[piece]]).all(0)):
            hit[k] = _same(a, i[piece[k]], b, j[piece[k]])
        out[piece] = hit
    return out


def overlapping(one: pa.Table, two: pa.Table, cell: float):
    """(i, j) arrays, in pieces, of polygons of a cell's blocks that overlap, in the cell of their boxes' common lower left corner."""
    gx, gy, a, b = one["_gx"][0].as_py(), one["_gy"][0].as_py(), Side(one), Side(two)
    for i, j in near_pairs(a, b, lambda x, y: (np.floor(x / cell) == gx) & (np.floor(y / cell) == gy)):
        hit = overlap(a, b, i, j)
        yield i[hit], j[hit]


def partners(one: pa.Table, two: pa.Table, cell: float, kind: pa.Schema) -> pa.Table:
    """(_shape, n, top): of each shape of ``one``, the polygons (_many) of other shapes of ``two`` that overlap it, and the greatest of their ids (_top)."""
    n = np.zeros(one.num_rows, np.int64)
    order = pc.sort_indices(two["_top"])
    rank, top = np.empty(two.num_rows, np.int64), np.full(one.num_rows, -1)
    rank[np.asarray(order)] = np.arange(two.num_rows)
    ids, many = pa.concat_arrays([members(one, "_id"), members(two, "_id")]).dictionary_encode().indices.to_numpy(), np.asarray(two["_many"])
    for i, j in overlapping(one, two, cell):
        other = ids[i] != ids[one.num_rows + j]
        i, j = i[other], j[other]
        np.add.at(n, i, many[j])
        np.maximum.at(top, i, rank[j])
    some = np.flatnonzero(n)
    tops = two["_top"].take(order).take(pa.array(top[some]))
    return pa.table([one["_id"].take(pa.array(some)), pa.array(n[some]), tops], names=kind.names).cast(kind)


def covered(x: np.ndarray, y: np.ndarray, s: Side, strict: bool):
    """(i, j) arrays, in pieces, of places and the polygons that cover (strictly: contain) them."""
    x0, y0, x1, y1 = s.box
    step = max(1, BOXES // max(1, s.n))
    for at in range(0, len(x), step):
        px, py = x[at : at + step, None], y[at : at + step, None]
        i, j = np.nonzero((px > x0) & (px < x1) & (py > y0) & (py < y1) if strict else (px >= x0) & (px <= x1) & (py >= y0) & (py <= y1))
        i += at
        hit = s.is_box[j]
        rest = np.flatnonzero(~hit)
        for piece in _pieces(rest, s.count[j[rest]]):
            hit[piece] = (_strictly if strict else _covers)(s, j[piece], x[i[piece]], y[i[piece]])
        yield i[hit], j[hit]


def members(table: pa.Table, name: str):
    """A column of lists as one array."""
    column = table[name].combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def listed(pairs, left, right, kind: pa.Schema):
    """Batches (_left, _right) of lists whose products are the members of all pairs: those of i beside those of all its j.

    No batch has more than LISTED members on the right, but for those of one pair.
    """
    many = np.diff(right.offsets.to_numpy())
    for i, j in pairs:
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        for piece in _pieces(np.arange(len(i)), many[j], LISTED):
            of, first = np.unique(i[piece], return_index=True)
            values = right.take(pa.array(j[piece])).flatten()
            ends = np.r_[0, np.cumsum(many[j[piece]])]
            offsets = pa.array(np.r_[ends[first], ends[-1]], pa.int32())
            yield pa.RecordBatch.from_arrays([left.take(pa.array(of)).cast(kind.field(0).type), pa.ListArray.from_arrays(offsets, values).cast(kind.field(1).type)], schema=kind)


def yearly_counts(one: pa.Table, two: pa.Table, cell: float) -> pa.Table:
    """(_shape, fire_year, n): fires of ``two`` (rows of shapes with lists _years and _ns) that meet the shapes of ``one``; both are of one cell."""
    kind = pa.schema([("_shape", pa.binary()), ("fire_year", pa.int64()), ("n", pa.int64())])
    if not (one.num_rows and two.num_rows):
        return kind.empty_table()
    a, b = Side(one), Side(two)
    gx, gy = one["_gx"][0].as_py(), one["_gy"][0].as_py()
    lists, ns = _chunk(two["_years"], pa.list_(pa.int64())), _chunk(two["_ns"], pa.list_(pa.int64()))
    years, of = lists.flatten(), np.repeat(np.arange(b.n), np.diff(lists.offsets.to_numpy()))
    names = years.unique()  # null is a year of its own
    column = pc.index_in(years, names, skip_nulls=False).to_numpy()
    weight = np.zeros((b.n, len(names)), np.int64)
    np.add.at(weight, (of, column), ns.flatten().to_numpy())
    total = np.zeros((a.n, len(names)), np.int64)
    for i, j in near_pairs(a, b, lambda x, y: (np.floor(x / cell) == gx) & (np.floor(y / cell) == gy)):
        hit = meet(a, b, i, j)
        i, j = i[hit], j[hit]
        for k in range(len(names)):
            total[:, k] += np.bincount(i, weight[j, k], a.n).astype(np.int64)
    row, k = np.nonzero(total)
    ids = _chunk(one["_id"], pa.binary())
    return pa.table([ids.take(pa.array(row)), names.take(pa.array(k)), pa.array(total[row, k])], schema=kind)



def _covers(s: Side, j: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether polygon j of each pair covers the point (x, y), boundary included."""
    at, of = _spread(s.first[j], s.count[j])
    e, x, y = s.edges[:, at], x[of], y[of]
    return _odd(e, of, len(j), x, y) | (np.bincount(of, _on(e, x, y), len(j)) > 0)


def _distances(s: Side, j: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """From each point to the nearest edge of polygon j; infinite without an edge."""
    at, of = _spread(s.first[j], s.count[j])
    e, x, y = s.edges[:, at], x[of], y[of]
    dx, dy = e[2] - e[0], e[3] - e[1]
    square = dx * dx + dy * dy
    t = np.clip(np.divide((x - e[0]) * dx + (y - e[1]) * dy, square, out=np.zeros(len(of)), where=square > 0), 0.0, 1.0)
    out = np.full(len(j), np.inf)
    np.minimum.at(out, of, np.hypot(x - e[0] - t * dx, y - e[1] - t * dy))
    return out


def place_matches(one: pa.Table, two: pa.Table, metres: float, kind: pa.Schema) -> pa.Table:
    """(x, y, held, held_least, near, near_least): of each place of ``one``, the polygons behind the shapes of ``two`` (least, _many) that cover it, and their least id.

    near: of places that none covers, those no farther than ``metres``.
    """
    if not (one.num_rows and two.num_rows):
        return kind.empty_table()
    x, y, s, many = _floats(one["x"]), _floats(one["y"]), Side(two), np.asarray(two["_many"])
    order = pc.sort_indices(two["least"])
    rank = np.empty(s.n, np.int64)
    rank[np.asarray(order)] = np.arange(s.n)
    n, least = np.zeros((2, len(x)), np.int64), np.full((2, len(x)), s.n)

    def tally(k: int, i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(n[k], i, many[j])
        np.minimum.at(least[k], i, rank[j])

    x0, y0, x1, y1 = s.box
    step = max(1, BOXES // s.n)
    for at in range(0, len(x), step):
        px, py = x[at : at + step, None], y[at : at + step, None]
        i, j = np.nonzero((px >= x0) & (px <= x1) & (py >= y0) & (py <= y1))
        i += at
        hit = s.is_box[j]
        rest = np.flatnonzero(~hit)
        for piece in _pieces(rest, s.count[j[rest]]):
            hit[piece] = _covers(s, j[piece], x[i[piece]], y[i[piece]])
        tally(0, i[hit], j[hit])
        free = at + np.flatnonzero(n[0, at : at + step] == 0)
        px, py = x[free, None], y[free, None]
        i, j = np.nonzero(np.hypot(np.maximum(np.maximum(x0 - px, px - x1), 0), np.maximum(np.maximum(y0 - py, py - y1), 0)) <= metres)
        i = free[i]
        for piece in _pieces(np.arange(len(i)), s.count[j]):
            close = piece[_distances(s, j[piece], x[i[piece]], y[i[piece]]) <= metres]
            tally(1, i[close], j[close])
    ids = two["least"].take(order)
    named = [ids.take(pa.array(v, mask=v == s.n)) for v in least]
    some = np.flatnonzero(n.any(0))
    return pa.table([one["x"], one["y"], pa.array(n[0]), named[0], pa.array(n[1]), named[1]], names=kind.names).take(pa.array(some)).cast(kind)
