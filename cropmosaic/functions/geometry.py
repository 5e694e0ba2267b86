"""Planar geometry as Spark SQL expressions.

A polygon (holes and several parts included) is one column
    rings  ARRAY<ARRAY<STRUCT<x DOUBLE, y DOUBLE>>>
and, ready for overlap tests, its x-monotone boundary
    edges  ARRAY<STRUCT<x1, y1, x2, y2 DOUBLE, s INT>>   x1 < x2, s = +1 top, -1 bottom
in which vertical edges are dropped. At every x the signs of the edges above and below a
point tell whether the point is inside, so areas of intersections are plain sums over pairs
of edges and need no clipping.

Each function takes the SQL text of its arguments (mostly a column name) and returns SQL
text for `F.expr`. Higher-order functions nest deeply here, and one parsed text is far
quicker to build than the same tree put together call by call. Every function names its
lambda variables with a prefix of its own, so texts can be nested freely.
"""

RINGS_TYPE = "array<array<struct<x:double,y:double>>>"
SEG_TYPE = "struct<x1:double,y1:double,x2:double,y2:double>"
EDGE_TYPE = "struct<x1:double,y1:double,x2:double,y2:double,s:int>"

# Lambert-93 (GRS80, parallels 49 and 44 degrees north, origin 3 E 46.5 N).
LAMBERT93_SRID = 2154
WGS84_SRID = 4326
LAMBERT93_E = 0.08181919104281579
LAMBERT93_N = 0.7256077650532692
LAMBERT93_C = 11754255.426096005
LAMBERT93_YS = 12655612.049875986
LAMBERT93_X0 = 700000.0
LAMBERT93_LON0 = 3.0


def number(value: float) -> str:
    """A double literal in SQL text."""
    return f"{value!r}D"


def bind(name: str, value: str, body: str) -> str:
    """`body` with `name` standing for `value`, which is computed once per row."""
    return f"transform(array({value}), {name} -> {body})[0]"


def box_rings(x0: str, y0: str, w: str, h: str) -> str:
    """Counter-clockwise closed rectangle as rings."""
    xa, ya = f"CAST({x0} AS DOUBLE)", f"CAST({y0} AS DOUBLE)"
    xb, yb = f"CAST({x0} + {w} AS DOUBLE)", f"CAST({y0} + {h} AS DOUBLE)"
    corners = [(xa, ya), (xb, ya), (xb, yb), (xa, yb), (xa, ya)]
    return "array(array(" + ", ".join(f"struct({x} AS x, {y} AS y)" for x, y in corners) + "))"


def _successors(ring: str) -> str:
    return f"concat(slice({ring}, 2, size({ring})), slice({ring}, 1, 1))"


def signed_ring_area(ring: str) -> str:
    """Shoelace area of one ring, positive when counter-clockwise.

    Coordinates are taken relative to the first vertex: projected metres near 6.6e6 would
    otherwise lose the digits that matter.
    """
    products = (
        f"zip_with({ring}, {_successors(ring)}, (sa, sb) -> "
        f"(sa.x - get({ring}, 0).x) * (sb.y - get({ring}, 0).y) "
        f"- (sb.x - get({ring}, 0).x) * (sa.y - get({ring}, 0).y))"
    )
    return f"(aggregate({products}, 0D, (st, sv) -> st + sv) / 2)"


def signed_area(rings: str) -> str:
    return f"aggregate({rings}, 0D, (art, arr) -> art + {signed_ring_area('arr')})"


def polygon_area(rings: str) -> str:
    """Planar area; holes run against their shell and so subtract themselves."""
    return f"abs({signed_area(rings)})"


def bbox(rings: str) -> str:
    """STRUCT<xmin, ymin, xmax, ymax>, NULL for an empty geometry."""
    xs = f"transform(flatten({rings}), bp -> bp.x)"
    ys = f"transform(flatten({rings}), bp -> bp.y)"
    return (
        f"CASE WHEN size(flatten({rings})) > 0 THEN struct(array_min({xs}) AS xmin, array_min({ys}) AS ymin, "
        f"array_max({xs}) AS xmax, array_max({ys}) AS ymax) END"
    )


def lonlat_to_lambert93(lon: str, lat: str) -> tuple[str, str]:
    """Closed-form conic projection of degrees to metres."""
    es = f"({number(LAMBERT93_E)} * sin(radians({lat})))"
    iso = (
        f"ln(tan(pi() / 4 + radians({lat}) / 2) * "
        f"power((1 - {es}) / (1 + {es}), {number(LAMBERT93_E)} / 2))"
    )
    radius = f"({number(LAMBERT93_C)} * exp(-{number(LAMBERT93_N)} * {iso}))"
    gamma = f"({number(LAMBERT93_N)} * radians({lon} - {number(LAMBERT93_LON0)}))"
    return (
        f"({number(LAMBERT93_X0)} + {radius} * sin({gamma}))",
        f"({number(LAMBERT93_YS)} - {radius} * cos({gamma}))",
    )


def to_lambert93(rings: str, srid: str) -> str:
    """Rings in Lambert-93 metres. Only lon/lat and Lambert-93 itself are known."""
    x, y = lonlat_to_lambert93("lp.x", "lp.y")
    return (
        f"CASE WHEN {srid} = {LAMBERT93_SRID} THEN {rings} "
        f"WHEN {srid} = {WGS84_SRID} THEN "
        f"transform({rings}, lr -> transform(lr, lp -> struct({x} AS x, {y} AS y))) "
        f"ELSE raise_error(concat('no transform to Lambert-93 from srid ', coalesce(CAST({srid} AS STRING), 'NULL'))) END"
    )


def lambert93_to_lonlat(x: str, y: str) -> tuple[str, str]:
    """Degrees of a point in metres, the inverse of lonlat_to_lambert93.

    The latitude of an isometric latitude has no closed form: each turn shrinks the error by the
    square of the eccentricity, so eight leave nothing of it.
    """
    east, south = f"({x} - {number(LAMBERT93_X0)})", f"({number(LAMBERT93_YS)} - {y})"
    grown = f"power(sqrt({east} * {east} + {south} * {south}) / {number(LAMBERT93_C)}, -1 / {number(LAMBERT93_N)})"
    es = f"({number(LAMBERT93_E)} * sin(it))"
    turn = f"2 * atan(ie * power((1 + {es}) / (1 - {es}), {number(LAMBERT93_E)} / 2)) - pi() / 2"
    latitude = bind("ie", grown, f"degrees(aggregate(sequence(1, 8), 2 * atan(ie) - pi() / 2, (it, ii) -> {turn}))")
    return f"({number(LAMBERT93_LON0)} + degrees(atan2({east}, {south}) / {number(LAMBERT93_N)}))", latitude


def to_lonlat(rings: str, srid: str) -> str:
    """Rings in degrees, for export; only Lambert-93 and lon/lat itself are known."""
    lon, lat = lambert93_to_lonlat("lp.x", "lp.y")
    return (
        f"CASE WHEN {srid} = {WGS84_SRID} THEN {rings} "
        f"WHEN {srid} = {LAMBERT93_SRID} THEN "
        f"transform({rings}, lr -> transform(lr, lp -> struct({lon} AS x, {lat} AS y))) "
        f"ELSE raise_error(concat('no transform to degrees from srid ', coalesce(CAST({srid} AS STRING), 'NULL'))) END"
    )


# ---------------------------------------------------------------- segments


def segments(rings: str) -> str:
    """All boundary segments as drawn, vertical ones too: ARRAY<STRUCT<x1, y1, x2, y2>>."""
    return (
        f"filter(flatten(transform({rings}, gr -> zip_with(gr, {_successors('gr')}, (ga, gb) -> "
        "struct(ga.x AS x1, ga.y AS y1, gb.x AS x2, gb.y AS y2)))), gs -> gs.x1 != gs.x2 OR gs.y1 != gs.y2)"
    )


def _forward(segs: str) -> str:
    """Segments turned to run from left to right (vertical ones upward), sorted by their left end."""
    return (
        f"array_sort(transform({segs}, fs -> CASE WHEN fs.x1 < fs.x2 OR (fs.x1 = fs.x2 AND fs.y1 < fs.y2) THEN fs "
        "ELSE struct(fs.x2 AS x1, fs.y2 AS y1, fs.x1 AS x2, fs.y1 AS y2) END))"
    )


def _side(e: str, x: str, y: str) -> str:
    """Sign of the turn from segment e to the point: 1 left, -1 right, 0 on the line."""
    return f"signum(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({e}.y2 - {e}.y1) * ({x} - {e}.x1))"


def _cross(e: str, f: str) -> str:
    """True where two segments cross at a point inside both."""
    return (
        f"({_side(e, f + '.x1', f + '.y1')} * {_side(e, f + '.x2', f + '.y2')} < 0 "
        f"AND {_side(f, e + '.x1', e + '.y1')} * {_side(f, e + '.x2', e + '.y2')} < 0)"
    )


def _boxes_meet(e: str, f: str) -> str:
    """Closed bounding boxes of two segments that run from left to right."""
    return (
        f"({e}.x1 <= {f}.x2 AND {f}.x1 <= {e}.x2 "
        f"AND greatest({e}.y1, {e}.y2) >= least({f}.y1, {f}.y2) "
        f"AND greatest({f}.y1, {f}.y2) >= least({e}.y1, {e}.y2))"
    )


def _touch(e: str, f: str) -> str:
    """True where two closed segments, both from left to right, share at least one point."""
    return (
        f"({_boxes_meet(e, f)} "
        f"AND {_side(e, f + '.x1', f + '.y1')} * {_side(e, f + '.x2', f + '.y2')} <= 0 "
        f"AND {_side(f, e + '.x1', e + '.y1')} * {_side(f, e + '.x2', e + '.y2')} <= 0)"
    )


def _on_inside(e: str, x: str, y: str) -> str:
    """True where the point lies on segment e (from left to right) but is neither of its ends."""
    return (
        f"({x} >= {e}.x1 AND {x} <= {e}.x2 "
        f"AND {y} >= least({e}.y1, {e}.y2) AND {y} <= greatest({e}.y1, {e}.y2) "
        f"AND ({x} != {e}.x1 OR {y} != {e}.y1) AND ({x} != {e}.x2 OR {y} != {e}.y2) "
        f"AND {_side(e, x, y)} = 0)"
    )


def contact_segments(rings: str) -> str:
    """Segments ready for `segments_touch`."""
    return _forward(segments(rings))


def segments_touch(own: str, other: str) -> str:
    """True where any two segments of the lists share a point. NULL lists share none."""
    return f"coalesce(exists({own}, te -> exists({other}, tf -> {_touch('te', 'tf')})), false)"


def _crossing_among(segs: str) -> str:
    """Self-crossing test on the segments of a feature."""
    meets = (
        f"({_boxes_meet('ce', 'cf')} AND ({_cross('ce', 'cf')} "
        f"OR {_on_inside('ce', 'cf.x1', 'cf.y1')} OR {_on_inside('ce', 'cf.x2', 'cf.y2')} "
        f"OR {_on_inside('cf', 'ce.x1', 'ce.y1')} OR {_on_inside('cf', 'ce.x2', 'ce.y2')}))"
    )
    crossing = (
        "exists(transform(cs, (ce, ci) -> exists(slice(cs, ci + 2, size(cs)), "
        f"cf -> cf.x1 <= ce.x2 AND {meets})), ch -> ch)"
    )
    repeated = (
        "exists(transform(cp, (cq, cj) -> cj > 0 AND cq = get(cp, cj - 1)), ch -> ch)"
    )
    starts = f"array_sort(transform({segs}, cv -> struct(cv.x1, cv.y1)))"
    return f"coalesce({bind('cp', starts, repeated)} OR {bind('cs', _forward(segs), crossing)}, false)"


def self_crossing(rings: str) -> str:
    """True where the boundary of one feature crosses itself, runs into itself or returns to a vertex.

    Segments are sorted by their left end; each is compared with the later ones only, and
    those starting beyond its right end fall out at the first comparison.
    """
    return bind("cg", segments(rings), _crossing_among("cg"))


# ---------------------------------------------------------------- repair


def _drop_repeats(ring: str) -> str:
    """Ring without its closing vertex and without equal neighbours."""
    kept = f"filter({ring}, (dp, di) -> di = 0 OR get({ring}, di - 1) != dp)"
    return bind(
        "dk",
        kept,
        "CASE WHEN size(dk) > 1 AND get(dk, 0) = get(dk, size(dk) - 1) THEN slice(dk, 1, size(dk) - 1) ELSE dk END",
    )


def point_in_ring(ring: str, x: str, y: str) -> str:
    """Even-odd test of a point against one ring."""
    crossed = (
        f"zip_with({ring}, {_successors(ring)}, (pa, pb) -> (pa.x > {x}) != (pb.x > {x}) "
        f"AND pa.y + ({x} - pa.x) / (pb.x - pa.x) * (pb.y - pa.y) > {y})"
    )
    return f"(size(filter({crossed}, pc -> pc)) % 2 = 1)"


def _middle(ring: str) -> tuple[str, str]:
    """Midpoint of the first edge of a ring."""
    return (
        f"((get({ring}, 0).x + get({ring}, 1).x) / 2)",
        f"((get({ring}, 0).y + get({ring}, 1).y) / 2)",
    )


def clean_rings(rings: str) -> str:
    """Rings closed, free of repeated points and of rings with fewer than three distinct ones.

    Shells turn counter-clockwise and holes (rings inside an odd number of others) clockwise.
    """
    kept = (
        f"filter(transform({rings}, kr -> {_drop_repeats('kr')}), kd -> size(array_distinct(kd)) >= 3)"
    )
    around = f"size(filter(ks, (ko, kj) -> kj != ki AND {point_in_ring('ko', *_middle('kn'))}))"
    hole = f"(size(ks) > 1 AND {around} % 2 = 1)"
    turned = f"CASE WHEN ({signed_ring_area('kn')} < 0) != {hole} THEN reverse(kn) ELSE kn END"
    closed = bind("kt", turned, "concat(kt, slice(kt, 1, 1))")
    return bind("ks", kept, f"transform(ks, (kn, ki) -> {closed})")


# ---------------------------------------------------------------- edges and overlap


def _oriented_of(segs: str) -> str:
    edges = (
        f"transform(filter({segs}, ou -> ou.x1 != ou.x2), oe -> CASE WHEN oe.x2 < oe.x1 "
        "THEN struct(oe.x2 AS x1, oe.y2 AS y1, oe.x1 AS x2, oe.y1 AS y2, 1 AS s) "
        "ELSE struct(oe.x1 AS x1, oe.y1 AS y1, oe.x2 AS x2, oe.y2 AS y2, -1 AS s) END)"
    )
    turned = "transform(od, ov -> struct(ov.x1 AS x1, ov.y1 AS y1, ov.x2 AS x2, ov.y2 AS y2, -ov.s AS s))"
    return bind("od", edges, f"CASE WHEN {edges_area('od', 'get(od, 0).y1')} < 0 THEN {turned} ELSE od END")


def oriented_edges(rings: str) -> str:
    """Signed x-monotone edges of a valid polygon; either overall orientation is accepted."""
    return _oriented_of(segments(rings))


def _y_at(e: str, x: str) -> str:
    return f"({e}.y1 + ({x} - {e}.x1) / ({e}.x2 - {e}.x1) * ({e}.y2 - {e}.y1))"


def _even_odd_of(segs: str) -> str:
    def meeting(e: str, f: str) -> str:
        return (
            f"{e}.x1 + ({e}.x2 - {e}.x1) * (({f}.x1 - {e}.x1) * ({f}.y2 - {f}.y1) - ({f}.y1 - {e}.y1) * ({f}.x2 - {f}.x1)) "
            f"/ (({e}.x2 - {e}.x1) * ({f}.y2 - {f}.y1) - ({e}.y2 - {e}.y1) * ({f}.x2 - {f}.x1))"
        )

    # both edges of a crossing are cut at the very same x
    cross_x = f"CASE WHEN ve < vf THEN {meeting('ve', 'vf')} ELSE {meeting('vf', 've')} END"
    cuts = (
        "array_sort(array_distinct(concat(array(ve.x1, ve.x2), "
        f"transform(filter(vs, vf -> {_boxes_meet('ve', 'vf')} AND {_cross('ve', 'vf')}), vf -> {cross_x}), "
        f"transform(filter(vs, vf -> {_on_inside('ve', 'vf.x1', 'vf.y1')}), vf -> vf.x1), "
        f"transform(filter(vs, vf -> {_on_inside('ve', 'vf.x2', 'vf.y2')}), vf -> vf.x2))))"
    )

    def y_of(x: str) -> str:
        return f"CASE WHEN {x} = ve.x1 THEN ve.y1 WHEN {x} = ve.x2 THEN ve.y2 ELSE {_y_at('ve', x)} END"

    pieces = (
        "transform(slice(vx, 2, size(vx)), (vb, vi) -> struct("
        f"get(vx, vi) AS x1, {y_of('get(vx, vi)')} AS y1, vb AS x2, {y_of('vb')} AS y2))"
    )
    # vertical segments stay in vs: an edge may be cut by them, but they become no pieces
    cut = (
        f"flatten(transform(filter(vs, vu -> vu.x1 != vu.x2), ve -> {bind('vx', cuts, pieces)}))"
    )
    # by one formula for both, so that of two pieces exactly one is below the other
    mid_x = "((vp.x1 + vp.x2) / 2)"
    mid_y, at = _y_at("vp", mid_x), _y_at("vq", mid_x)
    below = (
        f"size(filter(vc, (vq, vj) -> vj != vk AND vq.x1 <= {mid_x} AND {mid_x} < vq.x2 "
        f"AND ({at} < {mid_y} OR ({at} = {mid_y} AND vj < vk))))"
    )
    signed = (
        "transform(vc, (vp, vk) -> struct(vp.x1 AS x1, vp.y1 AS y1, vp.x2 AS x2, vp.y2 AS y2, "
        f"CASE WHEN {below} % 2 = 1 THEN 1 ELSE -1 END AS s))"
    )
    return bind("vs", _forward(segs), bind("vc", cut, signed))


def even_odd_edges(rings: str) -> str:
    """Signed edges of a possibly invalid polygon, read by the even-odd rule.

    Edges are cut where another edge crosses or ends on them; each piece is a top when an
    odd number of pieces lies below its middle. Ring orientation plays no part, and a figure
    of eight becomes its two lobes. Of pieces lying on each other the earlier one counts as
    lower, so that a doubled boundary is one top and one bottom.
    """
    return _even_odd_of(segments(rings))


def valid_edges(rings: str, meets: str | None = None) -> str:
    """Signed edges after repair: boundaries that do not meet themselves as drawn, all others by the even-odd rule.

    Several rings that do not meet need only be turned the right way, shells against holes. `meets`
    names a column that knows whether the boundary meets itself (`outlines.meets_itself`); where it is
    NULL the boundary is tested here.
    """
    nested = segments(f"({clean_rings(rings)})")
    crossing = _crossing_among("gv") if meets is None else f"CASE WHEN {meets} IS NULL THEN {_crossing_among('gv')} ELSE {meets} END"
    return bind(
        "gv",
        segments(rings),
        f"CASE WHEN {crossing} THEN {_even_odd_of('gv')} "
        f"WHEN size({rings}) > 1 THEN {bind('gn', nested, _oriented_of('gn'))} ELSE {_oriented_of('gv')} END",
    )


def edges_area(edges: str, base: str = "0D") -> str:
    """Area between signed edges; a base near their y keeps the digits of large coordinates."""
    return (
        f"aggregate({edges}, 0D, (eat, eae) -> eat + eae.s * (eae.x2 - eae.x1) "
        f"* ((eae.y1 - {base}) + (eae.y2 - {base})) / 2)"
    )


def _edge_overlap(a: str, b: str) -> str:
    """Share of one edge pair in the area of the intersection of two closed polygons.

    At each x the tops and bottoms of a closed polygon cancel, so of min(ya, yb) =
    (ya + yb - |ya - yb|) / 2 only the distance of the two lines remains, integrated over
    the x range the edges share.
    """
    lo, hi = f"greatest({a}.x1, {b}.x1)", f"least({a}.x2, {b}.x2)"
    at_lo = f"{_y_at(a, lo)} - {_y_at(b, lo)}"
    at_hi = f"{_y_at(a, hi)} - {_y_at(b, hi)}"
    # the one-step aggregate only names the two distances, cheaper than a struct to hold them
    distance = (
        f"aggregate(array({at_hi}), {at_lo}, (wl, wr) -> CASE WHEN wl * wr >= 0 THEN abs(wl + wr) "
        "ELSE (wl * wl + wr * wr) / abs(wl - wr) END)"
    )
    return f"{distance} * ({hi} - {lo}) * -({a}.s * {b}.s) / 4"


def overlap_area(a: str, b: str) -> str:
    """Area of the intersection of two polygons given by their signed edges."""
    return (
        f"aggregate({a}, 0D, (wt, wa) -> wt + aggregate({b}, 0D, (wu, wb) -> "
        f"CASE WHEN wb.x1 >= wa.x2 OR wa.x1 >= wb.x2 THEN wu ELSE wu + {_edge_overlap('wa', 'wb')} END))"
    )


# ---------------------------------------------------------------- exchange formats


def polygon_parts(rings: str) -> str:
    """Clean rings grouped into polygons: each shell (counter-clockwise) with its own holes.

    The smallest shell around a hole owns it.
    """
    shells = f"filter({rings}, ms -> {signed_ring_area('ms')} > 0)"
    holes = f"filter({rings}, mh -> {signed_ring_area('mh')} <= 0)"
    owned = (
        f"filter({holes}, mg -> {point_in_ring('mn', *_middle('mg'))} AND NOT exists({shells}, mo -> "
        f"{point_in_ring('mo', *_middle('mg'))} AND {signed_ring_area('mo')} < {signed_ring_area('mn')}))"
    )
    return f"transform({shells}, mn -> concat(array(mn), {owned}))"


def geojson_geometry(rings: str) -> str:
    """MultiPolygon geometry as a STRUCT ready for to_json."""
    return (
        "struct('MultiPolygon' AS type, "
        f"transform({polygon_parts(rings)}, jp -> transform(jp, jr -> transform(jr, jv -> array(jv.x, jv.y)))) AS coordinates)"
    )
