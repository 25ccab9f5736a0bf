"""The named queries as single DuckDB statements, by different and simpler algorithms.

Inputs (coordinates, tags, polygons) repeat the integer formulas of ``derived``. The operators are
restated on their own terms: cube rounding instead of the three-floor form, brute-force ray casting
over all cells of a polygon's box, a separating-axis test for hexagons, a gathered neighbourhood
join, a row-by-row greedy matching, recursive label spreading.
"""

from __future__ import annotations

import math

from hexmosaic.functions import rules
from hexmosaic.plans import derived as d
from hexmosaic.plans.queries import BOX, CITY_BOXES

LAT0, LNG0, R = 12.5, 105.0, 6371007.2


def n(v: float) -> str:
    """DOUBLE literal."""
    t = repr(float(v))
    return f"({t})" if "e" in t else f"({t}e0)"


RAD = math.pi / 180
COS0, SIN0 = math.cos(math.radians(LAT0)), math.sin(math.radians(LAT0))
KX, KY = RAD * R * COS0, R / COS0
ALPHA = math.atan2(math.sqrt(3) / 2, 2.5)


def size(res: int) -> float:
    return 575.0 * 7.0 ** ((8 - res) / 2)


def rot(res: int) -> tuple[float, float]:
    return (math.cos(ALPHA), math.sin(ALPHA)) if res % 2 else (1.0, 0.0)


def px(lng: str) -> str:
    return f"(({lng}) - {n(LNG0)}) * {n(KX)}"


def py(lat: str) -> str:
    return f"(sin(({lat}) * {n(RAD)}) - {n(SIN0)}) * {n(KY)}"


def add_cell(src: str, res: int, out: str = "h3", lat: str = "lat", lng: str = "lng") -> str:
    """Subquery: rows of ``src`` with the cell of (lat, lng), by cube rounding."""
    c, s = rot(res)
    base = (res + 1) * 2**58 + 2**57 + 2**28
    return f"""(SELECT * EXCLUDE (_x, _y, _u, _v, _q, _r, _rq, _rr, _rs),
      {base} + CAST(CASE WHEN abs(_rq-_q) > abs(_rr-_r) AND abs(_rq-_q) > abs(_rs+_q+_r) THEN -_rr-_rs ELSE _rq END AS BIGINT) * 536870912
      + CAST(CASE WHEN NOT (abs(_rq-_q) > abs(_rr-_r) AND abs(_rq-_q) > abs(_rs+_q+_r)) AND abs(_rr-_r) > abs(_rs+_q+_r) THEN -_rq-_rs ELSE _rr END AS BIGINT) AS {out}
     FROM (SELECT *, floor(_q+0.5) AS _rq, floor(_r+0.5) AS _rr, floor(0.5-_q-_r) AS _rs
     FROM (SELECT *, _u*{n(math.sqrt(3) / 3)} - _v/3 AS _q, _v*2/3 AS _r
     FROM (SELECT *, (_x*{n(c)} + _y*{n(s)})/{n(size(res))} AS _u, (_y*{n(c)} - _x*{n(s)})/{n(size(res))} AS _v
     FROM (SELECT *, {px(lng)} AS _x, {py(lat)} AS _y FROM {src} _a) _b) _c) _d) _e)"""


def cq(h: str) -> str:
    return f"((({h}) >> 29) % 536870912 - 268435456)"


def cr(h: str) -> str:
    return f"(({h}) % 536870912 - 268435456)"


def cxy(h: str, res: int) -> tuple[str, str]:
    c, s = rot(res)
    u = f"({n(size(res) * math.sqrt(3))} * ({cq(h)} + {cr(h)} / 2))"
    v = f"({n(size(res) * 1.5)} * {cr(h)})"
    return f"({u}*{n(c)} - {v}*{n(s)})", f"({u}*{n(s)} + {v}*{n(c)})"


def clat(h: str, res: int) -> str:
    return f"(asin({cxy(h, res)[1]} / {n(KY)} + {n(SIN0)}) / {n(RAD)})"


def clng(h: str, res: int) -> str:
    return f"({cxy(h, res)[0]} / {n(KX)} + {n(LNG0)})"


def lst(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# --- inputs -------------------------------------------------------------------------------

NODES = f"""nodes AS (
 SELECT o_orderkey AS id, {d.NODE_LAT} AS lat, {d.NODE_LNG} AS lng, o_orderstatus AS st,
        {lst(d.TAGS)}[({d.NODE_TAG}) + 1] AS tag FROM orders)"""

WAYS = f"""w0 AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS p, min(l_returnflag) AS rf, min(l_linestatus) AS ls
        FROM lineitem GROUP BY ALL),
 ways AS (SELECT {d.WAY_ID} AS id, ls, {lst(d.TAGS)}[({d.WAY_TAG}) + 1] AS tag,
   CASE WHEN l_linenumber = 7 THEN [-l_orderkey-1, -l_orderkey-2]
        WHEN rf = 'R' THEN [l_orderkey, -l_orderkey-1, l_orderkey+2, -l_orderkey-1, l_orderkey]
        ELSE [l_orderkey, l_orderkey+1, l_orderkey+2, l_orderkey+1, l_orderkey] END AS refs
   FROM w0)"""

WAY_XY = """way_xy AS (SELECT r.id, avg(nd.lat) AS lat, avg(nd.lng) AS lng
   FROM (SELECT id, unnest(refs) AS ref FROM ways) r JOIN nodes nd ON nd.id = r.ref GROUP BY r.id)"""

EXCLUDED = ", ".join(f"'{c}'" for c in rules.EXCLUDED)
KEY_RANK = lst(rules.POI_KEYS)

TAGGED = f"""node_tags AS (
   SELECT id, lat, lng, st, tag, split_part(tag, '=', 1) AS k,
     st = 'F' AND id % 3 = 0 AND split_part(tag, '=', 1) <> 'craft' AS crafty FROM nodes WHERE st <> 'P'),
 node_cat AS (SELECT id, lat, lng, st, tag, crafty,
     CASE WHEN crafty AND coalesce(list_position({KEY_RANK}, k), 99) > list_position({KEY_RANK}, 'craft') THEN 'craft=yes'
          WHEN list_position({KEY_RANK}, k) IS NOT NULL THEN tag END AS category FROM node_tags),
 way_cat AS (SELECT id, ls, tag, CASE WHEN list_position({KEY_RANK}, split_part(tag, '=', 1)) IS NOT NULL THEN tag END AS category FROM ways),
 tagged AS (SELECT 'node' AS kind, id, category FROM node_cat WHERE category NOT IN ({EXCLUDED})
   UNION ALL SELECT 'way', id, category FROM way_cat WHERE category NOT IN ({EXCLUDED}))"""


def _json(tag: str, pairs: list[tuple[str, str, str]]) -> str:
    out = f"""'{{"' || split_part({tag}, '=', 1) || '":"' || split_part({tag}, '=', 2) || '"'"""
    for cond, key, value in pairs:
        out += f""" || CASE WHEN {cond} THEN ',"{key}":"' || {value} || '"' ELSE '' END"""
    return out + " || '}'"


STAGED = f"""staged AS (
  SELECT 'osm' AS source, 'node/' || id AS source_id, 'Place ' || id AS name,
    CASE WHEN st = 'O' THEN 'EN ' || id END AS name_en, category, NULL::DOUBLE AS confidence, lat, lng,
    {_json("tag", [("crafty", "craft", "'yes'"), ("true", "name", "'Place ' || id"), ("st = 'O'", "name:en", "'EN ' || id")])} AS attrs
  FROM node_cat WHERE category NOT IN ({EXCLUDED})
  UNION ALL
  SELECT 'osm', 'way/' || w.id, CASE WHEN ls = 'O' THEN 'Way ' || w.id END, NULL, category, NULL, x.lat, x.lng,
    {_json("tag", [("ls = 'O'", "name", "'Way ' || w.id")])}
  FROM way_cat w JOIN way_xy x ON x.id = w.id WHERE category NOT IN ({EXCLUDED}))"""

ELEMENT_CTES = ", ".join([NODES, WAYS, WAY_XY, TAGGED, STAGED])

PLACES = f"""places AS (SELECT c_custkey AS k, 'p' || c_custkey AS id, {d.CONFIDENCE} AS confidence, {d.STATUS} AS status,
   CASE WHEN c_nationkey <> 3 THEN {lst(d.TAXONOMY)}[c_custkey % 8 + 1] END AS tax,
   'Customer ' || c_custkey AS name, CASE WHEN c_nationkey % 2 = 0 THEN 'English ' || c_custkey END AS name_en,
   lower(c_mktsegment) AS basic, CASE WHEN c_acctbal >= 0 THEN '"Brand ' || c_nationkey || '"' ELSE 'null' END AS brand,
   CASE WHEN c_nationkey < 5 THEN '["meta","msft"]' ELSE '["meta"]' END AS datasets,
   {d.PLACE_LAT} AS lat, {d.PLACE_LNG} AS lng FROM customer),
 place_poi AS (SELECT 'overture' AS source, id AS source_id, name, name_en, tax AS category, 'place>' || tax AS category_hierarchy,
   confidence, lat, lng, '{{"basic_category":"' || basic || '","brand":' || brand || ',"datasets":' || datasets || '}}' AS attrs
   FROM places WHERE confidence >= {{conf}} AND coalesce(status, 'open') = 'open' AND tax IS NOT NULL)"""


def places(conf: float = 0.6) -> str:
    return PLACES.replace("{conf}", n(conf)).replace("{{", "{").replace("}}", "}")


_DIR = ", ".join(f"({j}, {x}, {y})" for j, (x, y) in enumerate(d.DIRECTIONS))
_ISLET = ", ".join(f"({j}, {4000 + x}, {4000 + y})" for j, (x, y) in enumerate(((0, 0), (100, 0), (100, 100), (0, 100))))

EDGES = f"""dirs(j, dx, dy) AS (VALUES {_DIR}), sq(j, dx, dy) AS (VALUES {_ISLET}),
 verts AS (
  SELECT s_suppkey * 2 AS part_id, 0 AS ring, j, 8 AS nv,
    {d.degrees(f"({d.AREA_CX} + dx * {d.OUTER_R.format(j='j')})")} AS x, {d.degrees(f"({d.AREA_CY} + dy * {d.OUTER_R.format(j='j')})")} AS y
    FROM supplier, dirs
  UNION ALL SELECT s_suppkey * 2, 1, j, 8,
    {d.degrees(f"({d.AREA_CX} + dx * {d.HOLE_R.format(j='j')})")}, {d.degrees(f"({d.AREA_CY} + dy * {d.HOLE_R.format(j='j')})")}
    FROM supplier, dirs WHERE {d.HAS_HOLE}
  UNION ALL SELECT s_suppkey * 2 + 1, 0, j, 4, {d.degrees(f"({d.AREA_CX} + dx)")}, {d.degrees(f"({d.AREA_CY} + dy)")}
    FROM supplier, sq),
 edges AS (SELECT a.part_id, a.ring, a.j, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
   FROM verts a JOIN verts b ON a.part_id = b.part_id AND a.ring = b.ring AND b.j = (a.j + 1) % a.nv),
 boxes AS (SELECT part_id, min(x1) AS bx0, max(x1) AS bx1, min(y1) AS by0, max(y1) AS by1 FROM edges GROUP BY part_id)"""

SIDE = "((x2 - x1) * (lat - y1) - (lng - x1) * (y2 - y1))"
CROSS = f"((y1 > lat) <> (y2 > lat) AND CASE WHEN y2 > y1 THEN {SIDE} > 0 ELSE {SIDE} < 0 END)"
TOUCH = f"({SIDE} = 0 AND lng BETWEEN least(x1, x2) AND greatest(x1, x2) AND lat BETWEEN least(y1, y2) AND greatest(y1, y2))"


def inside(points: str, key: str, boundary: bool = True) -> str:
    """(key, part_id) of points in polygons: every point against every edge of the boxes it is in."""
    edge = f" OR max({TOUCH}::INT) = 1" if boundary else ""
    return f"""(SELECT p.{key}, e.part_id FROM {points} p JOIN boxes b ON p.lng BETWEEN bx0 AND bx1 AND p.lat BETWEEN by0 AND by1
      JOIN edges e ON e.part_id = b.part_id GROUP BY p.{key}, p.lat, p.lng, e.part_id HAVING sum({CROSS}::INT) % 2 = 1{edge})"""


def lattice(res: int) -> str:
    """CTE cand(part_id, h3, lat, lng): all cells around the boxes of the polygons."""
    c, s = rot(res)
    sz = size(res)
    base = (res + 1) * 2**58 + 2**57 + 2**28
    corner = ["bx0", "bx1"]
    us, vs = [], []
    for bx in corner:
        for by in ("by0", "by1"):
            us.append(f"({px(bx)}*{n(c)} + {py(by)}*{n(s)})")
            vs.append(f"({py(by)}*{n(c)} - {px(bx)}*{n(s)})")
    q = lambda f, off: f"floor({f}(" + ", ".join(
        f"({u}*{n(math.sqrt(3) / 3)} - {v}/3)/{n(sz)}" for u in us for v in vs
    ) + f")) {off}"
    r = lambda f, off: f"floor({f}(" + ", ".join(f"{v}*2/3/{n(sz)}" for v in vs) + f")) {off}"
    return f"""lat0 AS (SELECT part_id, CAST({q('least', '- 2')} AS BIGINT) AS q0, CAST({q('greatest', '+ 2')} AS BIGINT) AS q1,
      CAST({r('least', '- 2')} AS BIGINT) AS r0, CAST({r('greatest', '+ 2')} AS BIGINT) AS r1 FROM boxes),
     lat1 AS (SELECT part_id, q, unnest(range(r0, r1 + 1)) AS r FROM (SELECT part_id, r0, r1, unnest(range(q0, q1 + 1)) AS q FROM lat0)),
     lat2 AS (SELECT part_id, {base} + q * 536870912 + r AS h3 FROM lat1),
     cand AS (SELECT part_id, h3, {clat('h3', res)} AS lat, {clng('h3', res)} AS lng FROM lat2)"""


CENTER = f"""center AS (SELECT c.part_id, c.h3 FROM cand c JOIN edges e ON e.part_id = c.part_id
   GROUP BY c.part_id, c.h3, c.lat, c.lng HAVING sum({CROSS}::INT) % 2 = 1)"""


def touched(res: int, pieces: int = 16) -> str:
    """CTE touched(part_id, h3): cells an edge meets, by separating axes on short pieces."""
    c, s = rot(res)
    sz = size(res)
    h = math.sqrt(3) / 2
    frame = lambda x, y: (f"({px(x)}*{n(c)} + {py(y)}*{n(s)})/{n(sz)}", f"({py(y)}*{n(c)} - {px(x)}*{n(s)})/{n(sz)}")
    ua, va = frame(f"(x1 + (x2-x1)*i/{pieces})", f"(y1 + (y2-y1)*i/{pieces})")
    ub, vb = frame(f"(x1 + (x2-x1)*(i+1)/{pieces})", f"(y1 + (y2-y1)*(i+1)/{pieces})")
    axes = []
    for nx, ny in ((1.0, 0.0), (0.5, h), (-0.5, h)):
        a, b = f"((ua-cu)*{n(nx)} + (va-cv)*{n(ny)})", f"((ub-cu)*{n(nx)} + (vb-cv)*{n(ny)})"
        axes.append(f"least({a}, {b}) <= {n(h)} AND greatest({a}, {b}) >= {n(-h)}")
    # axis across the piece: the corners must not all lie on one side of its line
    cross = [
        f"((ub-ua)*(cv+{n(math.sin(math.radians(60 * k + 30)))}-va) - (vb-va)*(cu+{n(math.cos(math.radians(60 * k + 30)))}-ua))"
        for k in range(6)
    ]
    axes.append(f"least({', '.join(cross)}) <= 0 AND greatest({', '.join(cross)}) >= 0")
    near = ", ".join(f"({a}, {b})" for a in range(-2, 3) for b in range(-2, 3))
    base = (res + 1) * 2**58 + 2**57 + 2**28
    return f"""near(dq, dr) AS (VALUES {near}),
     pieces AS (SELECT part_id, {ua} AS ua, {va} AS va, {ub} AS ub, {vb} AS vb FROM (SELECT *, unnest(range({pieces})) AS i FROM edges)),
     spots AS (SELECT *, CAST(floor(ua*{n(math.sqrt(3) / 3)} - va/3 + 0.5) AS BIGINT) + dq AS q, CAST(floor(va*2/3 + 0.5) AS BIGINT) + dr AS r FROM pieces, near),
     spots2 AS (SELECT *, {n(math.sqrt(3))} * (q + r/2) AS cu, {n(1.5)} * r AS cv FROM spots),
     touched AS (SELECT DISTINCT part_id, {base} + q * 536870912 + r AS h3 FROM spots2 WHERE {' AND '.join(axes)})"""


def seg2(x: str, y: str, ax: str, ay: str, bx: str, by: str) -> str:
    """Squared distance from a point to a segment."""
    dx, dy = f"({bx} - {ax})", f"({by} - {ay})"
    t = f"greatest(0, least(1, (({x} - {ax})*{dx} + ({y} - {ay})*{dy}) / ({dx}*{dx} + {dy}*{dy})))"
    return f"(({x} - {ax} - {t}*{dx})**2 + ({y} - {ay} - {t}*{dy})**2)"


def within(res: int, buffer_m: float, whole_cell: bool) -> str:
    """CTE within(part_id, h3): all cells of the box against all pieces of the polygon's edges."""
    tests = [seg2("cu", "cv", "ua", "va", "ub", "vb")]
    if whole_cell:
        at = [
            (f"(cu + {n(math.cos(math.radians(60 * k + 30)))})", f"(cv + {n(math.sin(math.radians(60 * k + 30)))})")
            for k in (0, 1, 2, 3, 4, 5, 0)
        ]
        tests = [seg2(x, y, "ua", "va", "ub", "vb") for x, y in at[:6]]
        for (ax, ay), (bx, by) in zip(at, at[1:], strict=False):
            tests += [seg2(u, v, ax, ay, bx, by) for u, v in (("ua", "va"), ("ub", "vb"))]
    reach = (buffer_m / size(res)) ** 2
    return f"""candf AS (SELECT part_id, h3, {n(math.sqrt(3))} * ({cq('h3')} + {cr('h3')} / 2) AS cu, {n(1.5)} * {cr('h3')} AS cv FROM cand),
     within AS (SELECT DISTINCT c.part_id, c.h3 FROM candf c JOIN pieces p ON p.part_id = c.part_id
       WHERE abs(cu - ua) < 6 AND abs(cv - va) < 6 AND least({', '.join(tests)}, 1e9) <= {n(reach)})"""


RES = 8
BASE_CTES = f"{EDGES}, {lattice(RES)}, {CENTER}"
GRID_CTES = f"{BASE_CTES}, {touched(RES)}, grid AS (SELECT h3 FROM center UNION SELECT h3 FROM touched)"

RASTER = f"""raster AS (
  SELECT row0 + i AS row, col0 + j AS col, v AS value FROM (
   SELECT {d.BLOCK_ROW} AS row0, {d.BLOCK_COL} AS col0, unnest([0,0,0,1,1,1]) AS i, unnest([0,1,2,0,1,2]) AS j,
    unnest([l_quantity, l_linenumber::DOUBLE, CASE WHEN l_returnflag <> 'R' THEN l_quantity END,
            0::DOUBLE, CASE WHEN l_returnflag <> 'A' THEN l_quantity + 1 END, round(l_tax * 100)]) AS v FROM lineitem)
  WHERE v IS NOT NULL),
 pixels AS (SELECT {n(14.65)} + (row + 0.5e0) * {n(-1e-4)} AS lat, {n(102.4)} + (col + 0.5e0) * {n(1e-4)} AS lng, value AS pop FROM raster WHERE value > 0),
 pixel_cells AS (SELECT h3, sum(pop) AS population, count(*) AS n_pixels FROM {add_cell('pixels', RES)} GROUP BY h3)"""

POINT_GRID = f"point_grid AS (SELECT DISTINCT h3 FROM {add_cell('nodes', RES)})"
POP = """pop AS (SELECT g.h3, coalesce(c.population, 0) AS population, coalesce(c.n_pixels, 0)::INT AS n_pixels
   FROM {grid} g LEFT JOIN pixel_cells c USING (h3))"""


def group_case() -> str:
    whens = []
    for g, pats in rules.DEFAULT_GROUPS.items():
        for p in pats:
            test = f"category LIKE '{p[:-1]}%'" if p.endswith("=*") else f"category = '{p}'"
            whens.append(f"WHEN {test} THEN '{g}'")
    return f"CASE {' '.join(whens)} ELSE 'other' END"


NAMES = [*rules.DEFAULT_GROUPS, "other"]
COUNTS = f"""poi_cells AS (SELECT *, {group_case()} AS grp FROM {add_cell('{pois}', RES)}),
 counts AS (SELECT h3, count(*)::INT AS n_poi, {', '.join(f"count(*) FILTER (WHERE grp = '{g}')::INT AS n_{g}" for g in NAMES)} FROM poi_cells GROUP BY h3),
 entropy AS (SELECT h3, entropy(category) AS bits FROM poi_cells GROUP BY h3)"""


def counts(pois: str = "staged") -> str:
    return COUNTS.replace("{pois}", pois)


def disk(k: int) -> str:
    cells = [
        (dq * 536870912 + dr, max(abs(dq), abs(dr), abs(dq + dr)))
        for dq in range(-k, k + 1)
        for dr in range(-k, k + 1)
        if abs(dq + dr) <= k
    ]
    return ", ".join(f"({o}, {ring})" for o, ring in cells)


SUMS = ["population", "n_poi", *[f"n_{g}" for g in NAMES]]


def features(grid: str, pois: str = "staged", rounded: bool = True) -> str:
    """CTEs ending in feats(...): the feature table by gathering neighbours."""
    base = ", ".join(f"coalesce(c.n_{g}, 0)::INT AS n_{g}" for g in NAMES)
    ksum = ", ".join(
        f"sum(nb.{c}) FILTER (WHERE ring <= {k}){'' if c == 'population' else '::INT'} AS {c}_k{k}" for k in (1, 2) for c in SUMS
    )
    return f"""{POP.format(grid=grid)}, {counts(pois)},
     base AS (SELECT g.h3, p.population, coalesce(c.n_poi, 0)::INT AS n_poi, {base}, e.bits
       FROM {grid} g JOIN pop p USING (h3) LEFT JOIN counts c USING (h3) LEFT JOIN entropy e USING (h3)),
     dsk(o, ring) AS (VALUES {disk(2)}),
     hood AS (SELECT b.h3, {ksum} FROM base b, dsk JOIN base nb ON nb.h3 = b.h3 + dsk.o GROUP BY b.h3),
     feats AS (SELECT b.*, CASE WHEN population > 0 THEN n_poi * 1000e0 / population END AS poi_per_1k_pop, hood.* EXCLUDE (h3),
       population >= 200 AND n_poi = 0 AS data_gap FROM base b JOIN hood USING (h3))"""


FEATURE_COLS = (
    f"h3, lower(hex(h3)) AS h3_str, round({clat('h3', RES)}, 6) AS lat, round({clng('h3', RES)}, 6) AS lng, round(population, 6) AS population, n_poi, "
    + ", ".join(f"n_{g}" for g in NAMES)
    + ", round(bits, 6) AS poi_category_entropy, round(poi_per_1k_pop, 6) AS poi_per_1k_pop, "
    + ", ".join(f"round({c}_k{k}, 6) AS {c}_k{k}" if c == "population" else f"{c}_k{k}" for k in (1, 2) for c in SUMS)
    + ", data_gap"
)

CITY = "CASE " + " ".join(
    f"WHEN lng BETWEEN {x0} AND {x1} AND lat BETWEEN {y0} AND {y1} THEN '{c}'" for c, (x0, x1, y0, y1) in CITY_BOXES.items()
) + " END"

CUSTOMER_XY = f"""ours AS (SELECT c_custkey AS id, {d.PLACE_LAT} AS lat, {d.PLACE_LNG} AS lng, 'Customer ' || c_custkey AS name FROM customer),
 truth AS (SELECT c_custkey AS id, {d.degrees(f"{d._plat0} + (c_custkey * 6151) % 30011 + {d.TRUTH_DLAT}")} AS lat,
   {d.degrees(f"{d._plng0} + (c_custkey * 99991) % 29989 + {d.TRUTH_DLNG}")} AS lng, {d.TRUTH_NAME} AS name FROM customer)"""


def grams(name: str) -> str:
    norm = f"trim(regexp_replace(regexp_replace(lower({name}), '[[:punct:]]+', '', 'g'), ' +', ' ', 'g'))"
    pad = f"('  ' || {norm} || ' ')"
    return f"list_distinct(list_transform(range(1, length({pad}) - 1), lambda i: substr({pad}, i, 3)))"


def sim(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return f"({both} / (len({a}) + len({b}) - {both}))"


def dist(la: str, na: str, lb: str, nb: str) -> str:
    h = (
        f"(sin(({lb}-{la})*{n(RAD)}/2)**2 + cos({la}*{n(RAD)})*cos({lb}*{n(RAD)})*sin(({nb}-{na})*{n(RAD)}/2)**2)"
    )
    return f"(2*{n(R)}*asin(least(1, sqrt({h}))))"


def matching(radius: float, min_sim: float | None, wider: float = 1.1) -> str:
    """CTEs ending in matched(a, b, d, s): one pair per step, in greedy order.

    ``wider`` is at least how much shorter a degree of longitude is than one of latitude.
    """
    # a box a little larger than the radius bounds the exhaustive comparison
    pad = radius / 110000
    keep = "" if min_sim is None else f" AND s >= {min_sim}"
    s = "s" if min_sim is not None else "0"
    return f"""a0 AS (SELECT *, {grams('name')} AS g FROM ours), b0 AS (SELECT *, {grams('name')} AS g FROM truth),
     near AS (SELECT a0.id AS a, b0.id AS b, {dist('a0.lat', 'a0.lng', 'b0.lat', 'b0.lng')} AS d, {sim('a0.g', 'b0.g')} AS s
       FROM a0 JOIN b0 ON b0.lat BETWEEN a0.lat - {pad} AND a0.lat + {pad} AND b0.lng BETWEEN a0.lng - {pad * wider} AND a0.lng + {pad * wider}),
     ranked AS (SELECT *, row_number() OVER (ORDER BY d, -{s}, a, b) AS rn FROM near WHERE d <= {radius}{keep}),
     greedy AS (
       SELECT 0::BIGINT AS rn, []::BIGINT[] AS ua, []::BIGINT[] AS ub
       UNION ALL
       SELECT r.rn, CASE WHEN list_contains(ua, r.a) OR list_contains(ub, r.b) THEN ua ELSE list_append(ua, r.a) END,
              CASE WHEN list_contains(ua, r.a) OR list_contains(ub, r.b) THEN ub ELSE list_append(ub, r.b) END
       FROM greedy g JOIN ranked r ON r.rn = g.rn + 1),
     last AS (SELECT ua, ub FROM greedy ORDER BY rn DESC LIMIT 1),
     took AS (SELECT unnest(ua) AS a, unnest(ub) AS b FROM last),
     matched AS (SELECT r.a, r.b, r.d, r.s FROM took JOIN ranked r ON r.a = took.a AND r.b = took.b)"""


COMPARE = f"""{RASTER}, ma AS (SELECT o.*, m.a IS NOT NULL AS hit FROM ours o LEFT JOIN matched m ON m.a = o.id),
 mb AS (SELECT t.*, m.b IS NOT NULL AS hit FROM truth t LEFT JOIN matched m ON m.b = t.id),
 ca AS (SELECT h3, count(*)::INT AS ours, sum(hit::INT)::INT AS matched_ours FROM {add_cell('ma', RES)} GROUP BY h3),
 cb AS (SELECT h3, count(*)::INT AS ground_truth, sum(hit::INT)::INT AS matched_ground_truth FROM {add_cell('mb', RES)} GROUP BY h3),
 cmp AS (SELECT h3, {clat('h3', RES)} AS lat, {clng('h3', RES)} AS lng, coalesce(p.population, 0) AS population, coalesce(ours, 0) AS ours,
   coalesce(ground_truth, 0) AS ground_truth, coalesce(matched_ground_truth, 0) AS matched_ground_truth,
   coalesce(matched_ours, 0) AS matched_ours, coalesce(ground_truth, 0) - coalesce(ours, 0) AS gt_minus_ours
   FROM ca FULL JOIN cb USING (h3) LEFT JOIN pixel_cells p USING (h3))"""


def utm(zone: int = 48) -> str:
    """CTE uv(part_id, ring, j, nv, e, nn): vertices in UTM by the Krueger series."""
    f = 1 / 298.257223563
    t = f / (2 - f)
    ecc = math.sqrt(f * (2 - f))
    a = 6378137.0 / (1 + t) * (1 + t**2 / 4 + t**4 / 64)
    al = [t / 2 - 2 * t**2 / 3 + 5 * t**3 / 16, 13 * t**2 / 48 - 3 * t**3 / 5, 61 * t**3 / 240]
    lam = f"((x - {6 * zone - 183}) * {n(RAD)})"
    phi = f"(y * {n(RAD)})"
    tau = f"sinh(atanh(sin({phi})) - {n(ecc)} * atanh({n(ecc)} * sin({phi})))"
    east = "eta" + "".join(f" + {n(c)} * cos({2 * i}*xi) * sinh({2 * i}*eta)" for i, c in enumerate(al, 1))
    north = "xi" + "".join(f" + {n(c)} * sin({2 * i}*xi) * cosh({2 * i}*eta)" for i, c in enumerate(al, 1))
    return f"""u0 AS (SELECT part_id, ring, j, nv, atan2(tau, cos({lam})) AS xi, atanh(sin({lam}) / sqrt(1 + tau*tau)) AS eta
       FROM (SELECT *, {tau} AS tau FROM verts)),
     uv AS (SELECT part_id, ring, j, nv, {n(0.9996 * a)} * ({east}) AS e, {n(0.9996 * a)} * ({north}) AS nn FROM u0),
     ukm AS (SELECT part_id, sum(CASE WHEN ring = 0 THEN ar ELSE -ar END) / 1e6 AS area_km2 FROM (
        SELECT p.part_id, p.ring, abs(sum(p.e*q.nn - q.e*p.nn)) / 2 AS ar FROM uv p JOIN uv q
          ON p.part_id = q.part_id AND p.ring = q.ring AND q.j = (p.j + 1) % p.nv GROUP BY p.part_id, p.ring) GROUP BY part_id)"""


DEG2 = """deg AS (SELECT part_id, round(sum(CASE WHEN ring = 0 THEN ar ELSE -ar END), 12) AS deg2 FROM (
   SELECT e.part_id, e.ring, abs(sum((x1-ox)*(y2-oy) - (x2-ox)*(y1-oy))) / 2 AS ar FROM edges e
     JOIN (SELECT part_id, ring, x AS ox, y AS oy FROM verts WHERE j = 0) o ON o.part_id = e.part_id AND o.ring = e.ring
   GROUP BY e.part_id, e.ring) GROUP BY part_id)"""

COMMON = "source, source_id, name, name_en, category, {h} AS category_hierarchy, confidence, round(lat, 6) AS lat, round(lng, 6) AS lng, attrs"
HIER = "split_part(category, '=', 1) || '>' || category"


def parent_cte(src: str, res: int, out: str) -> str:
    """Subquery adding the parent of column h (resolution ``res``): the parent cell whose lattice
    point, scaled down, is nearest: brute force over the cells around the truncated position."""
    nq, nr = ("3*q + r", "2*r - q") if res % 2 == 0 else ("2*q - r", "q + 3*r")
    near = ", ".join(f"({a}, {b})" for a in range(-1, 3) for b in range(-1, 3))
    base = res * 2**58 + 2**57 + 2**28
    d2 = "((fq-pq)*(fq-pq) + (fq-pq)*(fr-pr) + (fr-pr)*(fr-pr))"
    return f"""(SELECT h, min_by({base} + pq * 536870912 + pr, {d2}) AS {out} FROM (
       SELECT h, fq, fr, CAST(floor(fq) AS BIGINT) + a AS pq, CAST(floor(fr) AS BIGINT) + b AS pr FROM (
         SELECT h, ({nq}) / 7e0 AS fq, ({nr}) / 7e0 AS fr FROM (SELECT DISTINCT h, {cq('h')} AS q, {cr('h')} AS r FROM {src})),
         (VALUES {near}) t(a, b)) GROUP BY h)"""


def wkt_ring(res: int) -> str:
    x, y = cxy("h3", res)
    c, s = rot(res)
    pts = []
    for k in (0, 1, 2, 3, 4, 5, 0):
        a = math.radians(60 * k + 30)
        u, v = size(res) * math.cos(a), size(res) * math.sin(a)
        dx, dy = u * c - v * s, u * s + v * c
        pts.append(
            f"round(({x} + {n(dx)}) / {n(KX)} + {n(LNG0)}, 6)::VARCHAR || ' ' || round(asin(({y} + {n(dy)}) / {n(KY)} + {n(SIN0)}) / {n(RAD)}, 6)::VARCHAR"
        )
    return "'POLYGON((' || " + " || ', ' || ".join(pts) + " || '))'"


NEAR_AREA = f"""{d.degrees(f"({d.AREA_CX} - 3000)")} AS xmin, {d.degrees(f"({d.AREA_CX} + 4100)")} AS xmax,
  {d.degrees(f"({d.AREA_CY} - 3000)")} AS ymin, {d.degrees(f"({d.AREA_CY} + 4100)")} AS ymax"""

QPOP = f"WITH {NODES}, {RASTER}, {POINT_GRID}, {POP.format(grid='point_grid')}"
_SEVENTHS = "[" + ", ".join(n(i / 7) for i in range(8)) + "]"
BREAKS = f"""cuts AS (SELECT unnest(range(8)) AS i, unnest(quantile_cont(population, {_SEVENTHS})) AS v FROM pop WHERE population > 0)"""

OFFSETS_1 = [dq * 536870912 + dr for dq in (-1, 0, 1) for dr in (-1, 0, 1) if abs(dq + dr) <= 1]

# The two sources of the duplicate query.
TWO = f"""{places(0.0)}, {CUSTOMER_XY}, second AS (
  SELECT 'fsq' AS source, p.id AS source_id, t.name, p.confidence, p.lat + (t.lat - p.lat) * 0.1e0 AS lat, p.lng + (t.lng - p.lng) * 0.1e0 AS lng
  FROM places p JOIN truth t ON t.id = p.k WHERE p.confidence >= 0 AND coalesce(p.status, 'open') = 'open' AND p.tax IS NOT NULL),
 both0 AS (SELECT source, source_id, name, confidence, lat, lng FROM place_poi UNION ALL SELECT * FROM second),
 both1 AS MATERIALIZED (SELECT *, source || '|' || source_id AS node, {grams('name')} AS g FROM {add_cell('both0', 11)}),
 spread AS (SELECT node, source, g, unnest([{', '.join(f'h3 + ({o})' for o in OFFSETS_1)}]) AS h3 FROM both1),
 link AS MATERIALIZED (SELECT x.node AS a, y.node AS b FROM spread x JOIN both1 y ON y.h3 = x.h3 AND y.source <> x.source
   WHERE {sim('x.g', 'y.g')} >= 0.5),
 reach(node, other) AS (SELECT node, node FROM both1 UNION SELECT r.node, l.b FROM reach r JOIN link l ON l.a = r.other),
 comp AS (SELECT node, min(other) AS dup_group_id FROM reach GROUP BY node)"""

ORACLES: dict[str, str] = {
    "bbox_prefilter": f"""SELECT id, area_name, round(xmin, 6) AS xmin, round(ymax, 6) AS ymax FROM (
        SELECT s_suppkey AS id, s_name AS area_name, s_nationkey, {NEAR_AREA} FROM supplier)
        WHERE s_nationkey <> 24 AND xmin < {BOX['xmax']} AND xmax > {BOX['xmin']} AND ymin < {BOX['ymax']} AND ymax > {BOX['ymin']}""",
    "osm_category": f"WITH {NODES}, {WAYS}, {TAGGED} SELECT kind, id, category FROM tagged",
    "way_centroid": f"WITH {NODES}, {WAYS}, {WAY_XY} SELECT id, round(lat, 6) AS lat, round(lng, 6) AS lon FROM way_xy",
    "stage_osm": f"WITH {ELEMENT_CTES} SELECT {COMMON.format(h=HIER)} FROM staged",
    "stage_places": f"WITH {places()} SELECT {COMMON.format(h='category_hierarchy')} FROM place_poi",
    "source_union": f"""WITH {ELEMENT_CTES}, {places()} SELECT source, category, count(*) AS n FROM (
        SELECT source, category FROM staged UNION ALL SELECT source, category FROM place_poi) GROUP BY ALL""",
    "cell_index": f"""WITH {NODES} SELECT id, h3_res7, h3_res8, h3_res11, lower(hex(h3_res8)) AS h3_str, h3_res8 AS back,
        11 AS res11, round({clat('h3_res8', 8)}, 6) AS lat8, round({clng('h3_res8', 8)}, 6) AS lng8,
        round({clat('h3_res7', 7)}, 6) AS lat7, round({clng('h3_res7', 7)}, 6) AS lng7, round({n(1.5 * math.sqrt(3) * 575 * 575 / 1e6)}, 9) AS km2
        FROM {add_cell(add_cell(add_cell('nodes', 7, 'h3_res7'), 8, 'h3_res8'), 11, 'h3_res11')}""",
    "cell_parent": f"""WITH {NODES}, g AS (SELECT DISTINCT h FROM {add_cell('nodes', 9, 'h')}),
        a AS (SELECT * FROM {parent_cte('g', 9, 'p8')}), b AS (SELECT DISTINCT p8 AS h FROM a), c AS (SELECT h AS p8, p7 FROM {parent_cte('b', 8, 'p7')})
        SELECT a.h AS h3, a.p8, c.p7 FROM a JOIN c USING (p8)""",
    "grid_disk": f"""WITH {NODES}, {POINT_GRID} SELECT h3, h3 + o AS cell, ring FROM point_grid, (VALUES {disk(2)}) t(o, ring)""",
    "cell_boundary_wkt": f"WITH {NODES}, {POINT_GRID} SELECT h3, {wkt_ring(RES)} AS wkt FROM point_grid",
    "polygon_area": f"WITH {EDGES}, {DEG2} SELECT part_id, deg2 FROM deg",
    "utm_area": f"WITH {EDGES}, {utm()} SELECT part_id, round(area_km2, 5) AS area_km2 FROM ukm",
    "boundary_parts": f"""WITH {EDGES}, {DEG2}, {utm()} SELECT row_number() OVER (ORDER BY deg2 DESC, part_id)::INT AS part_id,
        round(area_km2, 5) AS area_km2 FROM deg JOIN ukm USING (part_id)""",
    "surface_points": f"""WITH {EDGES}, cut AS (SELECT e.part_id, m.lat, x1 + (m.lat - y1) * (x2 - x1) / (y2 - y1) AS x
          FROM edges e JOIN (SELECT part_id, (by0 + by1) / 2 AS lat FROM boxes) m USING (part_id) WHERE (y1 > m.lat) <> (y2 > m.lat)),
        spans AS (SELECT part_id, lat, x, lead(x) OVER w AS xb, row_number() OVER w AS k FROM cut WINDOW w AS (PARTITION BY part_id ORDER BY x))
        SELECT part_id, round(arg_max(lat, xb - x), 6) AS lat, round(arg_max((x + xb) / 2, xb - x), 6) AS lng FROM spans WHERE k % 2 = 1 GROUP BY part_id""",
    "point_in_polygon": f"WITH {NODES}, {EDGES} SELECT id, part_id FROM {inside('nodes', 'id')}",
    "point_in_polygon_bands": f"WITH {CUSTOMER_XY}, {EDGES} SELECT id, part_id FROM {inside('ours', 'id')}",
    "crowded_cells": f"""WITH {NODES}, {EDGES}, tile_edges AS (SELECT part_id // {2 * d.AREAS_PER_TILE} AS part_id, x1, y1, x2, y2 FROM edges),
        tile_boxes AS (SELECT part_id, min(x1) AS bx0, max(x1) AS bx1, min(y1) AS by0, max(y1) AS by1 FROM tile_edges GROUP BY part_id)
        SELECT id, part_id AS tile FROM {inside('nodes', 'id').replace('JOIN boxes', 'JOIN tile_boxes').replace('JOIN edges', 'JOIN tile_edges')}""",
    "polyfill_center": f"WITH {BASE_CTES} SELECT part_id, h3 FROM center",
    "polyfill_center_odd": f"WITH {EDGES}, {lattice(9)}, {CENTER} SELECT part_id, h3 FROM center",
    "polyfill_overlap": f"WITH {GRID_CTES} SELECT part_id, h3 FROM center UNION SELECT part_id, h3 FROM touched",
    "polyfill_buffered": f"""WITH {GRID_CTES}, {within(RES, 500.0, False)} SELECT part_id, h3 FROM center
        UNION SELECT part_id, h3 FROM within""",
    "polyfill_buffered_overlap": f"""WITH {GRID_CTES}, {within(RES, 500.0, True)} SELECT part_id, h3 FROM center
        UNION SELECT part_id, h3 FROM touched UNION SELECT part_id, h3 FROM within""",
    "grid_table": f"""WITH {GRID_CTES} SELECT h3, lower(hex(h3)) AS h3_str, 8 AS res, round({clat('h3', RES)}, 6) AS lat,
        round({clng('h3', RES)}, 6) AS lng FROM grid""",
    "clip_and_index": f"""WITH {ELEMENT_CTES}, {GRID_CTES}, ins AS (SELECT DISTINCT source_id FROM {inside('staged', 'source_id')}),
        st AS (SELECT * FROM {add_cell(add_cell('staged', 8, 'h3_res8'), 11, 'h3_res11')})
        SELECT source_id, category, h3_res8, h3_res11 FROM st WHERE source_id IN (FROM ins) AND h3_res8 IN (FROM grid)""",
    "admin_tags": f"""WITH {NODES}, {POINT_GRID}, {EDGES}, c AS (SELECT h3, {clat('h3', RES)} AS lat, {clng('h3', RES)} AS lng FROM point_grid),
        loc AS (SELECT h3, min(s_name) AS commune FROM {inside('c', 'h3', False)} i JOIN supplier s ON s.s_suppkey = i.part_id // 2 GROUP BY h3)
        SELECT c.h3, r.r_name AS province, na.n_name AS district, loc.commune FROM c
        LEFT JOIN region r ON floor(c.lng - {n(102.4)}) = r.r_regionkey AND c.lat > 10 AND c.lat < 14.65
        LEFT JOIN nation na ON floor(c.lng - {n(102.4)}) = na.n_nationkey % 5 AND c.lat > 10 AND floor((c.lat - 10) / 0.93e0) = na.n_nationkey // 5
        LEFT JOIN loc USING (h3)""",
    "raster_pixels": f"WITH {RASTER} SELECT round(lat, 7) AS lat, round(lng, 7) AS lng, pop FROM pixels",
    "raster_block_sum": f"""WITH {RASTER} SELECT (row // 7)::INT AS block_row, (col // 7)::INT AS block_col, sum(value) AS value, count(*)::INT AS n_cells
        FROM raster WHERE row < {d.RASTER_ROWS // 7 * 7} AND col < {d.RASTER_COLS // 7 * 7} GROUP BY ALL""",
    "raster_window": f"""WITH {RASTER} SELECT row::INT AS row, col::INT AS col, value FROM raster
        WHERE row >= {int((BOX['ymax'] - 14.65) / -1e-4)} AND row < {int((BOX['ymin'] - 14.65) / -1e-4)}
          AND col >= {int((BOX['xmin'] - 102.4) / 1e-4)} AND col < {int((BOX['xmax'] - 102.4) / 1e-4)}""",
    "population_by_cell": f"{QPOP} SELECT h3, lower(hex(h3)) AS h3_str, population, n_pixels FROM pop",
    "group_counts": f"WITH {ELEMENT_CTES}, {counts()} SELECT * FROM counts",
    "category_entropy": f"WITH {ELEMENT_CTES}, {counts()} SELECT h3, round(bits, 6) AS bits FROM entropy",
    "neighbour_sums": f"""{QPOP}, dsk(o, ring) AS (VALUES {disk(2)})
        SELECT b.h3, sum(nb.population) FILTER (WHERE ring <= 1) AS population_k1, sum(nb.n_pixels) FILTER (WHERE ring <= 1)::INT AS n_pixels_k1,
          sum(nb.population) AS population_k2, sum(nb.n_pixels)::INT AS n_pixels_k2
        FROM pop b, dsk JOIN pop nb ON nb.h3 = b.h3 + dsk.o GROUP BY b.h3""",
    "neighbour_sums_wide": f"""{QPOP}, dsk(o, ring) AS (VALUES {disk(20)})
        SELECT b.h3, round(sum(nb.population), 6) AS population_k20, sum(nb.n_pixels)::INT AS n_pixels_k20
        FROM pop b, dsk JOIN pop nb ON nb.h3 = b.h3 + dsk.o GROUP BY b.h3""",
    "hex_features": f"""WITH {ELEMENT_CTES}, {GRID_CTES}, {RASTER}, ins AS (SELECT DISTINCT source_id FROM {inside('staged', 'source_id')}),
        clipped AS (SELECT * FROM staged WHERE source_id IN (FROM ins)), {features('grid', 'clipped')} SELECT {FEATURE_COLS} FROM feats""",
    "data_gap": f"""WITH {ELEMENT_CTES}, {RASTER}, {POINT_GRID}, {features('point_grid')}
        SELECT h3, round(population, 6) AS population, n_poi, n_poi_k2 FROM feats WHERE data_gap""",
    "service_gaps": f"""WITH {ELEMENT_CTES}, {RASTER}, {POINT_GRID}, {features('point_grid')}
        SELECT grp, h3, round(population, 6) AS population FROM (
          SELECT 'health' AS grp, h3, population FROM feats WHERE population >= 300 AND n_health_k1 = 0
          UNION ALL SELECT 'education', h3, population FROM feats WHERE population >= 300 AND n_education_k1 = 0
          UNION ALL SELECT 'finance', h3, population FROM feats WHERE population >= 300 AND n_finance_k1 = 0)""",
    "quantile_breaks": f"""{QPOP}, {BREAKS} SELECT b.i::INT AS class, round(a.v, 6) AS lower, round(b.v, 6) AS upper
        FROM cuts a JOIN cuts b ON b.i = a.i + 1""",
    "quantile_classes": f"""{QPOP}, {BREAKS}, inner_cuts AS (SELECT list(v) AS vs FROM cuts WHERE i BETWEEN 1 AND 6)
        SELECT h3, round(population, 6) AS population, (1 + len(list_filter(vs, lambda x: x < population)))::INT AS class
        FROM pop, inner_cuts WHERE population > 0""",
    "manual_classes": f"""WITH {ELEMENT_CTES}, {counts()} SELECT h3, n_poi, CASE WHEN n_poi >= 100 THEN '100+' WHEN n_poi >= 25 THEN '25–99'
        WHEN n_poi >= 10 THEN '10–24' WHEN n_poi >= 5 THEN '5–9' WHEN n_poi >= 2 THEN '2–4' WHEN n_poi = 1 THEN '1' END AS class FROM counts""",
    "top_cells": f"""WITH {ELEMENT_CTES}, {counts()}, t AS (SELECT h3, n_poi, {clat('h3', RES)} AS lat, {clng('h3', RES)} AS lng
        FROM counts ORDER BY n_poi DESC, h3 LIMIT 10) SELECT h3, n_poi, {CITY} AS city FROM t""",
    "rollup_parent": f"""{QPOP}, g AS (SELECT h3 AS h FROM pop) SELECT p7 AS h3, round(sum(population), 6) AS population, sum(n_pixels)::BIGINT AS n_pixels
        FROM pop JOIN {parent_cte('g', 8, 'p7')} x ON x.h = pop.h3 GROUP BY p7""",
    "uniform_children": f"""{QPOP}, t(a, b) AS (VALUES (0,0),(1,0),(0,1),(-1,1),(-1,0),(0,-1),(1,-1)),
        k AS (SELECT population, {cq('h3')} AS q, {cr('h3')} AS r FROM pop)
        SELECT {10 * 2**58 + 2**57 + 2**28} + (3*q + r + a) * 536870912 + (2*r - q + b) AS h3, round(population / 7, 6) AS population FROM k, t""",
    "explore_categories": f"""WITH {ELEMENT_CTES} SELECT split_part(category, '=', 1) AS top_level, category, count(*) AS n FROM staged GROUP BY ALL""",
    "top_categories": f"""WITH {ELEMENT_CTES} SELECT split_part(category, '=', 1) AS top_level, category, count(*) AS n FROM staged
        GROUP BY ALL ORDER BY n DESC, category LIMIT 10""",
    "categories_by_top_level": f"WITH {ELEMENT_CTES} SELECT split_part(category, '=', 1) AS top_level, count(*) AS n FROM staged GROUP BY ALL",
    "health_pois": f"WITH {ELEMENT_CTES} SELECT source_id, category FROM staged WHERE category IN ('amenity=clinic', 'amenity=pharmacy')",
    "snapshot_asof": f"""WITH l AS (SELECT o_orderpriority || '/' || ['release','extract','draft'][o_orderkey % 3 + 1] AS source, o_orderkey % 3 AS kind,
          o_orderkey % 12 AS patch, o_orderdate::DATE AS dt FROM orders WHERE o_orderkey % 3 < 2 AND o_orderdate::DATE <= DATE '{d.REFERENCE}'),
        p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY dt DESC, CASE WHEN kind = 0 THEN patch ELSE 0 END DESC) AS rn FROM l)
        SELECT source, CASE WHEN kind = 0 THEN strftime(dt, '%Y-%m-%d') || '.' || patch ELSE 'country-' || strftime(dt, '%y%m%d') || '.osm.pbf' END AS snapshot,
          strftime(dt, '%Y-%m-%d') AS snapshot_date, date_diff('day', dt, DATE '{d.REFERENCE}')::INT AS lag_days,
          abs(date_diff('day', dt, DATE '{d.REFERENCE}')) > 45 AS stale FROM p WHERE rn = 1""",
    "orphan_parents": f"""WITH {EDGES}, {lattice(8)}, {CENTER}, fine AS (SELECT DISTINCT h3 AS h FROM center),
        up AS (SELECT DISTINCT p7 AS h3 FROM {parent_cte('fine', 8, 'p7')}),
        coarse AS (WITH {lattice(7).replace('cand AS', 'cand7 AS').replace('lat0', 'k0').replace('lat1', 'k1').replace('lat2', 'k2')}
          SELECT DISTINCT c.h3 FROM cand7 c JOIN edges e ON e.part_id = c.part_id GROUP BY c.part_id, c.h3, c.lat, c.lng HAVING sum({CROSS}::INT) % 2 = 1)
        SELECT h3 FROM up WHERE h3 NOT IN (SELECT h3 FROM coarse)""",
    "name_trigram": f"""WITH {CUSTOMER_XY} SELECT a.id, round({sim(grams('a.name'), grams('b.name'))}, 6) AS similarity
        FROM ours a JOIN truth b ON a.id = b.id""",
    "match_points": f"""WITH RECURSIVE {CUSTOMER_XY}, {matching(100.0, 0.5)}
        SELECT a AS ours_id, b AS truth_id, round(d, 4) AS distance_m, round(s, 6) AS similarity FROM matched""",
    "match_distance_only": f"""WITH RECURSIVE {CUSTOMER_XY}, {matching(300.0, None)}
        SELECT a AS ours_id, b AS truth_id, round(d, 4) AS distance_m FROM matched""",
    "compare_by_cell": f"""WITH RECURSIVE {CUSTOMER_XY}, {matching(100.0, 0.5)}, {COMPARE}
        SELECT h3, round(lat, 6) AS lat, round(lng, 6) AS lng, round(population, 6) AS population, ours, ground_truth, matched_ground_truth,
          matched_ours, gt_minus_ours FROM cmp""",
    "agreement": f"""WITH RECURSIVE {CUSTOMER_XY}, {matching(100.0, 0.5)}, {COMPARE}, t AS (SELECT sum(ours)::BIGINT AS ours, sum(ground_truth)::BIGINT AS ground_truth,
          sum(matched_ours)::BIGINT AS matched_ours, sum(matched_ground_truth)::BIGINT AS matched_ground_truth FROM cmp)
        SELECT *, round(matched_ground_truth / ground_truth, 6) AS recall, round(matched_ours / ours, 6) AS precision FROM t""",
    "dedupe_pois": f"""WITH RECURSIVE {TWO}, r AS (SELECT b.*, c.dup_group_id, first_value(source) OVER (PARTITION BY c.dup_group_id
          ORDER BY coalesce(confidence, -1) DESC, source = 'fsq', source_id) AS best FROM both1 b JOIN comp c USING (node))
        SELECT source, source_id, name, dup_group_id FROM r WHERE source = best""",
    "quality_report": f"""WITH {ELEMENT_CTES}, {RASTER}, {POINT_GRID}, {features('point_grid')},
        f AS (SELECT count(*)::DOUBLE AS rows, count(DISTINCT h3)::DOUBLE AS distinct_cells, sum(population)::DOUBLE AS population, sum(n_poi)::DOUBLE AS n_poi,
          sum(data_gap::INT)::DOUBLE AS gaps FROM feats),
        g AS (SELECT count(*)::DOUBLE AS cells, count(*) * {n(1.5 * math.sqrt(3) * 575 * 575 / 1e6)} AS km2 FROM point_grid),
        p AS (SELECT count(*)::DOUBLE AS cells, sum((population > 0)::INT)::DOUBLE AS populated, sum(population)::DOUBLE AS total, max(population)::DOUBLE AS mx FROM pop)
        SELECT "check", round(value, 5) AS value FROM (
          SELECT unnest(['features.rows', 'features.distinct_cells', 'features.population', 'features.n_poi', 'features.data_gaps']) AS "check",
            unnest([rows, distinct_cells, population, n_poi, gaps]) AS value FROM f
          UNION ALL SELECT unnest(['grid.cells', 'grid.distinct_cells', 'grid.wrong_res', 'grid.cell_km2']), unnest([cells, cells, 0, km2]) FROM g
          UNION ALL SELECT unnest(['population.cells', 'population.populated', 'population.total', 'population.max_population']),
            unnest([cells, populated, total, mx]) FROM p)""",
    "poi_check": f"""WITH {ELEMENT_CTES}, {POINT_GRID}, s AS (SELECT * FROM {add_cell('staged', 8)})
        SELECT count(*) AS pois, count(DISTINCT source_id) AS distinct_ids, count(*) FILTER (WHERE h3 NOT IN (SELECT h3 FROM point_grid)) AS outside FROM s""",
    "stage_rows": f"""WITH {ELEMENT_CTES}, {places()}, {EDGES}, {RASTER} SELECT 'elements' AS stage,
          (SELECT count(*) FROM orders) + (SELECT count(*) FROM w0) + (SELECT count(*) FROM part) AS n_rows
        UNION ALL SELECT 'poi_osm', count(*) FROM staged UNION ALL SELECT 'places', count(*) FROM place_poi
        UNION ALL SELECT 'pixels', count(*) FROM pixels UNION ALL SELECT 'parts', count(*) FROM boxes""",
    "layer_extent": f"""WITH {NODES} SELECT round(min(lng), 6) AS xmin, round(max(lng), 6) AS xmax, round(min(lat), 6) AS ymin,
        round(max(lat), 6) AS ymax FROM nodes""",
    "point_layer": f"""WITH {ELEMENT_CTES} SELECT source_id, 'POINT(' || round(lng, 6)::VARCHAR || ' ' || round(lat, 6)::VARCHAR || ')' AS geometry FROM staged""",
    "app_pois": f"""WITH {ELEMENT_CTES} SELECT round(lat, 6) AS lat, round(lng, 6) AS lng, coalesce(name, name_en, '') AS name, category,
        {group_case()} AS grp, source_id AS id, source FROM staged""",
    "app_population": f"{QPOP} SELECT lower(hex(h3)) AS h3_str, round(population)::INT AS population FROM pop WHERE population >= 1",
    "geojson_sample": f"""WITH {ELEMENT_CTES}, q AS (SELECT *, CASE WHEN name IS NULL THEN 'null' ELSE '"' || name || '"' END AS nm,
          CASE WHEN name_en IS NULL THEN 'null' ELSE '"' || name_en || '"' END AS ne FROM staged
          WHERE lng BETWEEN {BOX['xmin']} AND {BOX['xmax']} AND lat BETWEEN {BOX['ymin']} AND {BOX['ymax']})
        SELECT '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || round(lng, 7)::VARCHAR || ',' || round(lat, 7)::VARCHAR ||
          ']}},"properties":{{"source_id":"' || source_id || '","name":' || nm || ',"name_en":' || ne || ',"category":"' || category || '","confidence":null}}}}' AS feature FROM q""",
    "population_layer": f"{QPOP} SELECT lower(hex(h3)) AS h3_str, round(population, 6) AS population, {wkt_ring(RES)} AS geometry FROM pop WHERE population > 0",
    "app_meta": f"""WITH {NODES}, {POINT_GRID} SELECT {RES} AS res, '{d.REFERENCE}' AS reference_date, 'osm' AS sources, '{','.join(NAMES)}' AS groups,
        {2 + 1 + len(NAMES) + 2 + 1 + 2 * (2 + len(NAMES))} AS n_fields, count(*) AS cells FROM point_grid""",
    "checksums": " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", count(*) AS rows, coalesce(sum(('0x' || substr(sha256({c}), 1, 8))::BIGINT), 0)::BIGINT AS checksum FROM {t}"""
        for t, columns in d.TEXT_COLUMNS.items()
        for c in columns
    ),
    "biggest_differences": f"""WITH RECURSIVE {CUSTOMER_XY}, {matching(100.0, 0.5)}, {COMPARE}
        SELECT h3, ours, ground_truth, gt_minus_ours FROM cmp ORDER BY abs(gt_minus_ours) DESC, h3 LIMIT 20""",
    "match_inspection": f"""WITH RECURSIVE {CUSTOMER_XY}, {matching(100.0, 0.5)}, ao AS (SELECT * FROM {add_cell('ours', RES)}), bo AS (SELECT * FROM {add_cell('truth', RES)})
        SELECT h3, CASE WHEN m.b IS NULL THEN 'only_ours' ELSE 'matched' END AS kind, id AS ours_id, m.b AS truth_id, round(m.d, 4) AS distance_m,
          round(m.s, 6) AS similarity FROM ao LEFT JOIN matched m ON m.a = ao.id
        UNION ALL SELECT h3, 'only_truth', NULL, id, NULL, NULL FROM bo WHERE id NOT IN (SELECT b FROM matched)""",
    "match_far_north": f"""WITH RECURSIVE {CUSTOMER_XY.replace('ours AS (', 'ours_0 AS (').replace('truth AS (', 'truth_0 AS (')},
        ours AS (SELECT id, lat + 62e0 AS lat, lng, name FROM ours_0), truth AS (SELECT id, lat + 62e0 AS lat, lng, name FROM truth_0),
        {matching(100.0, None, 4.0)} SELECT a AS ours_id, b AS truth_id, round(d, 4) AS distance_m FROM matched""",
    "source_catalogue": f"""WITH l AS (SELECT o_orderpriority || '/' || ['release','extract','draft'][o_orderkey % 3 + 1] AS source, o_orderkey % 3 AS kind,
          o_orderkey % 12 AS patch, o_orderdate::DATE AS dt FROM orders),
        p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY dt DESC, CASE WHEN kind = 0 THEN patch ELSE 0 END DESC) AS rn FROM l
          WHERE kind < 2 AND dt <= DATE '{d.REFERENCE}'),
        s AS (SELECT source AS name, kind = 2 AS yearly, p.dt, CASE WHEN kind = 2 THEN '{d.REFERENCE[:4]}' WHEN kind = 0 THEN strftime(p.dt, '%Y-%m-%d') || '.' || p.patch
            ELSE 'country-' || strftime(p.dt, '%y%m%d') || '.osm.pbf' END AS snapshot
          FROM (SELECT DISTINCT source, kind FROM l) n LEFT JOIN (SELECT source, dt, patch FROM p WHERE rn = 1) p USING (source)),
        t AS (SELECT *, CASE WHEN yearly THEN DATE '{d.REFERENCE[:4]}-07-01' ELSE dt END AS day FROM s)
        SELECT name, 'points' AS provides, snapshot, strftime(day, '%Y-%m-%d') AS snapshot_date, date_diff('day', day, DATE '{d.REFERENCE}')::INT AS lag_days,
          'https://h/' || snapshot || '?y={d.REFERENCE[:4]}' AS url, 'CC0' AS license,
          CASE WHEN yearly THEN NULL WHEN snapshot IS NULL THEN 'no snapshot' WHEN abs(date_diff('day', day, DATE '{d.REFERENCE}')) > 45 THEN 'stale snapshot' END AS warning
        FROM t""",
    "truth_round_trip": f"WITH {CUSTOMER_XY} SELECT name, 'customer' AS category, round(lat, 6) AS lat, round(lng, 6) AS lng FROM truth",
    "wkt_round_trip": f"WITH {EDGES}, {DEG2} SELECT part_id, round(deg2, 6) AS deg2 FROM deg",
    "grid_coverage": f"""WITH {BASE_CTES}, {utm()}, g AS (SELECT count(DISTINCT h3) AS cells, count(DISTINCT h3) * {n(1.5 * math.sqrt(3) * 575 * 575 / 1e6)} AS km2 FROM center)
        SELECT cells, 0::BIGINT AS repeated, round(km2, 4) AS cell_km2, round(km2 / (SELECT sum(area_km2) FROM ukm), 6) AS coverage FROM g""",
    "population_difference": f"""{QPOP}, t AS (SELECT sum(pop) AS src FROM pixels)
        SELECT count(*) AS cells, round(sum(population), 3) AS total, round((sum(population) - any_value(src)) / any_value(src), 6) AS difference FROM pop, t""",
}

ORACLES["ledger_rows"] = f"SELECT stage, 'v1' AS inputs, n_rows::BIGINT AS n_rows FROM ({ORACLES['stage_rows']})"
ORACLES["parts_without_cell"] = f"""WITH sp AS ({ORACLES['surface_points']}), filled AS ({ORACLES['polyfill_center']})
  SELECT part_id FROM {add_cell('sp', RES)} WHERE h3 NOT IN (SELECT h3 FROM filled)"""
