"""Geographic views of the driver's business tables.

The tables have no coordinates, so every view derives them with integer arithmetic on the keys,
which any engine repeats exactly. Expressions are kept as SQL text (``//`` is integer division) so
that the checks can state the same inputs; nothing else is shared with them.

Every 5,000 orders, 33 suppliers or 500 customers fill one tile of 0.31 degrees, so the area
covered grows with the tables while the density stays the same. A fifth of the nodes of a tile
sits on one market place of about 330 m, which makes a hot cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexmosaic.functions.geo import MULTIPOLYGON
from hexmosaic.operators.polygons import dump_parts
from hexmosaic.operators.population import Affine
from hexmosaic.session import bind, dealt
from hexmosaic.sources.readers import ELEMENTS

# Tags of nodes and ways, by index: places of every group, excluded ones and one non-place.
TAGS = [
    "amenity=pharmacy",
    "amenity=school",
    "amenity=bank",
    "amenity=place_of_worship",
    "office=government",
    "amenity=fuel",
    "amenity=restaurant",
    "tourism=hotel",
    "shop=convenience",
    "leisure=park",
    "amenity=bench",
    "shop=vacant",
    "healthcare=yes",
    "amenity=marketplace",
    "railway=station",
    "craft=tailor",
    "emergency=yes",
    "office=insurance",
    "historic=wayside_shrine",
    "amenity=cafe",
    "shop=pawnbroker",
    "amenity=clinic",
    "aeroway=helipad",
    "building=yes",
]
#: Order lines that a task groups to ways, about.
LINES_AT_ONCE = 1_000_000
TAXONOMY = ["hospital", "school", "bank", "hotel", "restaurant", "temple", "shop", "park"]
DIRECTIONS = [(10, 0), (7, 7), (0, 10), (-7, 7), (-10, 0), (-7, -7), (0, -10), (7, -7)]

# Text columns of the given tables; embeddings and labels have none.
TEXT_COLUMNS = {
    "region": ["r_name"],
    "nation": ["n_name"],
    "customer": ["c_name", "c_mktsegment"],
    "supplier": ["s_name"],
    "part": ["p_name", "p_brand", "p_type"],
    "orders": ["o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus"],
    "events": ["event_type", "props"],
    "documents": ["text", "lang", "source"],
    "pages": ["url", "html"],
    "benchmark": ["text"],
    "conversations": ["role", "text"],
}

NODATA = -99999.0
AFFINE = Affine(a=1e-4, b=0.0, c=102.4, d=0.0, e=-1e-4, f=14.65)
RASTER_ROWS, RASTER_COLS = 15 * 3100, 16 * 3100
REFERENCE = "2000-06-15"


def tile(k: str, per: int) -> tuple[str, str]:
    """Origin (lat, lng) of a key's tile in 1e-5 degrees."""
    t = f"({k} // {per})"
    return f"(1000000 + (({t} // 16) % 15) * 31000)", f"(10240000 + ({t} % 16) * 31000)"


def degrees(units: str) -> str:
    return f"CAST({units} AS DOUBLE) / 1e5"


def _node_xy() -> tuple[str, str]:
    lat0, lng0 = tile("o_orderkey", 5000)
    u, v = "((o_orderkey * 7919) % 30011)", "((o_orderkey * 104729) % 29989)"
    hot = "o_orderpriority = '1-URGENT'"
    lat = f"{lat0} + CASE WHEN {hot} THEN 6000 + {u} % 300 ELSE {u} * {u} // 30011 END"
    lng = f"{lng0} + CASE WHEN {hot} THEN 9000 + {v} % 300 ELSE {v} END"
    return degrees(lat), degrees(lng)


NODE_LAT, NODE_LNG = _node_xy()
NODE_TAG = f"(o_orderkey * 31 + CAST(substr(o_orderpriority, 1, 1) AS INT) * 5) % {len(TAGS)}"
WAY_ID = "l_orderkey * 10 + l_linenumber"
WAY_TAG = f"(p * 13 + l_linenumber * 5) % {len(TAGS)}"

_plat0, _plng0 = tile("c_custkey", 500)
PLACE_LAT = degrees(f"{_plat0} + (c_custkey * 6151) % 30011")
PLACE_LNG = degrees(f"{_plng0} + (c_custkey * 99991) % 29989")
CONFIDENCE = "CASE WHEN c_nationkey = 7 THEN NULL ELSE CAST(c_custkey % 101 AS DOUBLE) / 1e2 END"
STATUS = "CASE c_mktsegment WHEN 'MACHINERY' THEN 'closed' WHEN 'BUILDING' THEN NULL ELSE 'open' END"

AREAS_PER_TILE = 33
_slat0, _slng0 = tile("s_suppkey", AREAS_PER_TILE)
AREA_CY = f"({_slat0} + (s_suppkey * 7919) % 30011)"
AREA_CX = f"({_slng0} + (s_suppkey * 104729) % 29989)"
OUTER_R = "(150 + (s_suppkey * 37 + {j} * 53) % 150)"
HOLE_R = "(30 + (s_suppkey * 11 + {j} * 29) % 40)"
HAS_HOLE = "s_nationkey < 12"

_rt = "(l_orderkey // 5000)"
BLOCK_ROW = f"(14 - ({_rt} // 16) % 15) * 3100 + ((l_orderkey * 7919 + l_linenumber * 131) % 1549) * 2"
BLOCK_COL = f"({_rt} % 16) * 3100 + ((l_orderkey * 104729 + l_linenumber * 17) % 1031) * 3"

# Truth points lie up to 110 m from the place they describe; some names are edited.
TRUTH_DLAT = "((c_custkey * 37) % 201 - 100)"
TRUTH_DLNG = "((c_custkey * 53) % 201 - 100)"
TRUTH_NAME = (
    "CASE c_mktsegment WHEN 'BUILDING' THEN concat('Unrelated ', CAST(c_custkey * 7 AS VARCHAR(20))) "
    "WHEN 'FURNITURE' THEN concat('customer no ', CAST(c_custkey AS VARCHAR(20))) "
    "ELSE concat('Customer ', CAST(c_custkey AS VARCHAR(20))) END"
)


def spark_expr(text: str) -> Column:
    """Column of a shared expression."""
    return F.expr(text.replace("//", " div "))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tag_map(ix: Column, extra: list[tuple[Column, Column]]) -> Column:
    pick = F.element_at(F.array(*[F.lit(t) for t in TAGS]), (ix + 1).cast("int"))
    first = F.struct(F.split_part(pick, F.lit("="), F.lit(1)).alias("k"), F.split_part(pick, F.lit("="), F.lit(2)).alias("v"))
    entries = F.array(first, *[F.struct(k.alias("k"), v.alias("v")) for k, v in extra])
    return F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull()))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as map nodes; pending orders are bare nodes without tags."""
    o = table(spark, sf_dir, "orders")
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    ix = spark_expr(NODE_TAG)
    pick_key = F.split_part(F.element_at(F.array(*[F.lit(t) for t in TAGS]), (ix + 1).cast("int")), F.lit("="), F.lit(1))
    craft = F.when((status == "F") & (k % 3 == 0) & (pick_key != "craft"), "yes")
    name = F.concat(F.lit("Place "), k.cast("string"))
    en = F.when(status == "O", F.concat(F.lit("EN "), k.cast("string")))
    tags = F.when(
        status != "P", _tag_map(ix, [(F.lit("craft"), craft), (F.lit("name"), name), (F.lit("name:en"), en)])
    ).when(k % 2 == 0, F.create_map().cast("map<string,string>"))
    o = bind(o, ["o_orderkey"], tags=tags, lat=spark_expr(NODE_LAT), lon=spark_expr(NODE_LNG))
    return o.select(
        F.lit("node").alias("kind"),
        k.alias("id"),
        "tags",
        F.lit(None).cast("array<bigint>").alias("refs"),
        "lat",
        "lon",
    )


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes without their tags, which are most of the work of a node: (id, lat, lon)."""
    k, lat, lon = F.col("o_orderkey").alias("id"), spark_expr(NODE_LAT), spark_expr(NODE_LNG)
    return table(spark, sf_dir, "orders").select(k, lat.alias("lat"), lon.alias("lon"))


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as closed ways over the nodes of three orders, some of them missing."""
    li = table(spark, sf_dir, "lineitem")
    # nearly all keys differ, so tasks that combine before the shuffle would keep whole splits of a file
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus"]
    (li,) = dealt(columns[:2], li, LINES_AT_ONCE, li.select(*columns))
    w = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_partkey").alias("p"),
        F.chr(F.min(F.ascii("l_returnflag"))).alias("rf"),  # numbers keep the aggregate hashed
        F.chr(F.min(F.ascii("l_linestatus"))).alias("ls"),
    )
    k = F.col("l_orderkey")
    gone = F.array(-k - 1, -k - 2)
    side = F.when(F.col("rf") == "R", -k - 1).otherwise(k + 1)
    ring = F.array(k, side, k + 2, side, k)
    wid = spark_expr(WAY_ID).cast("bigint")
    name = F.when(F.col("ls") == "O", F.concat(F.lit("Way "), wid.cast("string")))
    w = bind(w, w.columns, tags=_tag_map(spark_expr(WAY_TAG), [(F.lit("name"), name)]))
    return w.select(
        F.lit("way").alias("kind"),
        wid.alias("id"),
        "tags",
        F.when(F.col("l_linenumber") == 7, gone).otherwise(ring).alias("refs"),
        F.lit(None).cast("double").alias("lat"),
        F.lit(None).cast("double").alias("lon"),
    )


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as relations, which staging ignores."""
    return table(spark, sf_dir, "part").select(
        F.lit("relation").alias("kind"),
        F.col("p_partkey").alias("id"),
        F.create_map(F.lit("amenity"), F.lit("school")).alias("tags"),
        F.array("p_partkey").alias("refs"),
        F.lit(None).cast("double").alias("lat"),
        F.lit(None).cast("double").alias("lon"),
    )


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map elements (kind, id, tags, refs, lat, lon)."""
    out = nodes(spark, sf_dir).unionByName(ways(spark, sf_dir)).unionByName(relations(spark, sf_dir))
    return out.select([f.split()[0] for f in ELEMENTS.split(", ")])


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as place records."""
    c = table(spark, sf_dir, "customer")
    lat, lng = spark_expr(PLACE_LAT), spark_expr(PLACE_LNG)
    key = F.col("c_custkey").cast("string")
    primary = F.when(
        F.col("c_nationkey") != 3,
        F.element_at(F.array(*[F.lit(t) for t in TAXONOMY]), (F.col("c_custkey") % 8 + 1).cast("int")),
    )
    english = F.when(F.col("c_nationkey") % 2 == 0, F.create_map(F.lit("en"), F.concat(F.lit("English "), key)))
    second = F.when(F.col("c_nationkey") < 5, F.lit("msft"))
    return c.select(
        F.concat(F.lit("p"), key).alias("id"),
        F.struct(F.concat(F.lit("Customer "), key).alias("primary"), english.alias("common")).alias("names"),
        spark_expr(CONFIDENCE).alias("confidence"),
        spark_expr(STATUS).alias("operating_status"),
        F.lower("c_mktsegment").alias("basic_category"),
        F.struct(primary.alias("primary"), F.array(F.lit("place"), primary).alias("hierarchy")).alias("taxonomy"),
        F.struct(
            F.struct(
                F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("Brand "), F.col("c_nationkey").cast("string"))).alias("primary")
            ).alias("names")
        ).alias("brand"),
        F.lit(None).cast("array<struct<freeform:string>>").alias("addresses"),
        F.array(
            F.struct(F.lit("meta").alias("dataset")),
            F.struct(second.alias("dataset")),
            F.struct(F.lit("meta").alias("dataset")),
        ).alias("sources"),
        lat.alias("lat"),
        lng.alias("lng"),
        F.struct(lng.alias("xmin"), lng.alias("xmax"), lat.alias("ymin"), lat.alias("ymax")).alias("bbox"),
    )


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers again as ground truth (id, lat, lng, name), displaced and renamed."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        spark_expr(degrees(f"{_plat0} + (c_custkey * 6151) % 30011 + {TRUTH_DLAT}")).alias("lat"),
        spark_expr(degrees(f"{_plng0} + (c_custkey * 99991) % 29989 + {TRUTH_DLNG}")).alias("lng"),
        spark_expr(TRUTH_NAME).alias("name"),
    )


def ours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as points of our own (id, lat, lng, name)."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        spark_expr(PLACE_LAT).alias("lat"),
        spark_expr(PLACE_LNG).alias("lng"),
        F.concat(F.lit("Customer "), F.col("c_custkey").cast("string")).alias("name"),
    )


def _ring(offsets: list[tuple[int, int]], radius: str | None) -> Column:
    """Closed ring around (cx, cy): literal offsets, scaled by a radius expression of ``j``."""
    closed = [*enumerate(offsets), (0, offsets[0])]
    table = ", ".join(f"named_struct('j', {j}, 'dx', {dx}, 'dy', {dy})" for j, (dx, dy) in closed)
    scale = "1" if radius is None else radius.format(j="o.j")
    at = f"named_struct('x', {degrees(f'(cx + o.dx * {scale})')}, 'y', {degrees(f'(cy + o.dy * {scale})')})"
    return spark_expr(f"transform(array({table}), o -> {at})")


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as land areas: a concave star, for some with a hole, and a tiny islet."""
    s = table(spark, sf_dir, "supplier")
    s = bind(s, ["s_suppkey", "s_name", "s_nationkey"], cx=spark_expr(AREA_CX), cy=spark_expr(AREA_CY))
    outer, hole = _ring(DIRECTIONS, OUTER_R), _ring(DIRECTIONS, HOLE_R)
    islet = _ring([(4000, 4000), (4100, 4000), (4100, 4100), (4000, 4100)], None)
    body = F.when(F.expr(HAS_HOLE), F.array(outer, hole)).otherwise(F.array(outer))
    box = {"xmin": ("cx", -3000), "xmax": ("cx", 4100), "ymin": ("cy", -3000), "ymax": ("cy", 4100)}
    return s.select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("area_name"),
        F.lit("country").alias("subtype"),
        F.lit("land").alias("class"),
        F.when(F.col("s_nationkey") == 24, "TH").otherwise("KH").alias("country"),
        F.array(body, F.array(islet)).cast(MULTIPOLYGON).alias("geometry"),
        F.struct(*[spark_expr(degrees(f"({c} + {d})")).alias(n) for n, (c, d) in box.items()]).alias("bbox"),
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons of all areas with part_id = 2 key + position."""
    p = dump_parts(areas(spark, sf_dir).select("id", "geometry"))
    return p.select((F.col("id") * 2 + F.col("part_ix")).alias("part_id"), "polygon")


def admin_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as strips, nations as rectangles, suppliers as small areas."""

    def box(x0: Column, y0: Column, w: float, h: float) -> Column:
        p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
        x1, y1 = x0 + F.lit(w), y0 + F.lit(h)
        ring = F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1), p(x0, y0))
        return F.array(F.array(ring)).cast(MULTIPOLYGON)

    r = table(spark, sf_dir, "region").select(
        F.lit("region").alias("subtype"),
        F.col("r_name").alias("area_name"),
        box(F.lit(102.4) + F.col("r_regionkey"), F.lit(10.0), 1.0, 4.65).alias("geometry"),
    )
    n = table(spark, sf_dir, "nation").select(
        F.lit("county").alias("subtype"),
        F.col("n_name").alias("area_name"),
        box(
            F.lit(102.4) + F.col("n_nationkey") % 5,
            F.lit(10.0) + F.floor(F.col("n_nationkey") / 5) * F.lit(0.93),
            1.0,
            0.93,
        ).alias("geometry"),
    )
    s = areas(spark, sf_dir).select(F.lit("locality").alias("subtype"), "area_name", "geometry")
    return r.unionByName(n).unionByName(s)


def raster_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as 2 x 3 raster blocks with people, empty, masked and no-data cells."""
    q = F.col("l_quantity").cast("float")
    none = F.lit(None).cast("float")
    line1 = F.array(q, F.col("l_linenumber").cast("float"), F.when(F.col("l_returnflag") != "R", q).otherwise(none))
    line2 = F.array(
        F.lit(0.0).cast("float"),
        F.when(F.col("l_returnflag") == "A", F.lit(NODATA).cast("float")).otherwise(q + F.lit(1).cast("float")),
        F.round(F.col("l_tax") * 100).cast("float"),
    )
    return table(spark, sf_dir, "lineitem").select(
        spark_expr(BLOCK_ROW).cast("int").alias("row0"),
        spark_expr(BLOCK_COL).cast("int").alias("col0"),
        F.array(line1, line2).alias("values"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as names of releases and dated extracts, with names that are neither."""
    o = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    kind = F.col("o_orderkey") % 3
    name = (
        F.when(kind == 0, F.concat(day.cast("string"), F.lit("."), (F.col("o_orderkey") % 12).cast("string")))
        .when(kind == 1, F.concat(F.lit("country-"), F.date_format(day, "yyMMdd"), F.lit(".osm.pbf")))
        .otherwise(F.concat(F.lit("draft-"), day.cast("string")))
    )
    source = F.concat(F.col("o_orderpriority"), F.lit("/"), F.element_at(F.array(F.lit("release"), F.lit("extract"), F.lit("draft")), (kind + 1).cast("int")))
    return o.select(source.alias("source"), name.alias("name"))
