"""Tag rules as Column expressions over a ``map<string,string>``.

Every function takes the tag map column (default ``tags``) and returns a Column, so the rules stay inside
whole-stage code generation and Catalyst can push the filters built from them below joins.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from urbanweave.functions import constants as K


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(table: dict, key: Column, default=None) -> Column:
    """Value of a small fixed table, as a literal map."""
    literal = F.create_map(*[F.lit(v) for pair in table.items() for v in pair])
    found = literal[key]
    return found if default is None else F.coalesce(found, F.lit(default))


def tag(key: str, tags: Column | str = "tags") -> Column:
    return col(tags)[key]


def has_tag(key: str, tags: Column | str = "tags") -> Column:
    return F.coalesce(F.map_contains_key(col(tags), key), F.lit(False))


def word(key: str, tags: Column | str = "tags") -> Column:
    """Tag value trimmed and in lower case, '' when missing."""
    return F.lower(F.trim(F.coalesce(tag(key, tags), F.lit(""))))


def one_of(value: Column, words) -> Column:
    """False, not null, when the value is missing."""
    return F.coalesce(value.isin(*words), F.lit(False))


def parse_double(value: Column) -> Column:
    """Number in the text, null when it is none."""
    return F.when(~value.rlike(r"[dDfF]\s*$"), value.try_cast("double"))


def parse_metres(value: Column) -> Column:
    """Number of a length tag with optional metre unit, null when it is none."""
    return F.regexp_extract(value, K.METRES_PATTERN, 1).try_cast("double")


def at_least_one(value: Column) -> Column:
    """Whole number not below one; null stays null."""
    return F.when(value.isNotNull(), F.greatest(F.lit(1), value.cast("int")))


# ---- roads


def highway(tags: Column | str = "tags") -> Column:
    return F.coalesce(tag("highway", tags), F.lit(""))


def road_width(tags: Column | str = "tags", scale: float = 1.0) -> Column:
    """Carriageway width: ``width`` tag, else lanes, else the class width; times the width scale."""
    return F.coalesce(
        parse_metres(tag("width", tags)),
        parse_double(tag("lanes", tags)) * K.LANE_WIDTH_M,
        lookup(K.ROAD_WIDTH_M, highway(tags)),
        F.lit(K.ROAD_WIDTH_DEFAULT_M),
    ) * F.lit(max(0.01, float(scale)))


def lane_count(tags: Column | str = "tags", width: Column | None = None) -> Column:
    """Lanes from the tag's first part, else from the width; two-way roads prefer the better even number."""
    width = road_width(tags) if width is None else width
    first = F.split(F.split(tag("lanes", tags), ";")[0], r"\|")[0]
    tagged = at_least_one(F.bround(parse_double(first)))
    near = F.greatest(F.lit(2), F.bround(width / K.LANE_WIDTH_M).cast("int"))
    low = F.greatest(F.lit(2), near - 1)
    high = near + 1
    better = F.when(F.abs(width / low - K.LANE_WIDTH_M) <= F.abs(width / high - K.LANE_WIDTH_M), low).otherwise(high)
    oneway = one_of(word("oneway", tags), K.TRUE_WORDS)
    return F.coalesce(tagged, F.when(oneway | (F.pmod(near, F.lit(2)) == 0), near).otherwise(better))


def is_motor(tags: Column | str = "tags") -> Column:
    return (highway(tags) != "") & ~one_of(highway(tags), K.NON_MOTOR_HIGHWAYS)


def is_major(tags: Column | str = "tags") -> Column:
    return one_of(tag("highway", tags), K.MAJOR_HIGHWAYS)


def is_primary_junction(tags: Column | str = "tags") -> Column:
    return one_of(tag("highway", tags), K.PRIMARY_JUNCTION_HIGHWAYS)


def is_roundabout(tags: Column | str = "tags") -> Column:
    return one_of(word("junction", tags), K.ROUNDABOUT_WORDS) | (word("highway", tags) == "mini_roundabout")


def is_bufferable(tags: Column | str = "tags", coords: Column | str = "coords", scale: float = 1.0) -> Column:
    """Ways that become pavement: no junction or service areas, no plain areas, at least two vertices."""
    skipped = one_of(F.trim(highway(tags)), K.UNBUFFERED_HIGHWAYS)
    area = one_of(word("area", tags), K.TRUE_WORDS) & (F.coalesce(tag("junction", tags), F.lit("")) != "roundabout")
    return ~skipped & ~area & (F.size(col(coords)) >= 2) & (road_width(tags, scale) > 0)


def road_rank(tags: Column | str = "tags") -> Column:
    return lookup({name: i for i, name in enumerate(K.ROAD_RANK)}, highway(tags), len(K.ROAD_RANK))


def grade_key(tags: Column | str = "tags") -> Column:
    """All carriageways share the ground, whatever the tags say."""
    return F.lit("ground:0")


def road_elevation(tags: Column | str = "tags") -> Column:
    return F.lit(0.0)


def same_named_road(a: Column | str, b: Column | str) -> Column:
    """Any of the naming keys carries the same non-empty text on both ways."""
    tests = []
    for key in K.SAME_ROAD_KEYS:
        left = F.trim(F.coalesce(tag(key, a), F.lit("")))
        right = F.trim(F.coalesce(tag(key, b), F.lit("")))
        tests.append((left != "") & (left == right))
    return reduce(lambda p, q: p | q, tests)


def same_chain_class(a: Column | str, b: Column | str) -> Column:
    ring_a = F.trim(F.coalesce(tag("junction", a), F.lit(""))) == "roundabout"
    ring_b = F.trim(F.coalesce(tag("junction", b), F.lit(""))) == "roundabout"
    return ~ring_a & ~ring_b & (is_motor(a) == is_motor(b))


def marking_kind(tags: Column | str = "tags", width: Column | None = None) -> Column:
    """Painted lines of a road: struct of the centre, lane and edge style ('none' when unpainted)."""
    width = road_width(tags) if width is None else width
    hwy = highway(tags)
    trunk = hwy.isin("motorway", "trunk", "primary")
    center = (
        F.when(trunk, "double_yellow_solid")
        .when(hwy == "secondary", F.when(width >= 9, "double_yellow_solid").otherwise("single_yellow_solid"))
        .when(hwy == "tertiary", "single_yellow_dash")
        .when((hwy == "residential") & (width >= 6), "single_white_dash")
        .otherwise("none")
    )
    lane = F.when(trunk | (hwy == "secondary") | ((hwy == "tertiary") & (width >= 8)), "white_dash").otherwise("none")
    edge = F.when(trunk | (hwy == "secondary"), "white_solid").otherwise("none")
    return F.struct(center.alias("center"), lane.alias("lane"), edge.alias("edge"))


def inbound_offset(tags: Column | str = "tags", width: Column | None = None) -> Column:
    """Distance of the first inbound lane's middle from the centre line."""
    width = road_width(tags) if width is None else width
    return F.when(marking_kind(tags, width)["lane"] == "white_dash", width * 0.125).otherwise(width * 0.25)


def road_surface(tags: Column | str = "tags") -> Column:
    return lookup(K.ROAD_SURFACE, word("highway", tags), K.ROAD_SURFACE_DEFAULT)


def rgb(table: dict, key: Column, default: str) -> Column:
    """Display colour struct of a table key."""
    def channel(i: int) -> Column:
        return lookup({k: v[i] for k, v in table.items()}, key, table[default][i])

    return F.struct(channel(0).alias("r"), channel(1).alias("g"), channel(2).alias("b"))


def road_rgb(surface: Column) -> Column:
    return rgb(K.ROAD_RGB, surface, "asphalt")


def facade_rgb(band: Column) -> Column:
    return rgb(K.FACADE_RGB, band, "mid")


# ---- names


@lru_cache(maxsize=1)
def simplified_table() -> tuple[str, str]:
    """Traditional characters and their simplified forms, from the Unicode transliteration rules Spark ships.

    The rules are applied once per session to the CJK block on the driver; the pair of strings is a constant
    of about three thousand characters, used by ``translate`` on the executors.
    """
    jvm = SparkSession.getActiveSession()._jvm
    rules = jvm.com.ibm.icu.text.Transliterator.getInstance("Traditional-Simplified")
    block = [chr(code) for code in range(0x4E00, 0xA000)]
    mapped = rules.transliterate("|".join(block)).split("|")
    changed = [(a, b) for a, b in zip(block, mapped) if a != b and len(b) == 1]
    return "".join(a for a, _ in changed), "".join(b for _, b in changed)


def to_simplified(text: Column, table: tuple[str, str] | None = None) -> Column:
    """Traditional to simplified characters; ``table`` replaces the built-in pair of equally long strings."""
    source, target = table or simplified_table()
    return F.translate(F.coalesce(text, F.lit("")), source, target)


def display_name(tags: Column | str = "tags", table: tuple[str, str] | None = None) -> Column:
    """First non-empty naming tag, simplified; '' when there is none."""
    named = [F.nullif(F.trim(tag(key, tags)), F.lit("")) for key in K.NAME_KEYS]
    return to_simplified(F.coalesce(*named), table)


def sign_label(name: Column, table: tuple[str, str] | None = None) -> Column:
    return F.substring(to_simplified(F.trim(F.coalesce(name, F.lit(""))), table), 1, K.SIGN_LABEL_CHARS)


# ---- buildings and facades


def building_floors(tags: Column | str = "tags") -> Column:
    levels = parse_double(F.nullif(tag("building:levels", tags), F.lit("")))
    height = parse_metres(F.nullif(tag("height", tags), F.lit("")))
    floors = F.coalesce(F.bround(levels), F.bround(height / K.FLOOR_HEIGHT_M))
    return F.coalesce(at_least_one(floors), F.lit(K.DEFAULT_FLOORS))


def building_height(tags: Column | str = "tags") -> Column:
    return building_floors(tags) * K.FLOOR_HEIGHT_M


def facade_band(height: Column) -> Column:
    floors = F.greatest(F.lit(1), F.bround(height / K.FLOOR_HEIGHT_M).cast("int"))
    band = None
    for name, top in K.BAND_TOP_FLOOR:
        band = F.when(floors <= top, name) if band is None else band.when(floors <= top, name)
    return band.otherwise(K.TOP_BAND)


def tile_floors(band: Column) -> Column:
    return lookup(K.FACADE_TILE_FLOORS, band, K.FACADE_TILE_FLOORS_DEFAULT)


def sheet_width(band: Column) -> Column:
    return lookup(K.FACADE_SHEET_WIDTH_M, band, K.FACADE_SHEET_WIDTH_DEFAULT_M)


def variant_count(band: Column) -> Column:
    return lookup(K.FACADE_VARIANTS, band, K.FACADE_VARIANTS_DEFAULT)


def is_shop(tags: Column | str = "tags") -> Column:
    shop_tag = F.coalesce(tag("shop", tags), F.lit("")) != ""
    return one_of(word("building", tags), K.SHOP_BUILDINGS) | shop_tag | one_of(word("amenity", tags), K.SHOP_AMENITIES)


def facade_variant(osm_id: Column, band: Column, tags: Column | str = "tags") -> Column:
    """Low buildings use the first half for shops and the second for homes, others the whole range, by id."""
    key = F.abs(osm_id)
    homes = K.FACADE_VARIANTS["low"] - K.LOW_SHOP_VARIANTS
    low = F.when(is_shop(tags), F.pmod(key, F.lit(K.LOW_SHOP_VARIANTS))).otherwise(
        F.pmod(key, F.lit(homes)) + K.LOW_SHOP_VARIANTS
    )
    return F.when(band == "low", low).otherwise(F.pmod(key, variant_count(band))).cast("int")


def roof_variant(osm_id: Column) -> Column:
    return F.pmod(F.abs(F.floor(osm_id / F.lit(7))), F.lit(K.ROOF_VARIANTS)).cast("int")


def facade_key(band: Column, osm_id: Column, tags: Column | str = "tags") -> Column:
    return F.format_string("Facade_%s_%d", band, facade_variant(osm_id, band, tags))


def roof_key(osm_id: Column) -> Column:
    return F.format_string("Roof_%d", roof_variant(osm_id))


# ---- water, vegetation, catalogue


def is_water_area(tags: Column | str = "tags") -> Column:
    return (
        one_of(tag("natural", tags), ["water"]) | has_tag("water", tags) | one_of(tag("landuse", tags), ["reservoir"])
    )


def is_waterway(tags: Column | str = "tags") -> Column:
    return one_of(tag("waterway", tags), K.WATERWAY_KINDS)


def waterway_width(tags: Column | str = "tags") -> Column:
    return F.coalesce(lookup(K.WATERWAY_WIDTH_M, tag("waterway", tags)), F.lit(K.WATERWAY_WIDTH_DEFAULT_M))


def is_vegetation(tags: Column | str = "tags") -> Column:
    return (
        one_of(tag("landuse", tags), K.VEGETATION_LANDUSE)
        | one_of(tag("leisure", tags), ["park"])
        | one_of(tag("natural", tags), ["wood"])
    )


def category(tags: Column | str = "tags") -> Column:
    """Catalogue class of a feature; the first rule that holds wins."""
    natural, landuse = tag("natural", tags), tag("landuse", tags)
    return (
        F.when(has_tag("building", tags), "building")
        .when(has_tag("highway", tags), "road")
        .when((natural == "water") | has_tag("waterway", tags) | (landuse == "reservoir"), "water")
        .when(natural == "tree", "tree")
        .when((natural == "wood") | landuse.isin(*K.VEGETATION_LANDUSE), "vegetation")
        .when(tag("leisure", tags) == "park", "vegetation")
        .otherwise("other")
    )


# ---- grid keys


def cell(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(float(size)))


def shard_id(x: Column, y: Column, west: Column, north: Column, size: float = K.SHARD_CELL_M) -> Column:
    """Catalogue shard; columns grow east from the extent's west side, rows grow south from its north side."""
    if size <= 0:
        raise ValueError("the shard size must be positive")
    return F.format_string("lod0_%+05d_%+05d", cell(x - west, size), cell(north - y, size))


def cell_token(ix: Column, iy: Column) -> Column:
    def token(v: Column) -> Column:
        return F.concat(F.when(v < 0, "n").otherwise(""), F.abs(v).cast("string"))

    return F.concat(F.lit("c"), token(ix), F.lit("_"), token(iy))


def node_mm(value: Column) -> Column:
    """Coordinate rounded to the millimetre, as an integer join key."""
    return F.bround(value * 1000).cast("long")


def cull_distances(kind: Column) -> Column:
    """Fade start and end of a layer's instances in metres and centimetres; the end never precedes the start."""
    start = lookup({k: v[0] for k, v in K.CULL_M.items()}, kind)
    end = F.greatest(start, lookup({k: v[1] for k, v in K.CULL_M.items()}, kind))
    return F.struct(
        start.alias("start_m"), end.alias("end_m"), (start * 100).alias("start_cm"), (end * 100).alias("end_cm")
    )
