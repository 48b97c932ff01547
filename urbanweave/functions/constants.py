"""Tables, limits and patterns that the results are defined by."""

# Carriageway width in metres by highway class.
ROAD_WIDTH_M = {
    "motorway": 22.0,
    "trunk": 16.0,
    "primary": 12.0,
    "secondary": 9.0,
    "tertiary": 7.0,
    "residential": 6.0,
    "service": 4.0,
    "footway": 2.0,
    "path": 2.0,
}
ROAD_WIDTH_DEFAULT_M = 5.0
LANE_WIDTH_M = 3.5

# Highway classes from the most to the least important; the position is the rank.
ROAD_RANK = [
    "motorway",
    "trunk",
    "primary",
    "secondary",
    "tertiary",
    "residential",
    "service",
    "footway",
    "path",
]
NON_MOTOR_HIGHWAYS = [
    "footway",
    "path",
    "steps",
    "pedestrian",
    "cycleway",
    "bridleway",
    "corridor",
    "construction",
    "proposed",
    "raceway",
    "busway",
]
MAJOR_HIGHWAYS = ["motorway", "trunk", "primary", "secondary"]
PRIMARY_JUNCTION_HIGHWAYS = ["motorway", "trunk", "primary"]
LAMP_HIGHWAYS = ["primary", "trunk", "motorway"]
UNBUFFERED_HIGHWAYS = ["junction", "rest_area", "services", "platform"]
TRUE_WORDS = ["yes", "true", "1"]
ROUNDABOUT_WORDS = ["roundabout", "circular"]

# Lengths such as "7.5", "7.5 m" or "7 meters".
METRES_PATTERN = r"(?i)^\s*([\d.]+)\s*(?:m|meters?)?\s*$"

NAME_KEYS = ["name:zh-Hans", "name:zh", "name", "name:zh-Hant", "name:zh-TW", "name:en", "ref"]
SAME_ROAD_KEYS = ["ref", "name:zh", "name", "name:en"]
SIGN_LABEL_CHARS = 14

# Roads, markings and placements, in metres and radians.
MARKING_BUFFER_M = 0.08
MARKING_Z_M = 0.09
DOUBLE_YELLOW_GAP_M = 0.18
DASH_ON_M = 4.0
DASH_GAP_M = 6.0
DASH_MIN_M = 0.4
ARROW_LENGTH_M = 5.0
ARROW_WIDTH_M = 1.15
ARROW_SETBACK_M = 8.0
JUNCTION_EXTRA_M = 1.8
JUNCTION_CLUSTER_M = 24.0
STRIPE_M = 0.40
STRIPE_GAP_M = 0.40
STRIPES_PER_ARM = 5
ARM_HEADING_TOL = 0.49
OPPOSITE_TOL = 0.52
SIGN_LATERAL_M = 0.6
SIGN_SPACING_M = 160.0
LAMP_LATERAL_M = 0.4
LAMP_SPACING_M = 40.0
MIN_OVERLAP_AREA_M2 = 1e-6

# Buildings.
FLOOR_HEIGHT_M = 3.0
DEFAULT_FLOORS = 3
FOOTPRINT_INSET_M = 0.06
MIN_FOOTPRINT_AREA_M2 = 4.0
CARRIAGEWAY_SEGMENT_M = 80.0
ENCLOSED_COVER_RATIO = 0.85
LOD0_CELL_M = 400.0
SHARD_CELL_M = 200.0

# Facades: storey limits of each band (inclusive), variants, storeys per tile, sheet width, display colour.
BAND_TOP_FLOOR = [("low", 3), ("mid", 8), ("high", 15)]
TOP_BAND = "tower"
FACADE_VARIANTS = {"low": 16, "mid": 12, "high": 8, "tower": 8}
FACADE_VARIANTS_DEFAULT = 16
FACADE_TILE_FLOORS = {"low": 3, "mid": 8, "high": 10, "tower": 14}
FACADE_TILE_FLOORS_DEFAULT = 3
FACADE_SHEET_WIDTH_M = {"low": 12.0, "mid": 16.0, "high": 20.0, "tower": 24.0}
FACADE_SHEET_WIDTH_DEFAULT_M = 12.0
FACADE_RGB = {
    "low": (0.72, 0.58, 0.42),
    "mid": (0.78, 0.74, 0.68),
    "high": (0.62, 0.68, 0.74),
    "tower": (0.55, 0.62, 0.72),
}
LOW_SHOP_VARIANTS = 8
ROOF_VARIANTS = 12
FACADE_TILE_UV_SCALE = 12.0
FACADE_TILE_U_CM = 600.0
ROOF_TILE_CM = 1500.0
FLAT_TILE_CM = 2000.0

SHOP_BUILDINGS = [
    "retail",
    "commercial",
    "shop",
    "supermarket",
    "kiosk",
    "warehouse",
    "industrial",
    "hangar",
    "garages",
    "garage",
]
SHOP_AMENITIES = [
    "restaurant",
    "cafe",
    "fast_food",
    "pharmacy",
    "bank",
    "bar",
    "pub",
    "marketplace",
    "fuel",
]

# Road surfaces by highway class, and the display colour of each surface.
ROAD_SURFACE = {
    "motorway": "highway",
    "trunk": "expressway",
    "primary": "national",
    "secondary": "provincial",
    "tertiary": "county",
    "residential": "asphalt",
    "unclassified": "asphalt",
    "living_street": "asphalt",
    "service": "cement",
    "footway": "path",
    "path": "path",
    "pedestrian": "pavement",
    "steps": "pavement",
    "cycleway": "pavement",
    "bridleway": "path",
    "track": "dirt",
    "construction": "dirt",
    "proposed": "dirt",
    "corridor": "pavement",
    "raceway": "asphalt",
    "busway": "asphalt",
    "junction": "asphalt",
}
ROAD_SURFACE_DEFAULT = "asphalt"
ROAD_RGB = {
    "highway": (0.12, 0.12, 0.14),
    "expressway": (0.16, 0.16, 0.18),
    "national": (0.18, 0.18, 0.20),
    "provincial": (0.22, 0.22, 0.22),
    "county": (0.24, 0.24, 0.23),
    "asphalt": (0.28, 0.28, 0.28),
    "cement": (0.45, 0.45, 0.42),
    "dirt": (0.45, 0.32, 0.18),
    "path": (0.55, 0.48, 0.32),
    "pavement": (0.52, 0.50, 0.46),
    "gravel": (0.40, 0.38, 0.34),
}

# Water and vegetation.
WATERWAY_WIDTH_M = {"river": 8.0, "stream": 3.0, "canal": 5.0}
WATERWAY_WIDTH_DEFAULT_M = 4.0
WATERWAY_KINDS = ["river", "stream", "canal"]
VEGETATION_LANDUSE = ["grass", "forest", "meadow"]

# Layer heights and draw distances, in metres.
LAYER_Z_M = {"water": -0.02, "vegetation": 0.05, "roads": 0.08, "buildings": 0.04}
CULL_M = {
    "building": (0.0, 1200.0),
    "lamp": (250.0, 400.0),
    "sign": (300.0, 500.0),
    "arrow": (80.0, 150.0),
    "tree": (400.0, 800.0),
}

# Raster codes.
FREE = 254
OCCUPIED = 0
UNKNOWN = 205
COST_FREE = 0
COST_LETHAL = 254
COST_UNKNOWN = 255
COST_MAX_INSCRIBED = 252
BUNDLE_FREE = 255
MAX_SLOPE = 0.35
RELIEF_HALF_SPAN_M = 50.0
RGBA_FREE = (40, 220, 80, 160)
RGBA_OCCUPIED = (220, 40, 40, 100)
RGBA_UNKNOWN = (180, 180, 180, 40)
HEIGHT_SIDE_PX = 2049
SQUARE_SIDE_PX = 2017

# WGS84 ellipsoid and the transverse Mercator grid of the UTM zones.
WGS84_A = 6378137.0
WGS84_F = 1.0 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EAST_M = 500000.0
UTM_FALSE_NORTH_SOUTH_M = 10000000.0

# Asset catalogue: file-name words, domains and browse folders.
LOW_RISE_SKIP_WORDS = [
    "church",
    "office",
    "factory",
    "warehouse",
    "construction",
    "empty",
    "corrugated",
    "derelict",
    "portacabin",
]
LOW_RISE_SHOP_WORDS = ["shop", "restaurant", "showroom", "pub", "garage", "loading_bay"]
LOW_RISE_HOME_WORDS = [
    "building_front",
    "building_h_windows",
    "building_modern",
    "building_side",
    "building_center",
    "windows",
]
SHEET_SKIP_WORDS = ["church", "empty", "construction", "portacabin", "corrugated"]
SHEET_INDUSTRIAL_WORDS = ["factory", "warehouse"]
PUBLIC_DOMAIN_LICENSES = ["pd", "pd-self", "pd-us"]
ASSET_BUCKETS = ["east_asia", "generic", "low_rise", "sheets", "signage", "details"]
ASSET_PARTS = ["facade", "roof", "decal"]
ASSET_BANDS = ["low", "mid", "high", "tower"]
ASSET_ROLES = {
    "east_asia": [],
    "generic": [],
    "low_rise": ["shop", "residential", "balcony"],
    "sheets": ["full", "office", "industrial"],
    "signage": ["vertical", "horizontal", "overlay"],
    "details": ["window", "door", "overlay"],
}
ROOF_METAL_WORDS = ["corrugat", "metal", "bitumen", "浪板", "iron", "steel", "copper"]
BALCONY_WORDS = ["_trim", "_objects", "balcony", "窗套"]
METAL_WALL_WORDS = ["corrugat", "factory_wall", "container", "asbestos", "浪板"]
CLADDING_WORDS = ["tile", "plaster", "cladding", "brick"]
GLASS_WORDS = ["skyscraper", "glass curtain", "glass"]
BAND_FOLDERS = {
    "low": ["facades/sheets/shopfront", "facades/sheets/residential", "facades/tileable/cladding"],
    "mid": ["facades/sheets/residential", "facades/tileable/cladding", "facades/tileable/midrise"],
    "high": ["facades/sheets/office", "facades/tileable/midrise", "facades/tileable/highrise"],
    "tower": ["facades/sheets/office", "facades/sheets/residential", "facades/tileable/highrise"],
}
LOW_SHOP_FOLDERS = ["facades/sheets/shopfront"]
LOW_HOME_FOLDERS = ["facades/sheets/residential", "facades/tileable/cladding"]
ROOF_FOLDERS = ["roofs/tile", "roofs/metal"]
PHOTO_SUFFIXES = ["jpg", "jpeg", "png"]
PHOTO_BANDS = {
    "low": ["Facade002", "Facade005", "Facade006", "Facade009", "Facade003"],
    "mid": ["Facade008", "Facade007", "Facade011", "Facade017"],
    "high": ["Facade014", "Facade013", "Facade012", "Facade010"],
    "tower": ["Facade001", "Facade018A", "Facade018B", "Facade020A"],
}
PHOTO_MIN_SIDE_PX = 600
PORTRAIT_RATIO = 1.25
SKIPPED_TITLE_WORDS = ["VIEW SOUTHEAST", "HABS"]
MIN_ASSET_BYTES = 1000
