"""Fixed values the results depend on: grids, tables, thresholds."""

# --- fixed values: Web Mercator ---------------------------------------------
MERC_LAT = 85.0511287798066
MERC_LAT_INSET = 85.05112878
MERC_LAT_PLAIN = 85.0511
MERC_ORIGIN = 20037508.342789244
METRES_PER_PIXEL_Z0 = 156543.03392804097
METRES_PER_DEGREE = 111320.0
KM_PER_DEGREE = 111.32
FINEST_ZOOM = 24
GLOBAL_BOUNDS = (-180.0, -85.0511, 180.0, 85.0511)

# --- fixed values: sinusoidal product grid ----------------------------------
SINUSOIDAL_RADIUS = 6371007.181
SINUSOIDAL_TILE = 1111950.5196666666
SINUSOIDAL_COLS = 36
SINUSOIDAL_ROWS = 18

# --- fixed values: build shards, rectangles of the z6 grid (inclusive) -------
SHARD_ZOOM = 6
SHARD_RECTANGLES = (
    (0, 0, 18, 17),
    (0, 18, 18, 27),
    (19, 0, 35, 13),
    (19, 14, 35, 27),
    (0, 28, 17, 57),
    (0, 58, 17, 63),
    (18, 28, 35, 40),
    (18, 41, 35, 58),
    (18, 59, 35, 63),
    (36, 0, 48, 19),
    (49, 0, 63, 19),
    (36, 20, 45, 31),
    (46, 20, 63, 31),
    (36, 32, 49, 53),
    (50, 32, 63, 53),
    (36, 54, 44, 63),
    (45, 54, 52, 63),
    (53, 54, 63, 63),
)
UNASSIGNED_SHARD = "unassigned"

# --- fixed values: coarse land boxes (minx, miny, maxx, maxy) ----------------
LAND_BOXES = (
    (-170.0, -60.0, -30.0, 72.0),
    (-30.0, -40.0, 60.0, 75.0),
    (60.0, -10.0, 150.0, 80.0),
    (110.0, -60.0, 180.0, -10.0),
    (-45.0, -55.0, -10.0, -30.0),
    (20.0, -75.0, 160.0, -60.0),
    (-90.0, 10.0, -60.0, 30.0),
    (-170.0, -25.0, -140.0, 25.0),
    (150.0, -50.0, 180.0, -30.0),
)
POLAR_LAT = 75.0
LAND_BUFFER_KM = 20.0

# --- fixed values: season windows (name, hemisphere, from m/d, to m/d) -------
SEASONS = (
    ("northern_growing_season", "north", 4, 1, 10, 31),
    ("southern_growing_season", "south", 10, 1, 4, 30),
)

# --- fixed values: finest zoom the data of each source supports --------------
SOURCE_CEILINGS = {
    "bmng": 8,
    "hls": 12,
    "landsat-c2-l2": 12,
    "sentinel2": 14,
    "copernicus": 14,
    "gsi_orthophotos": 18,
    "modis": 8,
    "viirs": 8,
    "openaerialmap": 22,
}

# --- fixed values: quality-flag bits -----------------------------------------
QA_BITS = {
    "cirrus": 1,
    "cloud": 2,
    "adjacent_cloud": 4,
    "cloud_shadow": 8,
    "snow": 16,
    "snow_ice": 16,
    "water": 32,
}
QA_DEFAULT_FLAGS = ("cirrus", "cloud", "adjacent_cloud", "cloud_shadow", "snow")

# --- fixed values: display stretch (min, max, gamma) -------------------------
STRETCHES = {
    "hls": (0.0, 3000.0, 0.8),
    "modis": (0.0, 4000.0, 1.0),
    "viirs": (0.0, 9000.0, 0.8),
    "sentinel2": (0.0, 10000.0, 1.0),
}
RGB_BANDS = {
    "hls": ("B04", "B03", "B02"),
    "sentinel2": ("B04", "B03", "B02"),
    "modis": ("Band1", "Band4", "Band3"),
    "viirs": ("I1", "I2", "I3"),
}

# --- fixed values: media types, vector datasets, product layers --------------
MEDIA_EXTENSIONS = {
    "image/jpeg": "jpg",
    "image/jpg": "jpg",
    "image/png": "png",
    "image/webp": "webp",
}
MEDIA_COMPRESSION = {"image/jpeg": "JPEG", "image/jpg": "JPEG"}
VECTOR_DATASETS = {
    "admin_0": "countries",
    "admin0": "countries",
    "countries": "countries",
    "admin_1": "states",
    "admin1": "states",
    "states": "states",
    "provinces": "states",
}
VIIRS_LAYERS_NEW = ("SurfReflect_I1_1", "SurfReflect_I2_1", "SurfReflect_I3_1")
VIIRS_LAYERS_OLD = (
    "SurfReflect_I1",
    "SurfReflect_I2",
    "SurfReflect_I3",
    "SurfReflect_QC_I1",
    "SurfReflect_QC_I2",
    "SurfReflect_QC_I3",
)
TILE_SUFFIXES = ("jpg", "jpeg", "png", "webp")

# --- fixed values: tileset labels and credits per source ---------------------
SOURCE_CREDITS = {
    "modis": ("MODIS MCD43A4", "Imagery: NASA MODIS MCD43A4 (LP DAAC)."),
    "viirs": (
        "VIIRS Corrected Reflectance",
        "Imagery: NASA VIIRS Corrected Reflectance (LP DAAC).",
    ),
    "copernicus": (
        "Copernicus Sentinel-2 Level-2A",
        "Imagery: Copernicus Sentinel-2 (European Space Agency).",
    ),
    "sentinel2": (
        "Sentinel-2 L2A (Microsoft Planetary Computer)",
        "Imagery: Copernicus Sentinel-2 (European Space Agency).",
    ),
    "gsi_orthophotos": (
        "GSI Seamless Orthophoto",
        "Imagery: Geospatial Information Authority of Japan (GSI) Seamless Orthophotography.",
    ),
}
DEFAULT_CREDIT = (
    "NASA Blue Marble Next Generation (2004)",
    "Imagery: NASA Blue Marble (2004).",
)

# --- fixed values: transfer pacing (KiB/s floor, wait ranges in seconds) -----
THROTTLE_FLOOR_KIBPS = 150.0
JITTER_RANGE_S = (60.0, 300.0)
COOLDOWN_RANGE_S = (600.0, 900.0)
