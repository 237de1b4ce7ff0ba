"""Fixed values of the satellite time-series domain.

Everything here has to match the data that users already hold (band names, file
tokens, reference dates, mask classes), so the values are stated literally.
"""

# --- fixed values: bands --------------------------------------------------------
S2_BANDS = ["B02", "B03", "B04", "B05", "B06", "B07", "B08", "B8A", "B11", "B12"]
S2_MASK_BANDS = ["CLM", "SCL"]
S2_EXTRA_BANDS = [
    "SCL",
    "CLM",
    "sunAzimuthAngles",
    "sunZenithAngles",
    "viewAzimuthMean",
    "viewZenithMean",
    "dataMask",
]
S1_BANDS = ["VH", "VV", "local_incidence_angle"]
DEM_BANDS = ["DEM"]
WEATHER_SHORT_NAMES = {
    "dewpoint-temperature": "DEW_TEMP",
    "precipitation-flux": "PREC",
    "solar-radiation-flux": "SOL_RAD",
    "temperature-max": "TEMP_MAX",
    "temperature-mean": "TEMP_MEAN",
    "temperature-min": "TEMP_MIN",
    "vapour-pressure": "VAP_PRESS",
    "wind-speed": "WIND_SPEED",
}
WEATHER_BANDS = list(WEATHER_SHORT_NAMES)

# --- fixed values: modality -> directory token -------------------------------------
MODALITY_TOKENS = {
    "s2": "Sentinel2",
    "s1_asc": "Sentinel1_ASCENDING",
    "s1_desc": "Sentinel1_DESCENDING",
    "dem": "DEM",
    "dew_temp": "DEW_TEMP",
    "prec": "PREC",
    "sol_rad": "SOL_RAD",
    "temp_max": "TEMP_MAX",
    "temp_mean": "TEMP_MEAN",
    "temp_min": "TEMP_MIN",
    "val_press": "VAP_PRESS",
    "wind_speed": "WIND_SPEED",
}
SCENE_SUFFIX = "_clip.nc"
SCENE_STEM = "openEO_"
SAMPLE_SUFFIX = ".pt"
JOB_ID_PREFIX = "vito-"

# --- fixed values: which modalities an option selects ------------------------------
OPTIONS = {
    "all": ["s2", "s1_asc", "s1_desc", "dem", "agera5"],
    "s2": ["s2"],
    "s1": ["s1_asc", "s1_desc"],
    "s1_asc": ["s1_asc"],
    "s1_desc": ["s1_desc"],
    "s1s2": ["s2", "s1_asc"],
    "sentinel": ["s2", "s1_asc", "s1_desc"],
    "dem": ["dem"],
    "agera5": ["agera5"],
}
RAW_LENGTH_PRIORITY = ["s2", "s1_asc", "s1_desc", "dem"]
SAMPLE_LENGTH_PRIORITY = ["s2", "s1_asc", "s1_desc", "dem", "agera5"]

# --- fixed values: dates, thresholds, sizes ----------------------------------------
REFERENCE_DATE = "2014-03-03"
SERIES_START = "2017-01-01"
SERIES_END = "2020-12-31"
DEFAULT_RANGE = ("2017-01-01", "2017-12-31")
WINDOW_MONTHS = [6, 7, 8, 9, 10, 11, 12]
DAYS_PER_MONTH = 30
MAX_NODATA_FRACTION = 0.3
MISSING_ABOVE = 1e9
CLIP_HEADROOM = 100.0
SMALL_FILE_KIB = 50
CROP_SIZE = 128
STATS_CROP = 8
STATS_QMIN, STATS_QMAX = 0.05, 0.95
TRAIN_ROI = {"size": 5120, "per_tile": 10}
VAL_ROI = {"size": 1280, "per_tile": 30}

# --- fixed values: tile lists -------------------------------------------------------
TRAIN_TILES = [
    "30TXT", "31TBG", "31TDL", "31TEN", "32UMB", "32TPT", "32TPQ",
    "32UQD", "33TVM", "33UXR", "33TYJ", "34UEC", "34TFR",
]
VAL_TILES = ["30TYR", "31TEK", "32TNR", "32UPC", "33TXK", "34UDB"]
