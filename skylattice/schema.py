"""Keys and schemas shared by all operators.

* cube   - one row per (tile, patch_id, modality, t, y, x), one column per band.
* frames - one row per (tile, patch_id, modality, t), one row-major array per band.
* heads  - one row per sample with its time axis only (no pixels).
"""

from pyspark.sql import types as T

SCENE = ["tile", "patch_id"]
KEY = ["tile", "patch_id", "modality"]
FRAME = [*KEY, "t"]
PIXEL = [*FRAME, "y", "x"]

MANIFEST = (
    "properties struct<title string, `card4l:processing_chain` struct<process_graph struct<"
    "loadcollection1 struct<arguments struct<temporal_extent array<string>>>, "
    "filterspatial1 struct<arguments struct<geometries struct<features array<struct<"
    "properties struct<Name string>>>>>>>>>, "
    "assets map<string, struct<href string>>"
)

# coordinates nest one level deeper in a MultiPolygon; they are parsed by type
FEATURE_GEOMETRY = "struct<type string, coordinates string>"
POLYGON = "array<array<array<double>>>"
MULTI_POLYGON = "array<array<array<array<double>>>>"
ROI_FEATURE = (
    f"type string, properties struct<Name string, id bigint>, geometry {FEATURE_GEOMETRY}"
)
ROI_COLLECTION = (
    "type string, features array<struct<type string, "
    f"properties struct<Name string, id bigint>, geometry {FEATURE_GEOMETRY}>>"
)


def cube_schema(bands, band_type=None, patch_type=None):
    """Fixed cube schema for a modality's band list (double bands, integer patches)."""
    keys = [
        ("tile", T.StringType()),
        ("patch_id", patch_type or T.IntegerType()),
        ("modality", T.StringType()),
        ("t", T.DateType()),
        ("y", T.IntegerType()),
        ("x", T.IntegerType()),
    ]
    fields = keys + [(b, band_type or T.DoubleType()) for b in bands]
    return T.StructType([T.StructField(n, t) for n, t in fields])
