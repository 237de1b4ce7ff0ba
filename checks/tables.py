"""Cubes, frames, catalogs and regions derived from the given tables.

Every derivation is a projection (or a small aggregate) of one table, so what the queries
read grows with that table.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OPTICAL_BANDS = ["b02", "b03", "b04", "b08"]
RADAR_BANDS = ["vv", "vh"]
TILES = ["T0", "T1", "T2", "T3", "T4"]
GRID = 16


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _tile(key: str, n: int):
    return F.concat(F.lit("T"), (F.col(key) % n).cast("string"))


def _div(key: str, n: int):
    return F.floor(F.col(key) / n)


def _month(ts: str):
    return F.to_date(F.date_trunc("month", F.col(ts)))


def cube_s2(spark, sf) -> DataFrame:
    """Optical cube from lineitem; pixels may occur several times."""
    return table(spark, sf, "lineitem").select(
        F.lit("s2").alias("modality"),
        _tile("l_suppkey", 5).alias("tile"),
        (F.col("l_partkey") % 4).cast("int").alias("patch_id"),
        _month("l_shipdate").alias("t"),
        (F.col("l_orderkey") % GRID).cast("int").alias("y"),
        (_div("l_partkey", 4) % GRID).cast("int").alias("x"),
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_quantity")).alias("b02"),
        F.col("l_extendedprice").alias("b03"),
        F.col("l_discount").alias("b04"),
        F.col("l_tax").alias("b08"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("clm"),
        (F.col("l_quantity").cast("int") % 12).alias("scl"),
    )


def cube_s1(spark, sf) -> DataFrame:
    """Radar cube from orders; ``vh`` has zeros."""
    return table(spark, sf, "orders").select(
        F.lit("s1_asc").alias("modality"),
        _tile("o_custkey", 5).alias("tile"),
        (F.col("o_orderkey") % 4).cast("int").alias("patch_id"),
        _month("o_orderdate").alias("t"),
        (_div("o_orderkey", 4) % GRID).cast("int").alias("y"),
        (_div("o_orderkey", 64) % GRID).cast("int").alias("x"),
        F.col("o_totalprice").alias("vv"),
        ((F.col("o_orderkey") % 97).cast("double") / 10).alias("vh"),
        F.when(F.col("o_orderstatus") == "F", "DESCENDING").otherwise("ASCENDING").alias("orbit"),
    )


def raw_s2(spark, sf) -> DataFrame:
    """Optical cube as delivered: NaN and huge fill values instead of NULL."""
    nan = F.lit(float("nan"))
    return cube_s2(spark, sf).withColumns(
        {
            "b02": F.coalesce("b02", nan),
            "b03": F.col("b03") * F.lit(20000.0),
            "b08": F.when(F.col("b08") > 0, F.col("b08")).otherwise(nan),
        }
    )


def unique_s2(spark, sf) -> DataFrame:
    """Optical cube with one row per pixel."""
    keys = ["modality", "tile", "patch_id", "t", "y", "x"]
    bands = [*OPTICAL_BANDS, "clm", "scl"]
    return cube_s2(spark, sf).groupBy(*keys).agg(*[F.max(b).alias(b) for b in bands])


def scenes(spark, sf) -> DataFrame:
    """Scene metadata (tile, t): percentage of cloudy pixels."""
    return (
        cube_s2(spark, sf)
        .groupBy("tile", "t")
        .agg((F.lit(100.0) * F.sum("clm") / F.count("*")).alias("cloud_cover"))
    )


def weather(spark, sf) -> DataFrame:
    """Daily series per tile and variable, from events."""
    return (
        table(spark, sf, "events")
        .groupBy(
            _tile("user_id", 5).alias("tile"),
            F.to_date("ts").alias("t"),
            F.col("event_type").alias("variable"),
        )
        .agg(F.round(F.avg("value"), 6).alias("v"), F.count("*").alias("n"))
    )


def coarse_grid(spark, sf) -> DataFrame:
    """Static layer from part: 20 cells wide, as many rows as the table fills."""
    return table(spark, sf, "part").select(
        F.lit("DEM").alias("tile"),
        _div("p_partkey", 20).cast("int").alias("y"),
        (F.col("p_partkey") % 20).cast("int").alias("x"),
        F.col("p_retailprice").alias("v"),
    )


def weather_grid(spark, sf) -> DataFrame:
    """Yearly layers on a lon/lat grid of 0.1 degrees from orders: 24 x 24 cells with gaps."""
    rows = table(spark, sf, "orders").select(
        F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("t"),
        (F.col("o_orderkey") % 24).cast("int").alias("y"),
        (_div("o_custkey", 3) % 24).cast("int").alias("x"),
        F.col("o_totalprice").cast("double").alias("v"),
    )
    return rows.groupBy("t", "y", "x").agg(F.min("v").alias("temp"), F.max("v").alias("rain"))


def warp_grids(spark, sf) -> DataFrame:
    """20 x 20 target grids of 2.5 km in UTM zone 31, one per supplier, each with its own origin."""
    s = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("S"), s.cast("string")).alias("tile"),
        (F.lit(430000.0) + (s % 17) * 5003.0).alias("x0"),
        (F.lit(5100000.0) + (s % 13) * 7001.0).alias("y0"),
        F.lit(2500.0).alias("res"),
        F.lit(20).alias("h"),
        F.lit(20).alias("w"),
        F.lit(31).alias("zone"),
        F.lit(False).alias("south"),
    )


def frames(spark, sf) -> DataFrame:
    """8 x 8 single-band frames from embeddings; series have different lengths."""
    return table(spark, sf, "embeddings").select(
        F.concat(F.lit("T"), F.col("label").cast("string")).alias("tile"),
        _div("vec_id", 120).cast("int").alias("patch_id"),
        F.lit("s2").alias("modality"),
        F.date_add(F.lit("2017-01-01").cast("date"), ((F.col("vec_id") % 120) * 3).cast("int")).alias("t"),
        F.lit(8).alias("h"),
        F.lit(8).alias("w"),
        F.col("embedding").alias("pixels"),
    )


def dense_cube(spark, sf) -> DataFrame:
    """Cube of nearly whole 8 x 8 frames, from embeddings: optical and radar dates with absent
    pixels, and one layer without a date per patch."""
    pixels = frames(spark, sf).select("tile", "patch_id", "t", F.posexplode("pixels").alias("pos", "e"))
    pixels = pixels.withColumns(
        {"y": _div("pos", 8).cast("int"), "x": (F.col("pos") % 8).cast("int"), "v": F.col("e").cast("double")}
    )
    where = ["y", "x"]
    cloud = F.when(F.col("v") > 0.1, 1).otherwise(0).alias("clm")

    def layer(name, rows, value):
        return rows.select(F.lit(name).alias("modality"), "tile", "patch_id", "t", *where, value.alias("v"), cloud, F.lit(4).alias("scl"))

    static = pixels.groupBy("tile", "patch_id", *where).agg(F.max("v").alias("v"))
    static = static.withColumn("t", F.lit(None).cast("date"))
    return (
        layer("s2", pixels.where("v >= -0.065D"), F.col("v"))
        .unionByName(layer("s1_asc", pixels.where("v >= -0.075D"), F.col("v") * 3))
        .unionByName(layer("dem", static, F.col("v")))
    )


def tiles_metric(spark, sf) -> DataFrame:
    """Square footprints in metres, one per customer."""
    x = (F.col("c_custkey") % 100).cast("double") * 109800.0
    y = _div("c_custkey", 100).cast("double") * 109800.0
    return table(spark, sf, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("tile"),
        x.alias("xmin"),
        y.alias("ymin"),
        (x + 109800.0).alias("xmax"),
        (y + 109800.0).alias("ymax"),
    )


def tiles_lonlat(spark, sf) -> DataFrame:
    """One-degree footprints in lon/lat, one per customer."""
    lon = (F.col("c_custkey") % 36).cast("double") - 9.75
    lat = (_div("c_custkey", 36) % 30).cast("double") + 30.25
    return table(spark, sf, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("tile"),
        lon.alias("xmin"),
        lat.alias("ymin"),
        (lon + 1.0).alias("xmax"),
        (lat + 1.0).alias("ymax"),
    )


def rois(spark, sf) -> DataFrame:
    """Triangular regions on the pixel grid of the cubes (10 m pixels), one per supplier."""
    x = (F.col("s_suppkey") % 13).cast("double") * 10.0 + 2.0
    y = (_div("s_suppkey", 13) % 12).cast("double") * 10.0 + 2.0
    corner = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    return table(spark, sf, "supplier").select(
        _tile("s_suppkey", 5).alias("tile"),
        F.col("s_suppkey").cast("int").alias("roi"),
        F.array(
            corner(x, y), corner(x + 38.0, y), corner(x, y + 44.0), corner(x, y)
        ).alias("ring"),
    )


def scene_files(spark, sf) -> DataFrame:
    """Listing of yearly scene files: optical ones from lineitem, radar ones from orders.

    The tile is the supplier (customer), so the number of files grows with the tables.
    """

    def listing(name, tile, patch, day, token):
        rows = table(spark, sf, name).select(
            F.concat(F.lit("T"), F.col(tile).cast("string")).alias("tile"),
            (F.col(patch) % 6).cast("string").alias("patch"),
            F.year(day).cast("string").alias("year"),
        )
        path = F.concat_ws(
            "/",
            "tile",
            "year",
            F.concat_ws("_", F.lit(token), "tile", "year"),
            F.concat(F.lit("openEO_"), "patch", F.lit("_clip.nc")),
        )
        return rows.groupBy(path.alias("path")).agg((F.count("*") * 5000).alias("length"))

    optical = listing("lineitem", "l_suppkey", "l_partkey", "l_shipdate", "Sentinel2")
    radar = listing("orders", "o_custkey", "o_orderkey", "o_orderdate", "Sentinel1_ASCENDING")
    return optical.unionByName(radar)


def file_tiles(spark, sf) -> DataFrame:
    """All tiles of ``scene_files``: as many as the tables have suppliers and customers."""
    return scene_files(spark, sf).select(F.split_part("path", F.lit("/"), F.lit(1)).alias("tile")).distinct()


def roi_files(spark, sf) -> DataFrame:
    """Unclipped scene files ``T?/year/.../openEO_<region>.nc`` from lineitem."""
    path = F.concat(
        _tile("l_suppkey", 5),
        F.lit("/"),
        F.year("l_shipdate").cast("string"),
        F.lit("/S2/openEO_"),
        F.col("l_suppkey").cast("string"),
        F.lit(".nc"),
    )
    return table(spark, sf, "lineitem").groupBy(path.alias("path")).agg(
        F.count("*").alias("length")
    )


def sample_files(spark, sf) -> DataFrame:
    """Listing of stored samples from orders."""
    mod = F.when(F.col("o_orderkey") % 3 == 0, "s1_asc").otherwise("s2")
    path = F.concat(
        F.lit("root/"),
        _tile("o_custkey", 7),
        F.lit("/Patch_id_openEO_"),
        (F.col("o_orderkey") % 500).cast("string"),
        F.lit("_clip_id"),
        (F.col("o_custkey") % 3).cast("string"),
        F.lit("_"),
        mod,
        F.lit(".pt"),
    )
    return table(spark, sf, "orders").groupBy(path.alias("path")).agg(
        F.count("*").alias("length")
    )


def manifests(spark, sf) -> DataFrame:
    """Job-result manifests as JSON text, one per supplier; every fourth has no time range."""
    key = F.col("s_suppkey")
    extent = F.when(key % 4 == 0, F.lit("null")).otherwise(
        F.concat(F.lit('["'), (key % 4 + 2017).cast("string"), F.lit('-01-01","x"]'))
    )
    text = F.concat(
        F.lit('{"properties":{"title":"Sentinel2_'),
        F.col("s_name"),
        F.lit('","card4l:processing_chain":{"process_graph":{"loadcollection1":'),
        F.lit('{"arguments":{"temporal_extent":'),
        extent,
        F.lit('}},"filterspatial1":{"arguments":{"geometries":{"features":'),
        F.lit('[{"properties":{"Name":"T'),
        (F.col("s_nationkey") % 5).cast("string"),
        F.lit('"}}]}}}}}},"assets":{"openEO_'),
        key.cast("string"),
        F.lit('.nc":{"href":"u'),
        key.cast("string"),
        F.lit('"},"stac.json":{"href":"s"}}}'),
    )
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("j-"), key.cast("string")).alias("jobId"), text.alias("manifest")
    )


def region_cube(spark, sf) -> DataFrame:
    """Optical cube stored per region: patch_id is the region's number."""
    cube = table(spark, sf, "lineitem").select(
        F.lit("s2").alias("modality"),
        _tile("l_suppkey", 5).alias("tile"),
        F.col("l_suppkey").cast("int").alias("patch_id"),
        _month("l_shipdate").alias("t"),
        (F.col("l_orderkey") % GRID).cast("int").alias("y"),
        (_div("l_partkey", 4) % GRID).cast("int").alias("x"),
        F.col("l_quantity").alias("b02"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("clm"),
    )
    return cube
