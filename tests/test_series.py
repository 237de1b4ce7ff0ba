"""Merging into stored cubes, and scans pruned by dates and tiles."""

import itertools
from pathlib import Path

from pyspark.sql import functions as F

from skylattice.operators import merge, select
from skylattice.schema import PIXEL
from skylattice.sources import cubes, series


def cube(spark):
    return spark.range(240).select(
        F.concat(F.lit("T"), (F.col("id") % 3).cast("string")).alias("tile"),
        F.lit(0).alias("patch_id"),
        F.lit("s2").alias("modality"),
        F.date_add(F.lit("2016-06-01").cast("date"), ((F.col("id") % 20) * 60).cast("int")).alias("t"),
        (F.col("id") % 7).cast("int").alias("y"),
        F.col("id").cast("int").alias("x"),
        F.when(F.col("id") % 5 != 0, F.col("id").cast("double")).alias("b02"),
        (F.col("id") % 9).cast("float").alias("b03"),
    )


def static(spark):
    return cube(spark).where("x < 9").withColumns(
        {"t": F.lit(None).cast("date"), "modality": F.lit("dem")}
    )


def rows_of(df, columns=None):
    return sorted(map(tuple, df.select(columns or df.columns).collect()), key=str)


def deliveries(spark):
    """Overlapping parts; the second has gaps and NaN, the third disagrees here and there."""
    everything = cube(spark).unionByName(static(spark))
    nan = F.when(F.col("x") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("b02"))
    return [
        everything.where("y < 5"),
        everything.where("y > 2").withColumn("b02", nan),
        everything.where("y = 3").withColumn("b03", (F.col("b03") + (F.col("x") % 4 == 0).cast("int")).cast("float")),
    ]


def test_any_order_of_deliveries_equals_one_merge(spark, tmp_path):
    files = deliveries(spark)
    want, apart = merge.merge_series(*files), merge.merge_conflicts(*files)
    assert apart.count() > 0
    for i, order in enumerate([(0, 1, 2), (2, 0, 1, 2, 0)]):
        path = str(tmp_path / f"cube{i}")
        for k in order:
            series.merge_into(files[k], path)
        back = cubes.read_cube(spark, path, want.schema)
        assert rows_of(back, want.columns) == rows_of(want)
        kept = series.stored_conflicts(spark, path, want.schema)
        assert rows_of(kept, [*PIXEL, "band"]) == rows_of(apart, [*PIXEL, "band"])


def test_a_run_that_broke_off_is_repeated(spark, tmp_path):
    """Conflicts are written, pixels are not: the repeated run gives the same."""
    files, path = deliveries(spark), str(tmp_path / "cube")
    series.merge_into(files[0], path)
    before = cubes.read_cube(spark, path, files[0].schema)
    old = spark.createDataFrame(before.collect(), before.schema)
    series.merge_into(files[2], path)
    cubes.by_year(old).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    series.merge_into(files[2], path)
    want = merge.merge_series(files[0], files[2])
    assert rows_of(cubes.read_cube(spark, path, want.schema), want.columns) == rows_of(want)


def test_other_directories_keep_their_files(spark, tmp_path):
    path = tmp_path / "cube"
    series.merge_into(cube(spark), str(path))

    def files():
        return {f.relative_to(path): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}

    before = files()
    series.merge_into(cube(spark).where("tile = 'T1' and year(t) = 2017"), str(path))
    changed = {str(f.parent) for f, _ in before.items() ^ files().items()}
    assert changed == {"modality=s2/tile=T1/year=2017"}
    assert len(before) > 6


def test_an_empty_delivery_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "cube")
    series.merge_into(cube(spark), path)
    series.merge_into(cube(spark).where("false"), path)
    assert cubes.read_cube(spark, path, cube(spark).schema).count() == 240


def read_files(df):
    """Files that the scans of an executed plan opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "FileSourceScanExec" and "tile" in node.schema().toString() + node.toString() and "b02" in node.toString():
            found += node.metrics().apply("numFiles").value()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return found


def test_collections_open_only_their_years_and_tiles(spark, tmp_path):
    path = cubes.write_cube(cube(spark), str(tmp_path / "cube"))
    stored = cubes.read_cube(spark, path, cube(spark).schema, "s2")
    every = len(list(Path(path).rglob("*.parquet")))
    tiles = cube(spark).where("tile = 'T2'").select("tile")
    some = select.load_collection(stored, "2017-01-01", "2018-01-01", ["b02"], tiles)
    want = select.load_collection(cube(spark), "2017-01-01", "2018-01-01", ["b02"]).where("tile = 'T2'")
    assert rows_of(some) == rows_of(want) != []
    assert read_files(some) == len(list(Path(path).glob("modality=s2/tile=T2/year=2017/*.parquet"))) < every
    none = select.load_collection(stored, tiles=tiles.where("false"))
    assert none.count() == 0


def test_half_open_range_at_the_turn_of_a_year(spark, tmp_path):
    path = cubes.write_cube(cube(spark), str(tmp_path / "cube"))
    stored = cubes.read_cube(spark, path, cube(spark).schema)
    for start, end in itertools.product([None, "2016-12-31", "2017-01-01"], [None, "2017-12-31", "2018-01-01"]):
        got = select.load_collection(stored, start, end).drop("year")
        want = select.load_collection(cube(spark), start, end)
        assert rows_of(got, want.columns) == rows_of(want)
