"""Mergeable sketches and exact quantiles that start from them."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.operators.sketches import (
    Quantile,
    cell_of,
    merge_sketches,
    refined_quantiles,
    sketch,
    sketch_quantiles,
)
from skylattice.streaming.sketch_store import SketchStore, sketch_new_files, stored_stats

QS = [Quantile("med", 0.5), Quantile("low", 0.5, lower=True), Quantile("qmin", 0.05), Quantile("qmax", 0.95)]


def groups():
    draw = random.Random(4)
    return {
        "wide": [draw.lognormvariate(0, 3) * draw.choice([-1, 1]) for _ in range(3000)],
        "crowd": [1000 + draw.random() for _ in range(2000)] + [7.0] * 500,  # one cell holds most values
        "same": [3.5] * 400,
        "tiny": [2.0],
        "zero": [0.0, -0.0, 0.0, -1e-300, 1e300],
        None: [1.0, 2.0, 4.0],
    }


def frame(spark, found):
    rows = [(g, v) for g, values in found.items() for v in values]
    rows += [("wide", None), ("wide", float("nan")), ("nothing", None)]
    return spark.createDataFrame(rows, "g string, v double").repartition(3)


def want(values):
    low = sorted(values)[max(int(np.ceil(0.5 * len(values))) - 1, 0)]
    return [np.quantile(values, 0.5), low, np.quantile(values, 0.05), np.quantile(values, 0.95)]


@pytest.mark.parametrize("most, parts", [(4096, 2048), (50, 16), (1, 8)])
def test_refined_is_exact(spark, most, parts):
    """However small the cells that are sorted, and however coarse the divisions."""
    found = groups()
    if parts == 8:
        found = {g: values[:60] for g, values in found.items()}
    rows = frame(spark, found)
    out = refined_quantiles(rows, sketch(rows, ["g"], "v"), ["g"], "v", QS, most, parts).collect()
    assert {r.g for r in out} == set(found)
    for r in out:
        assert [r.med, r.low, r.qmin, r.qmax] == pytest.approx(want(found[r.g]), rel=1e-9, abs=1e-9), r.g


def test_sketch_alone_is_close(spark):
    """Lower medians are values of a rank; each lies within two percent."""
    found = groups()
    rows = frame(spark, found)
    for r in sketch_quantiles(sketch(rows, ["g"], "v"), ["g"], QS).collect():
        assert r.low == pytest.approx(want(found[r.g])[1], rel=0.02)


def test_sketches_add_up(spark):
    rows = frame(spark, groups()).withColumn("part", F.abs(F.xxhash64("v")) % 3)
    whole = sketch(rows, ["g"], "v")
    merged = merge_sketches(sketch(rows, ["part", "g"], "v"), ["g"])
    assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()


def test_cells_follow_the_order_of_values(spark):
    values = [float("-inf"), -1.7e308, -5.0, -1e-300, -5e-324, 0.0, 5e-324, 1e-300, 1.0, 1.01, 5.0, 1.7e308, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    cells = [r[0] for r in df.orderBy("v").select(cell_of(F.col("v"))).collect()]
    assert cells == sorted(cells) and cells[0] < cells[1] and cells[-1] > cells[-2] and cells[5] == 0
    assert df.where("v < 0").select(F.max(cell_of(F.col("v")))).first()[0] < 0


def test_empty(spark):
    rows = frame(spark, {}).where("false")
    assert refined_quantiles(rows, sketch(rows, ["g"], "v"), ["g"], "v", QS).count() == 0


def test_added_files_only_are_read(spark, tmp_path):
    data, store = str(tmp_path / "cube"), SketchStore(str(tmp_path / "store"))
    schema = "modality string, a double, b int"

    def add(values):
        rows = [("s2", float(v), v * 2) for v in values]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(data)

    def run():
        query = sketch_new_files(spark.readStream.schema(schema).parquet(data), store, ["a", "b"])
        query.awaitTermination()
        return sum(p.numInputRows for p in query.recentProgress)

    add(range(1, 101))
    assert run() == 100 and run() == 0
    add(range(101, 112))
    assert run() == 11
    cube = spark.read.schema(schema).parquet(data)
    exact = {r.band: r for r in stored_stats(spark, store, ["a", "b"], cube=cube).collect()}
    close = {r.band: r for r in stored_stats(spark, store).collect()}
    assert spark.read.parquet(store.cells).select("file").distinct().count() == 2
    values = np.arange(1, 112)
    for band, k in (("a", 1), ("b", 2)):
        for name, q in (("med", 0.5), ("qmin", 0.05), ("qmax", 0.95)):
            assert exact[band][name] == pytest.approx(np.quantile(values * k, q))
            assert close[band][name] == pytest.approx(np.quantile(values * k, q), rel=0.03)
    assert {r.band for r in stored_stats(spark, store, ["b"]).collect()} == {"b"}
    with pytest.raises(ValueError):
        stored_stats(spark, store, cube=cube)
