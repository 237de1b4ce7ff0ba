"""Multimodal items from stored samples."""

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from skylattice.operators import stats
from skylattice.plans.items import ItemOption, load_items
from skylattice.sources.items import ItemStore

SCHEMA = "tile string, patch_id int, t date, h int, w int, b array<double>, clm array<int>"
DAY = datetime.date(2018, 1, 1)


def frame(tile, patch, day, value):
    t = None if day is None else DAY + datetime.timedelta(days=day)
    return (tile, patch, t, 4, 4, [None if i == 5 else float(value * 100 + i) for i in range(16)], [i % 2 for i in range(16)])


def store(spark, tmp_path, tables, buckets=4):
    made = ItemStore(spark, f"file://{tmp_path}/store", f"t_{uuid.uuid4().hex}", buckets)
    for name, rows in tables.items():
        made.write(name, spark.createDataFrame(rows, SCHEMA).repartition(3))
    return made


@pytest.fixture
def made(spark, tmp_path):
    optical = [frame("A", p, 10 * d, d) for p in range(3) for d in range(p + 1)]
    radar = [frame("A", 1, 3, 7), frame("B", 9, 4, 8)]
    return store(spark, tmp_path, {"s2": optical, "s1": radar, "dem": [frame("A", 0, None, 2), frame("A", 1, None, 3)]})


OPTIONS = [ItemOption("s2", ("b",), 2, masks=("clm",)), ItemOption("s1", ("b",)), ItemOption("dem", ("b",), 5)]


def test_items_have_each_modality_once(made):
    rows = {(r.tile, r.patch_id): r for r in load_items(made, OPTIONS, 4, 4, 2, 7).collect()}
    assert set(rows) == {("A", 0), ("A", 1), ("A", 2), ("B", 9)}
    one = rows["A", 0]
    assert one.s1 is None and one.s2.n_dates == 1 and one.s2.padd_mask == [False, True]
    assert one.s2.sits == [[[0.0, 6.0, 9.0, 10.0], [0.0] * 4]]  # the window's pixels; the missing one is 0
    assert one.s2.masks == [[[1, 0, 1, 0], [0] * 4]] and one.s2.doy[1] == 0
    assert one.dem.doy == [None] and one.dem.padd_mask == [False] and one.dem.sits == [[[0.0, 206.0, 209.0, 210.0]]]
    assert rows["A", 1].s1.n_dates == 1 and rows["A", 1].s1.sits[0][0][3] == 710.0
    chosen = rows["A", 2].s2
    assert chosen.n_dates == 2 and chosen.doy == sorted(chosen.doy) and chosen.padd_mask == [False, False]
    other = rows["B", 9]
    assert other.s2 is None and other.dem is None and other.s1.padd_mask == [False]


def test_items_need_no_exchange_of_pixels(made):
    loaded = load_items(made, OPTIONS, 4, 4, 2, 7)
    loaded.collect()
    seen = []

    def walk(node, above):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan(), above)
        if "QueryStageExec" in kind:
            return walk(node.plan(), above)
        if kind == "FileSourceScanExec":
            seen.append((node.simpleString(10_000), above))
        for i in range(node.children().size()):
            walk(node.children().apply(i), [*above, kind])

    walk(loaded._jdf.queryExecution().executedPlan(), [])
    pixels = [above for text, above in seen if "Bucketed: true" in text]
    assert len(pixels) == 3
    assert not any("ShuffleExchangeExec" in above for above in pixels)
    assert not any("BroadcastNestedLoopJoinExec" in above or "CartesianProductExec" in above for above in pixels)


def test_statistics_and_own_transform(spark, made):
    table = stats.band_stats(made.read("s2").select(F.lit("s2").alias("modality"), F.explode("b").alias("b")), ["b"])
    options = [
        ItemOption("s2", ("b",), 1, stats=table, transform=lambda v, band: v * 2 if band == "b" else v),
        ItemOption("s1", ("b",), 1, transform=lambda v, band: v + 1),
    ]
    s = table.first()
    for r in load_items(made, options, 4, 4, 4, 7).collect():
        if r.s2:
            raw = made.read("s2").where((F.col("tile") == r.tile) & (F.col("patch_id") == r.patch_id)).collect()
            scaled = [
                [2 * (min(max(v if v is not None else s.qmax + 1e9, s.qmin), s.qmax) - s.med) / (s.qmax - s.qmin) for v in x.b]
                for x in raw
            ]
            assert any(r.s2.sits[0][0] == pytest.approx(x) for x in scaled)
        if r.s1:
            assert r.s1.sits[0][0][0] % 100 == 1.0


def test_too_few_dates_are_an_error_if_strict(made):
    with pytest.raises(Exception, match="fewer than 2 dates of s2"):
        load_items(made, [ItemOption("s2", ("b",), 2, strict=True)], 4, 4, 2, 7).collect()
    with pytest.raises(ValueError, match="twice"):
        load_items(made, [OPTIONS[0], OPTIONS[0]], 4, 4, 2, 7)


def test_store_is_opened_again(spark, made):
    want = load_items(made, OPTIONS, 4, 4, 2, 7).orderBy("tile", "patch_id").collect()
    again = ItemStore(spark, made.path, f"t_{uuid.uuid4().hex}", made.buckets)  # as another session would
    assert load_items(again, OPTIONS, 4, 4, 2, 7).orderBy("tile", "patch_id").collect() == want


def test_random_window_is_shared_by_the_modalities(spark, tmp_path):
    rows = [frame("A", p, 0, 1) for p in range(20)]
    both = store(spark, tmp_path, {"s2": rows, "s1": rows})
    options = [ItemOption("s2", ("clm", "b")), ItemOption("s1", ("b",))]
    found = load_items(both, options, 4, 4, 2, 3, "random").collect()
    assert all(r.s2.sits[1] == r.s1.sits[0] for r in found)
    assert len({str(r.s1.sits) for r in found}) > 3
